"""Integrity controls, constraint counts and output contracts as one-row aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campuslens.operators.relational import KEY, Tables, wide_enrolment
from campuslens.vocabulary import MAX_GRADE



def control(name: str, df: DataFrame, value: Column | None = None) -> DataFrame:
    """One row (control, valor)."""
    value = F.count(F.lit(1)) if value is None else F.coalesce(value, F.lit(0))
    return df.agg(value.cast("bigint").alias("valor")).select(F.lit(name).alias("control"), "valor")


def controls(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Several (control, valor) rows from a single pass."""
    one = df.agg(*[F.coalesce(v, F.lit(0)).cast("bigint").alias(f"c{i}")
                   for i, v in enumerate(values.values())])
    cells = [F.struct(F.lit(n).alias("control"), F.col(f"c{i}").alias("valor"))
             for i, n in enumerate(values)]
    return one.select(F.explode(F.array(*cells)).alias("x")).select("x.*")


def stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def count_where(predicate: Column) -> Column:
    return F.count_if(predicate)


def not_three_grades(t: Tables, wanted: int = 3) -> DataFrame:
    """I-04: enrolments whose number of grades differs from three, zero included."""
    grades = t.calificacion.groupBy(*KEY).agg(F.count("periodo_id").alias("n"))
    return (t.matricula.select(*KEY).join(grades, KEY, "left")
            .select(*KEY, F.coalesce("n", F.lit(0)).alias("n")).where(F.col("n") != wanted))


def orphan_students(t: Tables) -> DataFrame:
    """I-05: students without enrolment."""
    return t.estudiante.join(t.matricula.select("estudiante_id"), "estudiante_id", "left_anti")


def orphan_enrolments(t: Tables) -> DataFrame:
    """I-06: enrolments of unknown students."""
    return t.matricula.join(t.estudiante.select("estudiante_id"), "estudiante_id", "left_anti")


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def table_counts(t: Tables) -> DataFrame:
    return stack([df.agg(F.count(F.lit(1)).alias("filas")).select(F.lit(n).alias("tabla"), "filas")
                  for n, df in t.named().items()])


def integrity_report(t: Tables, expected: dict[str, int] | None = None) -> DataFrame:
    """I-01 to I-11 with expected values; ``None`` expectations follow from the tables."""
    grade = F.col("nota")
    per_student = t.matricula.groupBy("estudiante_id").agg(F.count(F.lit(1)).alias("n"))
    found = stack([
        control("I-01 estudiantes", t.estudiante),
        controls(per_student, {"I-02 matriculas": F.sum("n"),
                               "I-07 estudiantes_en_ambas": count_where(F.col("n") == 2)}),
        controls(t.calificacion, {
            "I-03 calificaciones": F.count(F.lit(1)),
            "I-08 notas_fuera_dominio": count_where(~grade.between(0, MAX_GRADE)),
            "I-09 calificaciones_no_evaluadas": count_where(F.col("no_evaluado"))}),
        control("I-04 matriculas_sin_3_notas", not_three_grades(t)),
        control("I-05 estudiantes_sin_matricula", orphan_students(t)),
        control("I-06 matriculas_huerfanas", orphan_enrolments(t)),
        control("I-10 filas_origen_duplicadas",
                duplicate_groups(t.matricula, ["archivo_origen", "fila_origen"])),
        control("I-11 filas_vista_integracion", wide_enrolment(t)),
    ])
    wanted = F.lit(0).cast("bigint")
    for name, value in (expected or {}).items():
        wanted = F.when(F.col("control").startswith(name + " "), F.lit(value)).otherwise(wanted)
    return found.withColumn("esperado", wanted.cast("bigint"))


def failed_controls(report: DataFrame) -> DataFrame:
    return report.where(F.col("valor") != F.col("esperado"))


def require(report: DataFrame) -> None:
    """Aborts a load when a control differs; the report has a fixed handful of rows."""
    bad = failed_controls(report).collect()
    if bad:
        raise ValueError("integrity controls failed: " + "; ".join(
            f"{r['control']}={r['valor']} (expected {r['esperado']})" for r in bad))


def foreign_key(name: str, child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is missing in the parent, counted over distinct keys first."""
    per_key = child.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return control(name, per_key.join(parent.select(*keys), keys, "left_anti"), F.sum("n"))


def unique(name: str, df: DataFrame, keys: list[str]) -> DataFrame:
    return control(name, duplicate_groups(df, keys))


def constraint_report(t: Tables, grade_range=(0, MAX_GRADE), absences=(0, 93)) -> DataFrame:
    """Violations of every primary key, unique key, foreign key and CHECK."""
    m, c = t.matricula, t.calificacion
    return stack([
        unique("pk estudiante", t.estudiante, ["estudiante_id"]),
        unique("pk matricula", m, KEY),
        unique("pk calificacion", c, KEY + ["periodo_id"]),
        unique("uq matricula origen", m, ["archivo_origen", "fila_origen"]),
        foreign_key("fk estudiante escuela", t.estudiante, t.escuela, ["escuela_id"]),
        foreign_key("fk matricula estudiante", m, t.estudiante, ["estudiante_id"]),
        foreign_key("fk matricula asignatura", m, t.asignatura, ["asignatura_id"]),
        foreign_key("fk calificacion matricula", c, m, KEY),
        foreign_key("fk calificacion periodo", c, t.periodo, ["periodo_id"]),
        controls(m, {
            "ck reprobaciones_previas": count_where(~F.col("reprobaciones_previas").between(0, 3)),
            "ck faltas": count_where(~F.col("faltas").between(*absences)),
            "ck fila_origen": count_where(F.col("fila_origen") < 2)}),
        controls(c, {
            "ck nota": count_where(~F.col("nota").between(*grade_range)),
            "ck no_evaluado": count_where(F.col("no_evaluado") & (F.col("nota") != 0))}),
        controls(t.estudiante, {
            "ck edad": count_where(~F.col("edad").between(15, 22)),
            "ck sexo": count_where(~F.col("sexo").isin("F", "M")),
            "ck zona": count_where(~F.col("zona").isin("Urbana", "Rural")),
            "ck educ": count_where(~(F.col("educ_madre").between(0, 4)
                                     & F.col("educ_padre").between(0, 4))),
            "ck ordinales": count_where(~(F.col("tiempo_viaje").between(1, 4)
                                          & F.col("tiempo_estudio").between(1, 4)
                                          & F.col("salud").between(1, 5)))}),
    ])


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """R-02: nulls per column in one pass."""
    columns = columns or df.columns
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    cells = [F.struct(F.lit(c).alias("columna"), F.col(c).alias("nulos")) for c in columns]
    return one.select(F.explode(F.array(*cells)).alias("x")).select("x.*")


def domain_violations(df: DataFrame, nominal: dict[str, list[str]],
                      numeric: dict[str, tuple]) -> DataFrame:
    """R-04 and R-05: values outside the declared domains per column; null counts as outside."""
    tests = {c: ~F.coalesce(F.col(c).isin(*dom), F.lit(False)) for c, dom in nominal.items()}
    tests |= {c: ~F.coalesce(F.col(c).between(lo, hi), F.lit(False))
              for c, (lo, hi) in numeric.items()}
    one = df.agg(*[F.count_if(p).alias(c) for c, p in tests.items()])
    cells = [F.struct(F.lit(c).alias("columna"),
                      F.lit("R-04" if c in nominal else "R-05").alias("regla"),
                      F.col(c).alias("violaciones")) for c in tests]
    return one.select(F.explode(F.array(*cells)).alias("x")).select("x.*")


def dataset_contract(df: DataFrame, keys: list[str], required: list[str],
                     predicates: dict[str, Column]) -> DataFrame:
    """Uniqueness, nulls in required columns and domain predicates; every value must be 0."""
    nulls = F.lit(False)
    for c in required:
        nulls = nulls | F.col(c).isNull()
    return stack([
        unique("clave duplicada", df, keys),
        controls(df, {"nulos en obligatorias": count_where(nulls),
                      **{n: count_where(~F.coalesce(p, F.lit(False)))
                         for n, p in predicates.items()}}),
    ])

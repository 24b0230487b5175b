"""Wide view and analytic queries over the six normalised tables (A-01 to A-04)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campuslens.operators.running import quantiles
from campuslens.vocabulary import PASS_MARK, PERIOD_CODES

KEY = ["estudiante_id", "asignatura_id"]


@dataclass
class Tables:
    """The normalised model. Dimensions (school, subject, period) are small by nature, but no
    join hints them: the planner broadcasts by measured size and falls back to a shuffle."""
    escuela: DataFrame
    asignatura: DataFrame
    periodo: DataFrame
    estudiante: DataFrame
    matricula: DataFrame
    calificacion: DataFrame

    def named(self) -> dict[str, DataFrame]:
        return dict(self.__dict__)

    def subject_codes(self) -> DataFrame:
        return self.asignatura.select("asignatura_id", F.col("codigo").alias("asignatura"))

    def school_codes(self) -> DataFrame:
        return self.escuela.select("escuela_id", F.col("codigo").alias("escuela"))

    def period_codes(self) -> DataFrame:
        return self.periodo.select("periodo_id", F.col("codigo").alias("periodo"), "orden")


def wide_enrolment(t: Tables) -> DataFrame:
    """One row per enrolment. Grades fold to one row per enrolment before they meet the
    other tables, so the six-way join moves enrolments, not grades."""
    graded = t.calificacion.join(t.period_codes(), "periodo_id")
    cells = []
    for code in PERIOD_CODES:
        here = F.col("periodo") == code
        cells.append(F.max(F.when(here, F.col("nota"))).alias(f"nota_{code.lower()}"))
        cells.append(F.bool_or(F.when(here, F.col("no_evaluado")))
                     .alias(f"no_evaluado_{code.lower()}"))
    grades = graded.groupBy(*KEY).agg(*cells)
    both = t.matricula.groupBy("estudiante_id").agg(
        (F.count(F.lit(1)) == 2).alias("en_ambas_asignaturas"))
    return (t.matricula.join(grades, KEY)
            .join(t.estudiante, "estudiante_id").join(both, "estudiante_id")
            .join(t.subject_codes(), "asignatura_id").join(t.school_codes(), "escuela_id")
            .drop("asignatura_id", "escuela_id"))


def unpivot_grades(register: DataFrame, keys: list[str], grades: dict[str, int]) -> DataFrame:
    """R-14: one row per enrolment and period, flagged when the grade is 0 (R-08)."""
    wide = register.select(*keys, *[F.col(g).cast("int").alias(g) for g in grades])
    long = wide.unpivot(keys, list(grades), "_g", "nota")
    period = F.lit(None).cast("short")
    for g, number in grades.items():
        period = F.when(F.col("_g") == g, F.lit(number).cast("short")).otherwise(period)
    return long.select(*keys, period.alias("periodo_id"), "nota",
                       (F.col("nota") == 0).alias("no_evaluado"))


def grade_stats(t: Tables) -> DataFrame:
    """A-01. Grades live on a 0-20 scale, so the exact median buffers at most 21 counts."""
    cal = t.calificacion.join(t.subject_codes(), "asignatura_id").join(t.period_codes(), "periodo_id")
    group = ["asignatura", "periodo"]
    evaluated = ~F.col("no_evaluado")
    grade = F.when(evaluated, F.col("nota"))
    moments = cal.groupBy(*group).agg(
        F.count_if(evaluated).alias("n_evaluados"),
        F.round(F.avg(grade), 2).alias("media"),
        F.round(F.stddev_samp(grade), 2).alias("desv_est"),
        F.percentile(grade, F.lit(0.5)).alias("mediana"),
        F.count_if(F.col("no_evaluado")).alias("n_no_evaluados"))
    return moments.orderBy(*group)


def fail_rate_by_school(t: Tables, final: str = "P3") -> DataFrame:
    """A-02. Grades count per (student, subject) first: the star join then moves one row per
    enrolment key."""
    last = t.period_codes().where(F.col("periodo") == final).select("periodo_id")
    per_key = t.calificacion.join(last, "periodo_id").groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("nota") < PASS_MARK).alias("k"),
        F.count_if(F.col("no_evaluado")).alias("ne"))
    rows = (per_key.join(t.matricula.select(*KEY), KEY)
            .join(t.estudiante.select("estudiante_id", "escuela_id"), "estudiante_id")
            .join(t.school_codes(), "escuela_id").join(t.subject_codes(), "asignatura_id"))
    out = rows.groupBy("escuela", "asignatura").agg(
        F.sum("n").alias("n_matriculas"), F.sum("k").alias("n_reprobados"),
        F.sum("ne").alias("n_no_evaluados"))
    return out.select(
        "escuela", "asignatura", "n_matriculas", "n_reprobados",
        F.round(F.col("n_reprobados") / F.col("n_matriculas"), 4).alias("tasa_reprobacion"),
        "n_no_evaluados").orderBy(F.desc("tasa_reprobacion"), "escuela", "asignatura")


def p1_p3_transition(t: Tables) -> DataFrame:
    """A-03. The primary key allows one grade per period, so the self-join is one conditional
    aggregation per enrolment."""
    def passed(period: int):
        return F.max(F.when(F.col("periodo_id") == period, F.col("nota")))
    pairs = (t.calificacion.groupBy(*KEY).agg(passed(1).alias("n1"), passed(3).alias("n3"))
             .where(F.col("n1").isNotNull() & F.col("n3").isNotNull())
             .join(t.subject_codes(), "asignatura_id"))
    def state(col: str, code: str):
        return F.when(F.col(col) >= PASS_MARK, f"aprueba_{code}").otherwise(f"reprueba_{code}")
    return (pairs.groupBy("asignatura", state("n1", "P1").alias("estado_p1"),
                          state("n3", "P3").alias("estado_p3"))
            .agg(F.count(F.lit(1)).alias("n")).orderBy("asignatura", "estado_p1", "estado_p3"))


def fail_rate_by_prior(t: Tables, final: int = 3) -> DataFrame:
    """A-04. The period predicate sits with the join and reaches the scan."""
    last = t.calificacion.where(F.col("periodo_id") == final)
    return (t.matricula.join(last, KEY).groupBy("reprobaciones_previas").agg(
        F.count(F.lit(1)).alias("n_matriculas"),
        F.round(F.avg(F.when(F.col("nota") < PASS_MARK, 1.0).otherwise(0.0)), 4)
        .alias("tasa_reprobacion")).orderBy("reprobaciones_previas"))


def period_rows(wide: DataFrame, keep: list[str]) -> DataFrame:
    """Grade and flag pairs of the wide view as rows."""
    cells = F.array(*[F.struct(F.lit(c).alias("periodo"), F.col(f"nota_{c.lower()}").alias("nota"),
                               F.col(f"no_evaluado_{c.lower()}").alias("no_ev"))
                      for c in PERIOD_CODES])
    return wide.select(*keep, F.explode(cells).alias("_c")).select(*keep, "_c.*")


def period_means(wide: DataFrame, group: list[str]) -> DataFrame:
    """Mean and sample deviation of evaluated grades, and the naive mean with zeros."""
    rows = period_rows(wide, group)
    grade = F.when(~F.col("no_ev"), F.col("nota"))
    return rows.groupBy(*group, "periodo").agg(
        F.count(grade).alias("n"), F.avg(grade).alias("media"),
        F.stddev_samp(grade).alias("de"), F.avg("nota").alias("media_con_ceros"))


def early_alert_level(prior: str = "reprobaciones_previas", grade: str = "nota_p1"):
    """Alert level from the first grade and prior failures (deterministic part of the rule)."""
    return (F.when(F.col(grade) < 8, "alto")
            .when((F.col(grade) < PASS_MARK) | (F.col(prior) >= 2), "medio").otherwise("ninguno"))


def grand_total(df: DataFrame, key: str, aggs: list, total: str = "Total") -> DataFrame:
    """Group rows plus one total row in a single pass."""
    out = df.rollup(key).agg(F.grouping(key).alias("_g"), *aggs)
    return out.withColumn(key, F.when(F.col("_g") == 1, total).otherwise(F.col(key))).drop("_g")


def spread_text(df: DataFrame, group: list[str], value: str, name: str,
                small_domain: bool = True) -> DataFrame:
    """Median [Q1–Q3] as text, half-even like the published tables."""
    q = quantiles(df, group, value, {"_a": 0.5, "_b": 0.25, "_c": 0.75}, small_domain)
    txt = F.concat(F.bround("_a", 0).cast("int"), F.lit(" ["), F.bround("_b", 0).cast("int"),
                   F.lit("–"), F.bround("_c", 0).cast("int"), F.lit("]"))
    return q.select(*group, txt.alias(name))

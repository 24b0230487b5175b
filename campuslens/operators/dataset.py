"""Analytic dataset: one row per enrolment, 58 typed columns, one lazy plan over both sides."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campuslens.operators.outliers import above_mean_flag, outlier_fence
from campuslens.operators.split import SEED, grouped_split
from campuslens.vocabulary import PASS_MARK

KEY = ["estudiante_id", "asignatura"]
#: What ``derive`` looks at, besides the key.
DERIVED_FROM = ["reprobaciones_previas", "nota_p3", "no_evaluado_p3", "faltas"]


@dataclass(frozen=True)
class Variable:
    name: str
    type: str
    domain: str
    origin: str
    source: str
    rule: str


def _v(names: str, type_: str, domain: str, origin: str, source: str, rule: str = "—"):
    return [Variable(n, type_, domain, origin, source, rule) for n in names.split()]


# Names, types, domains and lineage of the 58 output columns, in output order.
DICTIONARY: list[Variable] = [
    *_v("estudiante_id", "bigint", ">= 1", "F1 real", "matricula.estudiante_id", "R-12"),
    *_v("asignatura", "string", "MAT, POR", "F1 real", "asignatura.codigo", "R-06"),
    *_v("escuela", "string", "GP, MS", "F1 real", "escuela.codigo", "R-06"),
    *_v("sexo", "string", "F, M", "F1 real", "estudiante.sexo", "R-06"),
    *_v("edad", "tinyint", "15–22", "F1 real", "estudiante.edad"),
    *_v("zona", "string", "Urbana, Rural", "F1 real", "estudiante.zona", "R-06"),
    *_v("tamano_familia", "string", "<=3, >3", "F1 real", "estudiante.tamano_familia", "R-06"),
    *_v("estado_padres", "string", "Juntos, Separados", "F1 real", "estudiante.estado_padres", "R-06"),
    *_v("educ_madre educ_padre", "tinyint", "0–4", "F1 real", "estudiante"),
    *_v("trabajo_madre trabajo_padre", "string", "5 niveles", "F1 real", "estudiante", "R-06"),
    *_v("motivo_eleccion", "string", "4 niveles", "F1 real", "estudiante.motivo_eleccion", "R-06"),
    *_v("tutor_legal", "string", "madre, padre, otro", "F1 real", "estudiante.tutor_legal", "R-06"),
    *_v("tiempo_viaje tiempo_estudio", "tinyint", "1–4", "F1 real", "estudiante"),
    *_v("apoyo_escolar apoyo_familiar actividades guarderia desea_superior internet "
        "relacion_romantica", "boolean", "V/F", "F1 real", "estudiante", "R-06"),
    *_v("relacion_familiar tiempo_libre salidas alcohol_semana alcohol_finde salud", "tinyint",
        "1–5", "F1 real", "estudiante"),
    *_v("reprobaciones_previas", "tinyint", "0–3 (3 = 3+)", "F1 real",
        "matricula.reprobaciones_previas", "R-07"),
    *_v("reprobaciones_3mas", "boolean", "V/F", "Derivada", "reprobaciones_previas = 3", "R-07"),
    *_v("clases_pagadas", "boolean", "V/F", "F1 real", "matricula.clases_pagadas", "R-06"),
    *_v("faltas", "smallint", "0–93", "F1 real", "matricula.faltas"),
    *_v("faltas_confiable", "boolean", "V/F", "Derivada", "matricula.faltas_confiable", "R-09"),
    *_v("faltas_atipicas", "boolean", "V/F", "Derivada", "faltas > Q3 + 3·RIC", "R-10"),
    *_v("nota_p1 nota_p2 nota_p3", "tinyint", "0–20", "F1 real", "calificacion.nota", "R-14"),
    *_v("no_evaluado_p1 no_evaluado_p2 no_evaluado_p3", "boolean", "V/F", "Derivada",
        "calificacion.no_evaluado", "R-08"),
    *_v("en_ambas_asignaturas", "boolean", "V/F", "Derivada", "COUNT(matricula) = 2", "R-12"),
    *_v("en_riesgo", "tinyint", "0/1", "Derivada (objetivo)", "nota_p3 < 10", "DEF-01"),
    *_v("rendimiento_sobre_promedio", "boolean", "V/F/NA", "Derivada", "nota_p3 > media", "P2"),
    *_v("sim_lms_eventos_p1 sim_lms_minutos_p1", "int", ">= 0", "F2 SIMULADO", "AG-01, P1", "R-26"),
    *_v("sim_lms_dias_activos_p1 sim_lms_tareas_revisadas_p1", "smallint", ">= 0", "F2 SIMULADO",
        "AG-01, P1", "R-26"),
    *_v("sim_lms_eventos_total sim_lms_minutos_total", "int", ">= 0", "F2 SIMULADO",
        "AG-01, P1–P3", "R-26"),
    *_v("sim_n_tutorias sim_n_tutorias_completadas", "smallint", ">= 0", "F3 SIMULADO", "AG-02",
        "R-26"),
    *_v("sim_n_alertas", "smallint", ">= 0", "F3 SIMULADO", "AG-03", "R-26"),
    *_v("sim_nivel_alerta_max", "tinyint", "0–3", "F3 SIMULADO", "AG-03", "R-26"),
    *_v("sim_alerta_cerrada", "boolean", "V/F", "F3 SIMULADO", "AG-03", "R-26"),
    *_v("particion", "string", "train, test", "Derivada", "pliegue 1 de 5 por estudiante", "L-04"),
    *_v("archivo_origen", "string", "archivo", "Linaje", "matricula.archivo_origen"),
    *_v("fila_origen", "bigint", ">= 2", "Linaje", "matricula.fila_origen"),
]
NULLABLE = ["rendimiento_sobre_promedio"]
REQUIRED = [v.name for v in DICTIONARY if v.name not in NULLABLE]


def integrate(wide: DataFrame, activity: DataFrame, sessions: DataFrame,
              alerts: DataFrame) -> DataFrame:
    """Wide view left-joined to the behaviour aggregates; no record means no activity (R-26).

    The activity is folded to one row per enrolment first, P1 columns and totals together, so
    the chain has three 1:1 joins on one key and no fan-out."""
    p1 = F.col("periodo") == "P1"

    def first(c):
        return F.sum(F.when(p1, F.col(c)))
    lms = activity.groupBy(*KEY).agg(
        first("n_eventos").alias("sim_lms_eventos_p1"), first("minutos").alias("sim_lms_minutos_p1"),
        first("dias_activos").alias("sim_lms_dias_activos_p1"),
        first("n_tareas_revisadas").alias("sim_lms_tareas_revisadas_p1"),
        F.sum("n_eventos").alias("sim_lms_eventos_total"),
        F.sum("minutos").alias("sim_lms_minutos_total"))
    tut = sessions.select(*KEY, F.col("n_tutorias").alias("sim_n_tutorias"),
                          F.col("n_tutorias_completadas").alias("sim_n_tutorias_completadas"))
    ale = alerts.select(*KEY, F.col("n_alertas").alias("sim_n_alertas"),
                        F.col("nivel_alerta_max").alias("sim_nivel_alerta_max"),
                        F.col("alerta_cerrada").alias("sim_alerta_cerrada"))
    out = wide.join(lms, KEY, "left").join(tut, KEY, "left").join(ale, KEY, "left")
    return out.na.fill(0, [c for c in out.columns if c.startswith("sim_")])


def at_risk() -> Column:
    return (F.col("nota_p3") < PASS_MARK).cast("int")


def derive(df: DataFrame, seed: int = SEED) -> DataFrame:
    """R-07, R-10, DEF-01, above-mean flag and the grouped split."""
    df = df.withColumns({"reprobaciones_3mas": F.col("reprobaciones_previas") == 3,
                         "en_riesgo": at_risk()})
    df = outlier_fence(df, ["asignatura"], "faltas", "faltas_atipicas", small_domain=True)
    df = above_mean_flag(df, ["asignatura"], "nota_p3", ~F.col("no_evaluado_p3"),
                         "rendimiento_sobre_promedio")
    return grouped_split(df, "estudiante_id", "en_riesgo", seed=seed)


def typed(df: DataFrame) -> DataFrame:
    """Dictionary order and types."""
    return df.select(*[F.col(v.name).cast(v.type).alias(v.name) for v in DICTIONARY])


def register_columns(wide: DataFrame) -> DataFrame:
    """The columns of the dataset that the wide view has, and the outcome, without the behaviour. Rows
    without a student are left out, as the split leaves them out."""
    out = wide.where(F.col("estudiante_id").isNotNull()).withColumn("en_riesgo", at_risk())
    return out.select(*[F.col(v.name).cast(v.type).alias(v.name) for v in DICTIONARY if v.name in out.columns])


def profile_dictionary(df: DataFrame) -> DataFrame:
    """The dictionary next to what the data hold: rows, nulls, smallest and largest value."""
    names = [v.name for v in DICTIONARY]
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count(n).alias(f"c_{n}") for n in names],
                 *[F.min(n).cast("string").alias(f"lo_{n}") for n in names],
                 *[F.max(n).cast("string").alias(f"hi_{n}") for n in names])
    cells = [F.struct(
        F.lit(v.name).alias("variable"), F.lit(v.type).alias("tipo"), F.lit(v.domain).alias("dominio"),
        F.lit(v.origin).alias("origen"), F.lit(v.source).alias("fuente_campo"),
        F.lit(v.rule).alias("regla"), F.col("_n").alias("filas"),
        (F.col("_n") - F.col(f"c_{v.name}")).alias("nulos"), F.col(f"lo_{v.name}").alias("minimo"),
        F.col(f"hi_{v.name}").alias("maximo")) for v in DICTIONARY]
    return one.select(F.explode(F.array(*cells)).alias("x")).select("x.*")

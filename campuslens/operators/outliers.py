"""Group-relative flags: the group statistic is aggregated and joined back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campuslens.operators.running import quantiles
from campuslens.session import bounded


def attach_group(df: DataFrame, stats: DataFrame, keys: list[str], label: str) -> DataFrame:
    return df.join(bounded(stats, label), keys, "left")


def outlier_fence(df: DataFrame, group: list[str], value: str, flag: str, factor: float = 3.0,
                  small_domain: bool = False) -> DataFrame:
    """Flags values strictly above Q3 + factor * (Q3 - Q1) of their group; all rows are kept."""
    q = quantiles(df, group, value, {"_q1": 0.25, "_q3": 0.75}, small_domain)
    fence = F.col("_q3") + factor * (F.col("_q3") - F.col("_q1"))
    return (attach_group(df, q, group, "fence")
            .withColumn(flag, F.col(value) > fence).drop("_q1", "_q3"))


def above_mean_flag(df: DataFrame, group: list[str], value: str, evaluated: Column,
                    flag: str) -> DataFrame:
    """Above the mean of the evaluated rows of its group; null where not evaluated."""
    means = df.groupBy(*group).agg(F.avg(F.when(evaluated, F.col(value))).alias("_mean"))
    return (attach_group(df, means, group, "means")
            .withColumn(flag, F.when(evaluated, F.col(value) > F.col("_mean"))).drop("_mean"))


def register_factors(df: DataFrame, group: list[str] = ["asignatura"]) -> DataFrame:
    """High absences (>= Q3) and prior failures, which the register alone gives."""
    q3 = quantiles(df, group, "faltas", {"_q75": 0.75}, small_domain=True)
    return attach_group(df, q3, group, "q75").withColumns({
        "f_inasistencia": F.col("faltas") >= F.col("_q75"),
        "f_reprob_previas": F.col("reprobaciones_previas") >= 1,
    }).drop("_q75")


def risk_factors(df: DataFrame, group: list[str] = ["asignatura"]) -> DataFrame:
    """High absences (>= Q3), prior failures, low activity (<= Q1); quartiles use all rows."""
    q1 = quantiles(df, group, "sim_lms_minutos_p1", {"_q25": 0.25})
    out = attach_group(register_factors(df, group), q1, group, "q25").withColumn(
        "f_bajo_lms", F.col("sim_lms_minutos_p1") <= F.col("_q25"))
    real = F.col("f_inasistencia").cast("int") + F.col("f_reprob_previas").cast("int")
    return out.withColumns({
        "n_factores_reales": real,
        "n_factores_total": real + F.col("f_bajo_lms").cast("int"),
    }).drop("_q25")

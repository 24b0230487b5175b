"""School calendar: closed date ranges with gaps between them."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Period:
    code: str
    order: int
    grade: str
    start: date
    end: date
    name: str


# School year 2005-2006, both ends inclusive.
SCHOOL_YEAR = (
    Period("P1", 1, "G1", date(2005, 9, 15), date(2005, 12, 16), "1.er período (sep–dic 2005)"),
    Period("P2", 2, "G2", date(2006, 1, 3), date(2006, 3, 24), "2.º período (ene–mar 2006)"),
    Period("P3", 3, "G3", date(2006, 4, 10), date(2006, 6, 16),
           "3.er período / nota final (abr–jun 2006)"),
)

PERIOD_SCHEMA = T.StructType([
    T.StructField("periodo_id", T.ShortType()),
    T.StructField("codigo", T.StringType()),
    T.StructField("nombre", T.StringType()),
    T.StructField("orden", T.ShortType()),
    T.StructField("nota_uci", T.StringType()),
    T.StructField("fecha_inicio", T.DateType()),
    T.StructField("fecha_fin", T.DateType()),
])


def period_table(spark: SparkSession, periods=SCHOOL_YEAR) -> DataFrame:
    rows = [(p.order, p.code, p.name, p.order, p.grade, p.start, p.end) for p in periods]
    return spark.createDataFrame(rows, PERIOD_SCHEMA)


def period_of(moment: Column, periods=SCHOOL_YEAR) -> Column:
    """Period code of a date or timestamp; null in the gaps and for null.

    The calendar is a handful of ranges, so a CASE replaces the range join and the
    expression stays inside code generation."""
    day = F.to_date(moment)
    out = F.lit(None).cast("string")
    for p in reversed(periods):
        out = F.when(day.between(F.lit(p.start), F.lit(p.end)), F.lit(p.code)).otherwise(out)
    return out


def school_days(spark: SparkSession, periods=SCHOOL_YEAR) -> DataFrame:
    """Monday to Friday days of each period."""
    return (
        period_table(spark, periods)
        .select(F.col("codigo").alias("periodo"),
                F.explode(F.sequence("fecha_inicio", "fecha_fin")).alias("dia"))
        .where(F.dayofweek("dia").between(2, 6))
    )

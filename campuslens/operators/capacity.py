"""Measured capacity: rows and bytes that pass through a job while it runs, and its time."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIXED_WIDTHS = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4,
                T.DateType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8,
                T.TimestampNTZType: 8}
#: Work space of an aggregation as a multiple of its input.
MARGIN = 3


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values: width of fixed types, octets of texts (a missing text has none)."""
    out = F.lit(0).cast("bigint")
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            out = out + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif type(f.dataType) in FIXED_WIDTHS:
            out = out + F.lit(FIXED_WIDTHS[type(f.dataType)])
        else:
            raise TypeError(f"column {f.name} has no measured width: {f.dataType.simpleString()}")
    return out


@dataclass
class Measured:
    rows: int
    bytes: int
    seconds: float

    @property
    def rows_per_second(self) -> float:
        return self.rows / self.seconds

    @property
    def bytes_per_row(self) -> float | None:
        return self.bytes / self.rows if self.rows else None


def measure(rows: DataFrame, job: Callable[[DataFrame], DataFrame]) -> Measured:
    """Runs ``job`` over the rows to its end. The rows are counted on their way into the job, in the
    same pass; its result is thrown away. Of an empty input the planner drops the counting."""
    seen = Observation()
    empty = rows.isEmpty()
    observed = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(rows)).alias("bytes"))
    result = job(observed)
    start = time.perf_counter()
    result.write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - start
    return Measured(0, 0, seconds) if empty else Measured(seen.get["rows"], seen.get["bytes"] or 0, seconds)


def project(base: DataFrame, scenarios: dict[str, int | None], memory: float) -> DataFrame:
    """Yearly rows and memory of larger systems. ``base`` is one row: ``n`` rows, ``b`` bytes, ``m``
    enrolments; a scenario without a size is the present one."""
    sizes = F.array(*[F.struct(F.lit(n).alias("escenario"), F.lit(m).cast("bigint").alias("f"))
                      for n, m in scenarios.items()])
    rows = base.select("n", "b", "m", F.explode(sizes).alias("x")).select("n", "b", "m", "x.*")
    annual = F.col("n").cast("double") / F.col("m") * F.coalesce("f", "m")
    size = F.col("b").cast("double") / F.col("n")
    return rows.select("escenario", F.round(annual, 4).alias("eventos_anuales"),
                       F.round(annual * size / 1e9, 6).alias("memoria_gb"),
                       (annual < memory / (MARGIN * size)).alias("cabe_en_8gb"))

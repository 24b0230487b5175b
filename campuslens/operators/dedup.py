"""Duplicate handling by aggregation: copies shrink on the map side, so a group of copies
that holds much of the table never meets in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: list[str], order: list[str], agg, copies: str | None) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    picked = agg(F.struct(*order, *rest)).alias("_row")
    extra = [F.count(F.lit(1)).alias(copies)] if copies else []
    out = df.groupBy(*keys).agg(picked, *extra)
    cols = [F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    return out.select(*cols, *([copies] if copies else []))


def keep_first(df: DataFrame, keys: list[str], order: list[str], copies: str | None = None):
    """First row per key in ``order``; ties fall to the remaining columns. Keys must not be null."""
    return _pick(df, keys, order, F.min, copies)


def keep_last(df: DataFrame, keys: list[str], order: list[str], copies: str | None = None):
    """Last row per key in ``order``."""
    return _pick(df, keys, order, F.max, copies)


def copy_counts(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def repeated_keys(df: DataFrame, group: list[str], keys: list[str]) -> DataFrame:
    """Per group: rows whose key repeats, number of such keys, rows a merge would lose."""
    per_key = copy_counts(df, group + keys, "_n")
    return per_key.groupBy(*group).agg(
        F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(0)).cast("bigint").alias("filas"),
        F.sum((F.col("_n") > 1).cast("bigint")).alias("grupos"),
        F.sum(F.col("_n") - 1).cast("bigint").alias("perdidas_si_fusion"),
    )


def exact_duplicates(df: DataFrame, group: list[str], columns: list[str]) -> DataFrame:
    """Rows beyond the first copy, over all ``columns``, per group."""
    copies = copy_counts(df, group + [c for c in columns if c not in group], "_n")
    return copies.groupBy(*group).agg(F.sum("_n").cast("bigint").alias("filas"),
                                      F.sum(F.col("_n") - 1).cast("bigint").alias("duplicados"))

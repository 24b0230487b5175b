"""Renaming, relabelling and replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def yes_no(column: str) -> Column:
    """yes/no to boolean; null outside the domain."""
    return F.when(F.col(column) == "yes", True).when(F.col(column) == "no", False)


def label(column: Column, labels: dict[str, str]) -> Column:
    """Code to label; null outside the map."""
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), column)


def relabel(df: DataFrame, names: dict[str, str], flags: list[str],
            labels: dict[str, dict[str, str]]) -> DataFrame:
    """R-06: target names, booleans and labels in one projection (keyed by target name)."""
    out = []
    for old, new in names.items():
        value = yes_no(old) if old in flags else F.col(old)
        out.append((label(value, labels[new]) if new in labels else value).alias(new))
    return df.select(*out)


def replicate(df: DataFrame, times: int, key: str, step: int, copy: str = "copia") -> DataFrame:
    """Every row ``times`` times, with the key shifted by ``step`` per copy."""
    numbers = F.array(*[F.lit(i) for i in range(times)]) if times <= 64 else F.sequence(
        F.lit(0), F.lit(times - 1))
    return df.select("*", F.explode(numbers).alias(copy)).withColumn(
        key, F.col(key).cast("bigint") + F.col(copy).cast("bigint") * step)

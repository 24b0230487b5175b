"""Stratified grouped folds by hash order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEED = 42


def grouped_folds(df: DataFrame, group: str, label: str, folds: int = 5, seed: int = SEED,
                  name: str = "pliegue") -> DataFrame:
    """Fold 1..folds per group; groups with the same label signature (rows, positive rows; a missing
    label is not positive) are dealt out in md5 order.

    Ranks inside a stratum come in two levels: the leading hash digits cut every stratum into
    4096 even slices, so a stratum with most of the groups is still ranked in parallel."""
    signature = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col(label).cast("int") == 1).alias("_k"))
    signature = signature.withColumn(
        "_h", F.md5(F.concat(F.lit(f"{seed}-"), F.col(group).cast("string")))) \
        .withColumn("_slice", F.substring("_h", 1, 3))
    stratum = ["_n", "_k"]
    sizes = signature.groupBy(*stratum, "_slice").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(*stratum).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = sizes.select(*stratum, "_slice",
                           F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*stratum, "_slice").orderBy("_h", group)
    ranked = signature.withColumn("_in", F.row_number().over(inside) - 1) \
        .join(offsets, stratum + ["_slice"])
    number = (F.col("_before") + F.col("_in")) % folds + 1
    return ranked.select(group, number.cast("int").alias(name))


def grouped_split(df: DataFrame, group: str, label: str, folds: int = 5, seed: int = SEED,
                  name: str = "particion") -> DataFrame:
    """Rows with 'test' for the groups of fold 1 and 'train' for the rest."""
    fold = grouped_folds(df, group, label, folds, seed, "_fold")
    return (df.join(fold, group)
            .withColumn(name, F.when(F.col("_fold") == 1, "test").otherwise("train"))
            .drop("_fold"))

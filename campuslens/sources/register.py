"""Typed reading of the register files, with lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campuslens.functions.text import strip_blanks
from campuslens.session import bounded
from campuslens.vocabulary import NUMERIC_DOMAINS, REGISTER_COLUMNS


def strict_int(column: str) -> Column:
    """Integer from text that may carry quotes and blanks; anything else aborts the job."""
    plain = F.replace(strip_blanks(F.col(column)), F.lit('"'), F.lit(""))
    number = plain.try_cast("int")
    return F.when(F.col(column).isNull() | number.isNotNull(), number).otherwise(
        F.raise_error(F.concat(F.lit(f"{column}: not an integer: "), plain)).cast("int"))


def check_header(found: list[str], expected: list[str], source: str) -> None:
    """R-01: missing or unexpected columns abort the read."""
    missing, extra = sorted(set(expected) - set(found)), sorted(set(found) - set(expected))
    if missing or extra:
        raise ValueError(f"R-01 invalid schema in {source}: missing={missing} extra={extra}")


def read_text_columns(spark: SparkSession, path: str, columns: list[str], sep: str = ";",
                      partitions: dict[str, str] | None = None) -> DataFrame:
    """CSV read as text under a declared schema; the header is checked first, empty is null."""
    probe = spark.read.option("sep", sep).option("header", True).csv(path)
    check_header([c for c in probe.columns if c not in (partitions or {})], columns, path)
    found = [c for c in probe.columns if c not in (partitions or {})]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in found])
    return (spark.read.option("sep", sep).option("header", True).option("nullValue", "")
            .option("enforceSchema", False).schema(schema).csv(path))


def with_lineage(raw: DataFrame, line: str = "fila_origen", file: str = "archivo_origen",
                 first_line: int = 2, path: str | None = None) -> DataFrame:
    """File name and line number of every row (first data line = 2), and on request its whole
    path: names and line numbers repeat when a register is several files.

    Rows keep their order inside a file split. Numbers inside a split come from the row
    position of the task; only one row per split is needed to shift them."""
    placed = raw.select(
        "*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_name").alias(file),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_pos"))
    splits = placed.groupBy("_path", "_start").agg(F.min("_pos").alias("_first"),
                                                   F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy("_path").orderBy("_start").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = bounded(splits.select("_path", "_start", "_first", F.coalesce(
        F.sum("_size").over(earlier), F.lit(0)).alias("_before")), "splits")
    number = F.col("_pos") - F.col("_first") + F.col("_before") + first_line
    numbered = placed.join(offsets, ["_path", "_start"]).withColumn(line, number)
    if path:
        numbered = numbered.withColumn(path, F.col("_path"))
    return (numbered.drop("_path", "_start", "_pos", "_first", "_before"))


def read_register(spark: SparkSession, path: str, subject: str) -> DataFrame:
    """One register (a file or a folder of files): 33 typed columns plus subject, file, line and
    path."""
    raw = with_lineage(read_text_columns(spark, path, REGISTER_COLUMNS), path="ruta_origen")
    typed = [strict_int(c).alias(c) if c in NUMERIC_DOMAINS else F.col(c)
             for c in REGISTER_COLUMNS]
    return raw.select(F.lit(subject).alias("asignatura"), "archivo_origen", "fila_origen",
                      "ruta_origen", *typed)

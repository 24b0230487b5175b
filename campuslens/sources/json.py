"""JSON sources: line-delimited logs and array files, under declared schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupto"

EVENT_SCHEMA = T.StructType([
    T.StructField("evento_id", T.StringType()), T.StructField("estudiante_id", T.IntegerType()),
    T.StructField("asignatura", T.StringType()), T.StructField("fecha", T.StringType()),
    T.StructField("tipo", T.StringType()), T.StructField("duracion_min", T.IntegerType()),
    T.StructField("revisada", T.BooleanType()),
])
SESSION_SCHEMA = T.StructType([
    T.StructField("tutoria_id", T.StringType()), T.StructField("estudiante_id", T.IntegerType()),
    *[T.StructField(c, T.StringType())
      for c in ("asignatura", "fecha", "tutor", "modalidad", "tema", "resultado")],
])
STATE_SCHEMA = T.ArrayType(T.StructType([T.StructField("estado", T.StringType()),
                                         T.StructField("fecha", T.StringType())]))
NOTE_SCHEMA = T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in
                                        ("nota_id", "fecha", "autor", "texto")]))
ALERT_SCHEMA = T.StructType([
    T.StructField("alerta_id", T.StringType()), T.StructField("estudiante_id", T.IntegerType()),
    *[T.StructField(c, T.StringType()) for c in ("asignatura", "periodo", "nivel", "estado",
                                                 "creada_en", "actualizado_en")],
    T.StructField("historial_estados", STATE_SCHEMA), T.StructField("notas", NOTE_SCHEMA),
])


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType,
                    corrupt: str | None = CORRUPT) -> DataFrame:
    """JSON Lines; unreadable lines land whole in the ``corrupt`` column."""
    reader = spark.read
    if corrupt:
        schema = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    return reader.schema(schema).json(path)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files that hold one JSON array each; the elements become rows."""
    return spark.read.option("multiLine", True).schema(schema).json(path)


def moment(column: Column) -> Column:
    """ISO text to timestamp without zone; blank or unreadable gives null."""
    return F.nullif(column, F.lit("")).try_cast("timestamp_ntz")


def with_arrival(df: DataFrame, name: str = "orden_llegada") -> DataFrame:
    """Arrival number: file, position of the split, row inside it."""
    return df.select("*", F.concat(
        F.col("_metadata.file_name"), F.lit("/"),
        F.lpad(F.col("_metadata.file_block_start").cast("string"), 20, "0"), F.lit("/"),
        F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0")).alias(name))

"""Registered queries through the file sources: the given tables are written out as CSV, JSON
Lines or JSON arrays in the shared folder and read back under declared schemas."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from campuslens.operators import checks as K
from campuslens.operators import documents as D
from campuslens.operators.relational import wide_enrolment
from campuslens.plans import testbed as B
from campuslens.plans.document_queries import followup_docs
from campuslens.plans.registry import query
from campuslens.session import scratch_dir
from campuslens.sources import json as J
from campuslens.sources import register as R
from campuslens.sources import tables as S


def fresh(spark, label):
    return f"{scratch_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def customer_csv(spark, sf):
    path = fresh(spark, "csv")
    quoted = F.concat(F.lit('" '), F.col("c_nationkey"), F.lit('"'))
    B.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"), "c_name",
        quoted.alias("c_nationkey"), "c_mktsegment",
    ).write.option("sep", ";").option("header", True).option("quoteAll", True) \
        .option("escape", '"').csv(path)
    return path


COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]


@query("scan_typed_csv", """
    SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_mktsegment FROM customer""")
def scan_typed_csv(spark, sf):
    raw = R.read_text_columns(spark, customer_csv(spark, sf), COLUMNS)
    return raw.select(R.strict_int("c_custkey").alias("c_custkey"), "c_name",
                      R.strict_int("c_nationkey").alias("c_nationkey"), "c_mktsegment")


@query("lineage_columns", """
    SELECT count(*) AS filas, count(*) AS lineas_distintas, 2 AS primera_linea, 0 AS huecos FROM customer""")
def lineage_columns(spark, sf):
    """Line numbers per file: unique, from 2, without gaps."""
    raw = R.with_lineage(R.read_text_columns(spark, customer_csv(spark, sf), COLUMNS))
    per_file = raw.groupBy("archivo_origen").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("fila_origen").alias("d"),
        F.min("fila_origen").alias("lo"), F.max("fila_origen").alias("hi"))
    return per_file.agg(
        F.sum("n").alias("filas"), F.sum("d").alias("lineas_distintas"),
        F.min("lo").cast("int").alias("primera_linea"),
        F.sum(F.col("hi") - F.col("lo") + 1 - F.col("n")).cast("int").alias("huecos"))


@query("cast_strict", "SELECT p_partkey, p_size FROM part")
def cast_strict(spark, sf):
    quoted = F.concat(F.lit(' "'), F.col("p_size"), F.lit('" '))
    text = B.table(spark, sf, "part").select("p_partkey", quoted.alias("p_size"))
    return text.select("p_partkey", R.strict_int("p_size").alias("p_size"))


@query("scan_jsonl", B.sql("""
    SELECT tipo, count(*) AS filas, count(fecha) AS con_fecha, count(revisada) AS con_revisada,
      CAST(sum(duracion_min) AS BIGINT) AS minutos, 0 AS corruptas FROM eventos GROUP BY tipo""", "eventos"))
def scan_jsonl(spark, sf):
    path = fresh(spark, "jsonl")
    B.events_raw(spark, sf).drop("orden_llegada").write.json(path)
    log = J.read_json_lines(spark, path, J.EVENT_SCHEMA)
    return log.withColumn("fecha", J.moment(F.col("fecha"))).groupBy("tipo").agg(
        F.count(F.lit(1)).alias("filas"), F.count("fecha").alias("con_fecha"),
        F.count("revisada").alias("con_revisada"),
        F.sum(F.col("duracion_min").cast("bigint")).alias("minutos"),
        F.count_if(F.col(J.CORRUPT).isNotNull()).cast("int").alias("corruptas"))


@query("scan_json_array", "SELECT item_id, text FROM benchmark")
def scan_json_array(spark, sf):
    """Array files of at most a thousand documents each (item ids are unique)."""
    path = fresh(spark, "json")
    chunk = F.floor(F.col("item_id") / 1000).alias("trozo")
    arrays = B.table(spark, sf, "benchmark").groupBy(chunk).agg(
        F.to_json(F.collect_list(F.struct("item_id", "text"))).alias("value"))
    arrays.write.partitionBy("trozo").text(path)
    schema = T.StructType([T.StructField("item_id", T.LongType()),
                           T.StructField("text", T.StringType())])
    return J.read_json_array(spark, path, schema).select("item_id", "text")


@query("scan_parquet", """
    SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS cantidad FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1997-01-01' GROUP BY l_returnflag""")
def scan_parquet(spark, sf):
    """Column pruning and a date predicate that reach the scan."""
    recent = F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz")
    return B.table(spark, sf, "lineitem").where(recent).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("cantidad"))


@query("build_3nf", B.sql("""
    SELECT 'escuela' AS tabla, count(*) AS filas FROM escuela UNION ALL
    SELECT 'asignatura', count(*) FROM asignatura UNION ALL SELECT 'periodo', count(*) FROM periodo UNION ALL
    SELECT 'estudiante', count(*) FROM estudiante UNION ALL SELECT 'matricula', count(*) FROM matricula
    UNION ALL SELECT 'calificacion', count(*) FROM calificacion""",
    "escuela", "asignatura", "periodo", "estudiante", "matricula", "calificacion"))
def build_3nf(spark, sf):
    """Six tables staged, gated on their keys, published and read back."""
    root = fresh(spark, "tablas")

    def gate(t):
        keys = K.constraint_report(t).where(F.col("control").rlike("^(pk|fk|uq) "))
        return keys.withColumn("esperado", F.lit(0).cast("bigint"))
    S.publish(spark, B.tables(spark, sf), root, gate)
    return K.table_counts(S.published(spark, root))


@query("csv_round_trip", B.sql("SELECT * FROM ancha", "ancha"))
def csv_round_trip(spark, sf):
    """The wide view through the CSV sink and back under its schema."""
    wide = wide_enrolment(B.tables(spark, sf))
    path = fresh(spark, "csv-salida")
    S.write_csv(wide, path)
    return S.read_csv(spark, path, wide.schema)


@query("json_round_trip", B.sql("""
    SELECT estudiante_id, count(*) AS eventos, CAST(sum(coalesce(duracion_min, 0)) AS BIGINT) AS minutos, max(fecha) AS ultimo,
      count(revisada) AS con_revisada FROM limpios JOIN customer ON c_custkey = estudiante_id GROUP BY ALL""", "limpios"))
def json_round_trip(spark, sf):
    """Nested follow-up documents through the JSON sink and back, all their events counted."""
    docs = followup_docs(spark, sf)
    path = fresh(spark, "json-salida")
    S.write_json(docs, path)
    events = D.unwind(S.read_json(spark, path, docs.schema), "interacciones_lms", D.DOCUMENT)
    return events.groupBy("estudiante_id").agg(
        F.count(F.lit(1)).alias("eventos"),
        F.sum(F.coalesce("duracion_min", F.lit(0)).cast("bigint")).alias("minutos"),
        F.max("fecha").alias("ultimo"), F.count("revisada").alias("con_revisada"))

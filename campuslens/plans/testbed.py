"""Domain tables derived from the shared star-schema tables, in Spark and as SQL text.

Every derivation covers whole tables: customers act as students, (customer, order status)
as enrolments, line items as grades and sessions, orders as alerts, events as the activity
log, documents as notes, parts as the two registers without a shared key."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from campuslens.functions.calendar import Period, period_of
from campuslens.operators.relational import Tables

ACTIVITY_PERIODS = (
    Period("P1", 1, "G1", date(2024, 1, 1), date(2024, 1, 10), "P1"),
    Period("P2", 2, "G2", date(2024, 1, 12), date(2024, 1, 20), "P2"),
    Period("P3", 3, "G3", date(2024, 1, 23), date(2024, 1, 29), "P3"),
)
SESSION_PERIODS = (
    Period("P1", 1, "G1", date(1995, 1, 1), date(1997, 6, 30), "P1"),
    Period("P2", 2, "G2", date(1997, 9, 1), date(1999, 6, 30), "P2"),
    Period("P3", 3, "G3", date(1999, 9, 1), date(2001, 12, 31), "P3"),
)
LANGUAGE_LEXICON = {
    "en": ["the", "and", "that", "for", "was"],
    "fr": ["les", "des", "dans", "est", "une"],
    "de": ["der", "die", "und", "den", "von"],
    "es": ["que", "los", "las", "por", "con"],
}
LANGUAGE_STOPS = ["est", "fortan"]
SEARCH_STEMS = ["menten", "ation", "schen"]


# declared, not inferred: opening a table costs no footer job
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def events_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Activity log with the defects the values themselves select: missing dates, copies,
    negative minutes, spelling variants of the type."""
    k = F.get_json_object("props", "$.k").cast("int")
    minutes = F.floor("value").cast("int")
    copies = F.when(F.col("value") >= 200, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    number = F.col("event_id").cast("string")
    return table(spark, sf, "events").select(
        F.concat(F.lit("EV-"), F.lpad(number, F.greatest(F.lit(7), F.length(number)), F.lit("0")))
        .alias("evento_id"),
        F.col("user_id").alias("estudiante_id"),
        F.when(k < 33, "F").when(k < 66, "O").otherwise("P").alias("asignatura"),
        F.when(k != 0, F.col("ts")).alias("fecha"),
        F.when(F.col("event_type") == "view", "recurso")
        .when(F.col("event_type") == "click", "tarea")
        .when(F.col("event_type") == "purchase", "Quiz")
        .when(F.col("event_type") == "signup", " foro").otherwise("resource").alias("tipo"),
        F.when(k == 1, -minutes).otherwise(minutes).alias("duracion_min"),
        F.when(F.col("event_type") == "click", k % 2 == 0).alias("revisada"),
        F.explode(copies).alias("_copia"), "event_id",
    ).select("*", (F.col("event_id") * 2 + F.col("_copia")).alias("orden_llegada")) \
        .drop("_copia", "event_id")


def matricula(spark: SparkSession, sf: str) -> DataFrame:
    amount = F.sum(F.floor("o_totalprice").cast("bigint"))
    status = F.col("o_orderstatus")
    return (table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("estudiante_id"), status)
            .agg(F.least(F.lit(3), F.count_if(F.col("o_orderpriority") == "1-URGENT"))
                 .cast("int").alias("reprobaciones_previas"),
                 F.bool_or(F.col("o_orderpriority") == "2-HIGH").alias("clases_pagadas"),
                 (amount % 94).cast("int").alias("faltas"),
                 (amount % 94 != 0).alias("faltas_confiable"),
                 (F.min("o_orderkey") + 2).alias("fila_origen"))
            .select("estudiante_id", F.ascii(status).alias("asignatura_id"),
                    "reprobaciones_previas", "clases_pagadas", "faltas", "faltas_confiable",
                    F.concat(F.lower(status), F.lit(".csv")).alias("archivo_origen"),
                    "fila_origen"))


def period_number():
    n = F.col("l_linenumber")
    return F.when(n <= 2, 1).when(n <= 4, 2).otherwise(3)


def calificacion(spark: SparkSession, sf: str) -> DataFrame:
    """Grade 0-20 per enrolment and period: integer mean of line quantities, rescaled.
    Line items fold per order before they meet the orders."""
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey", period_number().alias("periodo_id")) \
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("q"), F.count(F.lit(1)).alias("c"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return (joined.groupBy(F.col("o_custkey").alias("estudiante_id"),
                           F.ascii("o_orderstatus").alias("asignatura_id"), "periodo_id")
            .agg(F.sum("q").alias("q"), F.sum("c").alias("c"))
            .select("estudiante_id", "asignatura_id", "periodo_id",
                    F.expr("cast((q * 2) div (c * 5) as int)").alias("nota"))
            .withColumn("no_evaluado", F.col("nota") == 0))


def estudiante(spark: SparkSession, sf: str) -> DataFrame:
    c, n = F.col("c_custkey"), F.col("c_nationkey")
    seg = F.col("c_mktsegment")
    base = table(spark, sf, "customer").join(
        table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey"),
        "c_nationkey")

    def scale(expr, low, size):
        return (expr % size + low).cast("int")

    jobs = [("docente", 0), ("salud", 1), ("servicios", 2), ("hogar", 3)]

    def job(expr):
        out = F.lit("otro")
        for name, i in jobs:
            out = F.when(expr % 5 == i, name).otherwise(out)
        return out

    return base.select(
        c.alias("estudiante_id"), F.col("n_regionkey").alias("escuela_id"),
        F.when(F.col("c_acctbal") < 4500, "F").otherwise("M").alias("sexo"),
        scale(n, 15, 8).alias("edad"),
        F.when(seg.isin("HOUSEHOLD", "FURNITURE"), "Rural").otherwise("Urbana").alias("zona"),
        F.when(c % 3 == 0, "<=3").otherwise(">3").alias("tamano_familia"),
        F.when(c % 10 == 0, "Separados").otherwise("Juntos").alias("estado_padres"),
        scale(n, 0, 5).alias("educ_madre"), scale(c, 0, 5).alias("educ_padre"),
        job(n).alias("trabajo_madre"), job(c).alias("trabajo_padre"),
        F.when(seg == "BUILDING", "cercania").when(seg == "MACHINERY", "reputacion")
        .when(seg == "AUTOMOBILE", "oferta").otherwise("otro").alias("motivo_eleccion"),
        F.when(c % 7 == 0, "otro").when(c % 3 == 1, "padre").otherwise("madre").alias("tutor_legal"),
        scale(c, 1, 4).alias("tiempo_viaje"), scale(n, 1, 4).alias("tiempo_estudio"),
        (c % 8 == 0).alias("apoyo_escolar"), (n % 2 == 0).alias("apoyo_familiar"),
        (c % 2 == 0).alias("actividades"), (c % 5 != 0).alias("guarderia"),
        (c % 11 != 0).alias("desea_superior"), (n % 6 != 0).alias("internet"),
        (c % 3 == 1).alias("relacion_romantica"), scale(n, 1, 5).alias("relacion_familiar"),
        scale(c, 1, 5).alias("tiempo_libre"), scale(n + c, 1, 5).alias("salidas"),
        scale(c * 3, 1, 5).alias("alcohol_semana"), scale(n * 2, 1, 5).alias("alcohol_finde"),
        scale(c + 2, 1, 5).alias("salud"))


def tables(spark: SparkSession, sf: str) -> Tables:
    subjects = table(spark, sf, "orders").select("o_orderstatus").distinct()
    periods = table(spark, sf, "lineitem").select(period_number().alias("periodo_id")).distinct()
    code = F.concat(F.lit("P"), F.col("periodo_id"))
    return Tables(
        escuela=table(spark, sf, "region").select(
            F.col("r_regionkey").alias("escuela_id"), F.col("r_name").alias("codigo"),
            F.col("r_name").alias("nombre")),
        asignatura=subjects.select(F.ascii("o_orderstatus").alias("asignatura_id"),
                                   F.col("o_orderstatus").alias("codigo"),
                                   F.col("o_orderstatus").alias("nombre")),
        periodo=periods.select("periodo_id", code.alias("codigo"), code.alias("nombre"),
                               F.col("periodo_id").alias("orden")),
        estudiante=estudiante(spark, sf),
        matricula=matricula(spark, sf),
        calificacion=calificacion(spark, sf))


def enrolment_keys(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("estudiante_id"), F.col("o_orderstatus").alias("asignatura")
    ).distinct()


def sessions_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions: the supplier's customer of the same number takes the place of the student, so
    that some sessions have no enrolment."""
    flag = F.col("l_returnflag")
    return table(spark, sf, "lineitem").select(
        F.concat_ws("-", F.lit("TU"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        .alias("tutoria_id"),
        F.col("l_suppkey").alias("estudiante_id"), F.col("l_linestatus").alias("asignatura"),
        F.col("l_shipdate").alias("fecha"),
        F.when(flag == "A", "COMPLETADA").when(flag == "N", "No asistió")
        .otherwise("rescheduled").alias("resultado"))


def sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Standard sessions per enrolment of the order's customer."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    flag = F.col("l_returnflag")
    return (table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate", "l_returnflag")
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("o_custkey").alias("estudiante_id"),
                    F.col("o_orderstatus").alias("asignatura"), F.col("l_shipdate").alias("fecha"),
                    F.when(flag == "A", "completada").when(flag == "N", "no_asistio")
                    .otherwise("reprogramada").alias("resultado")))


def alerts(spark: SparkSession, sf: str) -> DataFrame:
    p, price = F.substring("o_orderpriority", 1, 1), F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("alerta_id"), F.col("o_custkey").alias("estudiante_id"),
        F.col("o_orderstatus").alias("asignatura"),
        F.when(p <= "2", "alto").when(p == "3", "medio").otherwise("bajo").alias("nivel"),
        F.when(price < 150000, "abierta").when(price < 300000, "en_seguimiento")
        .otherwise("cerrada").alias("estado"),
        F.col("o_orderdate").alias("creada_en"),
        F.floor(price / 100000).cast("bigint").alias("n_notas"))


def alert_json(spark: SparkSession, sf: str) -> DataFrame:
    """Raw alert documents, one JSON text (``documento``) per order: line items are the history,
    conversations the notes. The price selects the defects: foreign fields, unmarked simulation,
    empty histories, bad ids, short notes, students of nobody, unknown states and levels; histories
    are out of order and states and update times stale where the dates themselves say so."""
    price = F.floor("o_totalprice").cast("bigint")
    order = table(spark, sf, "orders").select(
        "*", price.alias("p"), (price % 97).alias("g"),
        F.col("o_orderkey").cast("string").alias("number"))
    flag = F.col("l_returnflag")
    state = F.when(flag == "A", "abierta").when(flag == "N", "en_seguimiento").otherwise("cerrada")
    step = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", state.alias("estado"))
    history = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.array_sort(F.collect_list(step)).alias("pasos"))
    turn = F.struct("turn", "role", "text", (F.col("conv_id") % 2).alias("antes"))
    talk = table(spark, sf, "conversations").groupBy(F.col("conv_id").alias("o_orderkey")).agg(
        F.array_sort(F.collect_list(turn)).alias("turnos"))
    docs = order.join(history, "o_orderkey", "left").join(talk, "o_orderkey", "left")
    created = F.col("o_orderdate")

    def later(days: Column) -> Column:
        return created + F.make_dt_interval(days.cast("int"))

    first = F.array(F.struct(
        F.when(F.col("g") == 6, "reabierta").otherwise("abierta").alias("estado"),
        created.alias("fecha")))
    steps = F.transform("pasos", lambda s: F.struct(
        s["estado"].alias("estado"), F.greatest(created, s["l_shipdate"]).alias("fecha")))
    turns = F.transform("turnos", lambda t: F.struct(
        F.concat_ws("-", F.lit("NT"), "number", t["turn"].cast("string")).alias("nota_id"),
        later(t["turn"] - t["antes"]).alias("fecha"),
        F.when(t["role"] == "user", "ORI-01").when(t["role"] == "assistant", "ORI-02")
        .otherwise("SIS-00").alias("autor"), t["text"].alias("texto")))
    short = F.array(F.struct(F.concat(F.lit("NT-"), "number").alias("nota_id"),
                             created.alias("fecha"), F.lit("ORI-01").alias("autor"),
                             F.lit("abc").alias("texto")))
    none = F.array().cast("array<struct<nota_id:string,fecha:timestamp_ntz,autor:string,texto:string>>")
    key, p1 = F.col("o_custkey"), F.substring("o_orderpriority", 1, 1)
    fields = F.struct(
        F.concat(F.when(F.col("g") == 3, "XX-").otherwise("AL-"),
                 F.lpad("number", F.greatest(F.lit(5), F.length("number")), F.lit("0")))
        .alias("alerta_id"),
        F.when(F.col("g") == 5, -key - 1).otherwise(key).alias("estudiante_id"),
        F.col("o_orderstatus").alias("asignatura"),
        period_of(created, SESSION_PERIODS).alias("periodo"),
        F.when(F.col("g") == 7, "urgente").when(p1 <= "2", "alto").when(p1 == "3", "medio")
        .otherwise("bajo").alias("nivel"),
        F.when(F.col("o_totalprice") < 150000, "abierta")
        .when(F.col("o_totalprice") < 300000, "en_seguimiento").otherwise("cerrada").alias("estado"),
        created.alias("creada_en"), later(F.col("p") % 61 - 10).alias("actualizado_en"),
        F.when(F.col("g") != 2, F.concat(first, F.coalesce(steps, F.filter(first, lambda x: F.lit(False)))))
        .otherwise(F.filter(first, lambda x: F.lit(False))).alias("historial_estados"),
        F.concat(F.coalesce(turns, none), F.when(F.col("g") == 4, short).otherwise(none)).alias("notas"),
        (F.col("g") != 1).alias("es_simulado"), F.lit("pedidos").alias("fuente"),
        F.when(F.col("g") == 0, "sin declarar").alias("comentario"))
    return docs.select(F.to_json(fields).alias("documento"))


def notes(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("n_chars")
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("nota_id"), F.col("source").alias("alerta_id"), "lang", "text",
        F.when(n < 500, "bajo").when(n < 3000, "medio").otherwise("alto").alias("nivel"))


def registers(spark: SparkSession, sf: str) -> DataFrame:
    """Two registers without a shared key: economy, standard and similar part types fall in one
    of two files by the parity of the part number."""
    name = F.split("p_name", " ")
    return table(spark, sf, "part").select(
        F.when(F.col("p_partkey") % 2 == 0, "A").otherwise("B").alias("archivo"),
        F.floor(F.col("p_partkey") / 2).cast("bigint").alias("fila"),
        F.col("p_brand").alias("k1"), F.col("p_type").alias("k2"),
        F.col("p_size").cast("string").alias("k3"),
        name[0].alias("d1"), name[1].alias("d2"),
        F.floor(F.col("p_retailprice") / 500).cast("string").alias("d3"))


# SQL counterparts, resolved by name ------------------------------------------------------- #
_K = "CAST(json_extract_string(e.props, '$.k') AS INTEGER)"
_PERIOD = "CASE WHEN l_linenumber <= 2 THEN 1 WHEN l_linenumber <= 4 THEN 2 ELSE 3 END"


def period_case(moment: str, periods) -> str:
    arms = " ".join(
        f"WHEN {moment} >= TIMESTAMP '{p.start}' AND {moment} < TIMESTAMP '{p.end}' + INTERVAL 1 DAY"
        f" THEN '{p.code}'" for p in periods)
    return f"CASE {arms} END"


def _job(x: str) -> str:
    return (f"CASE {x} % 5 WHEN 0 THEN 'docente' WHEN 1 THEN 'salud' WHEN 2 THEN 'servicios' "
            f"WHEN 3 THEN 'hogar' ELSE 'otro' END")


CTES: dict[str, tuple[list[str], str]] = {
    "eventos": ([], f"""
        SELECT 'EV-' || lpad(CAST(e.event_id AS VARCHAR), CAST(greatest(7, length(CAST(e.event_id AS VARCHAR))) AS INTEGER), '0') AS evento_id,
          e.user_id AS estudiante_id,
          CASE WHEN {_K} < 33 THEN 'F' WHEN {_K} < 66 THEN 'O' ELSE 'P' END AS asignatura,
          CASE WHEN {_K} <> 0 THEN e.ts END AS fecha,
          CASE e.event_type WHEN 'view' THEN 'recurso' WHEN 'click' THEN 'tarea'
            WHEN 'purchase' THEN 'Quiz' WHEN 'signup' THEN ' foro' ELSE 'resource' END AS tipo,
          CAST(CASE WHEN {_K} = 1 THEN -floor(e.value) ELSE floor(e.value) END AS INTEGER) AS duracion_min,
          CASE WHEN e.event_type = 'click' THEN {_K} % 2 = 0 END AS revisada,
          e.event_id * 2 + c.c AS orden_llegada
        FROM events e CROSS JOIN (VALUES (0), (1)) c(c) WHERE c.c = 0 OR e.value >= 200"""),
    "inscritos": ([], """
        SELECT DISTINCT o_custkey AS estudiante_id, o_orderstatus AS asignatura FROM orders"""),
    "primeros": (["eventos"], """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY evento_id ORDER BY orden_llegada) AS rn,
            count(*) OVER (PARTITION BY evento_id) AS copias
          FROM eventos WHERE fecha IS NOT NULL) WHERE rn = 1"""),
    "juzgados": (["primeros", "inscritos"], f"""
        SELECT p.*, {period_case('p.fecha', ACTIVITY_PERIODS)} AS periodo,
          CASE WHEN i.estudiante_id IS NULL THEN 'R-17'
               WHEN {period_case('p.fecha', ACTIVITY_PERIODS)} IS NULL THEN 'R-18' END AS regla,
          CASE lower(trim(p.tipo)) WHEN 'quiz' THEN 'cuestionario' WHEN 'resource' THEN 'recurso'
            ELSE lower(trim(p.tipo)) END AS tipo_ok
        FROM primeros p LEFT JOIN inscritos i USING (estudiante_id, asignatura)"""),
    "limpios": (["juzgados"], """
        SELECT evento_id, estudiante_id, asignatura, fecha, tipo_ok AS tipo,
          CAST(CASE WHEN duracion_min < 0 THEN NULL WHEN duracion_min > 240 THEN 240
               ELSE duracion_min END AS INTEGER) AS duracion_min, revisada, periodo
        FROM juzgados WHERE regla IS NULL"""),
    "actividad": (["limpios"], """
        SELECT estudiante_id, asignatura, periodo, count(*) AS n_eventos,
          CAST(sum(coalesce(duracion_min, 0)) AS BIGINT) AS minutos,
          count(*) FILTER (WHERE tipo = 'tarea') AS n_tareas,
          count(*) FILTER (WHERE revisada) AS n_tareas_revisadas,
          count(DISTINCT CAST(fecha AS DATE)) AS dias_activos
        FROM limpios GROUP BY ALL"""),
    "matricula": ([], """
        SELECT o_custkey AS estudiante_id, ascii(o_orderstatus) AS asignatura_id,
          CAST(least(3, count(*) FILTER (WHERE o_orderpriority = '1-URGENT')) AS INTEGER) AS reprobaciones_previas,
          bool_or(o_orderpriority = '2-HIGH') AS clases_pagadas,
          CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) % 94 AS INTEGER) AS faltas,
          sum(CAST(floor(o_totalprice) AS BIGINT)) % 94 <> 0 AS faltas_confiable,
          lower(o_orderstatus) || '.csv' AS archivo_origen,
          min(o_orderkey) + 2 AS fila_origen
        FROM orders GROUP BY o_custkey, o_orderstatus"""),
    "calificacion": ([], f"""
        SELECT *, nota = 0 AS no_evaluado FROM (
        SELECT o_custkey AS estudiante_id, ascii(o_orderstatus) AS asignatura_id,
          {_PERIOD} AS periodo_id,
          CAST((sum(CAST(l_quantity AS BIGINT)) * 2) // (count(*) * 5) AS INTEGER) AS nota
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)"""),
    "estudiante": ([], f"""
        SELECT c_custkey AS estudiante_id, n_regionkey AS escuela_id,
          CASE WHEN c_acctbal < 4500 THEN 'F' ELSE 'M' END AS sexo,
          c_nationkey % 8 + 15 AS edad,
          CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'Rural' ELSE 'Urbana' END AS zona,
          CASE WHEN c_custkey % 3 = 0 THEN '<=3' ELSE '>3' END AS tamano_familia,
          CASE WHEN c_custkey % 10 = 0 THEN 'Separados' ELSE 'Juntos' END AS estado_padres,
          c_nationkey % 5 AS educ_madre, c_custkey % 5 AS educ_padre,
          {_job('c_nationkey')} AS trabajo_madre, {_job('c_custkey')} AS trabajo_padre,
          CASE c_mktsegment WHEN 'BUILDING' THEN 'cercania' WHEN 'MACHINERY' THEN 'reputacion'
            WHEN 'AUTOMOBILE' THEN 'oferta' ELSE 'otro' END AS motivo_eleccion,
          CASE WHEN c_custkey % 7 = 0 THEN 'otro' WHEN c_custkey % 3 = 1 THEN 'padre' ELSE 'madre' END AS tutor_legal,
          c_custkey % 4 + 1 AS tiempo_viaje, c_nationkey % 4 + 1 AS tiempo_estudio,
          c_custkey % 8 = 0 AS apoyo_escolar, c_nationkey % 2 = 0 AS apoyo_familiar,
          c_custkey % 2 = 0 AS actividades, c_custkey % 5 <> 0 AS guarderia,
          c_custkey % 11 <> 0 AS desea_superior, c_nationkey % 6 <> 0 AS internet,
          c_custkey % 3 = 1 AS relacion_romantica, c_nationkey % 5 + 1 AS relacion_familiar,
          c_custkey % 5 + 1 AS tiempo_libre, (c_nationkey + c_custkey) % 5 + 1 AS salidas,
          (c_custkey * 3) % 5 + 1 AS alcohol_semana, (c_nationkey * 2) % 5 + 1 AS alcohol_finde,
          (c_custkey + 2) % 5 + 1 AS salud
        FROM customer JOIN nation ON c_nationkey = n_nationkey"""),
    "asignatura": ([], """
        SELECT DISTINCT ascii(o_orderstatus) AS asignatura_id, o_orderstatus AS asignatura FROM orders"""),
    "escuela": ([], "SELECT r_regionkey AS escuela_id, r_name AS escuela FROM region"),
    "periodo": ([], f"""
        SELECT DISTINCT {_PERIOD} AS periodo_id, 'P' || CAST({_PERIOD} AS VARCHAR) AS periodo FROM lineitem"""),
    "ancha": (["matricula", "calificacion", "estudiante", "asignatura", "escuela", "periodo"], """
        SELECT m.estudiante_id, a.asignatura, e.escuela, s.* EXCLUDE (estudiante_id, escuela_id),
          m.reprobaciones_previas, m.clases_pagadas, m.faltas, m.faltas_confiable,
          m.archivo_origen, m.fila_origen,
          max(c.nota) FILTER (WHERE p.periodo = 'P1') AS nota_p1,
          max(c.nota) FILTER (WHERE p.periodo = 'P2') AS nota_p2,
          max(c.nota) FILTER (WHERE p.periodo = 'P3') AS nota_p3,
          bool_or(c.no_evaluado) FILTER (WHERE p.periodo = 'P1') AS no_evaluado_p1,
          bool_or(c.no_evaluado) FILTER (WHERE p.periodo = 'P2') AS no_evaluado_p2,
          bool_or(c.no_evaluado) FILTER (WHERE p.periodo = 'P3') AS no_evaluado_p3,
          (SELECT count(*) FROM matricula m2 WHERE m2.estudiante_id = m.estudiante_id) = 2 AS en_ambas_asignaturas
        FROM matricula m JOIN asignatura a USING (asignatura_id)
        JOIN estudiante s ON s.estudiante_id = m.estudiante_id
        JOIN escuela e ON e.escuela_id = s.escuela_id
        JOIN calificacion c ON c.estudiante_id = m.estudiante_id AND c.asignatura_id = m.asignatura_id
        JOIN periodo p ON p.periodo_id = c.periodo_id
        GROUP BY ALL"""),
    "tutorias_crudas": ([], """
        SELECT concat_ws('-', 'TU', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS tutoria_id,
          l_suppkey AS estudiante_id, l_linestatus AS asignatura, l_shipdate AS fecha,
          CASE l_returnflag WHEN 'A' THEN 'COMPLETADA' WHEN 'N' THEN 'No asistió' ELSE 'rescheduled' END AS resultado
        FROM lineitem"""),
    "tutorias": ([], """
        SELECT o_custkey AS estudiante_id, o_orderstatus AS asignatura, l_shipdate AS fecha,
          CASE l_returnflag WHEN 'A' THEN 'completada' WHEN 'N' THEN 'no_asistio' ELSE 'reprogramada' END AS resultado
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "alertas": ([], """
        SELECT o_orderkey AS alerta_id, o_custkey AS estudiante_id, o_orderstatus AS asignatura,
          CASE WHEN o_orderpriority[1] <= '2' THEN 'alto' WHEN o_orderpriority[1] = '3' THEN 'medio' ELSE 'bajo' END AS nivel,
          CASE WHEN o_totalprice < 150000 THEN 'abierta' WHEN o_totalprice < 300000 THEN 'en_seguimiento' ELSE 'cerrada' END AS estado,
          o_orderdate AS creada_en, CAST(floor(o_totalprice / 100000) AS BIGINT) AS n_notas
        FROM orders"""),
    "notas": ([], """
        SELECT doc_id AS nota_id, source AS alerta_id, lang, text,
          CASE WHEN n_chars < 500 THEN 'bajo' WHEN n_chars < 3000 THEN 'medio' ELSE 'alto' END AS nivel
        FROM documents"""),
    "registros": ([], """
        SELECT CASE WHEN p_partkey % 2 = 0 THEN 'A' ELSE 'B' END AS archivo, p_partkey // 2 AS fila,
          p_brand AS k1, p_type AS k2, CAST(p_size AS VARCHAR) AS k3,
          string_split(p_name, ' ')[1] AS d1, string_split(p_name, ' ')[2] AS d2,
          CAST(CAST(floor(p_retailprice / 500) AS BIGINT) AS VARCHAR) AS d3
        FROM part"""),
}


def sql(body: str, *names: str) -> str:
    """``WITH`` clause of the named derivations and all they need, then ``body``."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for dep in CTES[name][0]:
            visit(dep)
        if name not in ordered:
            ordered.append(name)

    for n in names:
        visit(n)
    parts = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in ordered)
    return f"WITH {parts}\n{body}" if parts else body

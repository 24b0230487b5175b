"""Registered queries on raw nested documents: repair, validators, quarantine, and the document
aggregates (AG-01 to AG-07) over unnested arrays."""

from __future__ import annotations

from pyspark.sql import functions as F

from campuslens.functions import text as T
from campuslens.operators import alert_documents as L
from campuslens.operators import documents as D
from campuslens.operators import validation as V
from campuslens.plans import testbed as B
from campuslens.plans.document_queries import SUBJECTS, followup_docs
from campuslens.plans.registry import query
from campuslens.plans.text_queries import NONE

RULES = V.Rules(alert_id="^AL-[0-9]{5,}$", subjects=SUBJECTS, min_student=0,
                categories=(*B.LANGUAGE_LEXICON, NONE))


def parsed(spark, sf):
    return L.parse(B.alert_json(spark, sf), "documento")


def loaded(spark, sf) -> L.AlertLoad:
    return L.load(parsed(spark, sf), B.enrolment_keys(spark, sf), RULES,
                  categorise=lambda n: T.categorise(n, B.LANGUAGE_LEXICON))


# SQL counterparts on flat rows: history, notes and one summary per document ------------------- #
_RANK = "CASE estado WHEN 'abierta' THEN 0 WHEN 'en_seguimiento' THEN 1 WHEN 'cerrada' THEN 2 ELSE 3 END"
_STOPS = ", ".join(f"'{w}'" for w in T.STOP_WORDS)
_LANGS = list(B.LANGUAGE_LEXICON)
_HITS = ", ".join(f"count(*) FILTER (WHERE regexp_matches(w, '^({'|'.join(ps)})')) AS {lang}"
                  for lang, ps in B.LANGUAGE_LEXICON.items())
_BEST = f"greatest({', '.join(_LANGS)})"
_LEADERS = " + ".join(f"CAST({c} = {_BEST} AS INTEGER)" for c in _LANGS)
_ARMS = " ".join(f"WHEN {c} = {_BEST} THEN '{c}'" for c in _LANGS)
B.CTES["doc_base"] = ([], f"""
    SELECT *, CAST(floor(o_totalprice) AS BIGINT) % 97 AS g,
      CASE WHEN CAST(floor(o_totalprice) AS BIGINT) % 97 = 3 THEN 'XX-' ELSE 'AL-' END
        || lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(5, length(CAST(o_orderkey AS VARCHAR))) AS INTEGER), '0') AS alerta_id,
      CASE WHEN CAST(floor(o_totalprice) AS BIGINT) % 97 = 5 THEN -o_custkey - 1 ELSE o_custkey END AS estudiante_id,
      {B.period_case('o_orderdate', B.SESSION_PERIODS)} AS periodo,
      CASE WHEN CAST(floor(o_totalprice) AS BIGINT) % 97 = 7 THEN 'urgente' WHEN o_orderpriority[1] <= '2' THEN 'alto'
        WHEN o_orderpriority[1] = '3' THEN 'medio' ELSE 'bajo' END AS nivel,
      CASE WHEN o_totalprice < 150000 THEN 'abierta' WHEN o_totalprice < 300000 THEN 'en_seguimiento' ELSE 'cerrada' END AS estado0,
      o_orderdate + to_days(CAST(CAST(floor(o_totalprice) AS BIGINT) % 61 - 10 AS INTEGER)) AS act0
    FROM orders""")
B.CTES["doc_historia"] = (["doc_base"], f"""
    SELECT *, {_RANK} AS r FROM (
      SELECT o_orderkey, 0 AS pos, CASE WHEN g = 6 THEN 'reabierta' ELSE 'abierta' END AS estado, o_orderdate AS fecha
      FROM doc_base WHERE g <> 2
      UNION ALL SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderkey
          ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate,
            CASE l_returnflag WHEN 'A' THEN 'abierta' WHEN 'N' THEN 'en_seguimiento' ELSE 'cerrada' END),
        CASE l_returnflag WHEN 'A' THEN 'abierta' WHEN 'N' THEN 'en_seguimiento' ELSE 'cerrada' END,
        greatest(o_orderdate, l_shipdate) FROM lineitem JOIN doc_base ON l_orderkey = o_orderkey WHERE g <> 2)""")
B.CTES["doc_notas"] = (["doc_base"], """
    SELECT row_number() OVER () AS n, *, trim(regexp_replace(regexp_replace(regexp_replace(
      strip_accents(replace(replace(' ' || lower(texto) || ' ', 'est.', 'estudiante'), ' q ', ' que ')),
      '[^\\x00-\\x7F]', '', 'g'), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g')) AS norm FROM (
      SELECT o_orderkey, o_orderdate + to_days(CAST(turn - conv_id % 2 AS INTEGER)) AS fecha, role <> 'system' AS orientador, text AS texto
      FROM conversations JOIN doc_base ON conv_id = o_orderkey
      UNION ALL SELECT o_orderkey, o_orderdate, true, 'abc' FROM doc_base WHERE g = 4)""")
B.CTES["doc_categorias"] = (["doc_notas"], f"""
    SELECT n.*, CASE WHEN h.n IS NULL OR {_BEST} = 0 OR {_LEADERS} > 1 THEN '{NONE}' {_ARMS} END AS categoria
    FROM doc_notas n LEFT JOIN (SELECT n, {_HITS} FROM (SELECT n, unnest(string_split(norm, ' ')) AS w FROM doc_notas)
      WHERE length(w) > 2 AND w NOT IN ({_STOPS}) GROUP BY n) h USING (n)""")
B.CTES["doc_resumen"] = (["doc_historia", "doc_notas"], """
    SELECT b.*, h.* EXCLUDE (o_orderkey), t.* EXCLUDE (o_orderkey), coalesce(n_notas, 0) AS notas_n FROM doc_base b
    LEFT JOIN (SELECT o_orderkey, list(estado ORDER BY pos) AS antes, list(estado ORDER BY fecha, r) AS despues,
      max(fecha) AS ultimo_cambio, count(*) AS n_estados, bool_and(r < 3) AS conocidos FROM doc_historia GROUP BY ALL) h USING (o_orderkey)
    LEFT JOIN (SELECT o_orderkey, min(fecha) AS primera_nota, max(fecha) AS ultima_nota, min(length(texto)) AS corto,
      count(*) AS n_notas, bool_and(orientador) AS orientadas FROM doc_notas GROUP BY ALL) t USING (o_orderkey)""")
B.CTES["doc_reparados"] = (["doc_resumen"], """
    SELECT *, coalesce(despues[-1], estado0) AS estado,
      greatest(act0, o_orderdate, ultimo_cambio, ultima_nota) AS actualizado_en,
      coalesce(antes <> despues, false) AS orden_corregido, coalesce(despues[-1], estado0) <> estado0 AS estado_corregido,
      act0 < greatest(o_orderdate, ultimo_cambio, ultima_nota) AS act_corregido
    FROM doc_resumen WHERE g <> 5""")
#: Controls of the validators as SQL; ``{e}``, ``{a}`` and ``{h}``: state, update time and history.
_STRUCTURE = {
    "campos_ajenos": "g <> 0", "alerta_id": "g <> 3", "estudiante": "estudiante_id >= 0",
    "catalogos": "periodo IS NOT NULL AND nivel <> 'urgente' AND {e} <> 'reabierta'",
    "simulado": "g <> 1", "estados": "coalesce(conocidos, true)"}
_LIFE = {
    "actualizado_tras_crear": "{a} >= o_orderdate",
    "actualizado_tras_historial": "coalesce({a} >= ultimo_cambio, false)",
    "actualizado_tras_notas": "{a} >= coalesce(ultima_nota, o_orderdate)",
    "notas_tras_crear": "coalesce(primera_nota, o_orderdate) >= o_orderdate",
    "estado_es_ultimo": "coalesce({e} = {h}[-1], false)",
    "abre_en_inicial": "coalesce({h}[1] = 'abierta', false)",
    "historial_no_vacio": "coalesce(n_estados, 0) >= 1", "texto_suficiente": "coalesce(corto, 5) >= 5"}


def _controls(controls: dict[str, str], **names: str) -> dict[str, str]:
    return {n: c.format(**names) for n, c in controls.items()}


_RAW = _controls(_STRUCTURE | _LIFE, e="estado0", a="act0", h="antes")
_LOADED = _controls(_STRUCTURE | {"notas": "coalesce(orientadas, true)"} | _LIFE, e="estado",
                    a="actualizado_en", h="despues")
B.CTES["doc_juzgados"] = (["doc_reparados"], f"""
    SELECT *, concat_ws(',', {', '.join(f"CASE WHEN NOT ({c}) THEN '{n}' END" for n, c in _LOADED.items())}) AS regla
    FROM doc_reparados""")


@query("alert_docs_raw_controls", B.sql("SELECT control, rechazados FROM (" + " UNION ALL ".join(
    f"SELECT '{n}' AS control, count(*) FILTER (WHERE NOT ({c})) AS rechazados FROM doc_resumen"
    for n, c in _RAW.items()) + ")", "doc_resumen"))
def alert_docs_raw_controls(spark, sf):
    """Raw documents failing each control, before any repair."""
    found = L.raw_checks(RULES)
    docs = V.summarise_alert_documents(parsed(spark, sf))
    return V.failures_by_check(V.validate(docs, found), found)


@query("repair_alert_docs", B.sql("""
    SELECT alerta_id, estado, actualizado_en, array_to_string(coalesce(despues, []), '>') AS historial, notas_n AS n_notas,
      orden_corregido, estado_corregido, act_corregido FROM doc_reparados""", "doc_reparados"))
def repair_alert_docs(spark, sf):
    """R-24 on the nested documents of enrolled students."""
    return loaded(spark, sf).judged.select(
        "alerta_id", "estado", "actualizado_en",
        F.array_join(F.transform("historial_estados", lambda h: h["estado"]), ">").alias("historial"),
        F.size("notas").alias("n_notas"), *[F.col(f"_{c}").alias(c) for c in (
            "orden_corregido", "estado_corregido", "act_corregido")])


@query("alert_docs_ledger", B.sql("""
    SELECT 'R-24' AS regla, CAST(sum(CAST(orden_corregido AS INTEGER) + CAST(estado_corregido AS INTEGER)
      + CAST(act_corregido AS INTEGER)) AS BIGINT) AS afectados FROM doc_reparados
    UNION ALL SELECT 'R-25', CAST(sum(notas_n) AS BIGINT) FROM doc_reparados""", "doc_reparados"))
def alert_docs_ledger(spark, sf):
    return loaded(spark, sf).ledger()


@query("alert_docs_quarantine", B.sql("""
    SELECT regla, count(*) AS n, CAST(sum(coalesce(n_estados, 0)) AS BIGINT) AS estados, CAST(sum(notas_n) AS BIGINT) AS notas,
      min(alerta_id) AS primera FROM (SELECT regla, n_estados, notas_n, alerta_id FROM doc_juzgados WHERE regla <> ''
      UNION ALL SELECT 'R-17', n_estados, notas_n, alerta_id FROM doc_resumen WHERE g = 5) GROUP BY regla""", "doc_juzgados"))
def alert_docs_quarantine(spark, sf):
    """The quarantine read back from its records, by the controls that each one fails."""
    return L.read_back(loaded(spark, sf).quarantine).groupBy("regla").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size("historial_estados")).alias("estados"),
        F.sum(F.size("notas")).alias("notas"), F.min("alerta_id").alias("primera"))


@query("alert_docs_reconciliation", B.sql("""
    SELECT (SELECT count(*) FROM orders) AS leidos, (SELECT count(*) FROM doc_juzgados WHERE regla = '') AS aceptados,
      (SELECT count(*) FROM doc_juzgados WHERE regla <> '') + (SELECT count(*) FROM doc_base WHERE g = 5) AS rechazados""",
    "doc_juzgados"))
def alert_docs_reconciliation(spark, sf):
    """Every document read is accepted or in the quarantine."""
    load = loaded(spark, sf)
    none = F.lit(0).cast("bigint")
    kinds = (load.accepted.select(none.alias("leidos"), F.lit(1).alias("a"), F.lit(0).alias("r"))
             .unionByName(load.quarantine.select(none.alias("leidos"), F.lit(0).alias("a"), F.lit(1).alias("r")))
             .unionByName(B.alert_json(spark, sf).select(F.lit(1).cast("bigint").alias("leidos"),
                                                         F.lit(0).alias("a"), F.lit(0).alias("r"))))
    return kinds.agg(F.sum("leidos").alias("leidos"), F.sum("a").alias("aceptados"),
                     F.sum("r").alias("rechazados"))


# aggregates over unnested documents ------------------------------------------------------------ #
@query("doc_lms_activity", B.sql("SELECT * FROM actividad", "actividad"))
def doc_lms_activity(spark, sf):
    """AG-01 over the unnested events of the follow-up documents, all their parts."""
    events = D.unwind(followup_docs(spark, sf), "interacciones_lms", D.DOCUMENT)
    return D.lms_activity(events, periods=B.ACTIVITY_PERIODS)


_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
B.CTES["doc_tutorias"] = ([], f"""
    SELECT user_id AS estudiante_id, CASE WHEN {_K} < 33 THEN 'F' WHEN {_K} < 66 THEN 'O' ELSE 'P' END AS asignatura,
      ts AS fecha, CASE WHEN {_K} % 3 = 0 THEN 'no_asistio' ELSE 'completada' END AS resultado
    FROM events JOIN customer ON c_custkey = user_id
    WHERE event_type = 'signup' AND {B.period_case('ts', B.ACTIVITY_PERIODS)} IS NOT NULL""")


def embedded(spark, sf):
    return D.unwind(followup_docs(spark, sf), "tutorias", D.DOCUMENT)


@query("doc_sessions_per_enrolment", B.sql("""
    SELECT estudiante_id, asignatura, count(*) AS n_tutorias,
      count(*) FILTER (WHERE resultado = 'completada') AS n_tutorias_completadas, min(fecha) AS primera_tutoria
    FROM doc_tutorias GROUP BY ALL""", "doc_tutorias"))
def doc_sessions_per_enrolment(spark, sf):
    """AG-02 over the unnested sessions."""
    return D.sessions_per_enrolment(embedded(spark, sf))


@query("doc_alerts_per_enrolment", B.sql("""
    SELECT estudiante_id, o_orderstatus AS asignatura, count(*) AS n_alertas,
      max(CASE nivel WHEN 'bajo' THEN 1 WHEN 'medio' THEN 2 WHEN 'alto' THEN 3 ELSE 0 END) AS nivel_alerta_max,
      max(CASE WHEN estado = 'cerrada' THEN 1 ELSE 0 END) AS alerta_cerrada, CAST(sum(notas_n) AS BIGINT) AS n_notas
    FROM doc_juzgados WHERE regla = '' GROUP BY ALL""", "doc_juzgados"))
def doc_alerts_per_enrolment(spark, sf):
    """AG-03 over accepted documents; notes are counted in their arrays."""
    return D.alerts_per_enrolment(
        loaded(spark, sf).accepted.withColumn("n_notas", F.size("notas")))


@query("doc_alert_followed_by_session", B.sql("""
    SELECT nivel, count(*) AS n_alertas, count(*) FILTER (WHERE n > 0) AS con_tutoria_posterior,
      count(*) FILTER (WHERE estado = 'cerrada') AS cerradas,
      round_even(count(*) FILTER (WHERE n > 0) / count(*) * 100, 1) AS pct_con_tutoria
    FROM (SELECT d.o_orderkey, d.nivel, d.estado, count(t.estudiante_id) AS n FROM doc_juzgados d
      LEFT JOIN doc_tutorias t ON t.estudiante_id = d.estudiante_id AND t.asignatura = d.o_orderstatus
        AND t.fecha >= d.o_orderdate WHERE d.regla = '' GROUP BY ALL) GROUP BY nivel""", "doc_juzgados", "doc_tutorias"))
def doc_alert_followed_by_session(spark, sf):
    """AG-04 between the two collections of documents."""
    return D.alert_followed_by_session(loaded(spark, sf).accepted, embedded(spark, sf))


@query("doc_alerts_level_state", B.sql(
    "SELECT nivel, estado, count(*) AS n FROM doc_juzgados WHERE regla = '' GROUP BY ALL", "doc_juzgados"))
def doc_alerts_level_state(spark, sf):
    """AG-05 over accepted documents, by their repaired state."""
    return D.alerts_level_state(loaded(spark, sf).accepted)


@query("doc_notes_category_level", B.sql("""
    SELECT categoria, nivel, count(*) AS n FROM doc_categorias JOIN doc_juzgados USING (o_orderkey)
    WHERE regla = '' GROUP BY ALL""", "doc_categorias", "doc_juzgados"))
def doc_notes_category_level(spark, sf):
    """AG-06 over unnested notes of accepted documents."""
    return D.notes_category_level(D.unwind(loaded(spark, sf).accepted, "notas", ["nivel"]))


@query("doc_text_search", B.sql(f"""
    SELECT nivel, count(DISTINCT o_orderkey) AS n_alertas FROM doc_notas JOIN doc_juzgados USING (o_orderkey)
    WHERE regla = '' AND regexp_matches(norm, '(^| )({'|'.join(B.SEARCH_STEMS)})') GROUP BY nivel""",
    "doc_notas", "doc_juzgados"))
def doc_text_search(spark, sf):
    """AG-07: accepted documents with a note that mentions a stem; the arrays are searched in place."""
    found = F.exists("notas", lambda n: T.mentions(n["texto_normalizado"], B.SEARCH_STEMS))
    return loaded(spark, sf).accepted.where(found).groupBy("nivel").agg(
        F.count(F.lit(1)).alias("n_alertas"))

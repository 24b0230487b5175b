"""Registered queries on the activity log, sessions, alerts and nested documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from campuslens.functions.calendar import period_of, school_days as calendar_days
from campuslens.functions.text import standardise
from campuslens.operators import cleaning as C
from campuslens.operators import documents as D
from campuslens.operators import validation as V
from campuslens.plans import testbed as B
from campuslens.plans.registry import query
from campuslens.vocabulary import EVENT_TYPE_MAP, SESSION_RESULT_MAP

SUBJECTS = ("F", "O", "P")
ROLE_RANK = {"system": 0, "user": 1, "assistant": 2}


def cleaned(spark, sf) -> C.CleanedEvents:
    return C.clean_events(B.events_raw(spark, sf), B.enrolment_keys(spark, sf), B.ACTIVITY_PERIODS)


def cleaned_sessions(spark, sf) -> C.CleanedSessions:
    return C.clean_sessions(B.sessions_raw(spark, sf), B.enrolment_keys(spark, sf),
                            B.SESSION_PERIODS)


@query("lms_activity", B.sql("SELECT * FROM actividad", "actividad"))
def lms_activity(spark, sf):
    return D.lms_activity(cleaned(spark, sf).clean, periods=B.ACTIVITY_PERIODS)


@query("lms_totals", B.sql("""
    SELECT estudiante_id, asignatura, CAST(sum(n_eventos) AS BIGINT) AS sim_lms_eventos_total,
      CAST(sum(minutos) AS BIGINT) AS sim_lms_minutos_total FROM actividad GROUP BY ALL""",
    "actividad"))
def lms_totals(spark, sf):
    return D.lms_totals(lms_activity(spark, sf))


@query("clean_events", B.sql("SELECT * FROM limpios", "limpios"))
def clean_events(spark, sf):
    return cleaned(spark, sf).clean


@query("dedup_events", B.sql("SELECT * FROM primeros", "primeros"))
def dedup_events(spark, sf):
    return C.keep_first_events(B.events_raw(spark, sf)).withColumnRenamed("_copias", "copias")


@query("assign_period", f"""
    SELECT event_id, {B.period_case('ts', B.ACTIVITY_PERIODS)} AS periodo FROM events""")
def assign_period(spark, sf):
    return B.table(spark, sf, "events").select(
        "event_id", period_of(F.col("ts"), B.ACTIVITY_PERIODS).alias("periodo"))


_LEDGER = """
    SELECT 'R-15' AS regla, (SELECT count(*) FROM eventos WHERE fecha IS NULL) AS afectados
    UNION ALL SELECT 'R-16', (SELECT CAST(sum(copias - 1) AS BIGINT) FROM primeros)
    UNION ALL SELECT 'R-17', (SELECT count(*) FROM juzgados WHERE regla = 'R-17')
    UNION ALL SELECT 'R-18', (SELECT count(*) FROM juzgados WHERE regla = 'R-18')
    UNION ALL SELECT 'R-19', (SELECT count(*) FROM limpios)
    UNION ALL SELECT 'R-20', (SELECT count(*) FROM juzgados WHERE regla IS NULL
      AND tipo NOT IN ('recurso', 'tarea', 'foro', 'cuestionario'))
    UNION ALL SELECT 'R-21', (SELECT count(*) FROM juzgados WHERE regla IS NULL AND duracion_min < 0)
    UNION ALL SELECT 'R-22', (SELECT count(*) FROM juzgados WHERE regla IS NULL AND duracion_min > 240)"""


@query("rule_ledger", B.sql(_LEDGER, "eventos", "limpios"))
def rule_ledger(spark, sf):
    return cleaned(spark, sf).ledger()


@query("quarantine_by_rule", B.sql("""
    SELECT 'lms' AS fuente, 'R-15' AS regla, count(*) AS n FROM eventos WHERE fecha IS NULL
    UNION ALL SELECT 'lms', regla, count(*) FROM juzgados WHERE regla IS NOT NULL GROUP BY regla
    UNION ALL SELECT 'tutorias', 'R-23', count(*) FROM (
      SELECT t.* FROM tutorias_crudas t LEFT JOIN inscritos i USING (estudiante_id, asignatura)
      WHERE i.estudiante_id IS NULL OR """ + B.period_case("t.fecha", B.SESSION_PERIODS)
    + """ IS NULL)""", "eventos", "juzgados", "tutorias_crudas", "inscritos"))
def quarantine_by_rule(spark, sf):
    both = cleaned(spark, sf).quarantine.unionByName(cleaned_sessions(spark, sf).quarantine)
    return C.quarantine_by_rule(both)


@query("standardise_type", B.sql("""
    SELECT tipo, CASE lower(trim(tipo)) WHEN 'quiz' THEN 'cuestionario' WHEN 'resource' THEN 'recurso'
      ELSE lower(trim(tipo)) END AS estandar, count(*) AS n FROM eventos GROUP BY ALL""", "eventos"))
def standardise_type(spark, sf):
    raw = B.events_raw(spark, sf)
    return raw.groupBy("tipo").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "estandar", standardise(F.col("tipo"), EVENT_TYPE_MAP))


_RESULT = """CASE strip_accents(lower(trim(resultado))) WHEN 'no asistio' THEN 'no_asistio'
    WHEN 'completed' THEN 'completada' WHEN 'rescheduled' THEN 'reprogramada'
    ELSE strip_accents(lower(trim(resultado))) END"""


@query("standardise_result", B.sql(f"""
    SELECT resultado, {_RESULT} AS estandar, count(*) AS n FROM tutorias_crudas GROUP BY ALL""",
    "tutorias_crudas"))
def standardise_result(spark, sf):
    return B.sessions_raw(spark, sf).groupBy("resultado").agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("estandar", standardise(F.col("resultado"), SESSION_RESULT_MAP, fold=True))


@query("clean_sessions", B.sql(f"""
    SELECT * FROM (SELECT t.tutoria_id, t.estudiante_id, t.asignatura, t.fecha, {_RESULT} AS resultado,
      {B.period_case('t.fecha', B.SESSION_PERIODS)} AS periodo
    FROM tutorias_crudas t JOIN inscritos i USING (estudiante_id, asignatura)) WHERE periodo IS NOT NULL""",
    "tutorias_crudas", "inscritos"))
def clean_sessions(spark, sf):
    return cleaned_sessions(spark, sf).clean


@query("session_ledger", B.sql(f"""
    SELECT 'R-23' AS regla, *, mapeados + cuarentena AS afectados FROM (SELECT
      count(*) FILTER (WHERE resultado NOT IN ('completada', 'no_asistio', 'reprogramada')) AS mapeados,
      count(*) FILTER (WHERE i.estudiante_id IS NULL OR {B.period_case('t.fecha', B.SESSION_PERIODS)} IS NULL) AS cuarentena
    FROM tutorias_crudas t LEFT JOIN inscritos i USING (estudiante_id, asignatura))""",
    "tutorias_crudas", "inscritos"))
def session_ledger(spark, sf):
    return cleaned_sessions(spark, sf).ledger()


@query("sessions_per_enrolment", B.sql("""
    SELECT estudiante_id, asignatura, count(*) AS n_tutorias,
      count(*) FILTER (WHERE resultado = 'completada') AS n_tutorias_completadas,
      min(fecha) AS primera_tutoria FROM tutorias GROUP BY ALL""", "tutorias"))
def sessions_per_enrolment(spark, sf):
    return D.sessions_per_enrolment(B.sessions(spark, sf))


@query("alerts_per_enrolment", B.sql("""
    SELECT estudiante_id, asignatura, count(*) AS n_alertas,
      max(CASE nivel WHEN 'bajo' THEN 1 WHEN 'medio' THEN 2 WHEN 'alto' THEN 3 ELSE 0 END) AS nivel_alerta_max,
      max(CASE WHEN estado = 'cerrada' THEN 1 ELSE 0 END) AS alerta_cerrada,
      CAST(sum(n_notas) AS BIGINT) AS n_notas FROM alertas GROUP BY ALL""", "alertas"))
def alerts_per_enrolment(spark, sf):
    return D.alerts_per_enrolment(B.alerts(spark, sf))


@query("alert_followed_by_session", B.sql("""
    SELECT nivel, count(*) AS n_alertas, count(*) FILTER (WHERE n > 0) AS con_tutoria_posterior,
      count(*) FILTER (WHERE estado = 'cerrada') AS cerradas,
      round_even(count(*) FILTER (WHERE n > 0) / count(*) * 100, 1) AS pct_con_tutoria
    FROM (SELECT a.alerta_id, a.nivel, a.estado, count(t.estudiante_id) AS n FROM alertas a
      LEFT JOIN tutorias t ON t.estudiante_id = a.estudiante_id AND t.asignatura = a.asignatura
        AND t.fecha >= a.creada_en GROUP BY ALL) GROUP BY nivel""", "alertas", "tutorias"))
def alert_followed_by_session(spark, sf):
    return D.alert_followed_by_session(B.alerts(spark, sf), B.sessions(spark, sf))


@query("alerts_level_state", B.sql(
    "SELECT nivel, estado, count(*) AS n FROM alertas GROUP BY ALL", "alertas"))
def alerts_level_state(spark, sf):
    return D.alerts_level_state(B.alerts(spark, sf))


@query("pivot_level_state", B.sql("""
    SELECT estado, count(*) FILTER (WHERE nivel = 'bajo') AS bajo,
      count(*) FILTER (WHERE nivel = 'medio') AS medio, count(*) FILTER (WHERE nivel = 'alto') AS alto
    FROM alertas GROUP BY estado""", "alertas"))
def pivot_level_state(spark, sf):
    return D.pivot_level_state(B.alerts(spark, sf), ["bajo", "medio", "alto"])


@query("school_days", f"""
    WITH dias AS (SELECT CAST(range AS DATE) AS dia FROM range(
      (SELECT min(CAST(ts AS DATE)) FROM events), (SELECT max(CAST(ts AS DATE)) FROM events) + 1, INTERVAL 1 DAY))
    SELECT periodo, dia, count(e.event_id) AS n_eventos FROM (
      SELECT {B.period_case('CAST(dia AS TIMESTAMP)', B.ACTIVITY_PERIODS)} AS periodo, dia FROM dias
      WHERE isodow(dia) <= 5) d
    LEFT JOIN events e ON CAST(e.ts AS DATE) = d.dia WHERE periodo IS NOT NULL GROUP BY ALL""")
def school_days(spark, sf):
    """Weekdays of each period with their number of events."""
    per_day = B.table(spark, sf, "events").groupBy(F.to_date("ts").alias("dia")).agg(
        F.count(F.lit(1)).alias("n_eventos"))
    return calendar_days(spark, B.ACTIVITY_PERIODS).join(per_day, "dia", "left").na.fill(
        0, ["n_eventos"])


# nested documents -------------------------------------------------------------------------- #
def embedded_sessions(spark, sf):
    """Sessions with all document fields: the sign-up events."""
    k = F.get_json_object("props", "$.k").cast("int")
    number = F.col("event_id").cast("string")
    base = B.table(spark, sf, "events").where(F.col("event_type") == "signup")
    return base.select(
        F.concat(F.lit("TU-"), F.lpad(number, F.greatest(F.lit(5), F.length(number)), F.lit("0")))
        .alias("tutoria_id"),
        F.col("user_id").alias("estudiante_id"),
        F.when(k < 33, "F").when(k < 66, "O").otherwise("P").alias("asignatura"),
        F.col("ts").alias("fecha"), F.concat(F.lit("TUT-"), F.lpad(k, 2, "0")).alias("tutor"),
        F.when(k % 2 == 0, "virtual").otherwise("presencial").alias("modalidad"),
        F.lit("asistencia").alias("tema"),
        F.when(k % 3 == 0, "no_asistio").otherwise("completada").alias("resultado"),
        period_of(F.col("ts"), B.ACTIVITY_PERIODS).alias("periodo"),
    ).where(F.col("periodo").isNotNull())


_EMBEDDED = f"""SELECT user_id AS estudiante_id, {B.period_case('ts', B.ACTIVITY_PERIODS)} AS periodo,
    count(*) AS n_tutorias FROM events WHERE event_type = 'signup' GROUP BY ALL"""
_GRID = f"""rejilla AS (SELECT c_custkey AS estudiante_id, p.periodo FROM customer
      CROSS JOIN (VALUES ('P1'), ('P2'), ('P3')) p(periodo)),
    ev AS (SELECT estudiante_id, periodo, count(*) AS n_eventos, coalesce(CAST(sum(duracion_min) AS BIGINT), 0) AS minutos,
      arg_min(evento_id, struct_pack(f := fecha, e := evento_id)) AS primero,
      count(*) FILTER (WHERE revisada IS NOT NULL) AS con_revisada,
      bool_or(duracion_min < 1) AS corta FROM limpios GROUP BY ALL),
    tu AS ({_EMBEDDED})"""


def followup_docs(spark, sf, student="TRUE"):
    """Documents of the students that meet a predicate, which is applied before nesting."""
    students = B.table(spark, sf, "customer").select(F.col("c_custkey").alias("estudiante_id"))
    return D.build_followup_docs(students.where(student), cleaned(spark, sf).clean.where(student),
                                 embedded_sessions(spark, sf).where(student), B.ACTIVITY_PERIODS)


@query("build_followup_docs", B.sql(f"""
    SELECT * FROM (WITH {_GRID} SELECT g.estudiante_id, g.periodo,
      coalesce(n_eventos, 0) AS n_eventos, coalesce(n_tutorias, 0) AS n_tutorias,
      coalesce(minutos, 0) AS minutos, primero, coalesce(con_revisada, 0) AS con_revisada
    FROM rejilla g LEFT JOIN ev USING (estudiante_id, periodo)
    LEFT JOIN tu USING (estudiante_id, periodo))""", "limpios"))
def build_followup_docs(spark, sf):
    """Dense documents, reduced to comparable figures over all parts."""
    minutes = F.aggregate("interacciones_lms", F.lit(0).cast("bigint"), lambda a, e: a + F.coalesce(
        e["duracion_min"], F.lit(0)))
    marked = F.size(F.filter("interacciones_lms", lambda e: e["revisada"].isNotNull()))
    head = F.try_element_at("interacciones_lms", F.lit(1))
    return followup_docs(spark, sf).groupBy("estudiante_id", "periodo").agg(
        F.sum(F.size("interacciones_lms")).alias("n_eventos"),
        F.sum(F.size("tutorias")).alias("n_tutorias"), F.sum(minutes).alias("minutos"),
        F.min(F.when(head.isNotNull(), F.struct(head["fecha"].alias("f"),
                                                head["evento_id"].alias("e")))).alias("_p"),
        F.sum(marked).alias("con_revisada")).withColumn("primero", F.col("_p.e")).drop("_p")


RULES = V.Rules(event_id="^EV-[0-9]{7,}$", session_id="^TU-[0-9]{5,}$", subjects=SUBJECTS,
                min_student=0)


@query("validate_followup_docs", B.sql(f"""
    SELECT * FROM (WITH {_GRID}
    SELECT control, CASE WHEN control = 'evento_duracion' THEN (SELECT count(*) FROM ev WHERE corta)
      ELSE 0 END AS rechazados FROM (VALUES ('estudiante'), ('periodo'), ('simulado'), ('evento_id'),
      ('evento_catalogo'), ('evento_duracion'), ('evento_fecha'), ('tutoria_id'), ('tutoria_catalogo'),
      ('tutoria_fecha')) v(control))""", "limpios"))
def validate_followup_docs(spark, sf):
    checks = V.followup_checks(RULES)
    return V.failures_by_check(V.validate(followup_docs(spark, sf), checks), checks, D.DOCUMENT)


@query("doc_volume_counts", B.sql("""
    SELECT (SELECT count(*) * 3 FROM customer) AS documentos, (SELECT count(*) FROM limpios) AS embebidos,
      (SELECT count(*) FROM customer) AS claves""", "limpios"))
def doc_volume_counts(spark, sf):
    return D.volume_counts(followup_docs(spark, sf), "interacciones_lms", "estudiante_id")


@query("doc_lookup", B.sql("""
    SELECT estudiante_id, periodo, min(evento_id) FILTER (WHERE rn = 1) AS primero,
      min(evento_id) FILTER (WHERE rn = 2) AS segundo FROM (
      SELECT *, row_number() OVER (ORDER BY fecha, evento_id) AS rn FROM limpios
      WHERE estudiante_id = 1 AND periodo = 'P1') GROUP BY ALL""", "limpios"))
def doc_lookup(spark, sf):
    """One document by key with the first two items of its array."""
    one = D.doc_lookup(followup_docs(spark, sf, "estudiante_id = 1"),
                       F.expr("estudiante_id = 1 AND periodo = 'P1'"), "interacciones_lms",
                       at_least=2)
    item = F.col("interacciones_lms")
    return one.select("estudiante_id", "periodo", item[0]["evento_id"].alias("primero"),
                      item[1]["evento_id"].alias("segundo"))


# alert lifecycle on flat histories --------------------------------------------------------- #
def role_rank(role):
    out = F.lit(None).cast("int")
    for name, i in ROLE_RANK.items():
        out = F.when(role == name, i).otherwise(out)
    return out


_RANK = "CASE role WHEN 'system' THEN 0 WHEN 'user' THEN 1 WHEN 'assistant' THEN 2 END"


@query("fix_alert_lifecycle", f"""
    SELECT conv_id, arg_min(role, struct_pack(t := turn, r := {_RANK})) AS primer_estado,
      arg_max(role, struct_pack(t := turn, r := {_RANK})) AS estado, max(turn) AS ultimo_cambio,
      count(*) AS n_estados FROM conversations GROUP BY conv_id""")
def fix_alert_lifecycle(spark, sf):
    return C.last_state_per_alert(B.table(spark, sf, "conversations"), "conv_id", "turn", "role",
                                  role_rank(F.col("role")))


_LIFE = f"""SELECT conv_id, arg_min(role, struct_pack(t := turn, r := {_RANK})) AS primero,
    min(length(text)) AS corto, max(turn) AS ultimo, min(turn) AS inicio FROM conversations GROUP BY conv_id"""


@query("validate_alert_docs", f"""
    SELECT c.control, count(*) FILTER (WHERE
      (c.control = 'abre_en_inicial' AND primero <> 'user') OR (c.control = 'texto_suficiente' AND corto < 5)
      ) AS rechazados
    FROM ({_LIFE}) l, (VALUES ('actualizado_tras_crear'), ('actualizado_tras_historial'),
      ('actualizado_tras_notas'), ('notas_tras_crear'), ('estado_es_ultimo'), ('abre_en_inicial'),
      ('historial_no_vacio'), ('texto_suficiente')) c(control) GROUP BY c.control""")
def validate_alert_docs(spark, sf):
    """Lifecycle checks on conversations read as alert histories, aggregated per alert."""
    turns = B.table(spark, sf, "conversations")
    life = C.last_state_per_alert(turns, "conv_id", "turn", "role", role_rank(F.col("role")))
    bounds = turns.groupBy("conv_id").agg(
        F.min("turn").alias("creada_en"), F.max("turn").alias("actualizado_en"),
        F.min("turn").alias("primera_nota"), F.max("turn").alias("ultima_nota"),
        F.min(F.length("text")).alias("texto_minimo"))
    rules = V.Rules(first_state="user")
    checks = V.lifecycle_checks(rules)
    docs = life.join(bounds, "conv_id").withColumn("ultimo_estado", F.col("estado"))
    return V.failures_by_check(V.validate(docs, checks), checks)

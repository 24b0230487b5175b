"""Quality cascade on literal rows: each defect is charged to the first rule it fails."""

import json
from datetime import datetime as D

import pytest
from pyspark.sql import functions as F

from campuslens.functions.calendar import period_of
from campuslens.functions.text import categorise, mentions, normalise_text, ABSENCE_STEMS
from campuslens.operators import cleaning as C
from campuslens.operators import documents as X
from campuslens.operators import validation as V
from campuslens.sources import json as J

EVENTS = [
    (1, "EV-0000001", 1, "MAT", "2005-10-03T10:00:00", "RECURSO ", -12),
    (2, "EV-0000001", 1, "MAT", "2005-10-03T10:00:00", "recurso", 30),
    (3, "EV-0000002", 1, "MAT", None, "tarea", 30),
    (4, "EV-0000002", 1, "MAT", "2005-09-15T00:00:00", " tarea", 240),
    (5, "EV-0000003", 1, "MAT", "", "foro", 30),
    (6, "EV-0000004", 9001, "MAT", "2006-07-15T00:00:00", "foro", 30),
    (7, "EV-0000005", 1, "MAT", "2006-07-15T00:00:00", "foro", 30),
    (8, "EV-0000006", 1, "MAT", "2005-12-16T23:00:00", "quiz", 1499),
    (9, "EV-0000007", 1, "POR", "2006-02-01T00:00:00", "foro", 241),
]


@pytest.fixture(scope="module")
def cleaned(spark):
    raw = spark.createDataFrame(EVENTS, "orden_llegada long, evento_id string, estudiante_id int, "
                                "asignatura string, fecha string, tipo string, duracion_min int")
    raw = raw.withColumn("fecha", J.moment(F.col("fecha"))).withColumn(
        "revisada", F.lit(None).cast("boolean"))
    enrolled = spark.createDataFrame([(1, "MAT"), (1, "POR")], "estudiante_id int, asignatura string")
    return raw, C.clean_events(raw.repartition(3), enrolled)


def test_first_failed_rule(cleaned):
    ledger = {r["regla"]: r["afectados"] for r in cleaned[1].ledger().collect()}
    assert ledger == {"R-15": 2, "R-16": 1, "R-17": 1, "R-18": 1, "R-19": 4, "R-20": 3,
                      "R-21": 1, "R-22": 2}


def test_conservation_and_values(cleaned):
    raw, result = cleaned
    clean = {r["evento_id"]: r for r in result.clean.collect()}
    quarantine = result.quarantine.collect()
    assert raw.count() == len(clean) + len(quarantine) + 1
    assert clean["EV-0000001"]["tipo"] == "recurso" and clean["EV-0000001"]["duracion_min"] is None
    assert [clean[f"EV-000000{i}"]["duracion_min"] for i in (2, 6, 7)] == [240, 240, 240]
    assert {clean[k]["periodo"] for k in ("EV-0000001", "EV-0000002", "EV-0000006")} == {"P1"}
    record = json.loads(next(r["registro"] for r in quarantine if r["regla"] == "R-17"))
    assert record["estudiante_id"] == 9001


def test_documents_and_validators(spark, cleaned):
    students = spark.createDataFrame([(1,), (2,)], "estudiante_id int")
    none = spark.createDataFrame([], "estudiante_id int, periodo string, tutoria_id string, "
                                 "asignatura string, fecha timestamp_ntz, tutor string, "
                                 "modalidad string, tema string, resultado string")
    for size in (10_000, 1):
        docs = X.build_followup_docs(students, cleaned[1].clean, none, max_items=size)
        items = X.unwind(docs, "interacciones_lms", ["estudiante_id", "periodo"])
        assert items.count() == 4
        assert docs.where("parte = 0").count() == 6
        assert docs.count() == (6 if size > 1 else 8)
    checks = V.followup_checks()
    ok = V.validate(X.build_followup_docs(students, cleaned[1].clean, none), checks)
    assert ok.where("NOT valido").count() == 0
    bad = ok.withColumn("periodo_fin", F.lit("2005-09-16").cast("timestamp_ntz"))
    good, rejected = V.split_valid(V.validate(bad.drop("_fallos", "valido"), checks), "seguimiento",
                                   ["estudiante_id", "periodo", "interacciones_lms"])
    assert rejected.count() == 2 and good.count() == 4


ALERT = ("AL-00001", 1, "MAT", "P2", "alto", "abierta", D(2006, 1, 10), D(2006, 1, 5),
         [("cerrada", D(2006, 2, 1)), ("abierta", D(2006, 1, 10)), ("en_seguimiento", D(2006, 2, 1))],
         [("N1", D(2006, 2, 5), "ORI-01", "Est. con faltas")])
ALERT_SCHEMA = ("alerta_id string, estudiante_id int, asignatura string, periodo string, nivel string, "
                "estado string, creada_en timestamp_ntz, actualizado_en timestamp_ntz, "
                "historial_estados array<struct<estado:string,fecha:timestamp_ntz>>, "
                "notas array<struct<nota_id:string,fecha:timestamp_ntz,autor:string,texto:string>>")


def test_alert_lifecycle(spark):
    raw = spark.createDataFrame([ALERT], ALERT_SCHEMA).withColumns(
        {"es_simulado": F.lit(True), "fuente": F.lit("prueba")})
    fixed = C.fix_alert_documents(raw)
    row = fixed.first()
    assert [h["estado"] for h in row["historial_estados"]] == ["abierta", "en_seguimiento", "cerrada"]
    assert row["estado"] == "cerrada" and row["actualizado_en"] == D(2006, 2, 5)
    assert row["notas"][0]["categoria"] == "asistencia"
    assert {r["regla"]: r["afectados"] for r in C.alert_ledger(fixed).collect()} == {"R-24": 3, "R-25": 1}
    assert V.validate_alert_documents(fixed).first()["valido"]
    stale = fixed.withColumn("actualizado_en", F.lit("2006-01-05").cast("timestamp_ntz"))
    assert not V.validate_alert_documents(stale).first()["valido"]


def test_sessions(spark):
    raw = spark.createDataFrame(
        [("TU-00001", 1, "MAT", D(2006, 2, 1), "No asistió"), ("TU-00002", 1, "MAT", D(2006, 2, 1), "COMPLETADA"),
         ("TU-00003", 1, "MAT", D(2006, 8, 3), "completada"), ("TU-00004", 1, "MAT", None, "rescheduled")],
        "tutoria_id string, estudiante_id int, asignatura string, fecha timestamp_ntz, resultado string")
    out = C.clean_sessions(raw, spark.createDataFrame([(1, "MAT")], "estudiante_id int, asignatura string"))
    assert {r["tutoria_id"]: r["resultado"] for r in out.clean.collect()} == {
        "TU-00001": "no_asistio", "TU-00002": "completada"}
    led = out.ledger().first()
    assert (led["mapeados"], led["cuarentena"], led["afectados"]) == (3, 2, 5)


def test_pure_functions(spark):
    days = [(D(2005, 10, 3), "P1"), (D(2006, 2, 1), "P2"), (D(2006, 5, 20), "P3"),
            (D(2006, 7, 15), None), (D(2005, 12, 25), None), (None, None)]
    got = spark.createDataFrame(days, "d timestamp_ntz, p string").select(
        period_of(F.col("d")).alias("x"), "p").collect()
    assert all(r["x"] == r["p"] for r in got)
    texts = [("INASISTENCIAS  reiteradas; se contacta al representante. Est. con faltas",
              "inasistencias reiteradas se contacta al representante estudiante con faltas", "asistencia"),
             ("Conducta disruptiva en el aula", "conducta disruptiva en el aula", "conducta"),
             ("", "", "indeterminada"), ("familia nota", "familia nota", "indeterminada"),
             ("Straße ﬁn ½ Ñandú…", "strae fin 12 nandu", "indeterminada")]
    df = spark.createDataFrame(texts, "t string, n string, c string").withColumn(
        "x", normalise_text(F.col("t")))
    for r in df.withColumn("y", categorise(F.col("x"))).collect():
        assert (r["x"], r["y"]) == (r["n"], r["c"])
    assert df.where(mentions(F.col("x"), ABSENCE_STEMS)).count() == 1


def test_active_days_over_a_whole_period(spark):
    days = spark.sql("SELECT explode(sequence(date'2005-09-15', date'2005-12-16')) AS d").select(
        F.lit(1).alias("estudiante_id"), F.lit("MAT").alias("asignatura"), F.lit("P1").alias("periodo"),
        F.explode(F.array(F.lit(8), F.lit(15))).alias("h"), "d").select(
        "*", F.col("d").cast("timestamp_ntz").alias("fecha"), F.lit("tarea").alias("tipo"),
        F.lit(5).alias("duracion_min"), (F.col("h") == 8).alias("revisada"))
    row = X.lms_activity(days).first()
    assert (row["n_eventos"], row["minutos"], row["n_tareas"], row["n_tareas_revisadas"],
            row["dias_activos"]) == (186, 930, 186, 93, 93)


def test_counts_add_up_in_one_pass(spark, cleaned):
    raw, result = cleaned
    row = result.counts().first().asDict()
    assert row == {"entrada": raw.count(), "duplicados": 1, "rechazados": result.quarantine.count(),
                   "salida": result.clean.count()}
    assert row["entrada"] == row["duplicados"] + row["rechazados"] + row["salida"]
    keys = spark.createDataFrame([(1, "MAT")], "estudiante_id int, asignatura string")
    talks = C.clean_sessions(spark.createDataFrame(
        [(1, "MAT", D(2005, 10, 3), "completada"), (1, "MAT", None, "x"), (None, "MAT", D(2005, 10, 3), "x")],
        "estudiante_id int, asignatura string, fecha timestamp_ntz, resultado string"), keys)
    assert talks.counts().first().asDict() == {"entrada": 3, "duplicados": 0, "rechazados": talks.quarantine.count(),
                                               "salida": talks.clean.count()}

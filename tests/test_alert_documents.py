"""Raw alert documents: parsing, repair, controls, split and the quarantine read back."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from campuslens.operators import alert_documents as L
from campuslens.operators import documents as X

GOOD = {"alerta_id": "AL-00001", "estudiante_id": 1, "asignatura": "MAT", "periodo": "P2", "nivel": "alto",
        "estado": "abierta", "creada_en": "2006-01-10T00:00:00", "actualizado_en": "2006-01-05T00:00:00",
        "historial_estados": [{"estado": "cerrada", "fecha": "2006-02-01T00:00:00"},
                              {"estado": "abierta", "fecha": "2006-01-10T00:00:00"},
                              {"estado": "en_seguimiento", "fecha": "2006-02-01T00:00:00"}],
        "notas": [{"nota_id": "N1", "fecha": "2006-02-05T00:00:00", "autor": "ORI-01", "texto": "Est. con faltas"}],
        "es_simulado": True, "fuente": "prueba"}
BAD = {  # control -> change that breaks it
    "campos_ajenos": {"otro": 1},
    "alerta_id": {"alerta_id": "X"},
    "catalogos": {"nivel": "urgente"},
    "simulado": {"es_simulado": False},
    "estados": {"historial_estados": [{"estado": "abierta", "fecha": "2006-01-10T00:00:00"},
                                      {"estado": "reabierta", "fecha": "2006-01-11T00:00:00"}]},
    "notas": {"notas": [{"nota_id": "N1", "fecha": "2006-02-05T00:00:00", "autor": "yo", "texto": "bastante"}]},
    "notas_tras_crear": {"notas": [{"nota_id": "N1", "fecha": "2006-01-05T00:00:00", "autor": "ORI-01",
                                    "texto": "bastante"}]},
    "abre_en_inicial": {"historial_estados": [{"estado": "cerrada", "fecha": "2006-01-10T00:00:00"}]},
    "historial_no_vacio": {"historial_estados": []},
    "texto_suficiente": {"notas": [{"nota_id": "N1", "fecha": "2006-02-05T00:00:00", "autor": "ORI-01",
                                    "texto": "abc"}]},
}


@pytest.fixture(scope="module")
def load(spark):
    docs = [GOOD] + [GOOD | change for change in BAD.values()]
    docs += [GOOD | {"estudiante_id": 99}, GOOD | {"notas": None, "alerta_id": "AL-00077"}]
    raw = spark.createDataFrame([(json.dumps(d),) for d in docs] + [("no json",), (None,)], "d string")
    keys = spark.createDataFrame([(1, "MAT")], "estudiante_id bigint, asignatura string")
    return L.load(L.parse(raw, "d"), keys)


def test_repair_and_acceptance(load):
    rows = {r["alerta_id"]: r for r in load.accepted.collect()}
    assert set(rows) == {"AL-00001", "AL-00077"}
    assert [h["estado"] for h in rows["AL-00001"]["historial_estados"]] == ["abierta", "en_seguimiento", "cerrada"]
    assert rows["AL-00001"]["estado"] == "cerrada" and rows["AL-00077"]["notas"] == []
    assert rows["AL-00001"]["actualizado_en"] == datetime.datetime(2006, 2, 5)


def test_every_control_rejects(load):
    rules = [r["regla"] for r in load.quarantine.collect()]
    assert len(rules) == len(BAD) + 3 and rules.count("R-17") == 3  # orphans, text that is no document, null
    failed = {name for r in rules for name in r.split(",")}
    assert set(BAD) <= failed


def test_nothing_is_lost(load):
    assert load.accepted.count() + load.quarantine.count() == len(BAD) + 5
    back = L.read_back(load.quarantine).where("regla = 'notas'").first()
    assert back["notas"][0]["autor"] == "yo" and back["notas"][0]["texto_normalizado"] == "bastante"


def test_unwound_notes(load):
    notes = X.unwind(load.accepted, "notas", ["alerta_id", "nivel"])
    assert [(r["categoria"], r["nivel"], r["n"]) for r in X.notes_category_level(notes).collect()] == [
        ("asistencia", "alto", 1)]


def test_empty_input(spark):
    keys = spark.createDataFrame([(1, "MAT")], "estudiante_id bigint, asignatura string")
    empty = L.load(L.parse(spark.createDataFrame([], "d string"), "d"), keys)
    assert empty.accepted.count() == 0 == empty.quarantine.count()
    assert {r["regla"]: r["afectados"] for r in empty.ledger().collect()} == {"R-24": 0, "R-25": 0}


def test_raw_controls_see_what_the_repair_mends(spark):
    found = L.raw_checks(L.V.Rules())
    raw = spark.createDataFrame([(json.dumps(GOOD),)], "d string")
    judged = L.V.validate(L.V.summarise_alert_documents(L.parse(raw, "d")), found)
    assert set(judged.select(F.explode("_fallos")).toPandas()["col"]) == {
        "actualizado_tras_crear", "actualizado_tras_historial", "actualizado_tras_notas", "estado_es_ultimo",
        "abre_en_inicial"}


def test_ledger_stages_no_repaired_documents(spark, monkeypatch):
    staged, stage = [], L.materialise
    monkeypatch.setattr(L, "materialise", lambda df, label: staged.append(label) or stage(df, label))
    late = GOOD | {"estado": "abierta", "actualizado_en": "2006-01-01T00:00:00"}
    raw = spark.createDataFrame([(json.dumps(d),) for d in (late, GOOD | {"estudiante_id": 99})], "d string")
    keys = spark.createDataFrame([(1, "MAT")], "estudiante_id bigint, asignatura string")
    load = L.load(L.parse(raw, "d"), keys)
    ledger = {r["regla"]: r["afectados"] for r in load.ledger().collect()}
    assert staged == ["alertas"]
    assert ledger == {r["regla"]: r["afectados"] for r in L.C.alert_ledger(load.judged).collect()}
    assert ledger["R-24"] >= 2 and ledger["R-25"] == len(GOOD["notas"])

"""Small end-to-end run on literal register files and JSON sources."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from campuslens import vocabulary as V
from campuslens.operators import checks as K
from campuslens.operators.dataset import DICTIONARY, REQUIRED
from campuslens.operators.features import SCENARIOS, leaked
from campuslens.plans import pipeline as P
from campuslens.sources import register as R
from campuslens.sources import tables as S


def register_row(i, **changes):
    row = {c: d[0] for c, d in V.NOMINAL_DOMAINS.items()} | {c: d[0] for c, d in V.NUMERIC_DOMAINS.items()}
    row |= {"age": 15 + i % 6, "Medu": i % 5, "G1": 5 + i, "G2": 8, "G3": 7 + i, "absences": 3} | changes
    return row


def write_csv(path, rows):
    lines = [";".join(V.REGISTER_COLUMNS)]
    for r in rows:
        lines.append(";".join(f'"{r[c]}"' for c in V.REGISTER_COLUMNS))
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("in")
    mat = write_csv(root / "student-mat.csv", [register_row(0), register_row(1, G3=0, absences=0),
                                               register_row(2, sex="M")])
    por = write_csv(root / "student-por.csv", [register_row(0), register_row(1, higher="no")])
    tables = P.register_tables(spark, {"MAT": mat, "POR": por})
    events = [{"evento_id": f"EV-{i:07d}", "estudiante_id": 1, "asignatura": "MAT",
               "fecha": f"2005-10-0{i}T08:00:00", "tipo": "Task", "duracion_min": 300,
               "revisada": True} for i in (1, 2, 2, 3)]
    (root / "ev.jsonl").write_text("\n".join(map(json.dumps, events)))
    (root / "tu.jsonl").write_text(json.dumps({
        "tutoria_id": "TU-00001", "estudiante_id": 1, "asignatura": "MAT", "fecha": "2006-02-01T09:00:00",
        "tutor": "TUT-01", "modalidad": "virtual", "tema": "asistencia", "resultado": "completed"}))
    alert = {"alerta_id": "AL-00001", "estudiante_id": 1, "asignatura": "MAT", "periodo": "P2",
             "nivel": "alto", "estado": "abierta", "creada_en": "2006-01-05T00:00:00",
             "actualizado_en": "2006-01-05T00:00:00",
             "historial_estados": [{"estado": "abierta", "fecha": "2006-01-05T00:00:00"}], "notas": []}
    (root / "al.json").write_text(json.dumps([alert, alert | {"alerta_id": "AL-00002", "estudiante_id": 99}]))
    behaviour = P.clean_behaviour(spark, str(root / "ev.jsonl"), str(root / "tu.jsonl"),
                                  str(root / "al.json"), tables)
    return root, tables, behaviour


def test_register_and_identity(spark, built):
    root, tables, _ = built
    ids = {(r["archivo_origen"], r["fila_origen"]): r["estudiante_id"] for r in tables.matricula.collect()}
    assert ids == {("student-por.csv", 2): 1, ("student-por.csv", 3): 2, ("student-mat.csv", 2): 1,
                   ("student-mat.csv", 3): 2, ("student-mat.csv", 4): 3}
    report = K.integrity_report(tables, P.expected_counts(5, 3, 2, 1))
    assert K.failed_controls(report).count() == 0
    published = S.publish(spark, tables, str(root / "out"), lambda t: K.integrity_report(
        t, P.expected_counts(5, 3, 2, 1)))
    assert published.calificacion.count() == 15
    assert S.published(spark, str(root / "out")).matricula.count() == 5
    with pytest.raises(ValueError):
        S.publish(spark, tables, str(root / "out"), lambda t: K.integrity_report(
            t, P.expected_counts(6, 3, 2, 1)))


def test_dataset(built):
    _, tables, behaviour = built
    data = P.analytic_dataset(tables, behaviour)
    assert len(data.columns) == 58 == len(DICTIONARY)
    rows = {(r["estudiante_id"], r["asignatura"]): r for r in data.collect()}
    assert len(rows) == 5 and all(r[c] is not None for r in rows.values() for c in REQUIRED)
    first = rows[1, "MAT"]
    assert (first["sim_lms_eventos_p1"], first["sim_lms_minutos_p1"], first["sim_n_tutorias_completadas"],
            first["sim_n_alertas"]) == (3, 720, 1, 1)
    assert rows[2, "MAT"]["rendimiento_sobre_promedio"] is None
    assert not rows[2, "MAT"]["faltas_confiable"] and rows[2, "MAT"]["en_riesgo"] == 1
    assert behaviour.quarantine.select("regla").collect()[0]["regla"] == "R-17"


def test_documents_are_held_to_their_validators(built):
    _, tables, behaviour = built
    stored = P.store_documents(tables, behaviour)
    assert stored.followup.count() == 9 and stored.quarantine.count() == 0
    assert [r["alerta_id"] for r in stored.alerts.collect()] == ["AL-00001"]
    strict = P.store_documents(tables, behaviour, rules=P.W.Rules(event_id="^X", alert_id="^X"))
    assert strict.followup.count() == 8 and strict.alerts.count() == 0
    assert {(r["fuente"], r["regla"]) for r in strict.quarantine.collect()} == {
        ("seguimiento", "evento_id"), ("alertas", "alerta_id")}


def test_bad_files_abort(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("school;sex\nGP;F\n")
    with pytest.raises(ValueError, match="R-01"):
        R.read_register(spark, str(path), "MAT")
    bad = write_csv(tmp_path / "y.csv", [register_row(0, age="abc")])
    with pytest.raises(Exception, match="not an integer"):
        R.read_register(spark, bad, "MAT").collect()


def test_identity_reports(spark, tmp_path):
    mat = write_csv(tmp_path / "mat.csv", [register_row(0), register_row(3, sex="M"), register_row(4)])
    por = write_csv(tmp_path / "por.csv", [register_row(0, higher="no"), register_row(3, sex="M", age=22),
                                           register_row(4), register_row(4, traveltime=4)])
    report = P.load_register(spark, {"MAT": mat, "POR": por})
    assert [(r["asignatura"], r["filas"]) for r in report.repeated_keys.collect()] == [("POR", 2)]
    assert [(r["atributo_distinto"], r["valor_a"], r["valor_b"]) for r in report.near_misses.collect()] == [
        ("age", str(register_row(3)["age"]), "22")]
    assert {r["atributo"]: r["conflictos"] for r in report.conflicts.collect() if r["conflictos"]} == {
        "higher": 1}


def test_fan_out_aborts(built):
    _, tables, behaviour = built
    twice = replace(tables, calificacion=tables.calificacion.where("estudiante_id <> 2"))
    with pytest.raises(ValueError, match="enrolments"):
        P.analytic_dataset(twice, behaviour)


def test_no_leakage():
    assert all(not leaked(s) for s in SCENARIOS.values())
    assert "faltas" not in SCENARIOS["A_corte_P1"].numeric

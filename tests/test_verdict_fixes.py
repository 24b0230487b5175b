"""Cases in which the registered tables have no such rows: several files, blanks, all planes."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from campuslens import vocabulary as V
from campuslens.functions import text as X
from campuslens.functions.calendar import SCHOOL_YEAR
from campuslens.operators import documents as D
from campuslens.operators import models as M
from campuslens.operators import running as U
from campuslens.operators import validation
from campuslens.operators.documents import lms_activity
from campuslens.operators.features import CATEGORICAL, Scenario
from campuslens.plans import pipeline as P
from campuslens.sources.register import read_register
from test_pipeline import register_row, write_csv


def test_register_of_several_files_keeps_every_row_once(spark, tmp_path):
    parts = []
    for subject, shift in (("MAT", 0), ("POR", 1)):
        folder = tmp_path / subject
        folder.mkdir()
        write_csv(folder / "a.csv", [register_row(i + shift) for i in range(2)])
        write_csv(folder / "b.csv", [register_row(i + shift, sex="M") for i in range(2)])
        parts.append(read_register(spark, str(folder), subject))
    ids = P.resolve(parts[0].unionByName(parts[1]))
    rows = ids.collect()
    assert len(rows) == 8
    assert len({(r.ruta_origen, r.fila_origen) for r in rows}) == 8
    by_subject = {s: [r.estudiante_id for r in rows if r.asignatura == s] for s in ("MAT", "POR")}
    assert all(len(set(v)) == 4 for v in by_subject.values())
    assert sorted(by_subject["POR"]) == [1, 2, 3, 4]
    assert P.unmatched(ids).count() == 8 - 2 * len(set(by_subject["MAT"]) & set(by_subject["POR"]))


def test_near_misses_leave_matched_rows_out(spark, tmp_path):
    mat = read_register(spark, write_csv(tmp_path / "m.csv", [
        register_row(0), register_row(2, school="GP")]), "MAT")
    por = read_register(spark, write_csv(tmp_path / "p.csv", [
        register_row(0), register_row(2, school="MS")]), "POR")
    ids = P.resolve(mat.unionByName(por))
    found = P.register_near_misses(ids).collect()
    assert [(r.atributo_distinto, r.valor_a, r.valor_b) for r in found] == [("school", "GP", "MS")]


@pytest.mark.parametrize("raw", ["\tquiz\n", " Quiz　", "quiz", "\x1cQUIZ\x85"])
def test_blanks_of_every_kind_are_stripped(spark, raw):
    frame = spark.createDataFrame([(raw,)], "x string")
    assert frame.select(X.standardise(F.col("x"), V.EVENT_TYPE_MAP)).first()[0] == "cuestionario"


def test_letters_beyond_the_basic_plane_fold(spark):
    frame = spark.createDataFrame([("𝐟𝐚𝐥𝐭𝐚 🙂 ñandú",)], "x string")
    assert frame.select(X.normalise_text(F.col("x"))).first()[0] == "falta nandu"


def test_days_do_not_alias_without_the_period(spark):
    first = min(p.start for p in SCHOOL_YEAR)
    last = max(p.end for p in SCHOOL_YEAR)
    days = [first + timedelta(i) for i in range((last - first).days + 1)]
    rows = [(1, "MAT", d, "tarea", 5, True) for d in days]
    frame = spark.createDataFrame(
        rows, "estudiante_id int, asignatura string, fecha date, tipo string, duracion_min int, revisada boolean")
    got = lms_activity(frame, keys=("estudiante_id", "asignatura")).first()
    assert got.dias_activos == len(days) and isinstance(days[0], date)


def test_value_outside_a_closed_catalogue_ends_the_load(spark):
    frame = spark.createDataFrame([("wiki",), ("foro",)], "tipo string")
    with pytest.raises(ValueError, match="R-20: 1 values"):
        P.assert_closed(frame, "tipo", V.EVENT_TYPES, "R-20")
    P.assert_closed(frame.where("tipo = 'foro'"), "tipo", V.EVENT_TYPES, "R-20")


def test_slices_follow_the_histogram_not_the_values(spark):
    rows = spark.range(20_000).select((F.col("id") / 20_000).alias("v"), F.lit(1).alias("n"))
    rows = rows.unionByName(spark.createDataFrame([(1e9, 1)], "v double, n int"))
    sliced = U.in_slices(rows, [], "v", 2000)
    sizes = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
    assert len(sizes) == 11 and max(sizes) <= 2 * 20_001 / len(sizes)
    got = U.running_sums(rows, [], "v", ["n"], slice_rows=2000).orderBy("v").collect()
    assert [r.n_below for r in got] == list(range(20_001))
    assert {r.n_all for r in got} == {20_001}


def test_documents_in_parts_count_and_answer_like_whole_ones(spark):
    first = min(p.start for p in SCHOOL_YEAR)
    code = min(SCHOOL_YEAR, key=lambda p: p.start).code
    events = spark.createDataFrame(
        [(f"EV-{i:07d}", "MAT", datetime(first.year, first.month, first.day, 8, i), "foro",
          0 if i == 3 else 5, None, 1, code) for i in range(5)],
        "evento_id string, asignatura string, fecha timestamp_ntz, tipo string, duracion_min int, "
        "revisada boolean, estudiante_id int, periodo string")
    sessions = spark.createDataFrame(
        [], "tutoria_id string, asignatura string, fecha timestamp_ntz, tutor string, modalidad string, "
            "tema string, resultado string, estudiante_id int, periodo string")
    students = spark.createDataFrame([(1,), (2,)], "estudiante_id int")
    checks = validation.followup_checks()
    answers = []
    for size in (1, 2, 10_000):
        docs = D.build_followup_docs(students, events, sessions, max_items=size)
        counts = tuple(D.volume_counts(docs, "interacciones_lms", "estudiante_id").first())
        failed = validation.failures_by_check(validation.validate(docs, checks), checks, D.DOCUMENT)
        one = D.doc_lookup(docs, F.col("estudiante_id") == 1, "interacciones_lms", 2, 2).first()
        answers.append((counts, {r.control: r.rechazados for r in failed.collect()}, one.periodo,
                        [e.evento_id for e in one.interacciones_lms]))
    assert answers[0] == answers[1] == answers[2]
    assert answers[0][0] == (2 * len(SCHOOL_YEAR), 5, 2) and answers[0][1]["evento_duracion"] == 1
    assert answers[0][2:] == (code, ["EV-0000000", "EV-0000001"])


def test_forest_does_not_depend_on_the_input_partitions(spark, monkeypatch):
    monkeypatch.setitem(M.MODELS, M.FOREST, lambda rows: M.forest(rows).setNumTrees(5))
    i = F.col("id")
    rows = spark.range(400).select(
        i.alias("estudiante_id"), F.lit("MAT").alias("asignatura"),
        *[F.when(i % 3 == 0, "a").otherwise("b").alias(c) for c in CATEGORICAL if c != "asignatura"],
        (i % 17).alias("x"), (F.xxhash64("id") % 5).alias("y"),
        ((i % 17 + F.xxhash64("id") % 5) > 9).cast("int").alias("en_riesgo"))
    scores = []
    for parts in (2, 8):
        dealt = rows.repartition(parts)
        fitted = M.fit(dealt, Scenario("s", ("x", "y"), ()), M.FOREST)
        scores.append([r.p for r in fitted.score(rows, "p").orderBy("estudiante_id").collect()])
    assert scores[0] == scores[1]


def test_forest_larger_than_the_driver_is_fitted_in_groups(spark, monkeypatch):
    monkeypatch.setitem(M.MODELS, M.FOREST, lambda rows: M.forest(rows).setNumTrees(5))
    i = F.col("id")
    rows = spark.range(300).select(
        i.alias("estudiante_id"), F.lit("MAT").alias("asignatura"),
        *[F.when(i % 3 == 0, "a").otherwise("b").alias(c) for c in CATEGORICAL if c != "asignatura"],
        (i % 17).alias("x"), ((i % 17) > 9).cast("int").alias("en_riesgo"))
    whole = M.fit(rows, Scenario("s", ("x",), ()), M.FOREST)
    assert not isinstance(whole.model, M.ForestGroups)  # few rows: one fit of all trees, as before
    monkeypatch.setattr(M, "FOREST_NODES", 2 * 300 // 5 * 2)
    fits = []
    fit = M.RandomForestClassifier.fit
    monkeypatch.setattr(M.RandomForestClassifier, "fit",
                        lambda self, data: fits.append(self.getNumTrees()) or fit(self, data))
    grouped = M.fit(rows, Scenario("s", ("x",), ()), M.FOREST)
    assert fits == [2, 2, 1]
    scored = grouped.score(rows, "p")
    assert scored.columns == [*rows.columns, "p"]
    got = scored.select("en_riesgo", "p").collect()
    assert len(got) == 300 and all(0 <= r.p <= 1 and (r.p > 0.5) == (r.en_riesgo == 1) for r in got)

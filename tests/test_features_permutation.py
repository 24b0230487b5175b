"""Encoder without a bound on categories, permutations of the whole table."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from campuslens.operators import models as L
from campuslens.operators.features import Encoder, Scenario


def test_encoding_of_two_many_missing_and_unseen_categories(spark):
    train = spark.createDataFrame([("a", "x", 1.0, True), ("b", "y", 3.0, False), ("a", "z", 5.0, True), (None, "x", 3.0, True)],
                                  "two string, many string, n double, flag boolean")
    test = spark.createDataFrame([("b", "z", 3.0, True), ("c", None, 5.0, False)], train.schema)
    train, test = (d.withColumn("flag", F.col("flag").cast("int")) for d in (train, test))
    encoder = Encoder.fit(train, Scenario("s", ("n",), ("flag",)), ["two", "many"])
    assert encoder.names() == ["two=b", "many=x", "many=y", "many=z", "n", "flag"]
    rows = [r[0] for r in encoder.transform(test).select(vector_to_array("features")).collect()]
    sd, fs = 2 ** 0.5, (3 / 16) ** 0.5
    want = [[1, 0, 0, 1, 0, 0.25 / fs], [0, 0, 0, 0, 2 / sd, -0.75 / fs]]
    assert all(abs(x - y) < 1e-12 for r, w in zip(rows, want) for x, y in zip(r, w))


def test_many_categories_encode(spark):
    df = spark.range(100_000).select(F.concat(F.lit("c"), "id").alias("c"), F.col("id").cast("double").alias("n"))
    encoder = Encoder.fit(df, Scenario("s", ("n",), ()), ["c"])
    first = encoder.transform(df.limit(1)).first()["features"]
    assert len(encoder.names()) == first.size == 100_001
    assert first.numNonzeros() == 2  # the vector is sparse


def test_partners_are_permutations_of_the_whole_table(spark):
    n, repeats = 5_000, 3
    rows = spark.range(n).select("id", (F.col("id") * 2).alias("v"))
    got = L.shuffled_partners(rows, ["id"], ["v"], repeats, 1).select("_rep", "id", F.col("_other.v").alias("o")).collect()
    assert len(got) == n * repeats
    far = 0
    for rep in range(1, repeats + 1):
        own = {r["id"]: r["o"] for r in got if r["_rep"] == rep}
        assert sorted(own) == list(range(n)) and sorted(own.values()) == [2 * k for k in range(n)]
        far += sum(abs(k - o // 2) > n / 4 for k, o in own.items())
    assert 0.4 < far / (n * repeats) < 0.7  # 9/16 expected


def test_importance_finds_the_column_that_matters(spark):
    rows = spark.range(4_000).select(
        F.col("id").alias("estudiante_id"), F.lit("M").alias("asignatura"), F.rand(1).alias("u"), F.rand(2).alias("w"))
    rows = rows.withColumn("en_riesgo", (F.col("u") + 0.1 * F.rand(3) > 0.6).cast("int"))

    class Model:
        def score(self, df, name):
            return df.withColumn(name, F.col("u"))

    got = {r["variable"]: r for r in L.permutation_importance(Model(), rows, ["u", "w"], repeats=5).collect()}
    assert 0.4 < got["u"]["importancia"] < 0.55 and got["w"]["importancia"] == 0


def test_rows_are_encoded_once_for_all_scenarios(spark, monkeypatch):
    n = 400
    rows = spark.range(n).select(
        F.col("id").alias("estudiante_id"), F.lit("M").alias("asignatura"), (F.col("id") % 5 + 1).cast("int").alias("pliegue"),
        (F.col("id") % 3).cast("string").alias("c"), F.rand(1).alias("u"), F.rand(2).alias("w"))
    rows = rows.withColumn("en_riesgo", (F.col("u") + F.rand(3) > 1).cast("int")).localCheckpoint()
    scenarios = [Scenario("a", ("u",), ()), Scenario("b", ("w", "u"), ())]
    fits, fit = [], Encoder.fit
    monkeypatch.setattr(Encoder, "fit", staticmethod(lambda train, s: fits.append(s.name) or fit(train, s, ["c"])))
    got = {r["escenario"]: r for r in L.evaluate_all(rows, rows, scenarios, L.LOGISTIC).collect()}
    assert len(fits) == 6  # five folds and the test, not once more per scenario
    for s in scenarios:
        alone = L.evaluate(rows, rows, s, L.LOGISTIC).first()
        assert all(abs(alone[c] - got[s.name][c]) < 1e-9 for c in ("auc_roc", "cv_auc_roc", "umbral", "brier"))


def test_importance_of_boosted_trees_encodes_a_row_once(spark, monkeypatch):
    """Same drops as from encoding and scoring every copy whole."""
    rows = spark.range(1_200).select(
        F.col("id").alias("estudiante_id"), F.lit("M").alias("asignatura"), (F.col("id") % 3).cast("string").alias("c"),
        F.when(F.col("id") % 7 < 3, "a").when(F.col("id") % 7 < 6, "b").alias("two"),
        (F.xxhash64("id") % 50).cast("double").alias("u"), (F.col("id") % 2).cast("int").alias("f"))
    rows = rows.withColumn("en_riesgo", (F.col("u") + 20 * (F.col("c") == "1").cast("int") + 15 * F.col("f") > 10).cast("int"))
    encoder = Encoder.fit(rows, Scenario("s", ("u",), ("f",)), ["c", "two"])
    assert encoder.sources() == ["c", "c", "c", "two", "u", "f"]
    model = L.SecondOrderBoosting("en_riesgo", trees=12).fit(encoder.transform(rows))
    fitted, columns = L.Fitted(encoder, model), ["u", "f", "c", "two"]

    class Whole:
        score = staticmethod(fitted.score)

    want = [tuple(r) for r in L.permutation_importance(Whole(), rows, columns, repeats=3).collect()]
    seen, transform = [], Encoder.transform
    monkeypatch.setattr(Encoder, "transform", lambda self, df: seen.append(df.count()) or transform(self, df))
    got = [tuple(r) for r in L.permutation_importance(fitted, rows, columns, repeats=3).collect()]
    assert seen == [1_200]  # not once per column and repeat
    assert [g[0] for g in got] == [w[0] for w in want] and got[0][1] > 0.1
    assert all(abs(a - b) < 1e-12 for g, w in zip(got, want) for a, b in zip(g[1:], w[1:]))

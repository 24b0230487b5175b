"""Bootstrap kernels against weights written out row by row."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from campuslens.operators import bootstrap as S


def plain_auc(p, pos, neg):
    wins = sum(a * b * ((x > y) + (x == y) / 2) for x, a in zip(p, pos) for y, b in zip(p, neg))
    total = pos.sum() * neg.sum()
    return wins / total if total else None


@pytest.mark.parametrize("distinct", [7, 1000])
def test_cluster_auc_equals_the_exploded_form(spark, distinct, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 16)
    rng = np.random.default_rng(distinct)
    n, reps = 300, 8
    rows = [(f"c{rng.integers(40)}", float(rng.integers(distinct)), float(rng.random()), int(rng.random() < 0.4))
            for _ in range(n)]
    df = spark.createDataFrame(rows, "g string, a double, b double, y int").repartition(5)
    seeds = {r["g"]: r["s"] for r in df.select("g", F.xxhash64(F.lit(S.SEED), "g").alias("s")).distinct().collect()}
    names = sorted(seeds)
    weights = dict(zip(names, S.cluster_weights(np.array([seeds[g] for g in names]), reps)))
    found = {(r["modelo"], r["replica"]): r["auc"]
             for r in S.cluster_auc_draws(df, ["a", "b"], "y", "g", reps).collect()}
    y = np.array([r[3] for r in rows])
    for k, s in ((1, "a"), (2, "b")):
        for rep in range(reps):
            w = np.array([weights[r[0]][rep] for r in rows])
            want = plain_auc([r[k] for r in rows], w * y, w * (1 - y))
            assert found.get((s, rep)) == (pytest.approx(want, abs=1e-12) if want is not None else None)


def test_weights_are_poisson_one():
    w = S.cluster_weights(np.arange(-500, 500), 400)
    assert abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.02
    assert abs(np.corrcoef(w[0], w[1])[0, 1]) < 0.2


def test_mean_and_cliff_intervals(spark):
    rng = np.random.default_rng(1)
    rows = [("u" if k % 2 else None, int(rng.integers(12)), bool(k % 3)) for k in range(900)]
    df = spark.createDataFrame(rows, "g string, v int, x boolean")
    for r in S.mean_ci(df, ["g"], "v", 400).collect():
        values = [v for g, v, _ in rows if g == r["g"]]
        half = 1.96 * np.std(values) / len(values) ** 0.5
        assert r["ic_lo"] == pytest.approx(np.mean(values) - half, abs=half / 3)
        assert r["ic_hi"] == pytest.approx(np.mean(values) + half, abs=half / 3)
    assert S.mean_difference_ci(df, ["g"], "v", F.col("x"), 200).count() == 2
    for r in S.cliff_ci(df, ["g"], "v", F.col("x"), 400).collect():
        a = [v for g, v, x in rows if g == r["g"] and x]
        b = [v for g, v, x in rows if g == r["g"] and not x]
        delta = np.mean([[(p > q) - (p < q) for q in b] for p in a])
        assert r["ic_lo"] < delta < r["ic_hi"] and r["ic_hi"] - r["ic_lo"] < 0.4


def test_what_leaves_the_tasks_does_not_grow_with_the_rows(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(20_000).select(F.xxhash64("id").cast("string").alias("g"), F.rand(1).alias("p"),
                                        (F.col("id") % 3 == 0).cast("int").alias("y"))
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        draws = S.cluster_auc_draws(df, ["p"], "y", "g", 50)
        plan = draws._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate explode(sequence" not in plan and draws.count() == 50
        assert parts * 50 < 20_000  # slices x replicates
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")

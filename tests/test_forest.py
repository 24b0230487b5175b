"""Forests whose trees are grown whole by tasks."""

import numpy as np
from pyspark.sql import functions as F

from campuslens.operators import forest as O
from campuslens.operators import models as M
from campuslens.operators.features import CATEGORICAL, Scenario


def walk(tree, x, column=0):
    """Leaves reached by all rows of ``x``."""
    column, cut, left, _ = tree
    at = [0] * x.shape[1]
    for i in range(x.shape[1]):
        while column[at[i]] >= 0:
            a = at[i]
            at[i] = left[a] + int(x[column[a], i] > cut[a])
    return np.array(at)


def test_a_tree_follows_its_rules():
    rng = np.random.default_rng(1)
    x = np.stack([rng.integers(0, 6, 900), rng.integers(0, 2, 900), rng.integers(0, 33, 900)]).astype(np.uint8)
    y = ((x[0] > 2) ^ (rng.random(900) < 0.2)).astype(float)
    bag = np.random.default_rng([7, 3]).poisson(1.0, 900)
    tree = O.grow(x, y, 33, O.Rules(30, 5, 3, 7), 3)
    leaf = walk(tree, x)
    assert np.allclose(O.votes([tree, tree], x), 2 * tree[3][leaf])
    inside = np.flatnonzero(tree[0] >= 0)
    assert (tree[0][0], tree[1][0]) == (0, 2)  # all columns are drawn: the best test comes first
    for k in set(leaf):
        rows = leaf == k
        assert bag[rows].sum() >= 5
        assert abs(tree[3][k] - (bag * y)[rows].sum() / bag[rows].sum()) < 1e-12
    share = tree[3]
    for a in inside:  # no two leaves of one prediction
        b = tree[2][a]
        assert not (tree[0][b] < 0 and tree[0][b + 1] < 0 and (2 * share[b] > 1) == (2 * share[b + 1] > 1))
    assert len(O.grow(x, y, 33, O.Rules(0, 5, 3, 7), 3)[0]) == 1


def test_large_forest_is_grown_by_tasks(spark, monkeypatch):
    """Over 5,242 rows, 500 trees are more than one fit holds: no pass over all rows for each level of each group."""
    monkeypatch.setitem(M.MODELS, M.FOREST, lambda rows: M.forest(rows).setNumTrees(24))
    monkeypatch.setattr(M, "FOREST_NODES", 30_000)
    monkeypatch.setattr(O, "GROUP_NODES", 100)
    i = F.col("id")
    rows = spark.range(6_000).select(
        i.alias("estudiante_id"), F.lit("MAT").alias("asignatura"),
        *[F.when(i % 3 == 0, "a").otherwise("b").alias(c) for c in CATEGORICAL if c != "asignatura"],
        (i % 17).alias("x"), (F.xxhash64("id") % 50).alias("y"),
        ((i % 17) + F.xxhash64("id", F.lit(1)) % 5 > 9).cast("int").alias("en_riesgo")).localCheckpoint()
    scenario = Scenario("s", ("x", "y"), ())
    small = M.fit(rows.where("estudiante_id % 2 = 0"), scenario, M.FOREST)
    whole = small.score(rows, "p").select("en_riesgo", F.abs(F.col("en_riesgo") - F.col("p")).alias("off")).agg(F.avg("off")).first()[0]
    fits = []
    monkeypatch.setattr(M.RandomForestClassifier, "fit", lambda self, data: fits.append(1))
    scores = []
    for parts in (2, 5):
        fitted = M.fit(rows.repartition(parts), scenario, M.FOREST)
        assert isinstance(fitted.model, M.TaskForest) and not fits
        groups = list(fitted.model.groups())
        assert len(groups) > 1 and groups[0][0] == 0 and groups[-1][1] == 24
        assert all(a[1] == b[0] for a, b in zip(groups, groups[1:]))
        scored = fitted.score(rows, "p")
        assert scored.columns == [*rows.columns, "p"]
        scores.append([(r.en_riesgo, r.p) for r in scored.orderBy("estudiante_id").collect()])
    assert scores[0] == scores[1] and len(scores[0]) == 6_000
    assert abs(np.mean([abs(t - p) for t, p in scores[0]]) - whole) < 0.05  # MLlib's forest of half the rows


def test_rows_too_wide_for_a_task_are_fitted_in_passes(spark, monkeypatch):
    i = F.col("id")
    rows = spark.range(300).select(F.array(i.cast("double"), F.lit(1.0)).alias("a"), (i % 2).cast("double").alias("en_riesgo"))
    from pyspark.ml.functions import array_to_vector
    data = rows.select(array_to_vector("a").alias("features"), "en_riesgo")
    monkeypatch.setattr(M, "TASK_ROWS", 100)
    monkeypatch.setattr(M, "TASK_BYTES", 300 * 2 - 1)
    got = M.large_forest(data, M.forest(300).setNumTrees(3), 300, 2)
    assert isinstance(got, M.ForestGroups) and got.groups == 2
    monkeypatch.setattr(M, "TASK_BYTES", 300 * 2)
    assert isinstance(M.large_forest(data, M.forest(300).setNumTrees(3), 300, 2), M.TaskForest)

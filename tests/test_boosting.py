"""Boosting against a dense greedy version and a hand-computed leaf."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from campuslens.operators import boosting as G


def frame(spark, x, y, parts):
    rows = [(Vectors.sparse(len(r), [(i, float(v)) for i, v in enumerate(r) if v]) if n % 2 else
             Vectors.dense(r), float(t)) for n, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["features", "y"]).repartition(parts)


def greedy(x, y, trees, depth, rate, penalty, cuts):
    score = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, p * (1 - p)

        def grow(rows, left):
            value = -rate * g[rows].sum() / (h[rows].sum() + penalty)
            best = (0.0, None)
            for c in range(x.shape[1]) if left else ():
                for cut in cuts.get(c, ()):
                    a, b = rows[x[rows, c] <= cut], rows[x[rows, c] > cut]
                    if min(len(a), len(b)) >= G.LEAF_ROWS:
                        gain = sum(g[s].sum() ** 2 / (h[s].sum() + penalty) for s in (a, b)) \
                            - g[rows].sum() ** 2 / (h[rows].sum() + penalty)
                        if round(gain, G.GAIN_DIGITS) > best[0]:
                            best = (round(gain, G.GAIN_DIGITS), (a, b))
            if best[1] is None:
                return {int(r): value for r in rows}
            return grow(best[1][0], left - 1) | grow(best[1][1], left - 1)
        add = grow(np.arange(len(y)), depth)
        score = score + np.array([add[i] for i in range(len(y))])
    return 1 / (1 + np.exp(-score))


def test_leaf_of_one_split_by_hand(spark):
    x = np.array([[0.0]] * 20 + [[1.0]] * 20)
    y = np.array([0.0] * 15 + [1.0] * 5 + [0.0] * 5 + [1.0] * 15)
    model = G.SecondOrderBoosting("y", trees=1, depth=3).fit(frame(spark, x, y, 2))
    root, left, right = model.trees[0]
    assert (root.column, root.cut, left.n, right.n) == (0, 0.5, 20, 20)
    # p = 1/2 everywhere: gradients 15 * 0.5 - 5 * 0.5 = 5, second derivatives 20 / 4 = 5
    assert np.allclose(model.shrink.leaves(model.trees[0])[1:], [-0.05 * 5 / 6, 0.05 * 5 / 6])


@pytest.mark.parametrize("parts", [1, 3])
def test_equals_dense_greedy(spark, parts, monkeypatch):
    monkeypatch.setattr(G, "STAGE", 2)
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.integers(-2, 3, 260), rng.integers(0, 2, 260), rng.integers(0, 2, 260) * 3,
                         np.zeros(260), np.full(260, 2)]).astype(float)
    y = (rng.random(260) < 1 / (1 + np.exp(-(x[:, 0] - x[:, 1] * x[:, 0])))).astype(float)
    cuts = {c: [(a + b) / 2 for a, b in zip(np.unique(x[:, c]), np.unique(x[:, c])[1:])] for c in range(5)}
    df = frame(spark, x, y, parts)
    model = G.SecondOrderBoosting("y", trees=5).fit(df)
    want = greedy(x, y, 5, 3, 0.05, 1.0, cuts)
    scored = model.transform(df).collect()
    by_row = {(tuple(r), t): p for r, t, p in zip(x, y, want)}
    assert len(scored) == 260
    for r in scored:
        assert abs(r["probability"][1] - by_row[tuple(r["features"].toArray()), r["y"]]) < 1e-9


def test_many_values_and_one_label(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 1))
    y = (x[:, 0] > 0.3).astype(float)
    df = frame(spark, x, y, 2)
    model = G.SecondOrderBoosting("y", trees=3, depth=1).fit(df)
    assert all(abs(t[0].cut - 0.3) < 0.05 for t in model.trees)
    with pytest.raises(ValueError, match="both labels"):
        G.SecondOrderBoosting("y").fit(df.where("y = 1"))


def test_rows_are_bound_in_blocks_once(spark, monkeypatch):
    """No pass over the rows of a tree unpacks single rows: they are read for the blocks alone."""
    rng = np.random.default_rng(5)
    x = rng.integers(-2, 3, (120, 3)).astype(float)
    y = (x[:, 0] + x[:, 1] > 0).astype(float)
    bins = G.Bins({0: np.array([-1.5, -0.5, 0.5, 1.5]), 1: np.array([0.5]), 2: np.array([-0.5])})
    raw = frame(spark, x, y, 2)
    k, v = G.stored("features")
    rows = raw.select(k.alias("_k"), v.alias("_x"), raw["y"].alias("_y"))
    got = [G.Block(r.asDict(), bins) for r in G.block_rows(rows, bins, 0.25).collect()]
    assert sum(b.rows for b in got) == 120 and all((b.score == 0.25).all() for b in got)
    for column, cuts in bins.cuts.items():
        for cut in cuts:
            node = G.Node(0.0, 0.0, 0, column, float(cut))
            assert sum(int(b.below(node).sum()) for b in got) == (x[:, column] <= cut).sum()
            assert sum(int(b.label[b.below(node)].sum()) for b in got) == y[x[:, column] <= cut].sum()


def test_blocks_are_small_and_few_sums_need_no_exchange(spark, monkeypatch):
    """An entry takes two bytes of a block; sums that Spark adds up give the trees of those the driver adds up."""
    rng = np.random.default_rng(6)
    x = rng.integers(-2, 3, (3_000, 4)).astype(float)
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=3_000) > 0).astype(float)
    bins = G.Bins({c: np.array([-1.5, -0.5, 0.5, 1.5]) for c in range(4)})
    df = frame(spark, x, y, 3).cache()
    k, v = G.stored("features")
    for r in G.block_rows(df.select(k.alias("_k"), v.alias("_x"), df["y"].alias("_y")), bins, 0.0).collect():
        assert len(r["_row"]) + len(r["_cell"]) <= 2 * 4 * len(r["_y"]) // 8 + 8 * 20
    plans, collect = [], type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: plans.append(
        self._jdf.queryExecution().executedPlan().toString()) or collect(self))
    one = G.SecondOrderBoosting("y", trees=3, depth=2).fit(df)
    sums = [p for p in plans if "sums#" in p]
    assert len(sums) == 6 and not any("Exchange" in p for p in sums)
    monkeypatch.setattr(G, "SUMS_BYTES", 0)
    two = G.SecondOrderBoosting("y", trees=3, depth=2).fit(df)
    assert [[(t.column, t.cut, t.n) for t in tree] for tree in one.trees] == [
        [(t.column, t.cut, t.n) for t in tree] for tree in two.trees]

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from campuslens.llm import ball_tree as B


def brute(rows, k=10, every=100):
    part = [(i, r[0], [math.floor(1024 * x) for x in r[1]]) for i, r in enumerate(rows)
            if r[0] is not None and r[1] is not None
            and all(x is not None and math.isfinite(x) for x in r[1])]
    out = []
    for i, q, a in part:
        if q % every == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), v) for j, v, b in part
                           if j != i and len(b) == len(a))[:k]
            out += [(q, n + 1, v, -s) for n, (s, v) in enumerate(found)]
    return sorted(out)


def run(spark, rows, every=100):
    frame = spark.createDataFrame([(*r, 0, 0) for r in rows],
                                  "vec_id long, embedding array<float>, row int, dim int")
    return sorted(map(tuple, B.top_k(frame, F.col("vec_id") % every == 0).collect()))


def test_table(spark):
    rows = [(r.vec_id, r.embedding) for r in
            spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("leaf", [64, 4])
def test_ties_copies_and_odd_rows(spark, leaf, monkeypatch):
    rng = random.Random(leaf)
    vector = lambda: [rng.choice([-0.5, -0.25, 0.0, 0.25, 0.5, 0.125]) for _ in range(3)]
    rows = [(i, vector()) for i in range(400)] + [(1000 + i, [0.5, 0.5, 0.5]) for i in range(300)]
    rows += [(1000, [0.5, 0.5, 0.5]), (100, vector()), (None, [1.0, 1.0, 1.0]), (5000, None), (5100, []),
             (5101, []), (5200, [1.0, None, 0.0]), (5300, [float("nan"), 0.0, 0.0]),
             (5400, [float("inf"), 0.0, 0.0]), (6000, [1.0, 2.0]), (6001, [2.0, -1.0]), (7000, [9.0])]
    assert run(spark, rows) == brute(rows)


def test_scores_beyond_64_bits(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([1e17, -1e17, 1e16, 3.0, 0.5]), rng.choice([1.0, 1e12, -2.0])]) for i in range(120)]
    rows += [(200, [1e17, 1.0]), (201, [1.0, 1.0]), (300, [3e38, -3e38]), (400, [-1e9, 2e9])]
    rows = [(i, [struct.unpack("f", struct.pack("f", x))[0] for x in v]) for i, v in rows]
    low, high = -2**63, 2**63 - 1
    assert run(spark, rows) == [(q, n, v, max(low, min(high, s))) for q, n, v, s in brute(rows)]


def test_no_query_and_empty(spark):
    assert run(spark, [(1, [1.0])]) == []
    assert run(spark, []) == []


def test_pruning_keeps_the_result():
    import numpy as np
    rng = np.random.default_rng(0)
    centres = rng.normal(0, 800, (20, 8))
    vectors = np.floor(centres[rng.integers(0, 20, 4000)] + rng.normal(0, 30, (4000, 8))).astype(np.int64)
    ids = np.arange(4000)
    tree = B.BallTree.build(ids, ids, vectors)
    calls = []
    dots = B.dots
    B.dots = lambda a, b: calls.append(len(a) * len(b)) or dots(a, b)
    try:
        scores, found = tree.search(ids[:50], vectors[:50], np.full(50, B._NONE))
    finally:
        B.dots = dots
    assert sum(calls) < 50 * 4000 / 2
    for q in range(50):
        want = sorted((-int(s), i) for i, s in enumerate(vectors @ vectors[q]) if i != q)[:10]
        assert [(-int(s), int(i)) for s, i in zip(scores[q], found[q])] == want

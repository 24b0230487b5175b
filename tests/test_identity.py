"""Entity resolution against brute force, with copies and shuffled input."""

from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from campuslens.operators.identity import identity_evidence, identity_ids, near_misses, unmatched

ATTR = ["d1", "d2", "d3", "d4"]
COLUMNS = ["archivo", "fila", "k", *ATTR]


def random_rows(seed, n=24):
    rng = np.random.default_rng(seed)
    return [("A" if i % 2 else "B", i, f"k{rng.integers(0, 4)}",
             *[f"v{rng.integers(0, 3)}" for _ in ATTR]) for i in range(n)]


def best(rows):
    a = [r for r in rows if r[0] == "A"]
    b = [r for r in rows if r[0] == "B"]
    if len(a) > len(b):
        a, b = b, a
    score = [[sum(x[3 + i] == y[3 + i] for i in range(4)) for y in b] for x in a]
    return max((sum(score[i][p[i]] for i in range(len(a)))
                for p in permutations(range(len(b)), len(a))), default=0)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_assignment_is_optimal_per_block(spark, seed):
    rows = random_rows(seed)
    df = spark.createDataFrame(rows, COLUMNS)
    got = identity_evidence(df, F.col("archivo") == "A", "fila", ["k"], ATTR, 3).groupBy("k").agg(
        F.sum(F.col("coincidencias") * F.col("n_pares")).alias("total")).collect()
    totals = {r["k"]: r["total"] for r in got}
    for k in {r[2] for r in rows}:
        assert totals.get(k, 0) == best([r for r in rows if r[2] == k])


def test_accepts_by_threshold_and_uniqueness(spark):
    rows = [("A", 1, "x", "1", "1", "1", "1"), ("B", 1, "x", "1", "1", "1", "1"),
            ("A", 2, "y", "1", "1", "1", "1"), ("B", 2, "y", "1", "1", "2", "2"),
            ("A", 3, "z", "1", "1", "1", "1"), ("A", 4, "z", "1", "1", "1", "1"),
            ("B", 3, "z", "1", "1", "1", "1")]
    df = spark.createDataFrame(rows, COLUMNS)
    side = F.col("archivo") == "A"
    ev = identity_evidence(df, side, "fila", ["k"], ATTR, 3)
    by_key = {r["k"]: r for r in ev.collect()}
    assert by_key["x"]["aceptado"] and by_key["x"]["etapa"] == 1
    assert not by_key["y"]["aceptado"] and by_key["y"]["coincidencias"] == 2
    assert not by_key["z"]["aceptado"] and by_key["z"]["candidatos_a"] == 2
    ids = {(r["archivo"], r["fila"]): r["estudiante_id"]
           for r in identity_ids(df, side, "fila", ev).collect()}
    assert [ids["B", i] for i in (1, 2, 3)] == [1, 2, 3]
    assert ids["A", 1] == 1 and [ids["A", i] for i in (2, 3, 4)] == [4, 5, 6]


def test_near_miss_names_the_attribute(spark):
    rows = [("A", 1, "x", "1", "1", "1", "1"), ("B", 7, "x", "1", "1", "9", "1"),
            ("B", 8, "x", "1", "8", "9", "1")]
    df = spark.createDataFrame(rows, COLUMNS)
    got = near_misses(df, F.col("archivo") == "A", "fila", ["k", *ATTR]).collect()
    assert [(r["fila_a"], r["fila_b"], r["atributo_distinto"], r["valor_a"], r["valor_b"])
            for r in got] == [(1, 7, "d3", "1", "9")]


def test_accepted_partners_are_no_near_misses(spark):
    rows = [("A", 1, "x", "1", "1", "1", "1"), ("B", 1, "x", "1", "1", "1", "2"),
            ("A", 2, "y", "1", "1", "1", "1"), ("B", 3, "z", "1", "1", "1", "1"),
            ("B", 2, None, "1", "1", "1", None)]
    df = spark.createDataFrame(rows, COLUMNS)
    side = F.col("archivo") == "A"
    ev = identity_evidence(df, side, "fila", ["k"], ATTR, 3)
    rest = unmatched(df, side, "fila", ev)
    assert rest.columns == COLUMNS
    assert {(r["archivo"], r["fila"]) for r in rest.collect()} == {("A", 2), ("B", 2), ("B", 3)}
    got = [(r["fila_a"], r["fila_b"], r["atributo_distinto"]) for r in
           near_misses(rest, side, "fila", ["k", *ATTR]).collect()]
    assert got == [(2, 3, "k")]

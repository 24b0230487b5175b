import numpy as np
import xxhash
from pyspark.sql import functions as F

from campuslens.llm import covering, simhash
from campuslens.llm.components import components


def brute_print(text):
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows):
    prints = [brute_print(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted(((r[0], f"{prints[i]:016x}", least.get(find(i))) for i, r in enumerate(rows)),
                  key=repr)


def test_every_pair_within_two_bits_meets():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**64, 300, dtype=np.uint64)
    b = a.copy()
    for i in range(300):
        for bit in rng.integers(0, 64, i % 3):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    for x, y in ((a, b), (b, a)):
        home = covering.homes(x, 2)
        rows, anchors = covering.replicas(y, 2)
        met = set(zip(rows.tolist(), anchors.tolist()))
        assert len(met) == len(rows)
        assert all((i, int(home[i])) in met for i in range(300))


def test_codes_are_perfect():
    for code in covering.codes(2):
        words = np.random.default_rng(0).integers(0, 1 << code.length, 500)
        rows, _ = code.near(words, 0)
        assert rows.tolist() == list(range(500))


def variants():
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(100 + i, base.replace(f"word{7 * i} ", f"other{i} ")) for i in range(30)]
    return rows + [(3, base), (2, base.upper()), (900, "Quite another text about nothing")]


def test_against_brute_force(docs_frame, odd_rows, small_docs):
    rows = variants() + odd_rows + [(r.doc_id + 5000, r.text) for r in small_docs.collect()]
    got = simhash.simhash_groups(docs_frame(rows, extra=("fp", "root", "u"))).collect()
    assert sorted(map(tuple, got), key=repr) == brute_groups(rows)


def test_one_row_of_each_group_stays(docs_frame, odd_rows):
    rows = variants() + odd_rows
    frame = docs_frame(rows, extra=("_fp", "row", "component_id"))
    kept = simhash.one_per_group(frame)
    assert kept.columns == frame.columns
    groups = {(c if c is not None else f) for _, f, c in brute_groups(rows)}
    # rows of id 9 are one group; the smallest id of each group stays once
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(
        (g if isinstance(g, int) else None for g in groups), key=repr)


def test_empty(docs_frame):
    assert simhash.simhash_groups(docs_frame([])).count() == 0
    assert simhash.one_per_group(docs_frame([])).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long").repartition(5)).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 300)}


def test_replicas_are_never_broadcast(spark):
    """Spark sizes them like the fingerprints; the session's own threshold must not let them through the driver."""
    prints = spark.range(2_000).select(F.xxhash64("id").alias("fp"))
    found = simhash.links(prints)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    near = spark.createDataFrame([(0,), (1,), (7,), (7 << 40,)], "fp long")
    assert sorted(map(tuple, simhash.links(near).collect())) == [(0, 1), (1, 7)]

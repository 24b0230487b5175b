import random

import numpy as np

from campuslens.llm import covering, near_copies


def shingles(text):
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similarity(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_within_two_bits_share_an_anchor():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 2**46, 200, dtype=np.uint64)
    b = a.copy()
    for i in range(200):
        for bit in rng.choice(46, i % 3, replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)

    def anchors(prints):
        out = [set() for _ in prints]
        for row, anchor in zip(*covering.replicas(prints, 1, covering.SHORT_BLOCKS), strict=True):
            out[row].add(int(anchor))
        return out
    assert all(x & y for x, y in zip(anchors(a), anchors(b), strict=True))


def edited(words, rng, edits):
    words = list(words)
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"changed{rng.randrange(10**6)}"
    return " ".join(words)


def test_near_copies_go_and_others_stay(docs_frame):
    rng = random.Random(5)
    rows, families = [], 60
    for f in range(families):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([60, 150, 400, 1500]))]
        rows.append((f, " ".join(words)))
        rows.append((1000 + f, edited(words, rng, max(1, len(words) // 120))))
        rows.append((2000 + f, edited(words, rng, len(words) // 4)))
    assert all(similarity(rows[3 * f][1], rows[3 * f + 1][1]) >= 0.8 for f in range(families))
    assert all(similarity(rows[3 * f][1], rows[3 * f + 2][1]) < 0.5 for f in range(families))
    kept = {r.doc_id for r in near_copies.one_per_group(docs_frame(rows)).collect()}
    assert {i for i in kept if i < 1000 or i >= 2000} == {r[0] for r in rows if not 1000 <= r[0] < 2000}
    assert sum(1000 <= i < 2000 for i in kept) <= families // 20


def test_odd_rows_and_clashing_names(docs_frame, odd_rows):
    frame = docs_frame(odd_rows, extra=("_fp", "_ROW", "node"))
    out = near_copies.one_per_group(frame)
    assert out.columns == frame.columns
    # null, empty and blank texts are one group, the repeated row another
    assert sorted((r.doc_id for r in out.collect()), key=repr) == [10, 5, 8, 9, None]
    assert near_copies.one_per_group(docs_frame([])).count() == 0


def test_similarity_is_decided_at_its_bound(spark):
    base = [f"w{i}" for i in range(104)]  # 100 shingles
    texts = [(0, " ".join(base)), (1, " ".join(base[:84])), (2, " ".join(base[:83])), (3, ""), (4, None)]
    pairs = spark.createDataFrame([(1, 0), (2, 0), (4, 3), (3, 0)], "u long, v long")
    found = near_copies.similar(pairs, spark.createDataFrame(texts, "node long, text string"))
    assert sorted(map(tuple, found.collect())) == [(1, 0), (4, 3)]


def groups(rows):
    """Ids that stay, by brute force over the similarity alone."""
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    sets = [(i, shingles(t)) for i, t in rows]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if len(a & b) >= 0.8 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i for i in root if find(i) == i}


def test_siblings_that_are_similar_to_their_base_only(docs_frame):
    """1000 texts at 0.82 of one base and below 0.8 of one another; the base is the last row."""
    rng = random.Random(7)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(1000):
        words = list(base)
        for at in rng.sample(range(4, 196, 8), 4):  # five shingles each
            words[at] = f"changed{i}-{at}"
        rows.append((i, " ".join(words[:-1] if i % 2 else words)))
    rows.append((5000, " ".join(base)))
    assert all(0.8 <= similarity(t, rows[-1][1]) < 0.83 for _, t in rows[:-1])
    assert sum(similarity(rows[i][1], rows[i + 1][1]) < 0.8 for i in range(999)) > 900
    kept = {r.doc_id for r in near_copies.one_per_group(docs_frame(rows)).collect()}
    assert kept == {0}


def test_equal_words_in_another_order_do_not_hide_a_pair(docs_frame):
    """A has the distinct words of B and C, so all word fingerprints; B and C are similar."""
    rows = []
    for f in range(20):
        rng = random.Random(f)
        words = [f"f{f}w{i}" for i in range(200)]
        other = rng.sample(words, len(words))
        rows += [(3 * f, " ".join(other)), (3 * f + 1, " ".join(words)),
                 (3 * f + 2, " ".join([*words[100:], *words[:100], *words[100:]]))]
    expect = groups(rows)
    assert len(expect) == 40
    kept = {r.doc_id for r in near_copies.one_per_group(docs_frame(rows)).collect()}
    assert kept == expect


def test_truncated_and_extended_copies_go(docs_frame):
    """A block cut off, put before or put behind leaves a similarity of 0.80 to 0.90."""
    rng = random.Random(11)
    rows = []
    for f in range(40):
        words = [f"f{f}w{i}" for i in range(rng.choice([80, 200, 600]))]
        n = len(words) - 4
        share = 0.80 + 0.0025 * f
        cut, more = int(n * (1 - share)), int(n * (1 / share - 1))
        added = [f"f{f}added{i}" for i in range(more)]
        copies = [words[:len(words) - cut], words[cut:], words + added, added + words]
        rows += [(10 * f + 1 + k, " ".join(c)) for k, c in enumerate(copies)]
        rows.append((10 * f, " ".join(words)))
        assert all(0.8 <= similarity(rows[-1][1], t) < 0.92 for _, t in rows[-5:-1])
    kept = {r.doc_id for r in near_copies.one_per_group(docs_frame(rows)).collect()}
    assert kept == {10 * f for f in range(40)}


def test_long_texts_are_decided_at_their_bound(spark):
    """Sets of many slices, of equal and of different numbers of slices."""
    texts, pairs, expect = [], [], []
    for size in (1500, 4500, 20_000):
        base = [f"s{size}w{i}" for i in range(size + 4)]
        texts.append((size, " ".join(base)))
        for off in range(-3, 3):
            node = size + 100 + off
            texts.append((node, " ".join(base[:size * 4 // 5 + 4 + off])))
            pairs.append((node, size))
            expect += [(node, size)] if off >= 0 else []
    found = near_copies.similar(spark.createDataFrame(pairs, "u long, v long"),
                                spark.createDataFrame(texts, "node long, text string"))
    assert sorted(map(tuple, found.collect())) == sorted(expect)


def test_what_copies_have_in_common_is_one_bucket(spark):
    """Ten copies that differ in one word share some 40 first shingles: one row each, not one per shingle."""
    base = [f"w{i}" for i in range(200)]
    texts = [(i, " ".join([*base[:-1], f"own{i}"])) for i in range(10)]
    rows = near_copies.buckets(spark.createDataFrame(texts, "node long, text string")).frame.collect()
    assert {r.node for r in rows} == set(range(10))
    assert len(rows) <= 20 and sum(r.times for r in rows) > 200


def test_whole_rows_stay_in_place(spark, docs_frame):
    """Rows that stay are not shuffled to be told from the others."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(rng.sample(words, 80))) for i in range(20)] + [(50, " ".join(words)), (51, " ".join(words))]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = near_copies.one_per_group(docs_frame(rows))
        assert "hashpartitioning" not in out._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(r.doc_id for r in out.collect()) == [*range(20), 50]


def test_long_lists_go_through_a_sieve(spark, docs_frame, monkeypatch):
    monkeypatch.setattr(near_copies, "MAX_BROADCAST_ROWS", 0)
    monkeypatch.setattr(near_copies, "SIEVE_WORDS", 4)  # lets rows through that are not listed
    rows = spark.range(1000).selectExpr("id AS k", "repeat('x', 5) AS text")
    ids = spark.range(0, 2000, 7).selectExpr("id AS k", "-id AS node")
    for how in ("inner", "left_anti"):
        got, plain = near_copies.at_rows(rows, ids, "k", how), rows.join(ids, "k", how)
        assert got.columns == plain.columns
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))
    test_near_copies_go_and_others_stay(docs_frame)


def test_print_links_of_the_pipeline_are_not_broadcast(spark, monkeypatch):
    """Links of fingerprints are joined by a shuffle under the session's own broadcast threshold."""
    plans = {}

    def staged(df, label, stage=near_copies.stage):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return stage(df, label)
    monkeypatch.setattr(near_copies, "stage", staged)
    nodes = spark.createDataFrame([(10, 0), (11, 0), (12, 3), (13, 1 << 50)], "node long, fp long")
    assert {tuple(sorted(r)) for r in near_copies.simhash_links(nodes).collect()} == {(10, 11), (10, 12), (10, 13)}
    assert "SortMergeJoin" in plans["print-links"] and "Broadcast" not in plans["print-links"]

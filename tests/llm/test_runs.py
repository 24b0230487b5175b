"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st

from campuslens.llm import queries, runs


def lyndon_lengths(s):
    out = []
    for i in range(len(s)):
        j = i + 1
        while j < len(s) and s[j:] > s[i:]:
            j += 1
        out.append(j - i)
    return out


def brute_runs(w, min_length=6, min_exponent=4):
    out, seen = [], set()
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if (size := j - i + q) >= max(min_length, min_exponent * q) and (i, size) not in seen:
                seen.add((i, size))  # seen with a smaller period
                out.append((i, size, q))
            i = j + 1
    return sorted(out)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=30))
def test_groups_are_longest_lyndon_words(s):
    ranks = [sorted(set(s)).index(x) for x in s]
    lengths, groups = runs.lyndon_groups(ranks)
    assert lengths == lyndon_lengths(ranks)
    words = [tuple(ranks[i:i + n]) for i, n in enumerate(lengths)]
    assert all((groups[i] == groups[j]) == (words[i] == words[j])
               for i in range(len(s)) for j in range(len(s)))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40), st.integers(0, 12), st.integers(1, 5), st.integers(0, 30))
def test_runs_equal_brute_force(head, at, period, more):
    s = head + [head[(at + k % period) % len(head)] for k in range(more)] if head else []
    words = [b"w%d" % x for x in s]
    for length, exponent in ((6, 4), (2, 2), (5, 3)):
        assert runs.word_runs(words, length, exponent) == brute_runs(words, length, exponent)


def plant(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def brute_row(doc_id, text):
    words = plant(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    found = brute_runs(words)
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def both(spark, tmp_path, df):
    df.write.parquet(f"{tmp_path}/documents.parquet")
    made = queries.QUERIES["op12_lyndon_runs"](spark, str(tmp_path))
    assert made.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                            "runs_sha256", "collapsed_sha256"]
    want = [brute_row(r["doc_id"], r["text"]) for r in df.collect()]
    assert sorted(map(tuple, made.collect()), key=repr) == sorted(want, key=repr)
    return want


def test_query_on_random_words(spark, docs_frame, tmp_path):
    rng = random.Random(3)
    rows = []
    for k in range(400):
        words = [rng.choice("ab") if rng.random() < 0.5 else f"w{rng.randrange(40)}"
                 for _ in range(rng.randrange(60))]
        if k % 3 == 0:
            words += words[-rng.randrange(1, 5):] * rng.randrange(2, 9) + ["end"] * rng.randrange(3)
        rows.append((k, " \n".join(words)))
    want = both(spark, tmp_path, docs_frame(rows))
    assert sum(r[1] > 0 for r in want) > 100


def test_query_on_odd_rows(spark, docs_frame, odd_rows, tmp_path):
    odd_rows = [(r[0], r[1] and r[1][:4000]) for r in odd_rows]
    rows = [*odd_rows, (11, "\x00 \x85 " * 5), (12, "é é é é é é")]
    both(spark, tmp_path, docs_frame(rows, ["runs", "_text", "N_words"]))


def test_empty_table(spark, docs_frame):
    assert runs.run_digests(runs.periodic_runs(runs.with_planted_runs(docs_frame([])))).collect() == []


def test_long_text_of_few_words():
    rng = random.Random(5)
    words = [b"ab"[k:k + 1] for k in (rng.randrange(2) for _ in range(100_000))]
    words[40_000:] = words[40_000:40_007] * 8_000
    found = runs.word_runs(words)
    assert any(p == 7 and n >= 55_993 for _, n, p in found)
    part = [(s, n, p) for s, n, p in runs.word_runs(words[:2_000]) if s + n < 1_990]
    assert part == [r for r in brute_runs(words[:2_000]) if r[0] + r[1] < 1_990]
    assert set(part) <= set(found)

"""Merkle manifest against a plain single-process version."""

import hashlib
import os
import sys
import zlib

import pytest

from campuslens.llm import merkle, queries

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))
from check_queries import compare  # noqa: E402

SF = "/root/testdata/sf0.001"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def lower(text):
    return text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def climb(nodes):
    """Root of a list of hashes, and per node [(siblings before, siblings after), ...] to the root."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[k:k + 16] for k in range(0, len(nodes), 16)]
        for k, i in enumerate(at):
            run = runs[i // 16]
            paths[k].append((run[:i % 16], run[i % 16 + 1:]))
        at = [i // 16 for i in at]
        nodes = [digest("".join(run)) for run in runs]
    return nodes[0], paths


def brute(rows):
    """Rows are (doc_id, source, lang, n_chars, text)."""
    trees = {}
    for r in rows:
        trees.setdefault(r[1], []).append(r)
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for n in names:
        trees[n].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    below = {n: climb([leaf(r) for r in trees[n]]) for n in names}
    root, over = climb([below[n][0] for n in names])
    out = []
    for k, n in enumerate(names):
        for r, path in zip(trees[n], below[n][1], strict=True):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            now = leaf(r[:4] + (lower(r[4]),)) if hit else leaf(r)
            proof = ""
            for before, after in path + over[k]:
                proof += "".join(before + after)
                now = digest("".join(before) + now + "".join(after))
            out.append((r[0], leaf(r), below[n][0], root, digest(proof), now, now == root))
    return out


def check(spark, rows, extra=""):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    made = merkle.manifest(spark.createDataFrame([r + (0,) * bool(extra) for r in rows], schema + extra))
    got = [tuple(r) for r in made.collect()]
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)
    return got


def test_trees_of_many_sizes_and_sources(spark):
    sizes = {None: 1, "": 2, "a": 16, "b": 17, "ä": 256, "z": 257, "\U0001F600": 40, "￿": 3}
    sizes |= {f"s{k}": 1 for k in range(20)}  # two levels over the subroots
    rows, n = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            rows.append((n * 7 % 1000, source, "en", n, f"Text {n} ÄB"))
            n += 1
    got = check(spark, rows)
    assert {r[-1] for r in got} == {True, False}


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = [(None, None, None, None, None), (None, "a", "x", 1, "Abc"), (3, "a", None, 2, ""), (3, "a", None, 2, ""),
            (3, "a", None, 2, "other text"), (4, "a", "", 0, None), (5, "a", "en", 9, "Wort " * 200_000),
            (-7, "a", "en", 9, "\x00 B"), (35, "a", "en", 9, "AZ[@`"), (0, "a", "en", 1, "A")]
    check(spark, rows, ", _at int")


def test_one_document_and_none(spark):
    rows = [(0, "a", "en", 1, "A")]
    assert check(spark, rows)[0][4] == digest("")
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    assert merkle.manifest(spark.createDataFrame([], schema)).collect() == []


def test_one_source_has_its_subroot_as_root(spark):
    got = check(spark, [(k, "a", "en", k, f"T{k}") for k in range(300)])
    assert all(r[2] == r[3] for r in got)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_query_matches_sql(spark):
    name = "op13_merkle_proofs"
    ok, message = compare(spark, name, queries.QUERIES[name], queries.ORACLES[name], SF)
    assert ok, message

import hashlib
import random
import re

import pytest

from campuslens.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        doc, hit, ids = words(text), set(), set()
        for item_id, item in items:
            item = words(item)
            n = min(10, len(item))
            windows = {tuple(item[i:i + n]) for i in range(len(item) - n + 1)} if n else set()
            for i in range(len(doc) - n + 1 if n else 0):
                if tuple(doc[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    ids.add("null" if item_id is None else str(item_id))
        out.append((doc_id, len(doc), len(hit), len(ids),
                    hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def run(spark, docs_frame, docs, items, **kw):
    frame = docs_frame(docs, extra=("n_hit", "_text", "item"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in D.decontaminate(frame, bench, **kw).collect()), key=repr)


@pytest.mark.parametrize("sieve_bits", [24, 3])
def test_against_brute_force(spark, docs_frame, odd_rows, sieve_bits, monkeypatch):
    monkeypatch.setattr(D, "SIEVE_BITS", sieve_bits)
    rng = random.Random(1)
    vocabulary = ["alpha", "Beta", "gamma", "ñu", "7", "x9"]
    text = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([9, 10, 11, 30, 12, 25, 3, 1])]
    items += [(None, text(14)), (50, None), (51, "..."), (3, text(12)), (52, "the one the one " * 8)]
    docs = [(i, text(rng.randint(0, 60))) for i in range(40)]
    for i, (_, t) in enumerate(items):
        docs.append((100 + i, f"{text(5)} {t} {text(4)} {(t or '')[:30]}"))
    docs.append((200, "the one " * 50))
    docs += odd_rows
    assert run(spark, docs_frame, docs, items) == brute(docs, items)


def test_long_items_only(spark, docs_frame):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(4)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(40)) for i in range(6)]
    docs = [(i, text(300)) for i in range(30)] + [(77, items[0][1][4:60])]
    assert run(spark, docs_frame, docs, items) == brute(docs, items)


def test_table(spark, small_docs):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = sorted((tuple(r) for r in D.decontaminate(small_docs, bench).collect()), key=repr)
    want = brute([(r.doc_id, r.text) for r in small_docs.collect()],
                 [(r.item_id, r.text) for r in bench.collect()])
    assert got == want and any(r[5] for r in got)


def test_filter_and_empty_tables(spark, docs_frame):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")],
                                  "item_id long, text string")
    frame = docs_frame([(1, "ONE two three four five six seven eight nine ten!"), (2, "fine"), (3, None)],
                       extra=("contaminated", "row"))
    kept = D.clean_documents(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3]
    assert D.clean_documents(frame, bench.limit(0)).count() == 3
    assert D.clean_documents(frame.limit(0), bench).count() == 0

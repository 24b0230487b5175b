import re
from collections import Counter, defaultdict

import duckdb
import pytest

from campuslens.llm import mixing
from campuslens.llm.queries import OP4_SQL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """Proportional shares, capped at three times the size, the excess reshared until none is left."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, free, out = sum(sizes.values()), set(names), {}
    while free:
        level = (total - sum(out.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in free}
        out |= {s: 3 * sizes[s] for s in over}
        free -= over
    return out


def check(frame, rows):
    got = mixing.mix_sources(frame, carry=("source",)).collect()
    assert len(got) == len(rows)
    size = [len(WORD.findall(r[1] or "")) for r in rows]
    sizes = defaultdict(int)
    for r, n in zip(rows, size):
        sizes[r[3]] += n
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r[0], n) for r, n in zip(rows, size))
    want, taken = targets(sizes), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 0.5 + 1e-6
    return got


def test_table(small_docs):
    check(small_docs, [tuple(r) for r in small_docs.collect()])


def test_odd_rows_and_a_hot_source(docs_frame, odd_rows):
    rows = [(*r, None, s) for r, s in zip(odd_rows, "ab" * 9)] + [(20, "w " * 9, None, None)]
    rows += [(100 + i, "p q r", None, "hot") for i in range(300)] + [(1, "tiny", None, "z")]
    frame = docs_frame(rows, extra=("size", "bucket", "key"))
    first = check(frame, rows)
    again = mixing.mix_sources(frame.repartition(7), carry=("source",)).collect()
    assert Counter(map(tuple, first)) == Counter(map(tuple, again))


def test_matches_sql_on_odd_rows(docs_frame, odd_rows):
    rows = [(*r, None, s) for r, s in zip(odd_rows, "abc" * 9)]
    frame = docs_frame(rows)
    con = duckdb.connect()
    con.register("documents", frame.toArrow())
    assert Counter(con.execute(OP4_SQL).fetchall()) == Counter(
        map(tuple, mixing.mix_sources(frame).collect()))


def test_no_words_and_empty(docs_frame):
    assert [r.taken for r in mixing.mix_sources(docs_frame([(1, None), (2, " ")])).collect()] == [0, 0]
    assert mixing.mix_sources(docs_frame([])).count() == 0
    assert mixing.mixed_documents(docs_frame([])).count() == 0


def test_documents_of_the_mix(docs_frame):
    rows = [(i, f" a{i} b{i}\n\nc{i}  d{i} ", "en", f"s{i % 4}") for i in range(40)]
    frame = docs_frame(rows, extra=("size", "taken", "src"))
    taken = {r.doc_id: r.taken for r in mixing.mix_sources(frame).collect()}
    text = {r[0]: r[1] for r in rows}
    words = Counter()
    out = mixing.mixed_documents(frame)
    assert out.columns == frame.columns
    for r in out.collect():
        words[r.doc_id] += len(WORD.findall(r.text))
        assert text[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
    assert words == Counter({k: v for k, v in taken.items() if v})

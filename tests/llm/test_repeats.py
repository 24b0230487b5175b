import hashlib
import os
import random

import numpy as np
import pytest

from campuslens.llm import repeats as R


def brute(rows, span=50):
    texts = [(r[1] or "").encode() for r in rows]
    key = lambda i: (i is None, i or 0)
    least = {}
    for r, t in zip(rows, texts):
        for i in range(len(t) - span + 1):
            w = t[i:i + span]
            least[w] = min(least.get(w, key(r[0])), key(r[0]))
    out = []
    for r, t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - span + 1):
            if least[t[i:i + span]] < key(r[0]):
                gone[i:i + span] = b"\1" * span
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((r[0], len(t), sum(gone), sum(1 for p, g in zip(b"\0" + bytes(gone), gone) if g and not p),
                    hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(frame, **kw):
    got = R.remove_repeats(frame, **kw).collect()
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)
    return sorted((tuple(r)[:5] for r in got), key=repr)


@pytest.mark.parametrize("seed", [0, 1])
def test_against_brute_force(docs_frame, odd_rows, seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    shared = [text(n) for n in (49, 50, 51, 60, 75, 100, 200)]
    rows = []
    for i in range(80):
        parts = [text(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, 20)
            parts += [s[a:a + rng.randint(30, 220)], text(rng.randint(0, 30))]
        rows.append((rng.randint(0, 60), "".join(parts)))
    rows += [(200 + i, shared[6] + "tail") for i in range(5)] + [(300, "ab" * 300), (301, "ab" * 400), (302, "a" * 500)]
    rows += [(303, "a" * 499), (None, shared[6]), (None, shared[5] + "x")] + [(i, t if len(t or "") < 1000 else t[:900]) for i, t in odd_rows]
    frame = docs_frame(rows, extra=("block", "range", "kept")).repartition(5)
    assert run(frame, ranges=7) == brute(rows)


def test_table(docs_frame, small_docs):
    rows = [(r.doc_id, r.text) for r in small_docs.collect()]
    assert run(small_docs) == brute(rows)


def test_empty(docs_frame):
    assert run(docs_frame([])) == []
    assert run(docs_frame([(1, None)])) == brute([(1, None)])


def test_equal_contexts_in_rows_of_one_id(docs_frame):
    """A passage that a smaller document holds in part stands twice in a text and in two rows of one id."""
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    passage, other = text(200), text(150)
    rows = [(1, text(30) + passage[70:130] + text(30)), (2, passage + text(20) + passage),
            (3, other), (3, other), (0, other[40:100]), (None, other[45:110] + "z"), (None, other[45:110] + "z")]
    assert run(docs_frame(rows).coalesce(1), ranges=1) == brute(rows)


def test_zero_bytes(docs_frame):
    rows = [(i, "start of a passage " + "\0" * n) for i, n in enumerate((33, 60, 40, 52, 31, 45))]
    rows += [(10 + i, "\0" * n + "ab" + "\0" * (70 - n)) for i, n in enumerate((0, 5, 12, 30, 55, 68))]
    assert run(docs_frame(rows).coalesce(1), ranges=2) == brute(rows)


def test_suffixes_are_sorted_by_the_bytes_that_still_tie():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 40, 200):
        lengths = rng.integers(5, 17, n)
        keys = rng.integers(0, 2, (n, 16)).astype(np.uint8)
        keys[n // 2:] = keys[:n - n // 2]
        keys[np.arange(16) >= lengths[:, None]] = 0
        groups = rng.integers(0, 3, n).astype(np.uint64)
        order, common = R.sorted_suffixes(keys, lengths, groups)
        texts = [(int(groups[i]), keys[i].tobytes(), int(lengths[i])) for i in range(n)]
        assert order.tolist() == sorted(range(n), key=lambda i: (*texts[i], i))
        for at, (i, j) in enumerate(zip(order[:-1].tolist(), order[1:].tolist()), 1):
            same = os.path.commonprefix([keys[i, :lengths[i]].tolist(), keys[j, :lengths[j]].tolist()])
            assert common[at] == (len(same) if groups[i] == groups[j] else 0)
        assert common[0] == common[n] == 0

"""Personal data: base spans against plain regular expressions, the model against span-by-span EM."""

import hashlib
import math
import random
import re

import numpy as np
import pytest

from campuslens.llm import personal_data as pii
from campuslens.llm import queries

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def base_spans(text):
    return [(k, m.start(), m.end()) for k, p in BASE.items() for m in re.finditer(p, text or "")
            if valid(k, m.group())]


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def run(spark, df, tmp_path):
    df.write.parquet(f"{tmp_path}/documents.parquet")
    made = queries.QUERIES["op11_weak_supervision"](spark, str(tmp_path))
    assert made.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    return made.collect()


def check(spark, df, tmp_path):
    """Base columns equal the plain ones; returns the added spans by doc_id and text hash."""
    rows = run(spark, df, tmp_path)
    want = []
    for r in df.collect():
        spans = base_spans(r["text"])
        want.append((r["doc_id"], *[sum(s[0] == k for s in spans) for k in BASE],
                     hashlib.sha256(joined(spans).encode()).hexdigest()))
    assert sorted((tuple(r)[:6] for r in rows), key=repr) == sorted(want, key=repr)
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    added = {}
    for r in rows:
        base = base_spans(texts[r["doc_id"]])
        all_spans = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in r["spans"].split(",") if s)]
        if r["doc_id"] is not None and sum(x["doc_id"] == r["doc_id"] for x in rows) == 1:
            assert set(base) <= set(all_spans)
            assert all_spans == sorted(all_spans, key=lambda s: (list(BASE).index(s[0]), s[1]))
            more = [s for s in all_spans if s not in base]
            assert not any(a < d and c < b for _, a, b in more for _, c, d in base)
            added[r["doc_id"]] = [texts[r["doc_id"]][a:b] for _, a, b in more]
    return added


TRICKY = [
    "a@b.c_d@e.f x@y z@w.com a@b@c.d ..@-.- @a.b", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255 1.2.3 9999999999.1.1.1.1",
    "4111 1111 1111 1111-4111111111111111 x4111111111111111y 4111-1111-1111-1111", "+1 (017) 555-7713 +12 3 ++49 30 1234567 +1((((",
    "é\U0001F600 jane@mail.example.com \U0001F600 10.0.0.1", "6011000990139424 5 4111111111111111",
    "7" * 3000, "a" * 3000 + "@b.co", "+1" + " " * 2000 + "2345678", "1." * 1500, "x@y." * 800, "12 " * 1500,
    "5105105105105100 " * 50, "a.b+c%d@x-1.y-2.z " * 40, "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0"]


def test_base_spans_of_tricky_and_odd_texts(spark, docs_frame, odd_rows, tmp_path):
    rows = [*odd_rows, *((100 + k, t) for k, t in enumerate(TRICKY))]
    check(spark, docs_frame(rows, ["kind", "At", "votes"]), tmp_path)


def test_base_spans_of_random_texts(spark, docs_frame, tmp_path):
    rng = random.Random(2)
    rows = [(k, "".join(rng.choice("01125a. .@+-() ") for _ in range(rng.randrange(120)))) for k in range(600)]
    check(spark, docs_frame(rows), tmp_path)


def make_card(rng):
    head = "4" + "".join(rng.choice("0123456789") for _ in range(14))
    return next(head + c for c in "0123456789" if luhn(head + c))


def test_spelt_out_forms_are_added_and_clean_texts_left_alone(spark, docs_frame, tmp_path):
    rng = random.Random(7)
    rows, spelt = [], {}
    for k in range(300):
        rows.append((k, f"Please write to user{k}@mail{k % 9}.example.com or call +1 (212) 555-{1000 + k}, "
                        f"card {make_card(rng)}, host 10.1.{k % 200}.7."))
    for k in range(300, 340):
        spelt[k] = [f"user{k} [at] mail{k}.example [dot] com", f"(212) 555-{1000 + k}"]
        rows.append((k, f"mail {spelt[k][0]}, phone {spelt[k][1]}."))
    for k in range(340, 640):
        rows.append((k, f"Sold on 2024-01-{10 + k % 20} at 12:30:45, order {rng.randrange(10 ** 15, 10 ** 16)} of version "
                        f"1.2.{300 + k}.9, look at home and away. Pages 10-12, 1500 2000."))
    added = check(spark, docs_frame(rows), tmp_path)
    assert {k: v for k, v in added.items() if v} == spelt


def test_reliabilities_equal_em_over_single_spans():
    rng = np.random.default_rng(3)
    truth = rng.random(400) < 0.4
    votes = np.where(rng.random((400, 6)) < 0.75, np.where(truth, 1, -1)[:, None], rng.integers(-1, 2, (400, 6)))
    rows = [{"kind": "ip", **dict(zip(pii.LABELERS, map(int, v), strict=True)), **dict.fromkeys(pii.SHAPES, 0)} for v in votes]
    counted = {}
    for r in rows:
        counted[tuple(r.items())] = counted.get(tuple(r.items()), 0) + 1
    model = pii.SpanModel([dict(k) | {"n": n} for k, n in counted.items()])

    start = [[0.5, 0.3, 0.2], [0.1, 0.3, 0.6]]
    share, table = 0.5, [[list(start[y]) for y in (0, 1)] for _ in range(6)]
    for _ in range(400):
        post = []
        for v in votes:
            like = [(share if y else 1 - share) * math.prod(table[j][y][v[j] + 1] for j in range(6)) for y in (0, 1)]
            post.append(like[1] / sum(like))
        share = (sum(post) + 1) / (len(post) + 2)
        for j in range(6):
            for y in (0, 1):
                c = [2 * start[y][x] + sum((p if y else 1 - p) for p, v in zip(post, votes, strict=True) if v[j] + 1 == x)
                     for x in range(3)]
                table[j][y] = [x / sum(c) for x in c]
        if _ > 30 and abs(share - model.share[1]) < 1e-9:
            break
    assert share == pytest.approx(model.share[1], abs=1e-4)
    assert np.allclose(np.array(table), model.reliability[1], atol=1e-3)
    right = (model.posterior > 0.5) @ model.n
    assert 0.3 < right / 400 < 0.5


def test_empty_table(spark, docs_frame, tmp_path):
    assert run(spark, docs_frame([]), tmp_path) == []

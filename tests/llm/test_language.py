import zlib

import numpy as np
import pytest

from campuslens.llm import language as L


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = L.document_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    tested = [r for r in rows if r.held_out and r.lang and r.lang_pred != "und"]
    assert len(tested) > 100
    assert np.mean([r.lang == r.lang_pred for r in tested]) > 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)


EN = "the house on the hill was old and the wind would not stop blowing through the windows"
DE = "das alte haus auf dem hügel war leer und der wind wollte nicht aufhören zu wehen"


@pytest.fixture(scope="module")
def trained(docs_frame):
    rows = [(i, f"{EN} {i}", "en") for i in range(40)] + [(100 + i, f"{DE} {i}", "de") for i in range(40)]
    return L.learn_folds(docs_frame(rows))


def test_em_matches_a_plain_version(trained):
    """Proportions of a half-and-half text, against textbook EM with one trigram per step."""
    names, model = trained
    data = np.frombuffer(f"{EN} {DE}".encode(), np.uint8)
    text, slot = L.trigrams(data, np.array([0, len(data)]))
    share, _ = L.mixtures(text, slot, 1, model)
    pi = np.full(len(names), 1 / len(names))
    for _ in range(L.FULL_ROUNDS):
        joint = pi * np.exp(model.T[slot].astype(float))
        pi = (joint / joint.sum(1, keepdims=True)).mean(0)
    assert np.allclose(share[0], pi, atol=1e-3)


def test_language_sets(docs_frame, trained, odd_rows):
    rows = [(1, EN), (2, DE), (3, f"{EN}. {DE}"), (4, "12 !?"), (5, None), (6, ""), (7, EN), (7, EN),
            (None, DE), (8, EN * 2000)]
    frame = docs_frame(rows, extra=("_text", "share"))
    got = {r.doc_id: r for r in L.identify(frame, trained).collect()}
    assert (got[1].lang_pred, got[1].languages) == ("en", ["en"])
    assert (got[2].lang_pred, got[2].languages) == ("de", ["de"])
    assert sorted(got[3].languages) == ["de", "en"] and 0.3 < got[3].score < 0.7
    for i in (4, 5, 6):
        assert (got[i].lang_pred, got[i].score, got[i].languages) == ("und", 0.0, [])
    assert got[None].lang_pred == "de" and got[8].lang_pred == "en"
    assert L.identify(docs_frame(odd_rows), trained).count() == len(odd_rows)


def test_nothing_learnt_and_empty(docs_frame):
    frame = docs_frame([(1, EN), (2, None)])
    assert {r.lang_pred for r in L.document_languages(frame).collect()} == {"und"}
    assert L.document_languages(docs_frame([])).count() == 0


def test_stage_keeps_columns(docs_frame):
    rows = [(i, EN, "en") for i in range(20)] + [(50, "?"), (51, None)]
    frame = docs_frame(rows, extra=("lang_pred", "score", "row"))
    kept = L.in_known_language(frame)
    assert kept.columns == frame.columns and kept.count() == 20

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from campuslens.llm import token_file as TF

PATH = public_tokenizers.path(TF.TOKENIZER)


@given(st.lists(st.integers(0, 5000), min_size=1, max_size=400))
def test_select_and_decode_agree_with_the_offsets(sizes):
    ends = np.cumsum(sizes)
    bounds = TF.Bounds(TF.ef_encode(ends))
    assert bounds.all().tolist() == ends.tolist()
    assert [bounds.select(i) for i in range(len(ends))] == ends.tolist()


def test_code_is_near_the_minimum():
    ends = np.cumsum(np.random.default_rng(0).integers(1, 2000, 10_000))
    assert len(TF.ef_encode(ends)) * 8 / 10_000 < 2 + np.log2(1000) + 1.5


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(
    st.sampled_from(" \n\t'stremvldSTRE.,!_09éÉßÿÀ×÷ªİσΣςé̀ \x85\x1c　ǅÅ"), st.characters(codec="utf-8"))))
def test_encoder_equals_the_library(text):
    with open(PATH, "rb") as f:
        enc = TF.encoder(f.read())
    assert np.frombuffer(enc.encode(text), "<u2").tolist() == \
        Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


def brute(rows):
    tokenizer = Tokenizer.from_file(PATH)
    out = []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return out


def check(frame, rows):
    got = sorted(map(tuple, frame.select("start", "doc_id", "n_tokens", "ids_crc32").collect()))
    assert sorted(r[1:] for r in got if r[1] is not None) == sorted(
        r for r in brute(rows) if r[0] is not None)
    ids = [r[1] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    at = 0
    for start, _, n, _ in got:
        assert start == at
        at += n


def test_round_trip_on_the_table(small_docs):
    rows = [(r.doc_id, r.text) for r in small_docs.collect()]
    check(TF.tokens_round_trip(small_docs), rows)


def test_odd_rows_and_small_blocks(docs_frame, odd_rows, tmp_path):
    frame = docs_frame(odd_rows, extra=("start", "part"))
    TF.write_tokens(frame, str(tmp_path / "tokens"), block_tokens=8)
    check(TF.read_tokens(frame.sparkSession, str(tmp_path / "tokens")), odd_rows)


def test_empty_table(docs_frame):
    assert TF.tokens_round_trip(docs_frame([])).count() == 0


@pytest.mark.parametrize("copies", [3000])
def test_one_id_on_most_rows(docs_frame, copies):
    rows = [(1, "again")] * copies + [(0, "first"), (2, "last")]
    check(TF.tokens_round_trip(docs_frame(rows)), rows)

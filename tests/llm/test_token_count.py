import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from campuslens.llm import token_count as TC


def spec():
    with open(public_tokenizers.path(TC.VOCABULARY), "rb") as f:
        return f.read()


#: The same vocabulary and scores read as a unigram model: field 2 (trainer), field 3 (kind) = 1.
LIBRARY = SentencePieceProcessor(model_proto=spec() + b"\x12\x02\x18\x01")
COUNTER = TC.Counter(spec())


PIECES = {w: COUNTER.automaton.get(w)[1] for w in COUNTER.automaton}
LONGEST = max(map(len, PIECES))


def library(text):
    """Pieces of the best path in the library's n-best lattice."""
    return len(LIBRARY.nbest_encode_as_pieces(text, 2)[0]) if text else 0


def test_counts_of_words_equal_the_library(small_docs):
    words = sorted({w for r in small_docs.limit(80).collect() for w in (r.text or "").split()})
    words += ["日本", "🙂", "a\nb", "naïve", "x\ty"]
    assert len(words) > 3000
    assert [w for w in words if COUNTER.count(w)[0] != library(w)] == []


def brute(text):
    """Best (score, pieces) over all cuts, trying every piece from every start."""
    text = COUNTER.model.normalize(text)
    pieces = PIECES
    best = [(0.0, 0)] + [None] * len(text)
    for i in range(len(text)):
        for j in range(i + 1, min(i + LONGEST, len(text)) + 1):
            if text[i:j] in pieces:
                score, n = pieces[text[i:j]], 1
            elif j == i + 1:
                score, n = COUNTER.unknown, len(text[i:j].encode())
            else:
                continue
            score, n = best[i][0] + score, best[i][1] + n
            if best[j] is None or score > best[j][0]:
                best[j] = (score, n)
    return best[-1][::-1]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("  \n\tthe aing,.ñéß日本語🙂▁"),
                                  st.characters(codec="utf-8", exclude_characters="\0")), max_size=60))
def test_any_text_against_brute_force(text):
    assert COUNTER.count(text) == brute(text)


def test_against_brute_force_with_scores():
    for text in ["", "Hello  world", "the thing\nthat sings, ñandú 日本", "aaaa bbbb  cccc "]:
        assert COUNTER.count(text) == brute(text)


def test_table_and_odd_rows(docs_frame, small_docs, odd_rows):
    rows = [(r.doc_id, r.text) for r in small_docs.limit(20).collect()]
    rows += [(i, t) for i, t in odd_rows if len(t or "") < 1000]
    got = TC.count_tokens(docs_frame(rows, extra=("n_tokens", "score"))).collect()
    want = [(i, brute(t or "")[0]) for i, t in rows]
    assert sorted(((r.doc_id, r.n_tokens) for r in got), key=repr) == sorted(want, key=repr)
    assert TC.count_tokens(docs_frame([])).count() == 0


def test_long_texts_are_sums_of_their_segments(docs_frame):
    unit = " the thing ñandú, 日本 sings."
    row, = TC.count_tokens(docs_frame([(1, unit * 20_000)])).collect()
    first, more = COUNTER.count(unit), COUNTER.count(unit * 2)
    assert row.n_tokens == first[0] + 19_999 * (more[0] - first[0])
    assert row.score == first[1] + 19_999 * (more[1] - first[1])

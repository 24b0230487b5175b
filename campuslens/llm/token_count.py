"""Token counts without tokens: Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists the vocabulary pieces that end at each character; a forward pass
keeps, per position, the best score and the number of pieces on the best path, never the path.
Ties follow the tokenizer: pieces are tried by ascending start and a later one must be strictly
better. A character that is no piece costs the lowest score less ten and counts as its UTF-8 bytes
where the vocabulary has byte pieces, else as one piece for a run of such characters.

No piece of two characters or more spans a cut made before a blank that follows another character,
or around a character that only stands alone, so texts fall into segments whose best paths are
independent; each distinct segment is solved once and remembered. Scores of the public vocabulary
are integers, so sums are exact. Results are those of the sentencepiece library's lattice (its
n-best search) over the same pieces and scores; the library adds scores in 32 bits, so it rounds
where a total exceeds 2**24."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCABULARY = "piece_bpe_32k.model"
UNKNOWN_PENALTY = 10.0
#: Distinct segments that one worker remembers; later ones are solved again.
CACHE_ENTRIES = 300_000
_BLANK = "▁"

COUNTS = [T.StructField("n_tokens", T.LongType()), T.StructField("score", T.DoubleType())]


class Counter(dict):
    """(pieces, score) of each segment seen, for one vocabulary file."""

    def __init__(self, spec: bytes):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor
        super().__init__()
        self.model = SentencePieceProcessor(model_proto=spec)
        ids = range(self.model.vocab_size())
        plain = [i for i in ids if not (self.model.is_control(i) or self.model.is_unknown(i)
                                        or self.model.is_byte(i) or self.model.is_unused(i))]
        pieces = {self.model.id_to_piece(i): self.model.get_score(i) for i in plain}
        self.bytes = any(map(self.model.is_byte, ids))
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN_PENALTY
        self.single = {p for p in pieces if len(p) == 1}
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        joined = {c for p in pieces if len(p) > 1 for c in p} - {_BLANK}
        inner = any(a != _BLANK and b == _BLANK for p in pieces for a, b in zip(p, p[1:]))
        letters = "".join(map(re.escape, sorted(joined)))
        self.segments = re.compile(r"(?s).+" if inner or not joined else
                                   rf"(?s){_BLANK}*[{letters}]+|{_BLANK}+|.").findall

    def __missing__(self, segment: str) -> tuple[int, float]:
        found = self.solve(segment)
        if len(self) < CACHE_ENTRIES:
            self[segment] = found
        return found

    def solve(self, text: str) -> tuple[int, float]:
        n = len(text)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for end, match in self.automaton.iter(text):
            ends[end + 1].append(match)
        best, count = [0.0] + [float("-inf")] * n, [0] * (n + 1)
        stray = [False] * (n + 1)
        for end in range(1, n + 1):
            top, pieces, odd = best[end], 0, False
            for length, score in sorted(ends[end], reverse=True):
                score += best[end - length]
                if score > top:
                    top, pieces = score, count[end - length] + 1
            char = text[end - 1]
            if char not in self.single and best[end - 1] + self.unknown > top:
                top, odd = best[end - 1] + self.unknown, True
                pieces = count[end - 1] + (len(char.encode()) if self.bytes
                                           else not stray[end - 1])
            best[end], count[end], stray[end] = top, pieces, odd
        return count[n], best[n]

    def count(self, text: str) -> tuple[int, float]:
        parts = [self[s] for s in self.segments(self.model.normalize(text))]
        return sum(p[0] for p in parts), sum(p[1] for p in parts)


_COUNTERS: dict[int, Counter] = {}


def counter(spec: bytes) -> Counter:
    """One counter per Python worker and vocabulary."""
    key = zlib.crc32(spec)
    if key not in _COUNTERS:
        _COUNTERS[key] = Counter(spec)
    return _COUNTERS[key]


def count_tokens(docs: DataFrame, keep: list[str] | None = None, vocabulary: str | None = None,
                 text_col: str = "text") -> DataFrame:
    """``keep`` columns (default: doc_id) with n_tokens and the score of the best path.

    Null and empty texts have no tokens and score 0; every row is counted on its own, repeated ones
    too; other columns are ignored. A map without shuffle."""
    keep = ["doc_id"] if keep is None else keep
    with open(vocabulary or public_tokenizers.path(VOCABULARY), "rb") as f:
        spec = f.read()
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(spec)
        for batch in batches:
            found = [counts.count(t.as_py() or "") for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([f[0] for f in found], pa.int64()),
                 pa.array([f[1] for f in found], pa.float64())], [*keep, "n_tokens", "score"])

    return rows.mapInArrow(run, T.StructType([*(rows.schema[c] for c in keep), *COUNTS]))

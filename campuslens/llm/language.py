"""Language identification by mixtures of n-gram models.

Training counts byte trigrams of lower-cased letters per language, hashed into a table of fixed
size. A document's language proportions are the mixture weights that expectation-maximisation finds
for its trigrams; its set of languages is the one with the best penalised likelihood, found by
dropping the weakest language while the penalty saved is worth more than the likelihood lost."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campuslens.llm.common import fresh_name, mix64, packed, pieces, text_buffers

BITS = 15
SMOOTHING = 0.5
FULL_ROUNDS = 8
DROP_ROUNDS = 4
#: Folds of five: documents whose crc32 of the id leaves this remainder are never learnt from.
FOLDS, HELD_OUT = 5, 0
UNKNOWN = "und"
#: Bytes of a piece of text; the trigram arrays are some 60 times as large.
TEXT_BYTES = 1 << 19
_CHUNK = 1024

_B = np.arange(256)
#: Letters and bytes beyond ASCII stay, everything else is a gap.
CLEAN = np.where(((_B >= 97) & (_B <= 122)) | (_B >= 128), _B, 32).astype(np.uint8)
CLEAN[65:91] = np.arange(97, 123)


def trigrams(data: np.ndarray, offsets: np.ndarray, bits: int = BITS
             ) -> tuple[np.ndarray, np.ndarray]:
    """(text number, table slot) of every trigram. Each text is framed by gaps; trigrams with a gap
    in the middle say nothing about a word and are left out."""
    lengths = np.diff(offsets)
    framed = np.full(len(data) + 2 * len(lengths), 32, np.uint8)
    framed[np.arange(len(data)) + np.repeat(2 * np.arange(len(lengths)) + 1, lengths)] = CLEAN[data]
    text = np.repeat(np.arange(len(lengths)), lengths + 2)
    middle = np.flatnonzero(framed[1:-1] != 32) + 1 if len(framed) > 2 else np.zeros(0, np.int64)
    code = (framed[middle - 1].astype(np.uint64) << np.uint64(16)
            | framed[middle].astype(np.uint64) << np.uint64(8)
            | framed[middle + 1].astype(np.uint64))
    return text[middle], (mix64(code + np.uint64(1)) >> np.uint64(64 - bits)).astype(np.int64)


def learn(docs: DataFrame, bits: int = BITS) -> tuple[list[str], np.ndarray]:
    """Languages and their log-probabilities per table slot, from all rows of ``docs`` (text, lang).
    Each task adds up its texts in one table per language and hands over slices of it; the model
    that comes to the driver has languages x 2**bits numbers whatever the corpus holds."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in pieces(batch, "text", TEXT_BYTES):
                codes = part.column(1).dictionary_encode()
                text, slot = trigrams(*text_buffers(part.column(0)), bits)
                lang = codes.indices.to_numpy()[text]
                names = codes.dictionary.to_pylist()
                counts = np.bincount((lang.astype(np.int64) << bits) + slot,
                                     minlength=len(names) << bits).reshape(len(names), -1)
                for name, row in zip(names, counts, strict=True):
                    tables[name] = tables.get(name, 0) + row
        for name, counts in tables.items():
            chunks = counts.reshape(-1, _CHUNK)
            yield pa.RecordBatch.from_pydict({
                "lang": [name] * len(chunks), "chunk": pa.array(range(len(chunks)), pa.int32()),
                "counts": [c.astype("<i8").tobytes() for c in chunks]})

    def add(key, group):
        total = sum(np.frombuffer(b, "<i8") for b in group.column("counts").to_pylist())
        return pa.table({"lang": [key[0].as_py()], "chunk": pa.array([key[1].as_py()], pa.int32()),
                         "counts": [total.tobytes()]})

    schema = T.StructType([T.StructField("lang", T.StringType()),
                           T.StructField("chunk", T.IntegerType()),
                           T.StructField("counts", T.BinaryType())])
    parts = docs.where("text IS NOT NULL AND lang IS NOT NULL").select(
        F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    ).mapInArrow(count, schema).groupBy("lang", "chunk").applyInArrow(add, schema)
    rows = parts.collect()
    names = sorted({r["lang"] for r in rows})
    counts = np.zeros((len(names), 1 << bits))
    for r in rows:
        at = r["chunk"] * _CHUNK
        counts[names.index(r["lang"]), at:at + _CHUNK] = np.frombuffer(bytes(r["counts"]), "<i8")
    seen = counts.sum(0) > 0
    smooth = counts + SMOOTHING * np.maximum(seen, 1e-3)
    return names, np.log(smooth / smooth.sum(1, keepdims=True)).astype(np.float32)


def mixtures(text: np.ndarray, slot: np.ndarray, n_texts: int, model: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (n_texts x languages) of the selected language sets, and the log-likelihood
    per trigram. Texts without trigrams get proportion zero everywhere."""
    n_lang, size = model.shape
    share = np.zeros((n_texts, n_lang), np.float32)
    score = np.zeros(n_texts)
    if not len(slot) or not n_lang:
        return share, score
    keys, weight = np.unique(text * size + slot, return_counts=True)
    owner, slots = keys // size, keys % size
    weight = weight.astype(np.float32)
    total = np.bincount(owner, weight, n_texts)
    some = np.flatnonzero(total > 0)
    logs = model.T[slots]
    top = logs.max(1)
    like = np.exp(logs - top[:, None])

    def fit(texts, pi, rounds):
        """EM over the given texts (sorted); their trigram rows are contiguous."""
        chosen = np.zeros(n_texts, bool)
        chosen[texts] = True
        rows = np.flatnonzero(chosen[owner])
        own = np.searchsorted(texts, owner[rows])
        first = np.searchsorted(own, np.arange(len(texts)))
        part, w, n = like[rows], weight[rows], total[texts][:, None].astype(np.float32)
        for _ in range(rounds):
            joint = part * pi[own]
            joint *= (w / joint.sum(1))[:, None]
            pi = np.add.reduceat(joint, first) / n
        ll = np.add.reduceat(w * (np.log((part * pi[own]).sum(1)) + top[rows]), first)
        return pi, ll

    pi, ll = fit(some, np.full((len(some), n_lang), 1 / n_lang, np.float32), FULL_ROUNDS)
    share[some], score[some] = pi, ll
    penalty = 0.5 * np.log(np.maximum(total, 2)) + 2
    active = some
    for _ in range(n_lang - 1):
        now = share[active]
        weakest = np.where(now > 0, now, np.inf).argmin(1)
        rest = now.copy()
        rest[np.arange(len(active)), weakest] = 0
        rest = rest / rest.sum(1, keepdims=True)
        pi, ll = fit(active, rest, DROP_ROUNDS)
        better = ll + penalty[active] >= score[active]
        moved = active[better]
        share[moved], score[moved] = pi[better], ll[better]
        active = moved[(share[moved] > 0).sum(1) > 1]
        if not len(active):
            break
    return share, score / np.maximum(total, 1)


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray],
             keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """``keep`` columns (default: doc_id) with lang_pred, score (the proportion of that language)
    and languages (the selected set, largest share first).

    Null text and text without a letter are ``und`` with score 0, as is everything when no
    labelled text was learnt. Equal shares go to the first language by name. Only the text is
    read."""
    names, table = model
    keep = ["doc_id"] if keep is None else keep
    at = fresh_name(docs, "_text")
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).cast("string").alias(at))
    schema = T.StructType([*(rows.schema[c] for c in keep), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()),
                           T.StructField("languages", T.ArrayType(T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, at, TEXT_BYTES):
                column = part.column(part.num_columns - 1)
                n = part.num_rows
                text, slot = trigrams(*text_buffers(column))
                share, _ = mixtures(text, slot, n, table)
                letters = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False)
                known = letters.to_numpy(zero_copy_only=False) & (share.sum(1) > 0) \
                    if names else np.zeros(n, bool)
                best = share.argmax(1) if names else np.zeros(n, np.int64)
                order = np.argsort(-share, axis=1, kind="stable") if names else share
                pred = [names[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
                score = np.where(known, share[np.arange(n), best], 0.0) if names else np.zeros(n)
                sets = [[names[j] for j in order[i] if share[i, j] > 0] if known[i] else []
                        for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(pred, pa.string()),
                     pa.array(np.clip(score, 0, 1), pa.float64()),
                     pa.array(sets, pa.list_(pa.string()))],
                    [*keep, "lang_pred", "score", "languages"])

    return rows.mapInArrow(run, schema)


def held_out(doc_id) -> F.Column:
    """Whether a document is kept from training; so is one without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(True))


def learn_folds(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    return learn(docs.where(~held_out(F.col("doc_id"))))


def document_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, languages for every row. Repeated rows get equal
    results; rows with a null lang or id are predicted but not learnt from; columns other than
    doc_id, text and lang are ignored."""
    out = identify(docs, learn_folds(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score",
                      "languages")


def in_known_language(docs: DataFrame) -> DataFrame:
    """Documents with a language, with the input's columns: those without a letter go."""
    marked = identify(packed(docs), learn_folds(docs), keep=["row"])
    return marked.where(F.col("lang_pred") != UNKNOWN).select("row.*")

"""Benchmark decontamination by winnowing.

Of every ``window`` consecutive k-gram hashes the smallest is kept as a fingerprint. With
k + window - 1 = span, every run of ``span`` words has one, and a run that both sides share has the
same one: no shared span is missed. Documents and test items meet in a join of their fingerprints; a
hit is extended to the span of words around it, byte for byte. Items shorter than a span are one
window of their own length L, with k = L and a window of one.

A sieve of fixed size over the test fingerprints goes along with the documents, so that only what
may hit leaves them; it lets through every true hit. Results depend on the text alone, so hits travel
by a 128-bit hash of it, once for all copies of a text."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campuslens.llm.common import (
    BYTE_VALUES,
    LOWER,
    RollingHash,
    fresh_name,
    mix64,
    packed,
    pieces,
    sliding,
    stage,
    text_buffers,
)
from campuslens.session import bounded

SPAN = 10
GRAM = 5
#: Fingerprints are sieved by this many of their bits: 2 MB of flags, whatever the test table.
SIEVE_BITS = 24
#: Words of the contract, on text whose A-Z are not lower-cased yet.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_B = np.arange(256)
#: Digits, a-z after lower-casing, and every byte of a character beyond ASCII.
WORD_BYTE = ((_B >= 48) & (_B <= 57)) | ((_B >= 97) & (_B <= 122)) | (_B >= 128)

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("n_items", T.LongType()), T.StructField("items_sha256", T.StringType()),
    T.StructField("contaminated", T.BooleanType())])


class Words:
    """Words of a run of texts: places, hashes and the first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = LOWER[data]
        inside = WORD_BYTE[self.data]
        starts, ends = inside.copy(), inside.copy()
        starts[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        filled = offsets[:-1][offsets[1:] > offsets[:-1]]
        starts[filled] = inside[filled]
        last = offsets[1:][offsets[1:] > offsets[:-1]] - 1
        ends[last] = inside[last]
        self.starts, self.ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.hashes = RollingHash(BYTE_VALUES[self.data]).spans(self.starts, self.ends)
        self.text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self.left = self.first[1:][self.text_of] - np.arange(len(self.starts)) \
            if len(self.starts) else np.zeros(0, np.int64)

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k words from each place that has k words left in the array, above 0."""
        n = max(0, len(self.hashes) - k + 1)
        out = np.zeros(n, np.uint64)
        for i in range(k):
            out = mix64(out ^ self.hashes[i:i + n]) + np.uint64(i + 1)
        return out | np.uint64(1)

    def window(self, at: int, length: int) -> bytes:
        data = self.data
        return b" ".join(data[a:b].tobytes() for a, b in zip(
            self.starts[at:at + length].tolist(), self.ends[at:at + length].tolist()))

    def windows(self, length: int, span: int, k: int) -> np.ndarray:
        """Fingerprint of the window at each place: the smallest hash of its k-grams (of the whole
        window, where it is shorter than a span); 0 where the text has fewer words left."""
        if length < span:
            out = self.grams(length)
        else:
            grams = self.grams(k)
            out = sliding(grams, span - k + 1, np.minimum) if len(grams) > span - k else grams[:0]
        return np.where(self.left[:len(out)] >= length, out, np.uint64(0))


def decontaminate(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None,
                  text_col: str = "text", item_col: str = "item_id", span: int = SPAN,
                  gram: int = GRAM) -> DataFrame:
    """``keep`` columns of ``docs`` (default: doc_id) with n_words, n_hit (words inside an
    occurrence of a window), n_items, items_sha256 and contaminated.

    Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased. Null has no
    words; an item without words has no window; items with equal ids count once, a null item id is
    written as "null"; equal texts get equal results, repeated rows too; equal fingerprints of
    different words are told apart by their bytes; an empty test table leaves every document clean.
    A text is read whole by one task, about 60 bytes of memory a byte of it. Columns of ``docs`` that
    are not kept are ignored."""
    keep = ["doc_id"] if keep is None else keep
    spark = docs.sparkSession
    text, one, two = (fresh_name(docs, n) for n in ("_text", "_one", "_two"))
    frame = docs.select(*[F.col(f"`{c}`") for c in keep],
                        F.col(text_col).cast("string").alias(text))
    frame = frame.withColumns({one: F.xxhash64(F.lit(11), text), two: F.xxhash64(F.lit(12), text)})
    tests = stage(item_windows(benchmark, text_col, item_col, span, gram), "test-windows")
    lengths = sorted(r[0] for r in tests.select("length").distinct().collect())  # 1 to span
    hits = document_windows(frame.select(F.col(one).alias("one"), F.col(two).alias("two"),
                                         F.col(text).alias("text")),
                            sieve_of(tests), lengths, span, gram)
    # copies of a text give equal rows; one stays
    hits = hits.dropDuplicates(["one", "two", "length", "print", "window"])
    spans = F.transform("starts", lambda s: F.struct(
        s.alias("a"), (s + F.col("length")).alias("b")))
    marked = hits.join(tests, ["length", "print", "window"]).groupBy("one", "two").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(spans)))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("e"))
    covered = F.aggregate("spans", none, lambda s, x: F.struct(
        (s["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(x["a"], s["e"]))).alias("n"),
        F.greatest(s["e"], x["b"]).alias("e")), lambda s: s["n"])
    n_words, n_hit, n_items, digest, contaminated = RESULT.names
    marked = bounded(marked.select(
        F.col("one").alias(one), F.col("two").alias(two), covered.alias(n_hit),
        F.size("items").cast("long").alias(n_items),
        F.sha2(F.array_join("items", ","), 256).alias(digest)), "contaminated-texts")
    words = F.regexp_count(F.col(text), F.lit(WORD))
    out = frame.join(marked, [one, two], "left")
    return out.select(
        *[F.col(f"`{c}`") for c in keep],
        F.coalesce(words, F.lit(0)).cast("long").alias(n_words),
        F.coalesce(marked[n_hit], F.lit(0)).alias(n_hit),
        F.coalesce(marked[n_items], F.lit(0)).alias(n_items),
        F.coalesce(marked[digest], F.sha2(F.lit(""), 256)).alias(digest),
        (F.coalesce(marked[n_hit], F.lit(0)) > 0).alias(contaminated))


def item_windows(benchmark: DataFrame, text_col: str, item_col: str, span: int, gram: int
                 ) -> DataFrame:
    """length, print, window and items: every window of the test items once, with the sorted ids
    of the items that have it."""
    rows = benchmark.where(F.col(text_col).isNotNull()).select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"),
        F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                words = Words(*text_buffers(part.column(1)))
                names = part.column(0)
                count = np.diff(words.first)
                for length in np.unique(np.minimum(count, span)).tolist():
                    if not length:
                        continue
                    prints = words.windows(length, span, gram)
                    fits = (count >= span) if length == span else (count == length)
                    at = np.flatnonzero((prints > 0) & fits[words.text_of[:len(prints)]])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(at), length, np.int32)),
                        pa.array(prints[at].view(np.int64)),
                        pa.array([words.window(i, length) for i in at.tolist()], pa.binary()),
                        names.take(pa.array(words.text_of[at]))],
                        ["length", "print", "window", "item"])

    found = rows.mapInArrow(run, "length int, print long, window binary, item string")
    return found.groupBy("length", "print", "window").agg(
        F.array_sort(F.collect_set("item")).alias("items"))


def sieve_of(tests: DataFrame) -> np.ndarray:
    """One flag per value of a fingerprint's upper SIEVE_BITS bits; 2 MB at most reach the driver."""
    slot = F.shiftrightunsigned("print", 64 - SIEVE_BITS) + 1
    parts = tests.groupBy(F.bitmap_bucket_number(slot).alias("at")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    sieve = np.zeros(1 << SIEVE_BITS >> 3, np.uint8)
    for row in parts.collect():
        bits = np.frombuffer(bytes(row["bits"]), np.uint8)
        at = (row["at"] - 1) * 4096
        sieve[at:at + len(bits)] = bits[:len(sieve) - at]
    return sieve


def document_windows(texts: DataFrame, sieve: np.ndarray, lengths: list[int], span: int, gram: int
                     ) -> DataFrame:
    """one, two, length, print, window, starts: the windows of each text whose fingerprint passes
    the sieve, once per text, with all their places (word numbers)."""
    shift = np.uint64(64 - SIEVE_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                words = Words(*text_buffers(part.column(2)))
                for length in lengths:
                    prints = words.windows(length, span, gram)
                    slot = (prints >> shift).astype(np.int64)
                    passed = sieve[slot >> 3] >> (slot & 7).astype(np.uint8) & 1
                    found: dict[tuple[int, bytes], list[int]] = defaultdict(list)
                    for at in np.flatnonzero((prints > 0) & (passed > 0)).tolist():
                        found[int(words.text_of[at]), words.window(at, length)].append(at)
                    if not found:
                        continue
                    row = np.array([r for r, _ in found], np.int64)
                    first = np.array([p[0] for p in found.values()], np.int64)
                    starts = [(np.array(p) - words.first[r]).tolist()
                              for (r, _), p in found.items()]
                    yield pa.RecordBatch.from_arrays([
                        part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)),
                        pa.array(np.full(len(row), length, np.int32)),
                        pa.array(prints[first].view(np.int64)),
                        pa.array([w for _, w in found], pa.binary()),
                        pa.array(starts, pa.list_(pa.int64()))],
                        ["one", "two", "length", "print", "window", "starts"])

    return texts.mapInArrow(run, "one long, two long, length int, print long, window binary, "
                                 "starts array<long>")


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without any occurrence of a benchmark window; columns as they came."""
    marked = decontaminate(packed(docs), benchmark, keep=["row"])
    return marked.where(~F.col("contaminated")).select("row.*")

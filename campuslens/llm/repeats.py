"""Repeated passages across documents by common-prefix interval trees.

A byte goes when a string of ``span`` bytes over it also starts in a document with a smaller id.
Indexing every suffix of the corpus would multiply it, so suffixes are chosen by winnowing: of every
``span - gram + 1`` consecutive hashes of ``gram`` bytes the smallest is an anchor, so every string
of ``span`` bytes holds one, at the same place wherever the string occurs. The context of an anchor
is all the strings of ``span`` bytes around it.

Round 1 groups anchors by the hash of their gram, and inside by the hash of their context: whoever
shares a whole context with a smaller document is settled. Round 2 compares what is left, one
context per class, byte by byte: an enhanced suffix array over the contexts of a range of gram
hashes, its interval tree scanned with a stack, and every maximal repeat (left extensions that
differ) of at least ``span`` bytes reported with all its occurrences.

Texts stay where they were read: they are stored once in blocks, bucketed by block number, and both
rounds send packed arrays of anchors to the ranges of gram hashes and get one answer per anchor
back, so only anchors are shuffled. A gram that very many documents share is one entry per block."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campuslens.llm.common import (
    BYTE_VALUES,
    RollingHash,
    mix64,
    pieces,
    stage,
    text_buffers,
    window_minima,
)
from campuslens.session import scratch_dir

SPAN = 50
GRAM = 26
TEXT_BYTES = 1 << 20
#: Anchors that a range of gram hashes holds on average, in both rounds.
RANGE_ANCHORS = 1 << 17
#: Bits of the gram and context hashes that are sent; both together name a class.
_SENT = np.uint64((1 << 64) - (1 << 16))
_LAST = np.iinfo(np.int64).max  # stands for a null id: above every id

BLOCKS = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("ids", T.BinaryType()),
    T.StructField("nulls", T.BinaryType()), T.StructField("offsets", T.BinaryType()),
    T.StructField("text", T.BinaryType())])
PACKETS = T.StructType([
    T.StructField("range", T.IntegerType()), T.StructField("block", T.LongType()),
    T.StructField("packet", T.BinaryType())])
RESULT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()),
    T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
    T.StructField("kept_sha256", T.StringType()), T.StructField("kept", T.BinaryType())])


def _planes(*arrays: np.ndarray) -> bytes:
    """64-bit arrays byte by byte, so that equal high bytes compress away on the wire."""
    return b"".join(x.view(np.uint8).reshape(-1, 8).T.tobytes() for x in arrays)


def _from_planes(packet: bytes, arrays: int) -> np.ndarray:
    planes = np.frombuffer(packet, np.uint8).reshape(arrays, 8, -1)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.uint64)[:, :, 0]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row at a time; each holds a block of text."""
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def _batch(schema: T.StructType, rows: list[tuple]) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_type
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema.fields]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, schema.fields, strict=True)],
        schema.names)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, seen = TaskContext.get().partitionId(), 0
    for batch in batches:
        for piece in pieces(batch, "text", TEXT_BYTES):
            data, offsets = text_buffers(piece.column(1))
            ids = piece.column(0)
            yield _batch(BLOCKS, [(
                part << 32 | seen, ids.fill_null(_LAST).to_numpy().astype("<i8").tobytes(),
                ids.is_null().to_numpy(zero_copy_only=False).tobytes(),
                offsets.astype("<i8").tobytes(), data.tobytes())])
            seen += 1


class Anchors:
    """Anchors of a block, in the order of their gram hash and context hash."""

    def __init__(self, row: dict, span: int = SPAN, gram: int = GRAM):
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.data = np.frombuffer(row["text"], np.uint8)
        self.offsets = offsets = np.frombuffer(row["offsets"], "<i8")
        n = max(0, len(self.data) - gram + 1)
        doc = np.repeat(np.arange(len(self.ids)), np.diff(offsets))
        rolling = RollingHash(BYTE_VALUES[self.data])
        hashes = rolling.windows(gram) & _SENT | np.uint64(1 << 16)
        whole = offsets[1:][doc[:n]] - np.arange(n) >= span
        at = np.flatnonzero(window_minima(hashes, span - gram + 1, whole))
        doc = doc[at]
        first = np.maximum(offsets[:-1][doc], at - (span - gram))
        last = np.minimum(offsets[1:][doc], at + span)
        context = mix64(rolling.spans(first, last) ^ (
            (at - first).astype(np.uint64) << np.uint64(32) | (last - at).astype(np.uint64))) & _SENT
        order = np.lexsort((self.ids[doc], context, hashes[at]))
        self.at, self.doc, self.first, self.last = (x[order] for x in (at, doc, first, last))
        self.gram, self.context = hashes[at][order], context[order]
        new = np.ones(len(order), bool)
        new[1:] = (self.gram[1:] != self.gram[:-1]) | (self.context[1:] != self.context[:-1])
        #: First anchor (smallest id) of each class in the block, and the class of each anchor.
        self.heads = np.flatnonzero(new)
        self.klass = np.cumsum(new) - 1

    def ranges(self, hashes: np.ndarray, ranges: int) -> np.ndarray:
        """Bounds of the equal-width ranges in sorted gram hashes."""
        edges = [(i << 64) // ranges for i in range(1, ranges)]
        inner = np.searchsorted(hashes, np.array(edges, np.uint64))
        return np.concatenate([[0], inner, [len(hashes)]])


def _first_requests(ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            a = Anchors(row)
            gram, context, ids = (x[a.heads] for x in (a.gram, a.context, a.ids[a.doc]))
            bounds = a.ranges(gram, ranges)
            yield _batch(PACKETS, [
                (r, row["block"], _planes(gram[b:e], context[b:e], ids[b:e]))
                for r, (b, e) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())) if e > b])
    return run


def _first_answers(key, group):
    """Per class of a block: 0 nothing to do, 1 a smaller document has the context, 2 the block has
    its smallest document and the gram has other contexts."""
    packets = [_from_planes(p, 3) for p in group.column("packet").to_pylist()]
    sizes = [p.shape[1] for p in packets]
    gram, context, ids = np.concatenate(packets, axis=1)
    ids = ids.view(np.int64)
    order = np.lexsort((ids, context, gram))
    g, c, i = gram[order], context[order], ids[order]
    head = np.ones(len(g), bool)
    head[1:] = (g[1:] != g[:-1]) | (c[1:] != c[:-1])
    start = np.flatnonzero(head)
    least = np.repeat(i[start], np.diff(np.append(start, len(g))))
    new_gram = np.ones(len(g), bool)
    new_gram[1:] = g[1:] != g[:-1]
    of_gram = np.cumsum(new_gram) - 1
    many = np.bincount(of_gram, head) > 1
    code = np.where(least < i, 1, np.where(many[of_gram], 2, 0)).astype(np.uint8)
    answer = np.empty(len(g), np.uint8)
    answer[order] = code
    return _answers(key, group, [a.tobytes() for a in np.split(answer, np.cumsum(sizes)[:-1])])


def _answers(key, group, packets):
    return pa.table({"range": pa.array([key[0].as_py()] * len(packets), pa.int32()),
                     "block": group.column("block"), "packet": pa.array(packets, pa.binary())})


def _first_codes(a: Anchors, answers: list[dict] | None) -> np.ndarray:
    parts = sorted(answers or [], key=lambda x: x["range"])
    return np.frombuffer(b"".join(p["packet"] for p in parts), np.uint8)


def _second_requests(ranges: int):
    """Contexts of the classes that other contexts of their gram may cover in part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            a = Anchors(row)
            heads = a.heads[_first_codes(a, row["first"]) == 2]
            bounds, out = a.ranges(a.gram[heads], ranges), []
            for r, (b, e) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                if e > b:
                    h = heads[b:e]
                    texts = [a.data[x:y].tobytes() for x, y in
                             zip(a.first[h].tolist(), a.last[h].tolist())]
                    head = np.array([len(h)], "<u4").tobytes() + a.gram[h].tobytes() \
                        + a.ids[a.doc[h]].tobytes() + (a.at[h] - a.first[h]).astype(np.uint8).tobytes() \
                        + (a.last[h] - a.first[h]).astype(np.uint8).tobytes()
                    out.append((r, row["block"], head + b"".join(texts)))
            if out:
                yield _batch(PACKETS, out)
    return run


def sorted_suffixes(keys: np.ndarray, lengths: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of suffixes by group, bytes and length, and the common prefix of each with the one before
    it (0 at both ends and across groups).

    Eight bytes at a time are looked at, and only of suffixes that are equal so far to another; where two
    neighbours part, their common prefix is known."""
    n, words = len(keys), keys.view(">u8")
    order = np.argsort(groups, kind="stable")
    group = groups[order]
    first = np.ones(n + 1, bool)  # starts of runs of suffixes that are equal so far
    first[1:n] = group[1:] != group[:-1]
    inside = ~first
    common = np.zeros(n + 1, np.int64)
    common[inside] = keys.shape[1]
    # a zero byte of the text sorts like the padding: the shorter one comes first
    for k, column in enumerate([*words.T, lengths]):
        rows = np.flatnonzero(~(first[:-1] & first[1:]))
        run = np.cumsum(first[:-1])[rows]
        value = column[order[rows]].astype(np.uint64)
        by = np.lexsort((value, run))
        order[rows], value = order[rows][by], value[by]
        if k < words.shape[1]:
            parts = np.flatnonzero((value[1:] != value[:-1]) & ~first[rows[1:]]) + 1
            differ = value[parts] ^ value[parts - 1]
            first[rows[parts]] = True
            common[rows[parts]] = 8 * k + sum(
                (differ < np.uint64(1 << (64 - 8 * b))).astype(np.int64) for b in range(1, 8))
    own = lengths[order]
    common[1:n] = np.minimum(common[1:n], np.minimum(own[1:], own[:-1]))
    return order, common


def maximal_repeats(keys: np.ndarray, lengths: np.ndarray, groups: np.ndarray, before: np.ndarray,
                    least: int) -> Iterator[tuple[int, np.ndarray]]:
    """(length, suffixes) of all maximal repeats of at least ``least`` bytes among suffixes.

    ``keys`` holds the suffixes' bytes (rows, zero padded to a multiple of 8), ``lengths`` their
    lengths, ``groups`` what must be equal besides, ``before`` the byte to the left (-1: none).
    The suffix array is sorted once; a stack holds the open intervals of its common-prefix tree,
    and an interval is reported when the bytes to the left of its suffixes are not all one."""
    order, common = sorted_suffixes(keys, lengths, groups)
    left = before[order]
    # changes of the byte to the left, counted along the suffix array
    change = np.zeros(len(order) + 1, np.int64)
    change[1:len(order)] = np.cumsum((left[1:] != left[:-1]) | (left[1:] < 0))
    change[len(order)] = change[len(order) - 1] if len(order) else 0
    long = common >= least
    spots = np.flatnonzero(long[1:-1] | long[:-2]) + 1 if len(order) > 1 else []
    lcp = common.tolist()
    stack: list[list[int]] = []  # (length, first suffix)
    for i in np.asarray(spots).tolist():
        value = lcp[i] if lcp[i] >= least else 0
        begin = i - 1
        while stack and stack[-1][0] > value:
            length, begin = stack.pop()
            if change[i - 1] > change[begin] or left[begin] < 0:
                yield length, order[begin:i]
        if value and (not stack or stack[-1][0] < value):
            stack.append([value, begin])
    end = len(order)
    while stack:
        length, begin = stack.pop()
        if change[end - 1] > change[begin] or left[begin] < 0:
            yield length, order[begin:end]


def _second_answers(span: int = SPAN):
    def run(key, group):
        grams, ids, lefts, sizes, texts, counts = [], [], [], [], [], []
        for p in group.column("packet").to_pylist():
            n = int(np.frombuffer(p, "<u4", 1)[0])
            grams.append(np.frombuffer(p, np.uint64, n, 4))
            ids.append(np.frombuffer(p, np.int64, n, 4 + 8 * n))
            lefts.append(np.frombuffer(p, np.uint8, n, 4 + 16 * n))
            sizes.append(np.frombuffer(p, np.uint8, n, 4 + 17 * n))
            texts.append(p[4 + 18 * n:])
            counts.append(n)
        gram, doc = np.concatenate(grams), np.concatenate(ids)
        left, size = (np.concatenate(x).astype(np.int64) for x in (lefts, sizes))
        text = np.frombuffer(b"".join(texts) + bytes(128), np.uint8)
        begin = np.cumsum(size) - size
        reach = np.zeros((len(gram), 2), np.uint8)
        # suffixes of contexts with at least a span left, gram by gram
        owner = np.repeat(np.arange(len(gram)), size - span + 1)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(size - span + 1) - (size - span + 1),
                                                  size - span + 1)
        width = -(-(2 * span - GRAM) // 8) * 8
        at = begin[owner] + place
        length = size[owner] - place
        keys, windows = np.empty((len(at), width), np.uint8), np.lib.stride_tricks.sliding_window_view(text, width)
        for b in range(0, len(at), 1 << 16):
            e = b + (1 << 16)
            keys[b:e] = windows[at[b:e]]
            keys[b:e][np.arange(width) >= length[b:e, None]] = 0
        before = np.where(place > 0, text[np.maximum(at - 1, 0)].astype(np.int64), -1)
        for repeat, suffixes in maximal_repeats(keys, length, gram[owner], before, span):
            who = owner[suffixes]
            later = doc[who] > doc[who].min()
            for s, w in zip(suffixes[later].tolist(), who[later].tolist()):
                a, z = left[w] - place[s], place[s] + repeat - left[w]
                if a >= 0 and z >= GRAM:  # the repeat holds the anchor
                    reach[w, 0] = max(reach[w, 0], a)
                    reach[w, 1] = max(reach[w, 1], z)
        return _answers(key, group, [x.tobytes() for x in np.split(reach, np.cumsum(counts)[:-1])])
    return run


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        a = Anchors(row)
        codes = _first_codes(a, row["first"])
        edge = np.zeros(len(a.data) + 1, np.int64)
        own = a.ids[a.doc]
        gone = (codes[a.klass] == 1) | (own > own[a.heads][a.klass])
        np.add.at(edge, a.first[gone], 1)
        np.add.at(edge, a.last[gone], -1)
        parts = sorted(row["second"] or [], key=lambda x: x["range"])
        reach = np.frombuffer(b"".join(p["packet"] for p in parts), np.uint8).reshape(-1, 2)
        # a class is sent once, for all its anchors in rows of its smallest id
        of_class = np.zeros((len(a.heads), 2), np.int64)
        of_class[codes == 2] = reach
        before, after = of_class[a.klass].T
        some = (after > 0) & ~gone
        np.add.at(edge, a.at[some] - before[some], 1)
        np.add.at(edge, a.at[some] + after[some], -1)
        removed = np.cumsum(edge[:-1]) > 0
        rise = removed.copy()
        rise[1:] &= ~removed[:-1]
        begins = a.offsets[:-1][np.diff(a.offsets) > 0]
        rise[begins] = removed[begins]
        total = np.concatenate([[0], np.cumsum(removed)])
        spans = np.concatenate([[0], np.cumsum(rise)])
        nulls = np.frombuffer(row["nulls"], bool)
        out = []
        for i, (b, e) in enumerate(zip(a.offsets[:-1].tolist(), a.offsets[1:].tolist())):
            kept = a.data[b:e][~removed[b:e]].tobytes()
            out.append((None if nulls[i] else int(a.ids[i]), e - b, int(total[e] - total[b]),
                        int(spans[e] - spans[b]), hashlib.sha256(kept).hexdigest(), kept))
        yield _batch(RESULT, out)


def remove_repeats(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes that stay) per row of
    ``docs`` (doc_id, text).

    Strings are judged on the input and never cross documents. Null text is empty; a null id is
    larger than every id, and null ids are not smaller than each other, nor are rows that share an
    id; an empty table gives an empty result; other columns are ignored."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    name = f"text_blocks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.mapInArrow(_blocks, BLOCKS).write.bucketBy(buckets, "block").sortBy("block").option(
        "path", f"{scratch_dir(spark).rstrip('/')}/{name}").format("parquet").saveAsTable(name)
    blocks = spark.table(name)
    size = blocks.agg(F.sum(F.length("text"))).first()[0] or 0
    ranges = ranges or int(size * 2 / (SPAN - GRAM + 2) // RANGE_ANCHORS) + 16

    def exchange(requests: DataFrame, answer, label: str) -> DataFrame:
        answers = stage(requests.groupBy("range").applyInArrow(answer, PACKETS), label)
        return answers.groupBy("block").agg(F.collect_list(F.struct("range", "packet")).alias(label))

    first = exchange(blocks.mapInArrow(_first_requests(ranges), PACKETS), _first_answers, "first")
    met = blocks.join(first, "block", "left")
    second = exchange(met.mapInArrow(_second_requests(ranges), PACKETS), _second_answers(), "second")
    return met.join(second, "block", "left").mapInArrow(_finish, RESULT)

"""SimHash near-duplicates by anchor-point covering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campuslens.llm import covering
from campuslens.llm.common import LOWER, Stage, fresh_name, pieces, stage, text_buffers
from campuslens.llm.components import components

SHINGLE = 3
THRESHOLD = 2
SEED = 42
#: Hashes whose 64 bits are counted at once.
_COUNT_ROWS = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority bits of the XXH64 of all word shingles of a lower-cased text."""
    hashes = _hashes(text, shingle)
    return _majority(hashes) if len(hashes) else 0


def _hashes(text: bytes, shingle: int) -> np.ndarray:
    words = text.split()  # bytes split on space and 0x09-0x0D only
    if not words:
        return np.zeros(0, np.uint64)
    whole = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1).tolist()
    ends = (ends - 1).tolist()
    last = min(shingle, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(whole[a:b], SEED) for a, b in zip(starts, ends[last:])),
                       np.uint64, len(words) - last)


def _majority(hashes: np.ndarray) -> int:
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _COUNT_ROWS):
        part = np.ascontiguousarray(hashes[at:at + _COUNT_ROWS]).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, name: str, text_col: str = "text",
                      keep: list[str] | None = None, shingle: int = SHINGLE) -> DataFrame:
    """``keep`` columns (all by default) and the fingerprint as a signed long."""
    keep = docs.columns if keep is None else keep
    at = fresh_name(docs, "_text")
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).cast("string").alias(at))
    schema = T.StructType([rows.schema[c] for c in keep] + [T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, at):
                data, offsets = text_buffers(part.column(part.num_columns - 1))
                lower = LOWER[data].tobytes()
                prints = np.array([fingerprint(lower[a:b], shingle) for a, b in
                                   zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)],
                                  np.uint64)
                yield pa.RecordBatch.from_arrays(
                    part.columns[:-1] + [pa.array(prints.view(np.int64))], [*keep, name])

    return rows.mapInArrow(run, schema)


def _anchors(threshold: int, home: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                prints = batch.column(0).slice(at, 2000).to_numpy(zero_copy_only=False)
                unsigned = prints.view(np.uint64)
                if home:
                    rows, anchors = slice(None), covering.homes(unsigned, threshold)
                else:
                    rows, anchors = covering.replicas(unsigned, threshold)
                yield pa.RecordBatch.from_arrays([pa.array(anchors), pa.array(prints[rows])],
                                                 ["anchor", "fp"])
    return run


def links(prints: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """All pairs (u, v), u < v, of distinct fingerprints (column ``fp``) that differ in at most
    ``threshold`` bits. A fingerprint is at home at one anchor and replicated to each anchor within
    radius plus threshold; the join on the anchor is an ordinary shuffle join that adaptive
    execution splits where an anchor is crowded, and it emits links only. A fingerprint has at most
    64 + 2016 others within two bits, so the links cannot grow with the square of a group.

    The join is hinted: Spark takes the replicas for as many rows as there are fingerprints, a
    hundredth of what they are, and would broadcast them."""
    def schema(name):
        return T.StructType([T.StructField("anchor", T.LongType()),
                             T.StructField(name, T.LongType())])
    home = prints.select("fp").mapInArrow(_anchors(threshold, True), schema("u"))
    near = prints.select("fp").mapInArrow(_anchors(threshold, False), schema("v"))
    differ = F.bit_count(F.col("u").bitwiseXOR(F.col("v")))
    pairs = home.join(near.hint("merge"), (home.anchor == near.anchor) & (F.col("u") < F.col("v"))
                      & (differ <= threshold))
    return pairs.select("u", "v")


def group_labels(prints: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(fp, root, component_id) for each distinct fingerprint of ``prints`` (fp, doc_id): the smallest
    doc_id that is reachable over links. Exact copies are one row before anything is compared."""
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    roots = components(stage(links(nodes, threshold), "print-links"))
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    placed = stage(placed, "placed")
    least = stage(placed.groupBy("root").agg(F.min("least").alias("component_id")), "roots")
    return stage(placed.select("fp", "root").join(least, "root").select(
        "fp", "root", "component_id"), "labels")


def simhash_groups(docs: DataFrame, threshold: int = THRESHOLD, shingle: int = SHINGLE
                   ) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    Null and wordless texts have fingerprint zero and are linked like any other; null ids take
    part but never name a group unless it has no other; repeated rows get equal results; extra
    columns are ignored; an empty table gives an empty result."""
    prints = stage(with_fingerprints(docs, "fp", keep=["doc_id"], shingle=shingle), "fingerprints")
    return prints.join(group_labels(prints, threshold), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, threshold: int = THRESHOLD, shingle: int = SHINGLE
                  ) -> DataFrame:
    """Rows of ``docs`` without near-duplicates: of each group the row with the smallest doc_id
    stays (of equal ids, one of them)."""
    fp, row = fresh_name(docs, "_fp"), fresh_name(docs, "_row")
    marked = with_fingerprints(docs, fp, shingle=shingle)
    marked = Stage(marked.withColumn(row, F.monotonically_increasing_id()), "dedup").frame
    prints = marked.select(F.col(fp).alias("fp"), F.col("doc_id"), F.col(row).alias("row"))
    labels = group_labels(prints, threshold)
    best = prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"),
                                                   "doc_id", "row")).alias("best"))
    grouped = best.join(labels, "fp").groupBy("root").agg(F.min("best").alias("best"))
    return marked.join(grouped.select(F.col("best.row").alias(row)), row, "left_semi").select(
        *[F.col(f"`{c}`") for c in docs.columns])

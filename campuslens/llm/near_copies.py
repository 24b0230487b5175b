"""Near copies by similarity of word shingles, found by an exact set-similarity join.

Texts are near copies if their sets of 5-word shingles have a Jaccard similarity of 0.8 or more. Texts
of equal sets are one node. Two similar sets share a shingle among the first ones of each in any common
order (prefix filter); the order is by how often a shingle occurs, so common lines come last. Every
pair that the filter leaves and that is not joined already is compared over all its shingles.

Sets are known by hashes of 64 bits; nothing else is left to chance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campuslens.llm import simhash
from campuslens.llm.common import LOWER, RollingHash, Stage, fresh_name, mix64, pieces, \
    release_shuffles, stage, text_buffers
from campuslens.llm.components import components
from campuslens.session import MAX_BROADCAST_ROWS, bounded

SHINGLE = 5
SIMILARITY = 0.8
#: Slots that shingles are counted in for their order, in rows of so many. The counts decide the
#: work only: any order gives the same pairs.
SLOT_BITS, ROW_BITS = 20, 14
#: Mean number of shingles of a slice at most; larger sets are compared slice by slice.
SLICE = 2048
#: Slack of comparisons of counts with a share of them; over-wide is harmless for candidates, and
#: the shares of whole numbers that decide are further apart.
_EPS = 1e-6
_SEED = mix64(np.arange(1, 2, dtype=np.uint64) << np.uint64(20))


def _word_hashes(text: bytes) -> np.ndarray:
    words = text.split()
    return np.fromiter((xxhash.xxh64_intdigest(w, simhash.SEED) for w in words), np.uint64,
                       len(words))


def shingle_set(words: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of a text's shingles, ascending; of fewer words, one of the whole text."""
    width = min(shingle, len(words))
    starts = np.arange(len(words) - width + 1 if width else 0)
    return np.unique(RollingHash(words).spans(starts, starts + width))


def set_id(hashes: np.ndarray) -> int:
    """Hash of a set of shingles, zero of an empty one."""
    return int(mix64(hashes ^ _SEED).sum(dtype=np.uint64))


def _lower_texts(column: pa.Array) -> Iterator[bytes]:
    data, offsets = text_buffers(column)
    lower = LOWER[data].tobytes()
    return (lower[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True))


#: Bits of a set's parity map, in words of 64.
MAP_WORDS = 16
_MAP = [f"m{k}" for k in range(MAP_WORDS)]


def parity_map(hashes: np.ndarray) -> np.ndarray:
    """Each shingle of a set flips one of the bits. Two maps differ in no more bits than the sets have
    shingles that are not shared, so they can rule pairs out."""
    bit = (hashes & np.uint64(64 * MAP_WORDS - 1)).astype(np.int64)
    odd = np.bincount(bit, minlength=64 * MAP_WORDS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def with_prints(docs: DataFrame, names: list[str], text_col: str = "text") -> DataFrame:
    """All columns and ``names``: the 3-word SimHash, the hash of the set of shingles, its size and the
    words of its parity map."""
    at = fresh_name(docs, "_text")
    rows = docs.withColumn(at, F.col(text_col).cast("string"))
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.LongType()) for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, at):
                made = np.empty((part.num_rows, len(names)), np.uint64)
                for k, t in enumerate(_lower_texts(part.column(part.num_columns - 1))):
                    hashes = shingle_set(_word_hashes(t))
                    made[k, :3] = simhash.fingerprint(t), set_id(hashes), len(hashes)
                    made[k, 3:] = parity_map(hashes)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], *(pa.array(c) for c in made.view(np.int64).T.copy())], schema.names)

    return rows.mapInArrow(run, schema)


def _slots(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - SLOT_BITS)


def slot_counts(texts: DataFrame, similarity: float) -> tuple[np.ndarray, int]:
    """How many shingles of ``texts`` (node, text) fall into each slot, up to 65535, and the number of
    shingles in all prefixes."""
    def rows(counts: dict, total: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([*counts, -1], pa.int64()),
             pa.array([*(np.minimum(c, 65535).astype(np.uint16).tobytes() for c in counts.values()),
                       np.array([total], np.int64).tobytes()], pa.binary())], ["at", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_counts, total = np.zeros(1 << SLOT_BITS, np.uint32), 0
        for batch in batches:
            for part in pieces(batch, "text"):
                for t in _lower_texts(part.column(1)):
                    hashes = shingle_set(_word_hashes(t))
                    np.add.at(all_counts, _slots(hashes), np.uint32(1))
                    total += prefix_length(len(hashes), similarity)
        yield rows({k: c for k, c in enumerate(all_counts.reshape(-1, 1 << ROW_BITS)) if c.any()}, total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        total = 0
        for batch in batches:
            for k, c in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if k < 0:
                    total += int(np.frombuffer(c, np.int64)[0])
                else:
                    sums[k] = sums.get(k, 0) + np.frombuffer(c, np.uint16).astype(np.uint32)
        yield rows(sums, total)

    made, entries = np.zeros((1 << (SLOT_BITS - ROW_BITS), 1 << ROW_BITS), np.uint16), 0
    schema = "at long, counts binary"
    for r in texts.mapInArrow(count, schema).repartition(len(made), "at").mapInArrow(
            add, schema).toLocalIterator():
        if r["at"] < 0:
            entries += int(np.frombuffer(r["counts"], np.int64)[0])
        else:
            made[r["at"]] = np.frombuffer(r["counts"], np.uint16)
    return made.reshape(-1), entries


def prefix_length(n: int, similarity: float = SIMILARITY) -> int:
    """Of the first so many shingles of a set of ``n`` one is shared with each similar set."""
    return n - int(np.ceil(similarity * n - _EPS)) + 1 if n else 0


#: A shingle in a prefix: shingle, node, size of the set, position.
_ENTRY = np.dtype([("shingle", np.uint64), ("node", np.int64), ("n", np.int32), ("at", np.int32)])
#: Bytes of entries that one range of shingles is to have.
RANGE_BYTES = 16 << 20
_ENTRY_SCHEMA = "shingle long, node long, n long, at long"


def _entry_batch(entries: np.ndarray) -> pa.RecordBatch:
    columns = [entries["shingle"].view(np.int64), entries["node"], *(entries[c].astype(np.int64) for c in ("n", "at"))]
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns],
                                      ["shingle", "node", "n", "at"])


def shared_prefixes(texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(shingle, node, n, at) of ``texts`` (node, text): the first shingles of each set, from the rarest,
    with the size of the set and their positions; without those that have one node only.

    Entries travel packed, a row for each piece of text and range of shingles, and are sorted in the
    range's task, so what is seen once is never written. Slots of very many shingles are not
    gathered: their entries pass as they are, and the join that follows parts them."""
    slots, total = slot_counts(texts, similarity)
    counts = texts.sparkSession.sparkContext.broadcast(slots)
    ranges = max(1, total * _ENTRY.itemsize // RANGE_BYTES + 1)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                made = []
                for node, t in zip(part.column(0).to_pylist(), _lower_texts(part.column(1)), strict=True):
                    s = shingle_set(_word_hashes(t))
                    k = prefix_length(len(s), similarity)
                    own = np.empty(k, _ENTRY)
                    own["shingle"] = s[np.argsort(counts.value[_slots(s)], kind="stable")[:k]]
                    own["node"], own["n"], own["at"] = node, len(s), np.arange(k)
                    made.append(own)
                entries = np.concatenate(made)
                hot = counts.value[_slots(entries["shingle"])] == 65535
                key = ((entries["shingle"] >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
                key[hot] = -1
                order = np.argsort(key, kind="stable")
                entries, key = entries[order], key[order]
                starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[starts] if len(key) else [], pa.int64()),
                     pa.array([x.tobytes() for x in np.split(entries, starts[1:])] if len(key) else [], pa.binary())],
                    ["range", "entries"])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                entries = np.frombuffer(raw.as_py(), _ENTRY)
                if key < 0:
                    yield _entry_batch(entries)
                else:
                    held.append(entries)
        every = np.unique(np.concatenate(held or [np.empty(0, _ENTRY)]))  # by shingle, then node
        new = np.concatenate([[True], every["shingle"][1:] != every["shingle"][:-1]]) if len(every) else []
        group = np.cumsum(new) - 1 if len(every) else np.empty(0, np.int64)
        often = np.bincount(group)[group] > 1 if len(every) else np.empty(0, bool)
        for start in range(0, len(every), 1 << 16):
            yield _entry_batch(every[start:start + (1 << 16)][often[start:start + (1 << 16)]])

    packed = texts.mapInArrow(pack, "range long, entries binary")
    # hot entries are dealt out by their content, the others by their range
    deal = F.when(F.col("range") < 0, F.xxhash64("entries")).otherwise(F.col("range"))
    return packed.withColumn("deal", deal).repartition(ranges, "deal").drop("deal").mapInArrow(unpack, _ENTRY_SCHEMA)


def _may_be_similar(n, at, m, there, similarity: float):
    """A first shared shingle at these positions leaves enough shingles after it."""
    return F.least(n - at, m - there) >= similarity / (1 + similarity) * (n + m) - _EPS


def buckets(texts: DataFrame, similarity: float = SIMILARITY) -> Stage:
    """(bucket, node, n, at, times, lo, hi): the nodes that share a first shingle. ``times`` shingles that
    the very same nodes share are one bucket, with a node's least position in them, so that what copies
    have in common counts once; ``lo`` and ``hi`` are the ends (node, n, at) of the bucket. A bucket
    is named by a hash of its nodes; if two had the same name, they would only be too wide together."""
    rows = Stage(shared_prefixes(texts, similarity).distinct(), "prefixes")
    release_shuffles(texts.sparkSession)
    names = rows.frame.groupBy("shingle").agg(
        F.bit_xor(F.xxhash64("node")).alias("bucket"), F.count(F.lit(1)).alias("size")).where("size > 1")
    merged = Stage(rows.frame.join(names, "shingle").groupBy("bucket", "node").agg(
        F.min("n").alias("n"), F.min("at").alias("at"), F.count(F.lit(1)).alias("times")), "prefix-merged")
    release_shuffles(texts.sparkSession)
    rows.drop()
    it = F.struct("node", "n", "at")
    ends = merged.frame.groupBy("bucket").agg(F.min(it).alias("lo"), F.max(it).alias("hi"))
    out = Stage(merged.frame.join(ends, "bucket"), "prefix-buckets")
    merged.drop()
    return out


def end_candidates(shared: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Distinct (u, v), u > v, of each node and three of the first and last nodes of its buckets: the
    least, the greatest and the one it meets most often. That is linear in the nodes and joins most
    of a large group of copies; ``rest_candidates`` has all that remains."""
    def met(end: str) -> DataFrame:
        return shared.where((F.col("node") != F.col(f"{end}.node")) & _may_be_similar(
            F.col("n"), F.col("at"), F.col(f"{end}.n"), F.col(f"{end}.at"), similarity)).groupBy(
            "node", F.col(f"{end}.node").alias("end")).agg(F.sum("times").alias("times"))

    ends = met("lo").union(met("hi")).groupBy("node").agg(
        F.min("end").alias("x"), F.max("end").alias("y"),
        F.max(F.struct("times", "end"))["end"].alias("z"))
    return ends.select("node", F.explode(F.array_distinct(F.array("x", "y", "z"))).alias("end")).select(
        F.greatest("node", "end").alias("u"), F.least("node", "end").alias("v")).distinct()


def _maps_allow(a: str, b: str, similarity: float):
    """The sizes and parity maps of two sets do not rule them out."""
    differ = sum((F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in _MAP), F.lit(0))
    return differ <= (1 - similarity) / (1 + similarity) * (F.col(f"{a}.n") + F.col(f"{b}.n")) + _EPS


def possible(pairs: DataFrame, maps: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Those of ``pairs`` (u, v) that ``maps`` (node, n, m0, m1, ...) do not rule out."""
    a, b = maps.alias("a"), maps.alias("b")
    return pairs.join(a, F.col("u") == F.col("a.node")).join(
        b, (F.col("v") == F.col("b.node")) & _maps_allow("a", "b", similarity)).select("u", "v")


def rest_candidates(shared: DataFrame, roots: DataFrame, maps: DataFrame, similarity: float = SIMILARITY
                    ) -> DataFrame:
    """All other distinct (u, v) of ``shared`` that may be similar and are not joined already by
    ``roots`` (node, root): they share a bucket, their sizes and places in it allow it, and so do
    their ``maps`` (node, n, m0, m1, ...)."""
    placed = shared.select("bucket", "node", "at").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).where(
        "x != y").select("bucket")
    placed = Stage(placed.join(mixed, "bucket", "left_semi"), "prefix-rest")
    mapped = placed.frame.join(maps, "node")
    a, b = mapped.alias("a"), mapped.alias("b")
    met = a.join(b, (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.root") < F.col("b.root"))
                 & _may_be_similar(F.col("a.n"), F.col("a.at"), F.col("b.n"), F.col("b.at"),
                                   similarity) & _maps_allow("a", "b", similarity))
    out = Stage(met.select(F.greatest("a.node", "b.node").alias("u"),
                           F.least("a.node", "b.node").alias("v")).distinct(), "rest-candidates")
    placed.drop()
    return out.frame


def _slice_bits(n: int) -> int:
    return max(0, (n - 1).bit_length() - (SLICE - 1).bit_length()) if n else 0


def shingle_slices(rows: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(node, n, bits, slice, hashes) of ``rows`` (node, text): all distinct shingles, cut by the
    first ``bits`` bits of their hashes as the sizes of the set and of any similar one ask for."""
    def cut(hashes: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        n = len(hashes)
        for bits in range(_slice_bits(n), _slice_bits(int(n / similarity + _EPS)) + 1):
            bounds = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits if bits else 0)
            for k, part in enumerate(np.split(hashes, np.searchsorted(hashes, bounds))):
                yield bits, k, part

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                made = []
                for node, t in zip(part.column(0).to_pylist(), _lower_texts(part.column(1)),
                                   strict=True):
                    hashes = shingle_set(_word_hashes(t))
                    made += [(node, len(hashes), bits, k, x.view(np.int64))
                             for bits, k, x in cut(hashes)]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([m[i] for m in made], pa.int64()) for i in range(4)),
                     pa.array([m[4] for m in made], pa.list_(pa.int64()))],
                    ["node", "n", "bits", "slice", "hashes"])

    return rows.mapInArrow(run, "node long, n long, bits long, slice long, hashes array<long>")


def _ends(pairs: DataFrame) -> DataFrame:
    """Distinct nodes of ``pairs``."""
    return pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct()


def similar(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Those of ``pairs`` (u, v) whose texts (node, text) are similar, by all their shingles. Texts
    that no pair names are not looked at. A set of many shingles is compared in slices of its
    hashes, so that no row grows with a text."""
    wanted = _ends(pairs)
    sets = Stage(shingle_slices(texts.join(wanted, "node", "left_semi"), similarity), "shingle-sets")
    # similarity s needs sizes within a factor s of one another
    least = F.least("nu", "nv") >= similarity * F.greatest("nu", "nv") - _EPS
    sizes = sets.frame.groupBy("node").agg(F.first("n").alias("n"), F.min("bits").alias("own"))
    fit = bounded(pairs.join(sizes.toDF("u", "nu", "bu"), "u").join(sizes.toDF("v", "nv", "bv"), "v").where(
        least).select("u", "v", "nu", "nv", F.greatest("bu", "bv").alias("bits")), "fitting-pairs")

    def side(name: str, hashes: str, *more: str) -> DataFrame:
        """A set's slices for each of its pairs: they meet by pair, so a set moves with its pairs only."""
        return sets.frame.join(fit.withColumn("node", F.col(name)), ["node", "bits"]).select(
            "u", "v", "slice", F.col("hashes").alias(hashes), *more)

    shared = side("u", "a", "nu", "nv").join(side("v", "b"), ["u", "v", "slice"]).groupBy("u", "v").agg(
        F.first("nu").alias("nu"), F.first("nv").alias("nv"),
        F.sum(F.size(F.array_intersect("a", "b"))).alias("both"))
    out = stage(shared.where(F.col("both") >= similarity * (F.col("nu") + F.col("nv") - F.col("both"))
                             - _EPS).select("u", "v"), "similar-pairs")
    sets.drop()
    return out


#: Words of 64 bits that a sieve has at most.
SIEVE_WORDS = 1 << 18


def at_rows(rows: DataFrame, ids: DataFrame, key: str, how: str) -> DataFrame:
    """``rows`` joined to ``ids`` (distinct ``key``, more) by an "inner" or "left_anti" join in which whole rows
    move only if they may be named: a short list goes to the rows; of a longer one a sieve of 2 MB does,
    and the rows that stay in it are joined by a shuffle. The result is that of the plain join."""
    listed = stage(ids, "listed-rows")
    if listed.count() <= MAX_BROADCAST_ROWS:
        return rows.join(F.broadcast(listed), key, how)
    slot = F.pmod(F.xxhash64(key), F.lit(SIEVE_WORDS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(F.lit(1), key), F.lit(64)).cast("int"))
    sieve = stage(listed.groupBy(slot.alias("_slot")).agg(F.bit_or(bit).alias("_word")), "sieve")
    marked = rows.withColumn("_slot", slot).join(F.broadcast(sieve), "_slot", "left")
    inside = F.coalesce(F.col("_word").bitwiseAND(bit) != 0, F.lit(False))
    met = marked.where(inside).drop("_slot", "_word").join(listed, key, how)
    return met if how == "inner" else met.unionByName(marked.where(~inside).drop("_slot", "_word"))


def simhash_links(nodes: DataFrame) -> DataFrame:
    """(u, v) over ``nodes`` (node, fp) whose 3-word fingerprints differ in two bits at most."""
    heads = stage(nodes.groupBy("fp").agg(F.min("node").alias("head")), "heads")
    same = nodes.join(heads, "fp").where("node != head").select(
        F.col("node").alias("u"), F.col("head").alias("v"))
    pairs = stage(simhash.links(heads), "print-links")
    met = pairs.join(heads.select(F.col("fp").alias("u"), F.col("head").alias("a")), "u").join(
        heads.select(F.col("fp").alias("v"), F.col("head").alias("b")), "v")
    return same.union(met.select(F.col("a").alias("u"), F.col("b").alias("v")))


def one_per_group(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` without near copies: of each group of linked texts the row with the
    smallest doc_id stays (of equal ids, one of them; null ids last). Texts are linked if their
    shingles are similar, or if their 3-word fingerprints differ in two bits at most.

    Null and wordless texts are one group; texts of fewer than five words have one shingle; repeated
    rows are copies; extra columns stay; an empty table gives an empty result."""
    names = [fresh_name(docs, f"_{p}") for p in ("fp", "set", "size", *_MAP)]
    row = fresh_name(docs, "_row")
    marked = Stage(with_prints(docs, names).withColumn(row, F.monotonically_increasing_id()),
                   "prints").frame
    node = names[1]
    copies = marked.select(F.col(names[0]).alias("fp"), F.col(node).alias("node"),
                           F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"),
                                    F.col(row).alias("row")).alias("it"))
    nodes = Stage(copies.groupBy("fp", "node").agg(F.min("it").alias("best")), "print-nodes")
    sets = Stage(nodes.frame.groupBy("node").agg(F.min("best").alias("best")), "set-nodes")
    texts = marked.select(row, F.col("text").cast("string").alias("text"))
    maps = Stage(marked.groupBy(F.col(node).alias("node")).agg(
        *[F.min(name).alias(c) for name, c in zip(names[2:], ["n", *_MAP], strict=True)]), "parity-maps")

    def texts_of(wanted: DataFrame) -> DataFrame:
        """Texts of nodes."""
        found = wanted.join(sets.frame.select("node", F.col("best.row").alias(row)), "node")
        return at_rows(texts, found, row, "inner").select("node", "text")

    shared = buckets(marked.select(F.col(node).alias("node"), F.col("text").cast("string").alias("text")))
    release_shuffles(docs.sparkSession)
    candidates = Stage(possible(end_candidates(shared.frame), maps.frame), "end-candidates")
    prints = Stage(simhash_links(nodes.frame), "print-links")
    release_shuffles(docs.sparkSession)
    near = Stage(similar(candidates.frame, texts_of(_ends(candidates.frame))), "near-links")
    release_shuffles(docs.sparkSession)
    links = Stage(prints.frame.union(near.frame), "first-links")
    prints.drop()
    near.drop()
    first = components(links.frame)
    release_shuffles(docs.sparkSession)
    rest = rest_candidates(shared.frame, first, maps.frame)
    release_shuffles(docs.sparkSession)
    for old in (shared, candidates, links, maps):
        old.drop()
    more = Stage(first.toDF("u", "v").union(similar(rest, texts_of(_ends(rest)))), "all-links")
    release_shuffles(docs.sparkSession)
    roots = components(more.frame)
    best = Stage(sets.frame.join(roots, "node", "left").groupBy(
        F.coalesce("root", "node").alias("root")).agg(F.min("best").alias("best")).select(
        F.col("best.row").alias(row)), "kept-rows")
    gone = marked.select(row).join(best.frame, row, "left_anti")
    kept = at_rows(marked.select(row, *[F.col(f"`{c}`") for c in docs.columns]), gone, row, "left_anti")
    for old in (nodes, sets, more, best):
        old.drop()
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])

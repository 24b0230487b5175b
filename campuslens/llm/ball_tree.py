"""Exact top-k by inner product: a ball tree per shard, branch and bound.

Vectors are dealt into shards of bounded size by a hash; each shard becomes one row with its ball
tree. While a shard is built, the queries among its own rows are searched in it: their k-th score
there is a lower bound of the final one and travels with the query. The query set then goes over all
shards in blocks of bounded size; a task that searches several shards keeps the k-th scores it has
reached. A ball (centre c, radius r) is skipped for query q when q.c + |q| r is below that score.

Components are whole numbers held as floating point, which is exact for every size they can have;
scores are computed in floating point or 64-bit integers where that is exact, else in whole numbers
of any size; what 64 bits cannot hold ranks by a key of its own."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campuslens.llm.common import stage

TOP = 10
LEAF = 64
MAX_SHARD_ROWS = 1 << 16
#: Bytes of queries that go over the shards together.
BLOCK_BYTES = 8 << 20
_NONE = np.iinfo(np.int64).min
#: Below every score of components up to COMPONENT.
_NONE_WIDE = -10**700
COMPONENT = 1e300
LOWEST, HIGHEST = -2**63, 2**63 - 1

ROWS = T.StructType([
    T.StructField("row", T.LongType()), T.StructField("vec_id", T.LongType()),
    T.StructField("query", T.BooleanType()), T.StructField("dim", T.IntegerType()),
    T.StructField("vector", T.BinaryType())])
SHARDS = T.StructType([
    T.StructField("dim", T.IntegerType()), T.StructField("shard", T.LongType()),
    T.StructField("tree", T.BinaryType()), T.StructField("queries", T.BinaryType())])
FOUND = T.StructType([
    T.StructField("row", T.LongType()), T.StructField("query_id", T.LongType()),
    T.StructField("vec_id", T.LongType()),
    T.StructField("score", T.LongType()), T.StructField("beyond", T.BinaryType())])


def _pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpack(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data), allow_pickle=False) as f:
        return {k: f[k] for k in f.files}


def product_bound(a: np.ndarray, b: np.ndarray) -> float:
    """No inner product of a row of each, nor a partial sum of it, is larger."""
    with np.errstate(over="ignore"):
        return (float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0))
                * max(1, a.shape[1]))


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole-number inner products of all rows; in floating point or 64 bits where that is exact."""
    bound = product_bound(a, b)
    if bound < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 2**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    other = [[int(x) for x in row] for row in b.tolist()]
    out = np.empty((len(a), len(b)), object)
    for i, row in enumerate(a.tolist()):
        mine = [int(x) for x in row]
        out[i] = [sum(x * y for x, y in zip(mine, row, strict=True)) for row in other]
    return out


def at_most(scores: np.ndarray) -> np.ndarray:
    """Floating point numbers that are not above whole ones."""
    if scores.dtype == object:
        scores = np.array([max(-10**300, min(10**300, int(s))) for s in scores], np.float64)
    out = scores.astype(np.float64)
    return np.where(np.abs(out) < 2**53, out, np.nextafter(out, -np.inf))


def score_columns(scores: np.ndarray) -> list[pa.Array]:
    """64-bit scores, and for those that are at or beyond an end a key in order of the true ones."""
    if scores.dtype != object:
        return [pa.array(scores), pa.nulls(len(scores), pa.binary())]
    whole = [int(s) for s in scores]
    return [pa.array([max(LOWEST, min(HIGHEST, s)) for s in whole], pa.int64()),
            pa.array([None if LOWEST < s < HIGHEST else (s - _NONE_WIDE).to_bytes(320)
                      for s in whole], pa.binary())]


class BallTree:
    """Distinct vectors in tree order; every vector keeps the k + 1 smallest ids that have it (the
    query itself may be one of them), which is all that a top k can hold of it."""

    def __init__(self, data: dict[str, np.ndarray]):
        self.data = data

    @classmethod
    def build(cls, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int = TOP):
        order = np.lexsort((rows, ids))
        rows, ids, vectors = rows[order], ids[order], vectors[order]
        flat = np.ascontiguousarray(vectors)
        if flat.shape[1]:
            raw = flat.view(np.dtype((np.void, flat.dtype.itemsize * flat.shape[1]))).ravel()
            same = np.unique(raw, return_inverse=True)[1].ravel()
        else:
            same = np.zeros(len(flat), np.int64)
        by_vector = np.argsort(same, kind="stable")
        group = same[by_vector]
        place = np.arange(len(group)) - np.searchsorted(group, group)
        kept = by_vector[place <= k]
        rows, ids, vectors = rows[kept], ids[kept], vectors[kept]
        order, nodes, balls = np.arange(len(rows)), [], []

        def grow(a: int, b: int) -> int:
            part = vectors[order[a:b]].astype(np.float64)
            centre = part.mean(0)
            with np.errstate(over="ignore"):
                radius = float(np.sqrt(((part - centre) ** 2).sum(1).max(initial=0)))
            me = len(nodes)
            nodes.append([a, b, -1, -1])
            balls.append((centre, radius))
            if b - a > LEAF and radius > 0:
                axis = int(np.ptp(part, axis=0).argmax())
                middle = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(part[:, axis], middle)]
                nodes[me][2] = grow(a, a + middle)
                nodes[me][3] = grow(a + middle, b)
            return me

        grow(0, len(rows))
        return cls({"rows": rows[order], "ids": ids[order], "vectors": vectors[order],
                    "nodes": np.array(nodes, np.int64),
                    "centres": np.array([c for c, _ in balls]).reshape(len(nodes), -1),
                    "radii": np.array([r for _, r in balls])})

    def search(self, rows: np.ndarray, vectors: np.ndarray, floor: np.ndarray, k: int = TOP
               ) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids), each queries x k, ordered by falling score and rising id; unused places
        have ``none`` of the scores as score. ``floor`` is raised to the k-th score reached."""
        d, n = self.data, len(rows)
        big = product_bound(vectors, d["vectors"]) >= 2**62
        none = _NONE_WIDE if big else _NONE
        scores = np.full((n, k), none, object if big else np.int64)
        ids = np.full((n, k), np.iinfo(np.int64).max)
        wide = vectors.astype(np.float64)
        with np.errstate(over="ignore"):
            norms = np.sqrt((wide ** 2).sum(1))

        def bound(node: int, active: np.ndarray) -> np.ndarray:
            with np.errstate(over="ignore", invalid="ignore"):
                at = wide[active] @ d["centres"][node] + norms[active] * d["radii"][node]
                return at + 1e-9 * (np.abs(at) + norms[active] * (1 + d["radii"][node])) + 1e-6

        def visit(node: int, active: np.ndarray) -> None:
            active = active[~(bound(node, active) < floor[active])]  # keeps what is no number
            if not len(active):
                return
            a, b, left, right = d["nodes"][node]
            if left >= 0:
                ahead = sorted((left, right), key=lambda c: -bound(c, active).sum())
                for child in ahead:
                    visit(child, active)
                return
            for at in range(a, b, 4 * LEAF):  # a ball of equal vectors is one long leaf
                leaf = slice(at, min(b, at + 4 * LEAF))
                got = dots(vectors[active], d["vectors"][leaf])
                got = got.astype(scores.dtype, copy=False)
                got[rows[active][:, None] == d["rows"][leaf][None, :]] = none
                all_scores = np.concatenate([scores[active], got], axis=1)
                all_ids = np.concatenate(
                    [ids[active], np.broadcast_to(d["ids"][leaf], got.shape)], axis=1)
                if big:
                    order = np.array([sorted(range(len(s)), key=lambda j: (-s[j], i[j]))[:k]
                                      for s, i in zip(all_scores, all_ids, strict=True)])
                else:
                    order = np.lexsort((all_ids, ~all_scores), axis=-1)[:, :k]
                scores[active] = np.take_along_axis(all_scores, order, 1)
                ids[active] = np.take_along_axis(all_ids, order, 1)
                floor[active] = np.maximum(floor[active], at_most(scores[active][:, -1]))

        visit(0, np.arange(n))
        return scores, ids


def _quantise(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {name: [] for name in ROWS.names}
            rows = zip(*(batch.column(i).to_pylist() for i in (0, 1, 2)), batch.column(3), strict=True)
            for row, vec_id, query, vector in rows:
                values = vector.values
                if values.null_count:
                    continue
                x = values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(x).all():
                    with np.errstate(over="ignore"):
                        x = np.floor(scale * x).clip(-COMPONENT, COMPONENT) + 0.0
                    for name, value in zip(ROWS.names, (row, vec_id, query, len(x),
                                                        x.astype("<f8").tobytes()), strict=True):
                        out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("row", pa.int64()), ("vec_id", pa.int64()), ("query", pa.bool_()),
                ("dim", pa.int32()), ("vector", pa.binary())]))
    return run


def _shard(k: int):
    def run(key, group):
        dim = key[0].as_py()
        rows, ids = (group.column(c).to_numpy() for c in ("row", "vec_id"))
        vectors = np.frombuffer(b"".join(group.column("vector").to_pylist()), "<f8")
        vectors = vectors.reshape(len(rows), dim)
        tree = BallTree.build(rows, ids, vectors, k)
        asked = np.flatnonzero(group.column("query").to_numpy(zero_copy_only=False))
        floor = np.full(len(asked), -np.inf)
        if len(asked):
            tree.search(rows[asked], vectors[asked], floor, k)
        queries = _pack(rows=rows[asked], ids=ids[asked], vectors=vectors[asked], floor=floor)
        return pa.table({"dim": pa.array([dim], pa.int32()),
                         "shard": pa.array([key[1].as_py()], pa.int64()),
                         "tree": [_pack(**tree.data)],
                         "queries": pa.array([queries if len(asked) else None], pa.binary())})
    return run


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, asked = None, {}
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                if block != (place := (row.column(0)[0].as_py(), row.column(1)[0].as_py())):
                    parts = [_unpack(q) for q in row.column(3)[0].as_py()]
                    block = place
                    asked = {n: np.concatenate([p[n] for p in parts]) for n in parts[0]}
                tree = BallTree(_unpack(row.column(2)[0].as_py()))
                scores, ids = tree.search(asked["rows"], asked["vectors"], asked["floor"], k)
                none = _NONE_WIDE if scores.dtype == object else _NONE
                q, j = np.nonzero(((scores > none) & (scores >= asked["floor"][:, None]))
                                  .astype(bool))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(asked["rows"][q]), pa.array(asked["ids"][q]), pa.array(ids[q, j]),
                     *score_columns(scores[q, j])], FOUND.names)
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = TOP, scale: int = 1024,
          id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row that ``is_query`` selects, the k rows of highest
    integer inner product of floor(scale * component), ties to the smaller id, the query's own row
    left out.

    Rows without an id, and vectors that are null or hold a null or non-finite component, take no
    part. Vectors of different lengths are never compared. Rows that share an id are rows of their
    own, as queries and as candidates. ``score`` is 64-bit; one that does not fit is the nearest that
    does and ranks by its true value (components end at 1e300). Other columns are ignored. An empty table or query set gives an empty result."""
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"),
        F.coalesce(is_query, F.lit(False)).alias("query"),
        F.col(vector_col).cast("array<double>").alias("vector"))
    rows = stage(rows.mapInArrow(_quantise(scale), ROWS), "vectors")
    n = rows.count()
    shards = -(-n // int(min(MAX_SHARD_ROWS, max(256, 5 * n ** 0.5)))) or 1
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    dealt = stage(dealt.groupBy("dim", "shard").applyInArrow(_shard(k), SHARDS), "shards")
    sizes = dealt.where("queries IS NOT NULL").select("dim", "shard", F.length("queries").alias("b"))
    so_far = Window.orderBy("dim", "shard").rowsBetween(Window.unboundedPreceding, 0)
    blocks = stage(sizes.select("dim", "shard", F.floor(
        F.sum("b").over(so_far) / BLOCK_BYTES).alias("block")), "query-blocks")
    last = blocks.agg(F.max("block")).first()[0]
    found = None
    for block in range(-1 if last is None else last + 1):
        asked = dealt.join(F.broadcast(blocks.where(F.col("block") == block)), ["dim", "shard"])
        asked = asked.groupBy("dim").agg(F.collect_list("queries").alias("asked"))
        # at most BLOCK_BYTES and one shard's queries
        part = dealt.join(F.broadcast(asked), "dim").select(
            F.lit(block).cast("long").alias("block"), "dim", "tree", "asked"
        ).mapInArrow(_search(k), FOUND)
        found = part if found is None else found.union(part)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], FOUND)
    best = Window.partitionBy("row").orderBy(F.desc("score"), F.desc("beyond"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")

"""Connected components of an edge table by alternating star operations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campuslens.llm.common import Stage

_EDGES = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of one Arrow batch replaced by a star forest with the same components."""
    for batch in batches:
        u, v = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        nodes, index = np.unique(np.concatenate([u, v]), return_inverse=True)
        parent = list(range(len(nodes)))

        def find(x, parent=parent):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for a, b in zip(index[:len(u)].tolist(), index[len(u):].tolist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        root = np.fromiter((find(x) for x in range(len(nodes))), np.int64, len(nodes))
        tail = np.flatnonzero(root != np.arange(len(nodes)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[tail]), pa.array(nodes[root[tail]])],
                                         ["u", "v"])


def _neighbours(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(edges: DataFrame, large: bool, label: str) -> Stage:
    """Large star: larger neighbours of a node move to the smallest one around it. Small star:
    smaller neighbours and the node itself do. The minima are a table of their own, so the join
    can be split where one node has very many neighbours."""
    around = _neighbours(edges) if large else edges.where("u > v")
    least = Stage(around.groupBy("u").agg(F.min("v").alias("m")), f"{label}-min")
    joined = around.join(least.frame, "u")
    if large:
        joined = joined.where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    else:
        joined = joined.select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
    out = Stage(joined.where("u != v").distinct(), label)
    least.drop()
    return out


def _sign(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v) that is not itself the smallest of its
    component; root is the smallest. Each round is a written table, so a lost executor costs one
    round; superseded rounds are removed. The rounds grow with the logarithm of the largest
    component, not with the length of a chain."""
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = Stage(edges.where("u != v").mapInArrow(_forest, _EDGES).distinct(), "links")
    before = _sign(now.frame)
    while before[0]:
        large = _star(now.frame, True, "large-star")
        small = _star(large.frame, False, "small-star")
        now.drop()
        large.drop()
        now, after = small, _sign(small.frame)
        if after == before:
            break
        before = after
    return now.frame.select(F.col("u").alias("node"), F.col("v").alias("root"))

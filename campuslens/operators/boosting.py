"""Boosted trees for a 0/1 label with second-order leaves and an L2 term.

Each level of a tree is one pass: tasks fold their rows to sums of gradients and second derivatives per
(node, column, bin), Spark adds them up, and the driver gets those sums alone, at most
2 ** (depth - 1) times the number of bins of all columns. Rows are sparse: values of zero are not
stored, their sums are what the stored values leave of the node's total.

A fit binds rows in blocks once, as packed arrays of their bins (two bytes an entry), so that a pass
adds up arrays and looks at no row by itself. The scores of the trees so far are written into the
blocks every ``STAGE`` trees."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campuslens.session import materialise

BINS = 255
STAGE = 10
#: Rows of a block at most: their places have 16 bits.
BLOCK_ROWS = 1 << 16
#: Bytes of the tasks' sums that the driver adds up itself; of more, Spark does.
SUMS_BYTES = 8 << 20
LEAF_ROWS = 20
LEAF_WEIGHT = 1e-3
#: Gains that differ by less are ties; the first column and the lowest cut win.
GAIN_DIGITS = 9


def stored(features: str) -> tuple[Column, Column]:
    """Places and values of a vector's stored entries."""
    v = F.unwrap_udt(features)
    every = F.transform(v["values"], lambda x, i: i)
    return F.coalesce(v["indices"], every), v["values"]


class Entries:
    """Stored entries of a batch of rows, ordered by column."""

    def __init__(self, places: pd.Series, values: pd.Series):
        sizes = [len(p) for p in places]
        self.rows = len(sizes)
        place = np.concatenate([np.asarray(p, "int64") for p in places]) if self.rows else np.zeros(0, "int64")
        value = np.concatenate([np.asarray(v) for v in values]) if self.rows else np.zeros(0)
        order = np.argsort(place, kind="stable")
        self.place, self.value = place[order], value[order]
        self.row = np.repeat(np.arange(self.rows), sizes)[order]

    def of(self, column: int) -> slice:
        return slice(*np.searchsorted(self.place, [column, column + 1]))

    def below(self, node: "Node") -> np.ndarray:
        """Rows with ``value <= cut``."""
        out = np.full(self.rows, 0.0 <= node.cut)
        span = self.of(node.column)
        out[self.row[span]] = self.value[span] <= node.cut
        return out


@dataclass
class Bins:
    """Ascending cuts per column; a value lies in the bin of the first cut that is not below it."""
    cuts: dict[int, np.ndarray]
    columns: np.ndarray = field(init=False)
    starts: np.ndarray = field(init=False)
    zeros: np.ndarray = field(init=False)

    def __post_init__(self):
        self.columns = np.array(sorted(self.cuts), "int64")
        sizes = [len(self.cuts[c]) + 1 for c in self.columns]
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype("int64")
        self.zeros = np.array([np.searchsorted(self.cuts[c], 0.0) for c in self.columns], "int64")

    def cells(self, entries: Entries) -> tuple[np.ndarray, np.ndarray]:
        """Rows and cells (place among the bins of all columns) of the entries with cuts."""
        rows, cells = [np.zeros(0, "int64")], [np.zeros(0, "int64")]
        for c in np.unique(entries.place):
            at = np.searchsorted(self.columns, c)
            if at < len(self.columns) and self.columns[at] == c:
                span = entries.of(c)
                rows.append(entries.row[span])
                cells.append(self.starts[at] + np.searchsorted(self.cuts[c], entries.value[span]))
        return np.concatenate(rows), np.concatenate(cells)

    def cell_of(self, node: "Node") -> tuple[int, int, int]:
        """The place of a test's column among ``columns``, and the cells from its first to the cut's."""
        at = int(np.searchsorted(self.columns, node.column))
        first = int(self.starts[at])
        return at, first, first + int(np.searchsorted(self.cuts[node.column], node.cut))


class Block:
    """Bins of a block of rows: the rows of each cell that has any; rows in the bin of zero hold no entry."""

    def __init__(self, row: dict, bins: Bins):
        self.bins = bins
        self.row = np.frombuffer(row["_row"], "<u2")
        self.cells, self.counts = np.frombuffer(row["_cell"], "<i4").reshape(2, -1)
        self.ends = np.concatenate([[0], np.cumsum(self.counts)])
        self.label, self.score = (np.frombuffer(row[c], "<f8") for c in ("_y", "_s"))
        self.rows = len(self.label)
        self.known: dict[tuple[int, float], np.ndarray] = {}

    def below(self, node: "Node") -> np.ndarray:
        """Rows with ``value <= cut``; the trees of a stage share many tests."""
        test = (node.column, node.cut)
        if test not in self.known:
            self.known[test] = self._below(node)
        return self.known[test]

    def _below(self, node: "Node") -> np.ndarray:
        at, first, cut = self.bins.cell_of(node)
        zero = first + int(self.bins.zeros[at])
        out = np.full(self.rows, zero <= cut)
        begin, middle, end = self.ends[np.searchsorted(self.cells, [first, cut + 1, self.bins.starts[at + 1]])]
        out[self.row[begin:middle]] = True
        out[self.row[middle:end]] = False
        return out


BLOCKS = "_row binary, _cell binary, _y binary, _s binary"


def block_rows(rows: DataFrame, bins: Bins, start: float) -> DataFrame:
    """Blocks of the rows (``_k``, ``_x``, ``_y``), one per Arrow batch (more of a very long one)."""
    zero = np.zeros(int(bins.starts[-1]), bool)
    zero[bins.starts[:-1] + bins.zeros] = True

    def run(batches):
        for b in (x.iloc[i:i + BLOCK_ROWS] for x in batches for i in range(0, len(x), BLOCK_ROWS)):
            row, cell = bins.cells(Entries(b["_k"], b["_x"]))
            keep = ~zero[cell]
            row, cell = row[keep], cell[keep]
            order = np.argsort(cell, kind="stable")
            yield pd.DataFrame({
                "_row": [row[order].astype("<u2").tobytes()],
                "_cell": [np.stack(np.unique(cell, return_counts=True)).astype("<i4").tobytes()],
                "_y": [b["_y"].to_numpy("<f8").tobytes()], "_s": [np.full(len(b), start, "<f8").tobytes()]})
    return rows.mapInPandas(run, BLOCKS)


def _blocks(batch: pa.RecordBatch, bins: Bins) -> Iterator[Block]:
    """Blocks of an Arrow batch, on its own memory."""
    for values in zip(*batch.columns, strict=True):
        yield Block({n: v.as_buffer() for n, v in zip(batch.schema.names, values, strict=True)}, bins)


@dataclass
class Node:
    """A leaf (``column`` -1) or a test ``value <= cut`` with two children, by place in the tree."""
    g: float
    h: float
    n: int
    column: int = -1
    cut: float = 0.0
    left: int = -1
    right: int = -1


def places(tree: list[Node], entries: Entries | Block) -> np.ndarray:
    """The leaf of every row; parents come before their children."""
    kind = np.min_scalar_type(len(tree)).type
    at = np.zeros(entries.rows, kind)
    for i, node in enumerate(tree):
        if node.column >= 0:
            np.copyto(at, np.where(entries.below(node), kind(node.left), kind(node.right)), where=at == i)
    return at


def best_split(node: Node, g, h, n, bins: Bins, penalty: float):
    """(column, cut, left sums) of the largest gain, None where no split gains; ``g``, ``h``, ``n``:
    sums per cell without the rows that hold no value in a column."""
    if not len(bins.columns) or node.n < 2 * LEAF_ROWS:
        return None
    begin = bins.starts[:-1]
    sums = []
    for per_cell, total in ((g, node.g), (h, node.h), (n, node.n)):
        full = per_cell.astype("float64")
        full[begin + bins.zeros] += total - np.add.reduceat(full, begin)
        running = np.cumsum(full)
        sums.append(running - np.repeat(running[begin] - full[begin], np.diff(bins.starts)))
    gl, hl, nl = sums
    gr, hr, nr = node.g - gl, node.h - hl, node.n - nl
    allowed = (np.rint(nl) >= LEAF_ROWS) & (np.rint(nr) >= LEAF_ROWS) & (hl >= LEAF_WEIGHT) & (hr >= LEAF_WEIGHT)
    allowed[bins.starts[1:] - 1] = False  # all rows to the left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = gl ** 2 / (hl + penalty) + gr ** 2 / (hr + penalty) - node.g ** 2 / (node.h + penalty)
    gain = np.round(np.where(allowed, gain, 0.0), GAIN_DIGITS)
    best = int(gain.argmax())
    if gain[best] <= 0:
        return None
    at = int(np.searchsorted(bins.starts, best, "right")) - 1
    column = int(bins.columns[at])
    return (column, float(bins.cuts[column][best - bins.starts[at]]), gl[best], hl[best],
            int(np.rint(nl[best])))


def find_cuts(rows: DataFrame, total: int, bins: int = BINS) -> Bins:
    """Cuts from all rows: half way between neighbours where a column has at most ``bins`` values, else
    at its quantiles."""
    cells = rows.select(F.explode(F.arrays_zip("_k", "_x")).alias("e")).select("e._k", "e._x")
    values = materialise(cells.groupBy("_k", "_x").agg(F.count(F.lit(1)).alias("_n")), "valores")
    sizes = values.groupBy("_k").agg(F.count(F.lit(1)).alias("_d"), F.sum("_n").alias("_rows"))
    sizes = materialise(sizes, "columnas")
    few = values.join(sizes.where(F.col("_d") <= bins), "_k").groupBy("_k").agg(
        F.collect_set("_x").alias("v"), F.first("_rows").alias("_rows"), F.lit(True).alias("few"))
    shares = [i / bins for i in range(1, bins)]
    wide = sizes.where(F.col("_d") > bins)
    many = cells.join(wide, "_k").groupBy("_k").agg(
        F.percentile_approx("_x", shares, 10_000).alias("v"),
        F.first("_rows").alias("_rows"), F.lit(False).alias("few"))
    cuts = {}
    for r in few.unionByName(many).collect():  # at most ``bins`` numbers a column: a part of the model
        found = set(r["v"]) | ({0.0} if r["_rows"] < total else set())
        v = np.array(sorted(found))
        at = (v[:-1] + v[1:]) / 2 if r["few"] else v
        if len(at):
            cuts[r["_k"]] = at
    return Bins(cuts)


@dataclass
class Shrinkage:
    """Leaf values: -rate * sum(g) / (sum(h) + penalty)."""
    rate: float
    penalty: float

    def leaves(self, tree: list[Node]) -> np.ndarray:
        return np.array([-self.rate * t.g / (t.h + self.penalty) for t in tree])

    def add(self, score: np.ndarray, entries: Entries | Block, trees: list[list[Node]]) -> np.ndarray:
        for tree in trees:
            score = score + self.leaves(tree)[places(tree, entries)]
        return score


class Boosted:
    """Trees with their start score; ``transform`` adds the column ``probability``."""

    def __init__(self, start: float, shrink: Shrinkage):
        self.start, self.shrink, self.trees = start, shrink, []

    def transform(self, df: DataFrame) -> DataFrame:
        start, shrink, trees = self.start, self.shrink, self.trees

        @F.pandas_udf("double")
        def probability(k: pd.Series, x: pd.Series) -> pd.Series:
            entries = Entries(k, x)
            return pd.Series(1 / (1 + np.exp(-shrink.add(np.full(entries.rows, start), entries, trees))))
        p = probability(*stored("features"))
        return df.withColumn("_p", p).withColumn(
            "probability", array_to_vector(F.array(1 - F.col("_p"), F.col("_p")))).drop("_p")


class Tests:
    """The tests of all trees, each once. Rows are known by the outcomes, a bit a test, whatever the width
    of their vectors; scores equal those of ``Boosted.transform``."""

    def __init__(self, model: Boosted):
        self.model = model
        self.nodes = list({(n.column, n.cut): n for t in model.trees for n in t if n.column >= 0}.values())
        place = {(n.column, n.cut): k for k, n in enumerate(self.nodes)}
        self.trees = [([(i, place[n.column, n.cut], n) for i, n in enumerate(t) if n.column >= 0],
                       model.shrink.leaves(t)) for t in model.trees]

    def outcomes(self, features: str) -> Column:
        """Packed outcomes of a vector's tests."""
        nodes = self.nodes

        @F.pandas_udf("binary")
        def packed(k: pd.Series, x: pd.Series) -> pd.Series:
            entries = Entries(k, x)
            below = np.array([entries.below(n) for n in nodes] or np.zeros((0, entries.rows)), bool)
            return pd.Series([r.tobytes() for r in np.packbits(below, axis=0).T.copy()])
        return packed(*stored(features))

    def unpacked(self, packed: pa.Array) -> np.ndarray:
        """Outcomes by test and row."""
        rows = np.frombuffer(b"".join(packed.to_pylist()), np.uint8).reshape(len(packed), -1)
        return np.unpackbits(rows.T, axis=0, count=len(self.nodes)).astype(bool)

    def values(self, tree: int, below: np.ndarray) -> np.ndarray:
        """What a tree adds to the score of each row."""
        splits, leaves = self.trees[tree]
        at = np.zeros(below.shape[1], "int64")
        for i, test, node in splits:
            np.copyto(at, np.where(below[test], node.left, node.right), where=at == i)
        return leaves[at]

    def probability(self, parts: list[np.ndarray], rows: int) -> np.ndarray:
        score = np.full(rows, self.model.start)
        for part in parts:
            score += part
        return 1 / (1 + np.exp(-score))

    def copies(self, own: np.ndarray, other: np.ndarray, columns: list[set[int]]) -> Iterator[np.ndarray]:
        """Probabilities of the rows, then of copies of them that have the tests of some vector columns from
        ``other``; trees without a test of these columns are as for the rows."""
        base = [self.values(t, own) for t in range(len(self.trees))]
        yield self.probability(base, own.shape[1])
        for named in columns:
            mixed, parts = own.copy(), list(base)
            taken = [k for k, n in enumerate(self.nodes) if n.column in named]
            mixed[taken] = other[taken]
            for t, (splits, _) in enumerate(self.trees):
                if any(node.column in named for _, _, node in splits):
                    parts[t] = self.values(t, mixed)
            yield self.probability(parts, own.shape[1])


class SecondOrderBoosting:
    """Grows ``trees`` trees of ``depth`` levels."""

    def __init__(self, label: str, rate: float = 0.05, trees: int = 200, depth: int = 3, penalty: float = 1.0):
        self.label, self.trees, self.depth, self.shrink = label, trees, depth, Shrinkage(rate, penalty)

    def fit(self, data: DataFrame) -> Boosted:
        k, x = stored("features")
        rows = materialise(data.select(k.alias("_k"), x.alias("_x"),
                                       F.col(self.label).cast("double").alias("_y")), "arboles")
        total, share = rows.agg(F.count(F.lit(1)), F.avg("_y")).first()
        if not total or share in (0.0, 1.0):
            raise ValueError("boosting needs rows of both labels")
        bins = find_cuts(rows, total)
        model = Boosted(float(np.log(share / (1 - share))), self.shrink)
        blocks, written = self._scored(block_rows(rows, bins, model.start), [], bins), 0
        tasks = blocks.rdd.getNumPartitions()
        for _ in range(self.trees):
            if len(model.trees) - written == STAGE:
                blocks, written = self._scored(blocks, model.trees[written:], bins), len(model.trees)
                tasks = blocks.rdd.getNumPartitions()
            model.trees.append(self._grow(blocks, tasks, model.trees[written:], bins))
        return model

    def _scored(self, blocks: DataFrame, trees: list[list[Node]], bins: Bins) -> DataFrame:
        shrink = self.shrink

        def run(batches):
            for batch in batches:
                scores = [shrink.add(k.score, k, trees).tobytes() for k in _blocks(batch, bins)]
                yield batch.set_column(3, batch.schema.field(3), pa.array(scores, batch.schema.field(3).type))
        return materialise(blocks.mapInArrow(run, BLOCKS) if trees else blocks, "puntajes")

    def _grow(self, blocks: DataFrame, tasks: int, newer: list[list[Node]], bins: Bins) -> list[Node]:
        tree = [Node(0.0, 0.0, 0)]
        level = [0]
        for _ in range(self.depth):
            sums = self._sums(blocks, tasks, newer, tree, level, bins)
            following = []
            for i, node in enumerate(level):
                if node == 0:
                    g, h, n = sums[:, i, 0]
                    tree[0] = Node(float(g), float(h), int(n))
                split = best_split(tree[node], *sums[:, i, 1:], bins, self.shrink.penalty)
                if split is not None:
                    t = tree[node]
                    t.column, t.cut, g, h, n = split
                    t.left, t.right = len(tree), len(tree) + 1
                    tree += [Node(g, h, n), Node(t.g - g, t.h - h, t.n - n)]
                    following += [t.left, t.right]
            level = following
            if not level:
                break
        return tree

    def _sums(self, blocks: DataFrame, tasks: int, newer: list[list[Node]], tree: list[Node], level: list[int],
              bins: Bins) -> np.ndarray:
        """Sums of g, h and n per (place in ``level``, cell + 1) over all rows; at 0 is the node's total. A
        task's sums travel as one packed row while all of them are few bytes, else as rows that Spark adds up."""
        wide, nodes = int(bins.starts[-1]) + 1, len(level)
        slot = np.full(len(tree), nodes)  # rows of closed leaves fall into a place of their own
        slot[level] = np.arange(nodes)
        shrink = self.shrink

        def fold(batches):
            held = np.zeros((3, (nodes + 1) * wide))
            for block in (k for batch in batches for k in _blocks(batch, bins)):
                p = 1 / (1 + np.exp(-shrink.add(block.score, block, newer)))
                base = slot[places(tree, block)] * wide
                row = block.row.astype("int64")
                keys = base[row]
                keys += np.repeat(block.cells.astype("int64") + 1, block.counts)
                for side, w in zip(held, (p - block.label, p * (1 - p))):
                    side += np.bincount(base, w, len(side))
                    side += np.bincount(keys, w[row], len(side))
                held[2] += np.bincount(base, minlength=held.shape[1])
                held[2] += np.bincount(keys, minlength=held.shape[1])
            return held[:, :nodes * wide]

        def whole(batches):
            yield pa.RecordBatch.from_arrays([pa.array([fold(batches).tobytes()], pa.binary())], ["sums"])

        def each(batches):
            held = fold(batches)
            found = np.flatnonzero(held[2])
            yield pa.RecordBatch.from_arrays([pa.array(found), *(pa.array(side[found]) for side in held)],
                                             ["at", *"ghn"])

        made = np.zeros((3, nodes * wide))
        if tasks * made.nbytes <= SUMS_BYTES:
            for r in blocks.mapInArrow(whole, "sums binary").collect():
                made += np.frombuffer(r["sums"]).reshape(made.shape)
        else:
            partial = blocks.mapInArrow(each, "at bigint, g double, h double, n double")
            for r in partial.groupBy("at").agg(*[F.sum(c).alias(c) for c in "ghn"]).toLocalIterator():
                made[:, r["at"]] = r["g"], r["h"], r["n"]
        return made.reshape(3, nodes, wide)

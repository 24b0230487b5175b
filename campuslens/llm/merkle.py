"""Merkle manifest of a table: hash trees per source under one root, and proofs by recursive SQL.

Leaves of a source are numbered by a range sort, never by a window over the source. Levels are built
sixteen to one, so a source with a third of all rows is as wide as any other group of sixteen. Every
node is a row that names its parent; a recursive query climbs from the leaves, joins the parent's row
in each step, appends the siblings to the proof and folds the leaf under test into the parent's hash.

Leaves climb in blocks of two levels, 256 leaves to a row: they share all siblings above the block, so
each leaf keeps its own folded hash and the block keeps one proof. Siblings inside a block stand in its row,
and the table that the climb joins has a row for 3840 leaves."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campuslens.llm.common import Stage, stage

FAN_OUT = 16
RUN_BITS = 4
#: Levels that are looked at for the height of a tree: 16**15 leaves are more than any table has.
MAX_HEIGHT = 15
#: Tree number of the tree over the subroots.
TOP = -1
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(row: dict[str, Column]) -> Column:
    return digest(F.concat(*[encoded(row[f]) for f in FIELDS]))


def numbered(df: DataFrame, order: list, name: str, label: str) -> Stage:
    """``df`` as a stage table with ``name`` = 0, 1, ... in ``order``: rows are dealt out by range and
    sorted, and each range adds the rows of the ranges before it. The order must have no ties
    that matter. One row per range meets in the window."""
    at = F.monotonically_increasing_id()  # range number << 33 | row of the range
    ranged = Stage(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at),
                   f"{label}-ranges")
    part = F.shiftright("_at", 33).alias("_part")
    sizes = ranged.frame.groupBy(part).agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    out = Stage(ranged.frame.withColumn("_part", part).join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).alias(name)), label)
    ranged.drop()
    return out


def height(leaves: Column) -> Column:
    """Levels above the leaves of a tree: 0 for one leaf."""
    return sum((F.when(leaves > F.lit(FAN_OUT ** k), 1).otherwise(0) for k in range(MAX_HEIGHT)), F.lit(0))


#: Levels that a row of the climb starts with.
BLOCK_LEVELS = 2


def build_levels(leaves: DataFrame, carried: int = 0) -> list[DataFrame]:
    """Stage tables of the levels above ``leaves`` (tree, i, hash, height): rows (tree, i, hash, height,
    kids), lowest level first. ``kids`` are the hashes of a run in order. The first ``carried`` levels have
    a column ``row`` as well, the ``row`` values of their run in order."""
    levels, below = [], leaves
    top = leaves.agg(F.max("height")).first()[0] or 0
    for lv in range(1, top + 1):
        keep = ["row"] if lv <= carried else []
        run = F.array_sort(F.collect_list(F.struct("i", "hash", *keep)))
        runs = below.where(F.col("height") >= lv).groupBy(
            "tree", F.shiftright("i", RUN_BITS).alias("i")).agg(run.alias("run"), F.first("height").alias("height"))
        made = runs.select("tree", "i", "height", F.col("run.hash").alias("kids"),
                           *[F.col(f"run.{c}").alias(c) for c in keep])
        below = stage(made.withColumn("hash", digest(F.array_join("kids", ""))).withColumns(
            {c: F.struct("hash", F.col(c).alias("leaves")) for c in keep if lv == 1}), f"merkle-level-{lv}")
        levels.append(below)
    return levels


def _linked(df: DataFrame, lv: int, many_trees: bool) -> DataFrame:
    """Adds the link to the parent: (up_tree, up_lv, up_i) and the place in the parent's run; null at
    the root. Subroots hang under the tree over the subroots, where they stand at their tree's number."""
    below_root = F.col("height") > lv
    below_top = (F.col("tree") != TOP) & F.lit(many_trees)

    def link(inside: Column, above: Column) -> Column:
        return F.when(below_root, inside).when(below_top, above).cast("long")

    return df.withColumns({
        "up_tree": link(F.col("tree"), F.lit(TOP)), "up_lv": link(F.lit(lv + 1), F.lit(1)),
        "up_i": link(F.shiftright("i", RUN_BITS), F.shiftright("tree", RUN_BITS)),
        "place": link(F.col("i").bitwiseAND(FAN_OUT - 1), F.col("tree").bitwiseAND(FAN_OUT - 1))})


_LINK = ["up_tree", "up_lv", "up_i", "place"]


def _siblings(kids: str, place: str) -> list[str]:
    """SQL of the hashes before and after a place (from 0) of a run, as text."""
    return [f"array_join(slice({kids}, 1, int({place})), '')",
            f"array_join(slice({kids}, int({place}) + 2, {FAN_OUT}), '')"]


def _folded(kids: str, place: str, own: str) -> str:
    """SQL of a run's hash with another hash in one place."""
    before, after = _siblings(kids, place)
    return f"sha2(concat({before}, {own}, {after}), 256)"


def _refold(runs: str, kids: str, place: str) -> str:
    """SQL of ``runs`` with every leaf's folded hash put in a place of the next run up and hashed; ``u``, ``j``,
    ``r`` and ``k`` are a run, its place, a leaf and its place."""
    return (f"transform({runs}, (u, j) -> named_struct('hash', u.hash, 'leaves', transform(u.leaves, (r, k) -> "
            f"named_struct('doc_id', r.doc_id, 'leaf', r.leaf, 'folded', {_folded(kids, place, 'r.folded')}))))")


#: The climb. A row is a block of leaves that has reached a node whose parent is (up_tree, up_lv, up_i);
#: each step joins that parent. LIMIT ALL lifts Spark's bound on the rows of a recursion.
CLIMB = f"""
WITH RECURSIVE climb(up_tree, up_lv, up_i, place, runs, proof, subroot) AS (
  SELECT up_tree, up_lv, up_i, place, runs, '' AS proof, CAST(NULL AS STRING) AS subroot FROM {{seeds}}
  UNION ALL
  SELECT n.up_tree, n.up_lv, n.up_i, n.place, {_refold('c.runs', 'n.kids', 'c.place')},
         concat(c.proof, {', '.join(_siblings('n.kids', 'c.place'))}),
         coalesce(c.subroot, CASE WHEN n.tree = {TOP} THEN n.kids[int(c.place)] END)
  FROM climb c JOIN {{nodes}} n ON n.tree = c.up_tree AND n.lv = c.up_lv AND n.i = c.up_i)
SELECT runs, proof, subroot FROM climb WHERE up_tree IS NULL LIMIT ALL
"""


def _seeds(leaves: DataFrame, levels: list[DataFrame], many_trees: bool) -> DataFrame:
    """Where the climb starts: blocks of leaves folded up to the block's own node."""
    one = F.expr("named_struct('hash', hash, 'leaves', array(row))")
    made = _linked(leaves.where("height = 0"), 0, many_trees).select(*_LINK, F.array(one).alias("runs"))
    for lv, level in enumerate(levels[:BLOCK_LEVELS], 1):
        runs = level if lv == BLOCK_LEVELS else level.where(F.col("height") == lv)
        runs = _linked(runs, lv, many_trees).withColumn("runs", F.array("row") if lv == 1 else F.col("row"))
        runs = runs.withColumn("runs", F.expr(_refold("runs", "u.leaves.leaf", "k")))
        if lv > 1:
            runs = runs.withColumn("runs", F.expr(_refold("runs", "kids", "j")))
        made = made.union(runs.select(*_LINK, "runs"))
    return made


def _nodes(levels: list[DataFrame], over: list[DataFrame], many_trees: bool) -> DataFrame | None:
    """Parent-linked rows of all nodes that the climb can reach: those above the blocks."""
    made = [_linked(t, lv, many_trees).select("tree", F.lit(lv).alias("lv"), "i", "kids", *_LINK)
            for lv, t in [*enumerate(levels[BLOCK_LEVELS:], BLOCK_LEVELS + 1), *enumerate(over, 1)]]
    return reduce(DataFrame.union, made) if made else None


def tampered_fifth(row: dict[str, Column]) -> Column:
    """Rows under test: 5 divides the unsigned crc32 of the decimal doc_id."""
    return F.coalesce(F.crc32(row["doc_id"].cast("string").cast("binary")) % 5 == 0, F.lit(False))


def manifest(docs: DataFrame, tampered: Callable = tampered_fifth) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, lang, n_chars, text): ``doc_id, leaf, subroot, root,
    proof_sha256, folded_root, verified``.

    ``tampered`` names the rows whose text is lower-cased (A to Z) before the proof is folded. A null
    field hashes as ``-`` and a null text stays null; null sources are one source, the first; a null
    doc_id comes first in its source and is not tampered with; rows of one doc_id come in the order of
    their hashes, and repeated rows have a leaf each. A lone leaf is its subroot, a lone subroot the
    root; a proof without siblings hashes the empty text. A text is hashed whole by one task, whatever
    its length. Other columns are ignored, whatever their names; an empty table gives an empty result."""
    row = {f: F.col(f"`{f}`") for f in FIELDS}
    lower = row | {"text": F.translate(row["text"].cast("string"), UPPER, LOWER)}
    hashed = Stage(docs.select(
        row["doc_id"].alias("doc_id"), row["source"].cast("string").alias("source"),
        leaf_hash(row).alias("leaf"), F.when(tampered(row), leaf_hash(lower)).alias("other"),
        F.monotonically_increasing_id().alias("at")), "merkle-leaves")
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), "leaf", "at"]
    placed = numbered(hashed.frame, order, "n", "merkle-places")
    hashed.drop()
    sizes = placed.frame.groupBy("source").agg(F.min("n").alias("first"), F.count(F.lit(1)).alias("size"))
    trees = numbered(sizes, ["first"], "tree", "merkle-trees").frame.withColumn("height", height(F.col("size")))
    at = F.col("n") - F.col("first")
    leaves = stage(placed.frame.join(trees.withColumnRenamed("source", "of"), F.expr("source <=> of")).select(
        "tree", at.alias("i"), F.col("leaf").alias("hash"), "height",
        F.struct("doc_id", "leaf", F.coalesce("other", "leaf").alias("folded")).alias("row")), "merkle-rows")
    placed.drop()
    levels = build_levels(leaves, BLOCK_LEVELS)
    n_trees = trees.count()
    ends = [t.where(F.col("height") == lv).select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("i"),
                                                  "hash") for lv, t in enumerate([leaves, *levels])]
    subroots = stage(reduce(DataFrame.union, ends).withColumn(
        "height", height(F.lit(n_trees))), "merkle-subroots")
    over = build_levels(subroots)
    root = F.lit(next((r["hash"] for r in (over or [subroots])[-1].take(1)), None))
    many = n_trees > 1
    climbed = stage(_seeds(leaves, levels, many), "merkle-seeds")
    nodes = _nodes(levels, over, many)
    if nodes is None:
        climbed = climbed.select("runs", F.lit("").alias("proof"), F.lit(None).cast("string").alias("subroot"))
    else:
        climbed = docs.sparkSession.sql(CLIMB, seeds=climbed, nodes=stage(nodes, "merkle-nodes"))
    runs = climbed.select("proof", "subroot", F.col("runs.hash").alias("kids"), F.posexplode("runs").alias("j", "u"))
    each = runs.select("proof", "subroot", "kids", "j", F.col("u.leaves.leaf").alias("own"),
                       F.posexplode("u.leaves").alias("k", "r"))
    proof = ", ".join([*_siblings("own", "k"), *_siblings("kids", "j"), "proof"])
    return each.select(
        "r.doc_id", "r.leaf", F.coalesce("subroot", root).alias("subroot"), root.alias("root"),
        F.sha2(F.expr(f"concat({proof})"), 256).alias("proof_sha256"),
        F.col("r.folded").alias("folded_root"), (F.col("r.folded") == root).alias("verified"))

"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a hash-random key. Equal-width ranges of the key are range partitions of
equal expected size (the key is uniform), so no sampling pass is needed: rows of a source are
sorted inside their range, range totals give the prefix of each range, and a source is cut at its
budget of words. The number of ranges is the square root of the number of documents, so neither
the rows of one range nor the ranges of one source outgrow a task, however large a source is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campuslens.llm.common import BLANK, packed, stage

WORD = rf"[^{BLANK}]+"
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
_KEY_BITS = 60


def word_count(text: Column) -> Column:
    """Number of words. Each word with the blanks before it becomes one character, trailing
    blanks go, so the length is the count and no array of words is built."""
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), rf"[{BLANK}]*{WORD}", "x")
    return F.length(F.regexp_replace(marks, rf"[{BLANK}]+$", "")).cast("long")


def random_key(id_col: Column, text: Column) -> Column:
    """60 bits of an md5 over the id and the text, the same in every run."""
    joined = F.concat_ws("|", F.coalesce(id_col.cast("string"), F.lit("null")),
                         F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(joined.cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(sources: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS
                   ) -> DataFrame:
    """Adds ``target`` to a table of one row per source (nosrc, src, source_size).

    Weights go round the sources by code point, null last. Resharing the excess of capped sources
    until none is above its cap ends at target = min(cap, level * weight): with sources sorted by
    cap / weight the capped ones come first, and the level is the first one that caps nothing
    more. The windows see one row per source."""
    order = Window.orderBy("nosrc", "src")
    place = (F.row_number().over(order) - 1) % len(weights)
    ranked = sources.withColumn(
        "weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), place + 1))
    ranked = ranked.withColumn("cap", F.col("source_size") * max_epochs)
    ranked = ranked.withColumn("bound", F.col("cap") / F.col("weight"))
    by_bound = Window.orderBy("bound", "nosrc", "src")
    before = by_bound.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding,
                                                      Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    shares = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    ranked = ranked.withColumn("level", left / shares)
    fits = F.when(F.col("level") <= F.col("bound"), F.struct("bound", "nosrc", "src", "level"))
    level = F.min(fits).over(everything)["level"]
    return ranked.withColumn(
        "target", F.least(F.col("cap").cast("double"), level * F.col("weight"))).select(
            "nosrc", "src", "source_size", "target")


def mix_sources(docs: DataFrame, carry: tuple[str, ...] = (), weights=WEIGHTS,
                max_epochs: int = MAX_EPOCHS, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source") -> DataFrame:
    """Words that the mix takes from each document.

    Returns ``doc_id, size, source_size, target, taken`` and the ``carry`` columns, one row per
    input row. ``taken`` is the number of words of the document among the first round(target)
    words of its source's shuffled, repeated sequence; it lies between 0 and max_epochs * size,
    and a source's sum is its rounded target. Null text has no words; null is a source of its own,
    last in the order; a null id hashes as "null"; equal rows are interchangeable; an empty table
    gives an empty result. Other columns are ignored unless named in ``carry``."""
    keyed = docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).isNull().alias("nosrc"),
        F.coalesce(F.col(source_col), F.lit("")).alias("src"),
        word_count(F.col(text_col)).alias("size"),
        random_key(F.col(id_col), F.col(text_col)).alias("key"),
        F.struct(*[F.col(f"`{c}`") for c in carry] or [F.lit(0).alias("none")]).alias("carried"))
    narrow = stage(keyed.drop("carried"), "mix-keys")
    ranges = int((narrow.count() or 1) ** 0.5) + 1
    bucket = F.shiftright(F.shiftright("key", _KEY_BITS - 32) * F.lit(ranges), 32).alias("bucket")
    parts = ["nosrc", "src", "bucket"]
    totals = narrow.groupBy("nosrc", "src", bucket).agg(F.sum("size").alias("words"))
    targets = source_targets(
        narrow.groupBy("nosrc", "src").agg(F.sum("size").alias("source_size")),
        weights, max_epochs)
    earlier = Window.partitionBy("nosrc", "src").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    totals = totals.withColumn("base", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    totals = stage(totals.join(targets, ["nosrc", "src"]).drop("words"), "mix-ranges")
    rows = (keyed if carry else narrow.withColumn("carried", F.struct(F.lit(0).alias("none"))))
    inside = Window.partitionBy(*parts).orderBy("key", "_id").rowsBetween(
        Window.unboundedPreceding, -1)
    rows = rows.withColumn("bucket", bucket).withColumn(
        "prefix", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(totals, parts)
    budget = F.floor(F.col("target") + 0.5)
    start = F.col("base") + F.col("prefix")
    taken = sum((F.greatest(F.lit(0), F.least(
        F.col("size"), budget - start - F.col("source_size") * k)) for k in range(max_epochs)),
        F.lit(0))
    return rows.select(F.col("_id").alias("doc_id"), "size", "source_size", "target",
                       taken.cast("long").alias("taken"),
                       *[F.col("carried")[c].alias(c) for c in carry])


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word: a split after each word keeps the blanks."""
    parts = F.split(text, rf"(?<=[^{BLANK}])(?=[{BLANK}])", -1)
    return F.array_join(F.slice(parts, F.lit(1), n.cast("int")), "")


def mixed_documents(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mix as documents, with the input's columns: each document once per full epoch taken,
    and the document at a source's cut once more with its first words only."""
    rows = mix_sources(packed(docs), ("row",), weights, max_epochs, "row.doc_id", "text",
                       "row.source").where(F.col("taken") > 0)
    copies = F.sequence(F.lit(0), (F.ceil(F.col("taken") / F.col("size")) - 1).cast("int"))
    rows = rows.withColumn("copy", F.explode(copies))
    words = F.least(F.col("size"), F.col("taken") - F.col("copy") * F.col("size"))
    cut = words < F.col("size")
    rows = rows.withColumn("text", F.when(cut, first_words(F.col("row.text"), words)).otherwise(
        F.col("row.text"))).withColumn("cut", cut)
    made = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.when(F.col("cut"), F.length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return rows.select(*[made.get(c, F.col("row")[c]).alias(c) for c in docs.columns])

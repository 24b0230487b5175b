"""Bootstrap intervals from weights, not from copied rows.

Resampling n rows gives every row a Binomial count, close to Poisson(1); the draws here use
independent Poisson weights, so replicates need no coordination between tasks. Weights live and die
inside a task as matrices (rows x replicates): what leaves it is one row per group and replicate
for sums, and one per slice of the score order and replicate for areas, whatever the number of rows."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campuslens.operators.running import histogram

REPLICATES = 2000
SEED = 42
#: Rows whose weights are in memory at a time.
CHUNK = 256
#: Groups whose sums a task holds before it hands them on.
OPEN_GROUPS = 64

Weights = Callable[[pd.DataFrame], tuple[np.ndarray, ...]]


def _scrambled(x: np.ndarray) -> np.ndarray:
    """Finaliser of the public splitmix64 generator."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Distribution function of Poisson(1) at 0, 1, ...
_POISSON_ONE = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])


def cluster_weights(seeds: np.ndarray, replicates: int) -> np.ndarray:
    """Poisson(1) weights (seed x replicate) that hang on the seed and the replicate only."""
    steps = np.arange(1, replicates + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    u = _scrambled(seeds.astype(np.int64).view(np.uint64)[:, None] + steps[None, :]) >> np.uint64(11)
    return np.searchsorted(_POISSON_ONE, u.astype(float) / float(1 << 53), side="right").astype(float)


def row_weights(counts: list[str], replicates: int) -> Weights:
    """Poisson(count) weights of histogram rows, from generators seeded by ``_seed``."""
    def draw(pdf: pd.DataFrame) -> tuple[np.ndarray, ...]:
        rngs = [np.random.default_rng(s & 0x7FFFFFFFFFFFFFFF) for s in pdf["_seed"]]
        return tuple(np.stack([rng.poisson(n, replicates) for rng, n in zip(rngs, pdf[c])]).astype(float)
                     for c in counts)
    return draw


def _seeded(hist: DataFrame, keys: list[str], seed: int) -> DataFrame:
    """Seeds hang on the row content, so draws do not depend on partitioning."""
    return hist.withColumn("_seed", F.xxhash64(F.lit(seed), *keys))


def weighted_sums(hist: DataFrame, group: list[str], value: str, weights: Weights, names: list[str],
                  replicates: int) -> DataFrame:
    """Per group and replicate the sums ``w_<name>`` of the weights and ``s_<name>`` of weight x value. A
    task folds its rows before they leave it."""
    columns = [f"{k}_{n}" for n in names for k in "ws"]
    schema = T.StructType([*(hist.schema[g] for g in group), T.StructField("replica", T.IntegerType()),
                           *(T.StructField(c, T.DoubleType()) for c in columns)])

    def rows(sums: dict) -> Iterator[pd.DataFrame]:
        for key, found in sums.items():
            out = pd.DataFrame({c: found[k] for k, c in enumerate(columns)})
            out.insert(0, "replica", np.arange(replicates, dtype="int32"))
            for g, k in zip(reversed(group), reversed(key)):
                out.insert(0, g, [k] * replicates)
            yield out

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for start in range(0, len(batch), CHUNK):
                pdf = batch.iloc[start:start + CHUNK]
                keys = list(pdf[group].astype(object).itertuples(index=False, name=None))
                known = {k: i for i, k in enumerate(dict.fromkeys(keys))}
                member = np.zeros((len(known), len(pdf)))
                member[[known[k] for k in keys], np.arange(len(pdf))] = 1
                value_of = pdf[value].to_numpy(float)
                made = np.stack([x for w in weights(pdf) for x in (member @ w, (member * value_of) @ w)], 1)
                for key, k in known.items():
                    sums[key] = sums[key] + made[k] if key in sums else made[k]
            if len(sums) > OPEN_GROUPS:
                yield from rows(sums)
                sums = {}
        yield from rows(sums)

    return hist.mapInPandas(fold, schema).groupBy(*group, "replica").agg(
        *[F.sum(c).alias(c) for c in columns])


class _Sweep:
    """Weighted pair counts of one group in the order of its values: for each replicate the weights of the
    two classes and the area, positive x (negative below + half of the ties)."""

    def __init__(self, replicates: int):
        self.pos, self.neg, self.area, self.tie_pos, self.tie_neg = np.zeros((5, replicates))
        self.lo = self.tie = None

    def add(self, values: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> None:
        starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        pos, neg = np.add.reduceat(pos, starts), np.add.reduceat(neg, starts)
        if self.lo is None:
            self.lo = values[0]
        if self.tie == values[0]:
            pos[0] += self.tie_pos
            neg[0] += self.tie_neg
        else:
            self.close()
        below = self.neg + np.concatenate([np.zeros((1, neg.shape[1])), np.cumsum(neg[:-1], 0)])
        self.area += (pos[:-1] * (below[:-1] + neg[:-1] / 2)).sum(0)
        self.pos += pos[:-1].sum(0)
        self.neg = below[-1]
        self.tie, self.tie_pos, self.tie_neg = values[-1], pos[-1], neg[-1]

    def close(self) -> None:
        """The last value has come to its end."""
        self.area += self.tie_pos * (self.neg + self.tie_neg / 2)
        self.pos += self.tie_pos
        self.neg = self.neg + self.tie_neg
        self.tie_pos, self.tie_neg, self.tie = np.zeros_like(self.pos), np.zeros_like(self.pos), None


def weighted_auc(rows: DataFrame, group: list[str], value: str, weights: Weights, replicates: int) -> DataFrame:
    """Per group and replicate the share of weighted (positive, negative) pairs in which the positive has
    the greater value, ties counting half; null where a class has no weight.

    Rows are dealt out by ranges of (group, value) and swept in order; a range hands on one row per group
    and replicate, and the ranges of a group are put together by the negatives of the ranges below.
    A value that very many rows share stays in one range, which streams in bounded memory."""
    schema = T.StructType([*(rows.schema[g] for g in group), T.StructField("_lo", T.DoubleType()),
                           T.StructField("replica", T.IntegerType()),
                           *(T.StructField(c, T.DoubleType()) for c in ("pos", "neg", "area"))])
    order = [*group, value]

    def result(key: tuple, sweep: _Sweep) -> pd.DataFrame:
        sweep.close()
        out = pd.DataFrame({"_lo": sweep.lo, "replica": np.arange(replicates, dtype="int32"), "pos": sweep.pos,
                            "neg": sweep.neg, "area": sweep.area})
        for g, k in zip(reversed(group), reversed(key)):
            out.insert(0, g, [k] * replicates)
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, sweep = None, None
        for batch in batches:
            keys = list(batch[group].astype(object).itertuples(index=False, name=None))
            cuts = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                for start in range(a, b, CHUNK):
                    if sweep is None or keys[start] != now:
                        if sweep is not None:
                            yield result(now, sweep)
                        now, sweep = keys[start], _Sweep(replicates)
                    pdf = batch.iloc[start:min(start + CHUNK, b)]
                    sweep.add(pdf[value].to_numpy(float), *weights(pdf))
        if sweep is not None:
            yield result(now, sweep)

    ranged = rows.where(F.col(value).isNotNull()).repartitionByRange(*order).sortWithinPartitions(*order)
    slices = ranged.mapInPandas(run, schema)
    lower = Window.partitionBy(*group, "replica").orderBy("_lo").rowsBetween(Window.unboundedPreceding, -1)
    whole = slices.withColumn("_below", F.coalesce(F.sum("neg").over(lower), F.lit(0.0)))
    pairs = F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0.0))
    return whole.groupBy(*group, "replica").agg(
        (F.sum(F.col("area") + F.col("pos") * F.col("_below")) / pairs).alias("auc"))


def _interval(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """2.5 % and 97.5 % points over the replicates (a fixed number of rows per group)."""
    q = F.percentile(value, F.array(F.lit(0.025), F.lit(0.975)))
    return df.groupBy(*group).agg(q.alias("_q"), F.count(value).alias("replicas")).select(
        *group, F.col("_q")[0].alias("ic_lo"), F.col("_q")[1].alias("ic_hi"), "replicas")


def mean_ci(df: DataFrame, group: list[str], value: str, replicates: int = REPLICATES,
            seed: int = SEED) -> DataFrame:
    """Percentile interval of the mean per group."""
    hist = _seeded(histogram(df, group, value), group + [value], seed)
    drawn = weighted_sums(hist, group, value, row_weights(["n"], replicates), ["n"], replicates)
    return _interval(drawn.withColumn("m", F.col("s_n") / F.nullif(F.col("w_n"), F.lit(0.0))), group, "m")


def mean_difference_ci(df: DataFrame, group: list[str], value: str, first: Column,
                       replicates: int = REPLICATES, seed: int = SEED) -> DataFrame:
    """Percentile interval of mean(first) - mean(rest)."""
    rows = df.withColumn("_x", first.cast("int")).where(F.col("_x").isNotNull())
    hist = histogram(rows, group, value, x=F.col("_x"), y=1 - F.col("_x"))
    hist = _seeded(hist, group + [value], seed)
    drawn = weighted_sums(hist, group, value, row_weights(["x", "y"], replicates), ["x", "y"], replicates)

    def mean(w):
        return F.col(f"s_{w}") / F.nullif(F.col(f"w_{w}"), F.lit(0.0))
    return _interval(drawn.withColumn("d", mean("x") - mean("y")), group, "d")


def cliff_ci(df: DataFrame, group: list[str], value: str, first: Column,
             replicates: int = REPLICATES, seed: int = SEED) -> DataFrame:
    """Percentile interval of Cliff's delta, twice the area less one."""
    rows = df.withColumn("_x", first.cast("int")).where(F.col("_x").isNotNull())
    hist = _seeded(histogram(rows, group, value, x=F.col("_x"), y=1 - F.col("_x")), group + [value], seed)
    areas = weighted_auc(hist, group, value, row_weights(["x", "y"], replicates), replicates)
    return _interval(areas.withColumn("d", 2 * F.col("auc") - 1), group, "d")


def cluster_auc_draws(df: DataFrame, scores: list[str], label: str, cluster: str,
                      replicates: int = REPLICATES, seed: int = SEED) -> DataFrame:
    """AUC of each score in every cluster-bootstrap replicate (one-class replicates drop out). A cluster
    has one weight per replicate, the same for all scores."""
    y = F.col(label).cast("int")
    packed = df.select(F.xxhash64(F.lit(seed), F.col(cluster)).alias("_seed"), F.explode(F.array(*[
        F.struct(F.lit(s).alias("modelo"), F.col(s).cast("double").alias("p"))
        for s in scores])).alias("x"), y.alias("y")).select("_seed", "x.*", "y") \
        .groupBy("_seed", "modelo", "p").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))

    def weights(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        w = cluster_weights(pdf["_seed"].to_numpy(), replicates)
        return w * pdf["pos"].to_numpy(float)[:, None], w * pdf["neg"].to_numpy(float)[:, None]

    return weighted_auc(packed, ["modelo"], "p", weights, replicates).where(F.col("auc").isNotNull())


def cluster_auc_ci(df: DataFrame, score: str, label: str, cluster: str,
                   replicates: int = REPLICATES, seed: int = SEED) -> DataFrame:
    draws = cluster_auc_draws(df, [score], label, cluster, replicates, seed)
    return _interval(draws, ["modelo"], "auc")


def cluster_auc_delta_ci(df: DataFrame, pairs: list[tuple[str, str]], label: str, cluster: str,
                         replicates: int = REPLICATES, seed: int = SEED) -> DataFrame:
    """Paired difference of AUC (alternative - base) with the same weights for both scores."""
    scores = sorted({s for pair in pairs for s in pair})
    draws = cluster_auc_draws(df, scores, label, cluster, replicates, seed)
    wide = draws.groupBy("replica").pivot("modelo", scores).agg(F.first("auc"))
    cells = F.array(*[F.struct(F.lit(f"{a} − {b}").alias("comparacion"),
                               (F.col(f"`{a}`") - F.col(f"`{b}`")).alias("d")) for a, b in pairs])
    long = wide.select(F.explode(cells).alias("x")).select("x.*")
    return _interval(long, ["comparacion"], "d")

"""Classifier metrics as aggregates over score histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campuslens.operators.outliers import attach_group
from campuslens.operators.running import histogram, quantiles, running_sums


def _sweep(df: DataFrame, group: list[str], score: str, label: str, small: bool) -> DataFrame:
    y = F.col(label).cast("int")
    hist = histogram(df, group, score, pos=y, neg=1 - y)
    return running_sums(hist, group, score, ["pos", "neg"], small)


def auc_roc_pr(df: DataFrame, score: str, label: str, group: list[str] = [],
               small_domain: bool = False) -> DataFrame:
    """Rank AUC-ROC and step-sum average precision per group."""
    s = _sweep(df, group, score, label, small_domain)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    tp, fp = F.col("pos_all") - F.col("pos_below"), F.col("neg_all") - F.col("neg_below")
    out = s.groupBy(*group).agg(
        F.sum("pos").alias("positivos"), F.sum("neg").alias("negativos"),
        F.sum(pos * (F.col("neg_below") + neg / 2)).alias("_a"),
        F.sum(pos * tp / (tp + fp)).alias("_p"))
    both = (F.col("positivos") > 0) & (F.col("negativos") > 0)
    return out.select(
        *group, "positivos", "negativos",
        F.when(both, F.col("_a") / (F.col("positivos").cast("double") * F.col("negativos")))
        .alias("auc_roc"),
        F.when(F.col("positivos") > 0, F.col("_p") / F.col("positivos")).alias("auc_pr"))


def threshold_for_recall(df: DataFrame, score: str, label: str, target: float = 0.80,
                         group: list[str] = [], small_domain: bool = False) -> DataFrame:
    """Largest score whose recall (score >= threshold) reaches the target."""
    s = _sweep(df, group, score, label, small_domain)
    recall = (F.col("pos_all") - F.col("pos_below")) / F.col("pos_all")
    return s.groupBy(*group).agg(
        F.coalesce(F.max(F.when(recall >= target, F.col(score))), F.min(score)).alias("umbral"))


def classification_metrics(df: DataFrame, score: str, label: str, threshold,
                           group: list[str] = []) -> DataFrame:
    """Confusion counts and rates at a threshold, and the Brier score, in one pass."""
    y, hit = F.col(label).cast("int") == 1, F.col(score) >= threshold
    counts = df.groupBy(*group).agg(
        F.count_if(y & hit).alias("tp"), F.count_if(~y & hit).alias("fp"),
        F.count_if(y & ~hit).alias("fn"), F.count_if(~y & ~hit).alias("tn"),
        F.avg(F.pow(F.col(score) - F.col(label), 2)).alias("brier"))
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))

    def share(a, b, empty):
        return F.when(b > 0, a / b).otherwise(F.lit(empty).cast("double"))
    return counts.withColumns({
        "recall": share(tp, tp + fn, 0.0), "precision": share(tp, tp + fp, 0.0),
        "f1": share(2 * tp, 2 * tp + fp + fn, 0.0), "especificidad": share(tn, tn + fp, None)})


def metrics_by_stratum(df: DataFrame, strata: list[str], score: str, label: str, threshold,
                       small_domain: bool = False) -> DataFrame:
    """AUC, recall and precision per value of each stratum column; one-class strata drop out."""
    long = df.select(score, label, F.explode(F.array(*[
        F.struct(F.lit(s).alias("estrato"), F.col(s).cast("string").alias("valor"))
        for s in strata])).alias("x")).select(score, label, "x.*")
    keys = ["estrato", "valor"]
    auc = auc_roc_pr(long, score, label, keys, small_domain)
    rates = classification_metrics(long, score, label, threshold, keys)
    both = auc.where(F.col("auc_roc").isNotNull()).join(rates, keys)
    n = F.col("positivos") + F.col("negativos")
    return both.select(*keys, n.alias("n"), (F.col("positivos") / n).alias("prevalencia"),
                       "auc_roc", "recall", "precision")


def calibration_bins(df: DataFrame, score: str, label: str, bins: int = 5,
                     small_domain: bool = False) -> DataFrame:
    """Mean score and observed rate in quantile bins."""
    probs = {f"_e{i}": i / bins for i in range(1, bins)}
    keyed = df.withColumn("_all", F.lit(0))
    edges = quantiles(keyed, ["_all"], score, probs, small_domain)
    number = F.lit(0)
    for e in probs:
        number = number + (F.col(e) < F.col(score)).cast("int")
    return (attach_group(keyed, edges, ["_all"], "edges").groupBy(number.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("prob_media"),
                 F.avg(F.col(label).cast("double")).alias("frecuencia")))

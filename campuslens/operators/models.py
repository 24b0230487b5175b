"""Early-warning models on MLlib: fits, out-of-fold scores, evaluation, interpretation."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import (LogisticRegression, RandomForestClassificationModel,
                                       RandomForestClassifier)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campuslens.operators.boosting import Boosted, SecondOrderBoosting, Tests
from campuslens.operators.bootstrap import weighted_auc
from campuslens.operators.features import Encoder, Scenario, union
from campuslens.operators.forest import Rules, TaskForest
from campuslens.operators.metrics import (auc_roc_pr, classification_metrics,
                                          threshold_for_recall)
from campuslens.operators.running import histogram
from campuslens.operators.split import SEED, grouped_folds
from campuslens.session import materialise, scratch_dir

LABEL, GROUP = "en_riesgo", "estudiante_id"
PRIOR, LOGISTIC, FOREST, BOOSTING = ("Línea base (prior)", "Regresión logística",
                                     "Random forest", "Gradient boosting")


ROWS_PER_TASK = 20_000
#: Forest tasks at least; bags are drawn per partition, so the count must not hang on the machine.
FOREST_PARTITIONS = 8
PARALLEL_FITS = 4
#: Between the seeds of groups of trees.
SEED_STEP = 1_000_003
#: Nodes that the trees of one fit may have at most, which the driver holds.
FOREST_NODES = 1 << 20
#: Rows from which, and bytes of binned rows up to which, tasks grow the trees of a large forest.
TASK_ROWS, TASK_BYTES = 5_000, 256 << 20


def logistic(rows: int):
    """L2 with C = 1: the penalty per row is 1 / n."""
    return LogisticRegression(labelCol=LABEL, regParam=1.0 / rows, elasticNetParam=0.0,
                              standardization=False, maxIter=200, tol=1e-6)


def forest(rows: int):
    return RandomForestClassifier(labelCol=LABEL, numTrees=500, minInstancesPerNode=5,
                                  featureSubsetStrategy="sqrt", maxDepth=30,
                                  maxMemoryInMB=1024, seed=SEED)


def boosting(rows: int):
    return SecondOrderBoosting(LABEL, rate=0.05, trees=200, depth=3, penalty=1.0)


MODELS: dict[str, Callable] = {LOGISTIC: logistic, FOREST: forest, BOOSTING: boosting}


class Prior:
    """Training prevalence for every row."""

    def __init__(self, rate: float):
        self.rate = rate

    def score(self, df: DataFrame, name: str) -> DataFrame:
        return df.withColumn(name, F.lit(float(self.rate)))


class ForestGroups:
    """A forest whose trees are too large together for the driver: groups of trees in the shared folder, of
    which the driver holds one at a time."""

    def __init__(self, folder: str, groups: int, trees: int):
        self.folder, self.groups, self.trees = folder, groups, trees

    @classmethod
    def fit(cls, data: DataFrame, estimator: RandomForestClassifier, at_once: int) -> "ForestGroups":
        folder = f"{scratch_dir(data.sparkSession).rstrip('/')}/bosque-{uuid.uuid4().hex}"
        trees = estimator.getNumTrees()
        starts = range(0, trees, at_once)
        for k, start in enumerate(starts):
            part = estimator.copy({estimator.numTrees: min(at_once, trees - start),
                                   estimator.seed: SEED + SEED_STEP * k})
            part.fit(data).write().save(f"{folder}/{k}")
        return cls(folder, len(starts), trees)

    def score(self, encoded: DataFrame, name: str) -> DataFrame:
        """Each tree votes with the shares of the classes in its leaf, as in one forest."""
        votes = "_votos"
        rows = encoded.withColumn(votes, F.lit(0.0))
        for k in range(self.groups):
            scored = RandomForestClassificationModel.load(f"{self.folder}/{k}").transform(rows)
            rows = materialise(scored.withColumn(votes, F.col(votes) + vector_to_array("rawPrediction")[1])
                               .select(*rows.columns), "votos")
        return rows.withColumn(name, F.col(votes) / self.trees).drop(votes)


def with_score(model, encoded: DataFrame, name: str) -> DataFrame:
    """Encoded rows with the probability of the positive class."""
    if isinstance(model, ForestGroups | TaskForest):
        return model.score(encoded, name)
    return model.transform(encoded).withColumn(name, vector_to_array("probability")[1]).drop(
        "rawPrediction", "probability", "prediction")


class Fitted:
    def __init__(self, encoder: Encoder, model):
        self.encoder, self.model = encoder, model

    def score(self, df: DataFrame, name: str = "p") -> DataFrame:
        return with_score(self.model, self.encoder.transform(df), name).drop("features")


def fit(train: DataFrame, scenario: Scenario, model: str):
    """Encoder and model from the training rows."""
    if model == PRIOR:
        return Prior(train.agg(F.avg(LABEL)).first()[0])
    encoder = Encoder.fit(train, scenario)
    return Fitted(encoder, train_model(encoder.transform(train), train.count(), model))


def train_model(data: DataFrame, rows: int, model: str):
    """The model from ``rows`` encoded rows."""
    # iterative fits run many short jobs: few rows need few tasks (a no-op on large tables)
    if model != FOREST:
        data = data.coalesce(max(1, rows // ROWS_PER_TASK))
    else:
        key = [GROUP, "asignatura"]
        data = data.repartition(max(FOREST_PARTITIONS, rows // ROWS_PER_TASK), *key) \
            .sortWithinPartitions(*key)
    data = data.select("features", F.col(LABEL).cast("double").alias(LABEL))
    estimator = MODELS[model](rows)
    if model == FOREST:
        at_once = trees_at_once(rows, estimator.getMinInstancesPerNode())
        if at_once < estimator.getNumTrees():
            return large_forest(data, estimator, rows, at_once)
    return estimator.fit(data)


def large_forest(data: DataFrame, estimator: RandomForestClassifier, rows: int, at_once: int):
    """A forest that one fit cannot hold: its trees are grown by tasks while a task can hold the binned rows,
    else in groups of trees by passes over all rows."""
    width = data.select("features").first()[0].size
    if rows < TASK_ROWS or rows * width > TASK_BYTES:
        return ForestGroups.fit(data, estimator, at_once)
    rules = Rules(estimator.getMaxDepth(), estimator.getMinInstancesPerNode(), int(np.ceil(np.sqrt(width))), SEED)
    return TaskForest.fit(data, LABEL, rows, estimator.getNumTrees(), estimator.getMaxBins(), rules)


def trees_at_once(rows: int, least: int) -> int:
    """So many trees have ``FOREST_NODES`` nodes at most, if each leaf has ``least`` of ``rows`` rows (one
    tree at least)."""
    return max(1, FOREST_NODES // max(1, 2 * rows // least))


class Prepared:
    """Training rows and rows to score, encoded once for several scenarios: what is learned from the
    rows (categories, moments, their number) is the same for each."""

    def __init__(self, train: DataFrame, other: DataFrame, scenarios: list[Scenario]):
        self.encoder = Encoder.fit(train, union(scenarios))
        self.rows = train.count()
        ready = self.encoder.prepare(train).select(GROUP, "asignatura", LABEL,
                                                   *self.encoder.parts(self.encoder.moments))
        self.train = materialise(ready, "preparado")
        self.other = materialise(self.encoder.prepare(other), "preparado")

    @staticmethod
    def scaled(scenario: Scenario) -> list[str]:
        return [*scenario.numeric, *scenario.flags]

    def fit(self, scenario: Scenario, model: str):
        data = self.encoder.assemble(self.train, self.scaled(scenario))
        return train_model(data, self.rows, model)

    def score(self, df: DataFrame, scenario: Scenario, fitted, name: str) -> DataFrame:
        """``df``, which holds the columns of ``other``, with the scores of a fitted model."""
        return with_score(fitted, self.encoder.assemble(df, self.scaled(scenario)), name).select(*df.columns, name)


def out_of_fold(sets: list[Prepared], scenario: Scenario, model: str, fold: str = "pliegue") -> DataFrame:
    """Scores of every training row by a model that has not seen its group; ``sets`` holds the other
    rows and the rows of each fold."""
    def one(rows: Prepared) -> DataFrame:
        return rows.score(rows.other, scenario, rows.fit(scenario, model), "p").select(
            GROUP, "asignatura", fold, LABEL, "p")

    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        parts = list(pool.map(one, sets))
    return materialise(reduce(DataFrame.unionByName, parts), "oof")


def fold_sets(train: DataFrame, scenarios: list[Scenario], folds: int = 5, fold: str = "pliegue") -> list[Prepared]:
    """Per fold the rows of the others to train on and its own to score."""
    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        return list(pool.map(lambda k: Prepared(train.where(F.col(fold) != k), train.where(F.col(fold) == k),
                                                scenarios), range(1, folds + 1)))


def with_folds(train: DataFrame, folds: int = 5) -> DataFrame:
    """Training rows with their cross-validation fold, as a stage table."""
    return materialise(train.join(grouped_folds(train, GROUP, LABEL, folds), GROUP), "folds")


def fold_summary(oof: DataFrame, fold: str = "pliegue") -> DataFrame:
    """Mean and deviation over the folds of AUC-ROC and average precision."""
    return auc_roc_pr(oof, "p", LABEL, [fold]).agg(
        F.avg("auc_roc").alias("cv_auc_roc"), F.stddev_samp("auc_roc").alias("cv_auc_roc_de"),
        F.avg("auc_pr").alias("cv_auc_pr"), F.stddev_samp("auc_pr").alias("cv_auc_pr_de"))


def evaluate(train: DataFrame, test: DataFrame, scenario: Scenario, model: str,
             sets: list[Prepared] | None = None, whole: Prepared | None = None) -> DataFrame:
    """One result row: fold summary, threshold by recall on out-of-fold scores, test metrics.
    ``train`` carries its fold column; ``sets`` (folds) and ``whole`` are rows prepared before."""
    if model == PRIOR:
        folds, threshold = None, 0.5
    else:
        oof = out_of_fold(sets or fold_sets(train, [scenario]), scenario, model)
        folds = fold_summary(oof)
        threshold = threshold_for_recall(oof, "p", LABEL).first()["umbral"]
    if model == PRIOR:
        scored = fit(train, scenario, model).score(test, "p")
    else:
        whole = whole or Prepared(train, test, [scenario])
        scored = whole.score(whole.other, scenario, whole.fit(scenario, model), "p")
    scored = materialise(scored.select(GROUP, LABEL, "p"), "scored")
    row = auc_roc_pr(scored, "p", LABEL).select("auc_roc", "auc_pr")
    rates = classification_metrics(scored, "p", LABEL, threshold)
    names = {"escenario": scenario.name, "modelo": model, "umbral": float(threshold)}
    out = row.select(*[F.lit(v).alias(k) for k, v in names.items()], "*")
    for extra in ([folds] if folds is not None else []) + [rates]:
        cells = extra.first().asDict()
        out = out.withColumns({k: F.lit(v).cast("double") for k, v in cells.items()})
    return out


def evaluate_all(train: DataFrame, test: DataFrame, scenarios: list[Scenario],
                 model: str) -> DataFrame:
    """One result row per scenario; the scenarios are independent and run side by side. Rows are
    encoded once per fold and once for the test, whatever the number of scenarios."""
    sets, whole = ([], None) if model == PRIOR else (fold_sets(train, scenarios), Prepared(train, test, scenarios))
    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        rows = list(pool.map(lambda s: evaluate(train, test, s, model, sets, whole), scenarios))
    return reduce(DataFrame.unionByName, rows)


def scored_test(train: DataFrame, test: DataFrame, scenarios: list[Scenario],
                model: str) -> DataFrame:
    """Test rows with one score column per scenario."""
    rows = Prepared(train, test, scenarios)
    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        fits = list(pool.map(lambda s: rows.fit(s, model), scenarios))
    out = rows.other
    for s, fitted in zip(scenarios, fits):
        out = rows.score(out, s, fitted, s.name)
    return materialise(out.select(*test.columns, *[s.name for s in scenarios]), "scored")


def circular_feature(df: DataFrame, seed: int = SEED, name: str = "sim_circular") -> DataFrame:
    """A predictor built from the target: exp(0.15 * final grade + noise), noise by hash."""
    def uniform(salt):
        h = F.pmod(F.xxhash64(F.lit(seed + salt), GROUP, "asignatura"), F.lit(1 << 52))
        return (h.cast("double") + 0.5) / float(1 << 52)
    noise = 0.5 * F.sqrt(-2 * F.log(uniform(0))) * F.cos(2 * np.pi * uniform(1))
    return df.withColumn(name, F.exp(0.15 * F.col("nota_p3") + noise))


def hash_ranks(rows: DataFrame, hashed: str, group: str, name: str) -> DataFrame:
    """Numbers 1..n in the order of the 64-bit hash ``hashed`` inside each ``group``. The hash's leading bits
    cut a group into 4096 even slices, so that no window spans a group."""
    sliced = rows.withColumn("_slice", F.shiftrightunsigned(hashed, 52))
    sizes = sliced.groupBy(group, "_slice").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0))).drop("_size")
    inside = Window.partitionBy(group, "_slice").orderBy(hashed)
    return sliced.withColumn("_in", F.row_number().over(inside)).join(offsets, [group, "_slice"]).withColumn(
        name, F.col("_before") + F.col("_in")).drop("_slice", "_in", "_before")


def shuffled_partners(rows: DataFrame, keys: list[str], columns: list[str], repeats: int, seed: int) -> DataFrame:
    """Every row of ``rows`` once per repeat (``_rep`` from 1) beside a partner's ``columns`` in the struct
    ``_other``: a random permutation of the whole table. The row of place k in one hash order
    meets the row of place k in the repeat's order, which is a join on numbers."""
    packed = rows.select(*rows.columns, F.explode(F.sequence(F.lit(0), F.lit(repeats))).alias("_rep"))
    placed = materialise(hash_ranks(packed.withColumn("_hash", F.xxhash64(F.lit(seed), "_rep", *keys)),
                                    "_hash", "_rep", "_place"), "orders")
    base = placed.where("_rep = 0").drop("_rep", "_hash")
    other = placed.where("_rep > 0").select("_rep", "_place", F.struct(*columns).alias("_other"))
    return base.join(other, "_place").drop("_place")


#: Rows whose copies are scored at once.
COPY_ROWS = 4096


def _boosted_copies(fitted: Fitted, test: DataFrame, key: list[str], columns: list[str], repeats: int, seed: int
                    ) -> DataFrame:
    """(_col, _rep, label, p) of all copies. Rows are encoded once and travel as the outcomes of the trees'
    tests; a copy takes those of the exchanged column from the partner."""
    tests, sources = Tests(fitted.model), fitted.encoder.sources()
    named = [{k for k, c in enumerate(sources) if c == name} for name in columns]
    encoded = fitted.encoder.transform(test).select(
        *key, F.col(LABEL).cast("long").alias(LABEL), tests.outcomes("features").alias("_tests"))
    rows = shuffled_partners(materialise(encoded, "probadas"), key, ["_tests"], repeats, seed)
    rows = rows.select("_rep", LABEL, "_tests", F.col("_other._tests").alias("_partner"))

    def run(batches):
        for batch in (x.slice(i, COPY_ROWS) for x in batches for i in range(0, x.num_rows, COPY_ROWS)):
            own, other = (tests.unpacked(batch.column(k)) for k in (2, 3))
            for name, p in zip(["", *columns], tests.copies(own, other, named)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * batch.num_rows), batch.column(0), batch.column(1), pa.array(p)],
                    ["_col", "_rep", LABEL, "p"])
    return rows.mapInArrow(run, f"_col string, _rep int, {LABEL} long, p double")


def permutation_importance(fitted: Fitted, test: DataFrame, columns: list[str],
                           repeats: int = 30, seed: int = SEED) -> DataFrame:
    """Mean and deviation of the AUC drop when one column is permuted over all rows of ``test``.

    A repeat has one permutation for all columns, so rows x repeats are shuffled; the copies with one column
    exchanged are scored where they arise and leave as (column, repeat, score) histograms."""
    key = [GROUP, "asignatura"]
    if isinstance(fitted, Fitted) and isinstance(fitted.model, Boosted):
        scored = _boosted_copies(fitted, test.select(*dict.fromkeys([*key, LABEL, *columns])), key, columns, repeats, seed)
    else:
        rows = shuffled_partners(test.select(*dict.fromkeys([*key, LABEL, *columns])), key, columns, repeats, seed)

        def copy(name: str | None) -> Column:
            return F.struct(F.lit(name or "").alias("_col"), LABEL, *[
                F.col("_other")[c].alias(c) if c == name else F.col(c) for c in columns])

        # the unchanged copy of a repeat gives the AUC to compare with
        copies = rows.select("_rep", F.explode(F.array(*[copy(c) for c in (None, *columns)])).alias("x"))
        scored = fitted.score(copies.select("_rep", "x.*"), "p")
    hist = histogram(scored, ["_col", "_rep"], "p", pos=F.col(LABEL), neg=1 - F.col(LABEL))

    def counts(pdf: pd.DataFrame) -> tuple[np.ndarray, ...]:
        return tuple(pdf[c].to_numpy(float)[:, None] for c in ("pos", "neg"))

    areas = weighted_auc(materialise(hist, "permuted"), ["_col", "_rep"], "p", counts, 1)
    base = areas.where("_col = ''").select("_rep", F.col("auc").alias("_base"))
    drops = areas.where("_col <> ''").join(F.broadcast(base), "_rep").withColumn("_drop", F.col("_base") - F.col("auc"))
    return drops.groupBy(F.col("_col").alias("variable")).agg(
        F.avg("_drop").alias("importancia"), F.stddev_pop("_drop").alias("de")).orderBy(
        F.desc("importancia"), "variable")

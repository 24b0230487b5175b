"""Statistics against published answers and brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from campuslens.functions.stats import chi2_tail, t_quantile, wilson
from campuslens.operators import nonparametric as N
from campuslens.operators.metrics import auc_roc_pr, threshold_for_recall
from campuslens.operators.running import dense_numbers, quantiles
from campuslens.operators.split import grouped_split


@pytest.mark.parametrize("k,n,lo,hi", [(130, 395, 0.284615, 0.376905), (35, 71, 0.380052, 0.606587),
                                       (12, 492, 0.014006, 0.042144)])
def test_wilson(spark, k, n, lo, hi):
    a, b = wilson(F.lit(k), F.lit(n))
    row = spark.range(1).select(a.alias("a"), b.alias("b")).first()
    assert row["a"] == pytest.approx(lo, abs=1e-6) and row["b"] == pytest.approx(hi, abs=1e-6)


def test_tails():
    assert chi2_tail(57.331366, 1) == pytest.approx(3.68e-14, rel=1e-2)
    assert chi2_tail(0.385833, 1) == pytest.approx(0.534498, abs=1e-6)
    assert chi2_tail(7.272543, 2) == pytest.approx(0.026350, abs=1e-6)
    assert chi2_tail(9.487729, 4) == pytest.approx(0.05, abs=1e-6)
    assert t_quantile(1) == pytest.approx(12.7062, abs=1e-3)
    assert t_quantile(10) == pytest.approx(2.228139, abs=1e-5)
    assert t_quantile(1000) == pytest.approx(1.962339, abs=1e-5)


def test_chi_square(spark):
    cells = [("POR", e, r, n) for e, r, n in (("GP", 1, 32), ("GP", 0, 391), ("MS", 1, 68), ("MS", 0, 158))]
    df = spark.createDataFrame(cells, "a string, e string, r int, n int").withColumn(
        "_", F.explode(F.sequence(F.lit(1), F.col("n"))))
    row = N.with_chi2_p(N.chi_square(df, ["a"], "e", "r")).first()
    assert row["chi2"] == pytest.approx(57.331366, abs=1e-5)
    assert row["v_cramer"] == pytest.approx(0.297217, abs=1e-6)


def test_holm(spark):
    df = spark.createDataFrame([(0.296685,), (0.000314819,), (0.001299405,)], "p double")
    got = sorted(r["p_holm"] for r in N.holm_adjust(df.withColumn("f", F.lit(1)), ["f"]).collect())
    assert got == pytest.approx([0.000944457, 0.002598810, 0.296685], abs=1e-8)


@pytest.mark.parametrize("small", [True, False])
def test_ranks_and_quantiles(spark, small):
    rng = np.random.default_rng(7)
    x, y = rng.integers(0, 9, 60), rng.integers(2, 12, 45)
    rows = [("g", True, int(v)) for v in x] + [("g", False, int(v)) for v in y]
    df = spark.createDataFrame(rows, "g string, x boolean, v int").repartition(5)
    row = N.mann_whitney(df, ["g"], "v", F.col("x"), small).first()
    u = sum((a > b) + 0.5 * (a == b) for a in x for b in y)
    assert row["u"] == pytest.approx(u) and row["delta"] == pytest.approx(2 * u / (60 * 45) - 1)
    q = quantiles(df, ["g"], "v", {"a": 0.1, "b": 0.5, "c": 0.93}, small).first()
    want = np.percentile(np.concatenate([x, y]), [10, 50, 93])
    assert [q["a"], q["b"], q["c"]] == pytest.approx(list(want))


def test_metrics_brute_force(spark):
    rng = np.random.default_rng(3)
    p, y = np.round(rng.random(80), 2), rng.integers(0, 2, 80)
    df = spark.createDataFrame(list(zip(p.tolist(), y.tolist())), "p double, y int")
    row = auc_roc_pr(df, "p", "y").first()
    pos, neg = p[y == 1], p[y == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    assert row["auc_roc"] == pytest.approx(auc)
    t = threshold_for_recall(df, "p", "y").first()["umbral"]
    assert (pos >= t).mean() >= 0.8 and (pos > t).mean() < 0.8


def test_split_is_grouped_and_stable(spark):
    df = spark.range(3000).select((F.col("id") % 1700).alias("g"), (F.col("id") % 4 == 0).cast("int").alias("y"))
    a = grouped_split(df, "g", "y")
    b = grouped_split(df.repartition(7), "g", "y")
    share = a.where("particion = 'test'").count() / 3000
    assert 0.15 < share < 0.25
    assert a.groupBy("g").agg(F.countDistinct("particion").alias("n")).where("n > 1").count() == 0
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_dense_numbers(spark):
    df = spark.range(50).select((F.col("id") * 7 + 3).alias("s"))
    rows = dense_numbers(df.repartition(6), "s", "n", block=40).orderBy("s").collect()
    assert [r["n"] for r in rows] == list(range(1, 51))
    assert math.isclose(rows[0]["s"], 3)


def test_register_factors_need_no_behaviour(spark):
    from campuslens.operators import dataset as A
    from campuslens.operators import outliers as O
    wide = spark.createDataFrame(
        [(1, "M", 5, 9, 0), (2, "M", 20, 12, 1), (3, "M", 1, None, 3), (None, "M", 9, 4, 2), (4, "P", 7, 10, 0)],
        "estudiante_id int, asignatura string, faltas int, nota_p3 int, reprobaciones_previas int")
    rows = A.register_columns(wide)
    assert rows.count() == 4  # the split drops rows without a student
    assert [(r.estudiante_id, r.en_riesgo) for r in rows.orderBy("estudiante_id").collect()] == [
        (1, 1), (2, 0), (3, None), (4, 0)]
    assert all(rows.schema[v.name].dataType.simpleString() == v.type for v in A.DICTIONARY if v.name in rows.columns)
    flags = ["estudiante_id", "f_inasistencia", "f_reprob_previas"]
    whole = O.risk_factors(rows.withColumn("sim_lms_minutos_p1", F.lit(1)))
    assert sorted(map(tuple, O.register_factors(rows).select(*flags).collect())) == sorted(
        map(tuple, whole.select(*flags).collect()))

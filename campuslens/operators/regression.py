"""Odds ratios with cluster-robust standard errors."""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campuslens.functions.stats import Z95
from campuslens.session import materialise

RESULT = T.StructType([T.StructField("variable", T.StringType()),
                       *[T.StructField(c, T.DoubleType()) for c in
                         ("OR", "ic_lo", "ic_hi", "p", "ee")], T.StructField("n", T.LongType())])


def odds_ratios_clustered(df: DataFrame, predictors: dict[str, Column], label: str,
                          cluster: str) -> DataFrame:
    """Binomial regression on the distinct design rows, then the sandwich: the information
    matrix and the per-cluster score sums, folded to their k x k cross products. Only k x k
    numbers reach the driver (k = predictors + 1)."""
    names = ["const", *predictors]
    k = len(names)
    rows = df.select(F.col(cluster).alias("_g"), F.col(label).cast("double").alias("_y"),
                     F.lit(1.0).alias("x0"),
                     *[c.cast("double").alias(f"x{i}") for i, c in enumerate(predictors.values(), 1)])
    xs = [f"x{i}" for i in range(k)]
    design = materialise(rows.groupBy(*xs).agg(
        F.count(F.lit(1)).cast("double").alias("_n"), F.avg("_y").alias("_rate")), "design")
    model = GeneralizedLinearRegression(
        family="binomial", link="logit", labelCol="_rate", weightCol="_n", maxIter=50, tol=1e-10,
    ).fit(design.select("_rate", "_n", array_to_vector(F.array(*xs[1:])).alias("features")))
    beta = np.array([model.intercept, *model.coefficients])
    eta = sum((F.col(x) * float(b) for x, b in zip(xs, beta)), F.lit(0.0))
    mu = 1 / (1 + F.exp(-eta))

    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    weight = F.col("_n") * F.col("_mu") * (1 - F.col("_mu"))
    info = design.withColumn("_mu", mu).withColumn("_w", weight).agg(
        F.sum("_n").alias("n"), *[F.sum(F.col("_w") * F.col(xs[i]) * F.col(xs[j]))
                                  .alias(f"h{i}_{j}") for i, j in pairs]).first()
    hessian = np.zeros((k, k))
    for i, j in pairs:
        hessian[i, j] = hessian[j, i] = info[f"h{i}_{j}"]

    residual = F.col("_y") - F.col("_mu")
    scores = rows.withColumn("_mu", mu).groupBy("_g").agg(
        *[F.sum(residual * F.col(x)).alias(f"s{i}") for i, x in enumerate(xs)])
    cross = scores.agg(F.count(F.lit(1)).alias("g"), *[
        F.sum(F.col(f"s{i}") * F.col(f"s{j}")).alias(f"m{i}_{j}") for i, j in pairs]).first()
    meat = np.zeros((k, k))
    for i, j in pairs:
        meat[i, j] = meat[j, i] = cross[f"m{i}_{j}"]
    n, g = info["n"], cross["g"]
    bread = np.linalg.inv(hessian)
    cov = bread @ meat @ bread * (g / (g - 1)) * ((n - 1) / (n - k))
    se = np.sqrt(np.diag(cov))
    out = [(name, *(float(np.exp(v)) for v in (b, b - Z95 * s, b + Z95 * s)),
            math.erfc(abs(b / s) / math.sqrt(2)), float(s), int(n))
           for name, b, s in zip(names, beta, se) if name != "const"]
    return df.sparkSession.createDataFrame(out, RESULT)

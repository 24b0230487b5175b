"""Closed-form statistics as column expressions, and distribution tails for small results."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

Z95 = 1.959963984540054


def wilson(k: Column, n: Column, z: float = Z95) -> tuple[Column, Column]:
    """Wilson interval of a proportion."""
    k, n = k.cast("double"), n.cast("double")
    p = k / n
    base = 1 + z * z / n
    centre = (p + z * z / (2 * n)) / base
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / base
    return centre - half, centre + half


def cliff_band(delta: Column) -> Column:
    """Magnitude names of an effect size (fixed values .147, .33, .474)."""
    a = F.abs(delta)
    return (F.when(a < 0.147, "despreciable").when(a < 0.33, "pequeño")
            .when(a < 0.474, "mediano").otherwise("grande"))


def chi2_tail(x: float, df: int) -> float:
    """Upper tail of chi-square for integer df, by its finite recurrence."""
    if x is None or df is None or math.isnan(x) or df < 1:
        return float("nan")
    h = x / 2
    if df % 2:
        tail, k = math.erfc(math.sqrt(h)), 1
    else:
        tail, k = math.exp(-h), 2
    while k < df:
        tail += math.exp(k / 2 * math.log(h) - h - math.lgamma(k / 2 + 1)) if h > 0 else 0.0
        k += 2
    return tail


def t_cdf(t: float, df: int) -> float:
    """Student t distribution for integer df, by its finite trigonometric series."""
    theta = math.atan2(t, math.sqrt(df))
    c2 = math.cos(theta) ** 2
    if df % 2:
        term = math.cos(theta)
        total = term if df > 1 else 0.0
        for k in range(3, df - 1, 2):
            term *= c2 * (k - 1) / k
            total += term
        area = 2 / math.pi * (theta + math.sin(theta) * total)
    else:
        term = total = 1.0
        for k in range(2, df - 1, 2):
            term *= c2 * (k - 1) / k
            total += term
        area = math.sin(theta) * total
    return 0.5 + area / 2


def t_quantile(df: int, z: float = Z95) -> float:
    """97.5 % point of Student t (two-sided 95 %)."""
    if df is None or df < 1:
        return float("nan")
    if df > 300:
        z3, z5, z7 = z ** 3, z ** 5, z ** 7
        return (z + (z3 + z) / (4 * df) + (5 * z5 + 16 * z3 + 3 * z) / (96 * df ** 2)
                + (3 * z7 + 19 * z5 + 17 * z3 - 15 * z) / (384 * df ** 3))
    lo, hi = 0.0, 20.0
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if t_cdf(mid, df) < 0.975 else (lo, mid)
    return (lo + hi) / 2


@F.pandas_udf(DoubleType())
def chi2_p(x: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([chi2_tail(a, int(b)) for a, b in zip(x, df)])


@F.pandas_udf(DoubleType())
def normal_p(z: pd.Series) -> pd.Series:
    """Two-sided normal p value."""
    return z.map(lambda v: math.erfc(abs(v) / math.sqrt(2)))


@F.pandas_udf(DoubleType())
def t_point(df: pd.Series) -> pd.Series:
    return df.map(lambda v: t_quantile(int(v)) if v == v and v >= 1 else float("nan"))

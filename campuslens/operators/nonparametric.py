"""Rank tests, contingency tests and corrections from histograms and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campuslens.functions.stats import chi2_p, cliff_band, normal_p
from campuslens.operators.running import average_rank, histogram, running_sums


def mann_whitney(df: DataFrame, group: list[str], value: str, first: Column,
                 small_domain: bool = False) -> DataFrame:
    """U of the first sample against the rest, Cliff's delta, and the tie-corrected z."""
    rows = df.withColumn("_x", first).where(F.col("_x").isNotNull())
    hist = histogram(rows, group, value, x=F.col("_x").cast("int"), n=F.lit(1))
    ranked = running_sums(hist, group, value, ["n"], small_domain)
    n, x = F.col("n").cast("double"), F.col("x")
    sums = ranked.groupBy(*group).agg(
        F.sum(x * average_rank("n")).alias("_r"), F.sum(x).alias("n1"), F.sum("n").alias("_n"),
        F.sum(n * n * n - n).alias("_ties"))
    n1, total = F.col("n1").cast("double"), F.col("_n").cast("double")
    n2 = total - n1
    out = sums.withColumn("n2", (F.col("_n") - F.col("n1")))
    out = out.withColumn("u", F.col("_r").cast("double") - n1 * (n1 + 1) / 2)
    out = out.withColumn("delta", F.when(n1 * n2 > 0, 2 * F.col("u") / (n1 * n2) - 1))
    sd = F.sqrt(n1 * n2 / 12 * (total + 1 - F.col("_ties") / (total * (total - 1))))
    top = F.greatest(F.col("u"), n1 * n2 - F.col("u")) - n1 * n2 / 2 - 0.5
    return out.withColumn("z", F.when(sd > 0, F.greatest(top, F.lit(0.0)) / sd)).withColumn(
        "magnitud", cliff_band(F.col("delta"))).drop("_r", "_n", "_ties")


def with_normal_p(df: DataFrame, z: str = "z", name: str = "p") -> DataFrame:
    """Two-sided p of a small result."""
    return df.withColumn(name, normal_p(F.coalesce(F.col(z), F.lit(0.0))))


def wilcoxon_signed(df: DataFrame, group: list[str], difference: Column,
                    small_domain: bool = False) -> DataFrame:
    """Signed ranks of the non-zero differences: W+, W-, T, rank-biserial r and z."""
    rows = df.withColumn("_d", difference).where(F.col("_d") != 0)
    rows = rows.withColumn("_abs", F.abs("_d"))
    hist = histogram(rows, group, "_abs", n=F.lit(1), pos=(F.col("_d") > 0).cast("int"))
    ranked = running_sums(hist, group, "_abs", ["n"], small_domain)
    n, rank = F.col("n").cast("double"), average_rank("n")
    out = ranked.groupBy(*group).agg(
        F.sum("n").alias("n"), F.sum(F.col("pos") * rank).cast("double").alias("w_mas"),
        F.sum((F.col("n") - F.col("pos")) * rank).cast("double").alias("w_menos"),
        F.sum(n * n * n - n).alias("_ties"))
    n = F.col("n").cast("double")
    sd = F.sqrt(n * (n + 1) * (2 * n + 1) / 24 - F.col("_ties") / 48)
    low = F.least("w_mas", "w_menos")
    return out.withColumns({
        "t": low,
        "r_rb": (F.col("w_mas") - F.col("w_menos")) / (F.col("w_mas") + F.col("w_menos")),
        "z": F.when(sd > 0, (low - n * (n + 1) / 4) / sd),
    }).drop("_ties")


def friedman(df: DataFrame, group: list[str], measures: list[str]) -> DataFrame:
    """Friedman chi-square over complete rows, Kendall's W; p in closed form for three measures."""
    k = len(measures)
    rows = df.dropna(subset=measures)
    ranks, ties = [], F.lit(0.0)
    for a in measures:
        below, same = F.lit(0.0), F.lit(0.0)
        for b in measures:
            if a != b:
                below = below + (F.col(b) < F.col(a)).cast("double")
                same = same + (F.col(b) == F.col(a)).cast("double")
        ranks.append(1 + below + same / 2)
        ties = ties + (same + 1) * (same + 1) - 1
    sums = rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.sum(ties).alias("_t"),
        *[F.sum(r).alias(f"_r{i}") for i, r in enumerate(ranks)])
    n = F.col("n").cast("double")
    squares = sum((F.col(f"_r{i}") * F.col(f"_r{i}") for i in range(k)), F.lit(0.0))
    raw = 12 / (k * n * (k + 1)) * squares - 3 * n * (k + 1)
    correction = 1 - F.col("_t") / (n * k * (k * k - 1))
    out = sums.withColumn("chi2", raw / correction)
    out = out.withColumn("kendall_w", F.col("chi2") / (n * (k - 1)))
    if k == 3:
        out = out.withColumn("p", F.exp(-F.col("chi2") / 2))
    return out.drop("_t", *[f"_r{i}" for i in range(k)])


def chi_square(df: DataFrame, group: list[str], row: str, column: str) -> DataFrame:
    """Pearson chi-square without continuity correction and Cramér's V per group, from
    contingency counts. Margins are sums of the counts, cells without rows enter as expected."""
    cells = df.groupBy(*group, row, column).agg(F.count(F.lit(1)).alias("o"))
    w = Window.partitionBy
    sized = cells.withColumns({
        "_r": F.sum("o").over(w(*group, row)), "_c": F.sum("o").over(w(*group, column))})
    # sum (o-e)^2/e over all cells = N * (sum o^2/(r*c) - 1); empty cells add nothing to it
    o = F.col("o").cast("double")
    out = sized.groupBy(*group).agg(
        F.sum("o").alias("n"), F.sum(o * o / (F.col("_r") * F.col("_c"))).alias("_s"),
        F.countDistinct(row).alias("_rows"), F.countDistinct(column).alias("_cols"))
    n = F.col("n").cast("double")
    least = F.least(F.col("_rows"), F.col("_cols")) - 1
    return out.withColumns({
        "chi2": n * (F.col("_s") - 1),
        "gl": ((F.col("_rows") - 1) * (F.col("_cols") - 1)).cast("int"),
    }).withColumn("v_cramer", F.when(least > 0, F.sqrt(
        F.greatest(F.col("chi2"), F.lit(0.0)) / (n * least)))).drop("_s", "_rows", "_cols")


def with_chi2_p(df: DataFrame, chi2: str = "chi2", degrees: str = "gl", name: str = "p"):
    return df.withColumn(name, chi2_p(F.col(chi2), F.col(degrees)))


def holm_adjust(df: DataFrame, family: list[str], p: str = "p", name: str = "p_holm",
                tie: list[str] = []) -> DataFrame:
    """Step-down Holm correction inside each family of tests."""
    ordered = Window.partitionBy(*family).orderBy(p, *tie)
    size = F.count(F.lit(1)).over(Window.partitionBy(*family))
    step = F.least(F.lit(1.0), (size - F.row_number().over(ordered) + 1) * F.col(p))
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("_step", step).withColumn(name, F.max("_step").over(upto)).drop("_step")


def compare_groups(df: DataFrame, group: str, above: str, ordinal: list[str],
                   binary: list[str]) -> DataFrame:
    """Above against below the mean, per subject and variable, in one long pass:
    Mann-Whitney and Cliff's delta for ordered variables, chi-square and V for flags."""
    def long(columns):
        return df.where(F.col(above).isNotNull()).select(
            group, above, F.explode(F.array(*[
                F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("valor"))
                for c in columns])).alias("x")).select(group, above, "x.*")
    keys = [group, "variable"]
    ranks = mann_whitney(long(ordinal), keys, "valor", F.col(above))
    ranked = ranks.select(*keys, F.lit("Mann-Whitney U").alias("prueba"),
                          F.col("n1").alias("n_sobre"), F.col("n2").alias("n_bajo"),
                          F.col("u").alias("estadistico"), F.col("delta").alias("valor_efecto"),
                          "magnitud", "z", F.lit(None).cast("int").alias("gl"))
    flags = long(binary)
    sides = flags.groupBy(*keys).agg(F.count_if(F.col(above)).alias("n_sobre"),
                                     F.count_if(~F.col(above)).alias("n_bajo"))
    chi = chi_square(flags, keys, above, "valor").join(sides, keys).select(
        *keys, F.lit("Chi-cuadrado").alias("prueba"), "n_sobre", "n_bajo",
        F.col("chi2").alias("estadistico"), F.col("v_cramer").alias("valor_efecto"),
        F.lit("").alias("magnitud"), F.lit(None).cast("double").alias("z"), "gl")
    return ranked.unionByName(chi)


def comparison_p(df: DataFrame) -> DataFrame:
    """p values of a comparison table and their Holm correction per subject."""
    p = F.when(F.col("prueba") == "Chi-cuadrado",
               chi2_p(F.coalesce("estadistico", F.lit(0.0)), F.coalesce("gl", F.lit(1)))) \
        .otherwise(normal_p(F.coalesce("z", F.lit(0.0))))
    return holm_adjust(df.withColumn("p", p), ["asignatura"], tie=["variable"])

"""Entity resolution between two files without a shared key.

Rows collapse to distinct profiles (block key + comparison attributes) with a count per
file, so copies never multiply. The distance "number of differing attributes" is a metric:
by the triangle inequality some optimal 1:1 assignment pairs equal profiles first. Those
pairs need no comparison at all; what is left on both sides of a block is small and goes
to an exact solver, block by block. No block is cut short."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campuslens.operators.running import dense_numbers
from campuslens.session import materialise, spark_cores


def profiles(rows: DataFrame, side: Column, row_id: str, columns: list[str]) -> DataFrame:
    """Distinct profiles with rows per file and the smallest row id per file; ``side`` is true
    for the first file."""
    return rows.groupBy(*columns).agg(
        F.count_if(side).alias("n_a"), F.count_if(~side).alias("n_b"),
        F.min(F.when(side, F.col(row_id))).alias("fila_a"),
        F.min(F.when(~side, F.col(row_id))).alias("fila_b"))


def blocks(rows: DataFrame, side: Column, keys: list[str]) -> DataFrame:
    """Keys present in both files with their candidate counts."""
    return (rows.groupBy(*keys).agg(F.count_if(side).alias("candidatos_a"),
                                    F.count_if(~side).alias("candidatos_b"))
            .where((F.col("candidatos_a") > 0) & (F.col("candidatos_b") > 0)))


def naive_merge_size(rows: DataFrame, side: Column, keys: list[str]) -> DataFrame:
    """Rows of an unguarded merge on the key, and the number of common keys."""
    both = blocks(rows, side, keys)
    return both.agg(
        F.coalesce(F.sum(F.col("candidatos_a") * F.col("candidatos_b")), F.lit(0))
        .cast("bigint").alias("filas_merge"), F.count(F.lit(1)).alias("claves_comunes"))


def assign(score: np.ndarray, supply: np.ndarray, demand: np.ndarray) -> np.ndarray:
    """Units moved between profiles with multiplicities: min(sum supply, sum demand) units with
    the largest total score, by shortest augmenting paths with potentials."""
    cost = (score.max(initial=0) - score).astype("int64")
    p, q = cost.shape
    flow = np.zeros((p, q), dtype="int64")
    supply, demand = supply.astype("int64").copy(), demand.astype("int64").copy()
    far = np.iinfo("int64").max // 4
    pot_row, pot_col = np.zeros(p, dtype="int64"), cost.min(axis=0, initial=far)
    while supply.any() and demand.any():
        dist_row, dist_col = np.where(supply > 0, -pot_row, far), np.full(q, far)
        from_row, from_col = np.full(q, -1), np.full(p, -1)
        open_row, open_col = np.ones(p, bool), np.ones(q, bool)
        while True:
            near_row = np.where(open_row, dist_row, far)
            near_col = np.where(open_col, dist_col, far)
            i, j = int(near_row.argmin()), int(near_col.argmin())
            if min(near_row[i], near_col[j]) >= far:
                break
            if near_row[i] <= near_col[j]:
                open_row[i] = False
                via = dist_row[i] + cost[i] + pot_row[i] - pot_col
                better = open_col & (via < dist_col)
                dist_col[better], from_row[better] = via[better], i
            else:
                open_col[j] = False
                via = dist_col[j] - cost[:, j] - pot_row + pot_col[j]
                better = open_row & (flow[:, j] > 0) & (via < dist_row)
                dist_row[better], from_col[better] = via[better], j
        pot_row += np.where(dist_row < far, dist_row, 0)
        pot_col += np.where(dist_col < far, dist_col, 0)
        end = j = int(np.where(demand > 0, pot_col, far).argmin())
        path, units = [], int(demand[end])
        while True:
            i = int(from_row[j])
            path.append((i, j, 1))
            if from_col[i] < 0:
                break
            j = int(from_col[i])
            path.append((i, j, -1))
            units = min(units, int(flow[i, j]))
        units = min(units, int(supply[i]))
        for a, b, sign in path:
            flow[a, b] += sign * units
        supply[i] -= units
        demand[end] -= units
    return flow


EVIDENCE = ["fila_a", "fila_b", "coincidencias", "n_pares", "aceptado", "candidatos_a",
            "candidatos_b", "etapa"]


BLOCKS_PER_GROUP = 2_000


def _solve_one(rows: list[tuple], threshold: int) -> list[tuple]:
    """Assignment inside one block; a row is (attributes, n_a, n_b, fila_a, fila_b)."""
    left = [r for r in rows if r[1] > r[2]]
    right = [r for r in rows if r[2] > r[1]]

    def agreement(a, b):
        return sum(x == y for x, y in zip(a[0], b[0]))
    score = np.array([[agreement(a, b) for b in right] for a in left])
    flow = assign(score, np.array([r[1] - r[2] for r in left]),
                  np.array([r[2] - r[1] for r in right]))
    total_a, total_b = sum(r[1] for r in rows), sum(r[2] for r in rows)
    out = []
    for i, j in zip(*np.nonzero(flow)):
        a, b, s = left[i], right[j], int(score[i, j])
        once = s >= threshold and sum(r[2] for r in rows if agreement(a, r) == s) == 1 \
            and sum(r[1] for r in rows if agreement(b, r) == s) == 1
        out.append((a[3] if a[1] == 1 else None, b[4] if b[2] == 1 else None, s,
                    int(flow[i, j]), bool(once), int(total_a), int(total_b), 2))
    return out


def _solve_blocks(keys: list[str], attributes: list[str], threshold: int):
    """Solver for a batch of whole blocks (many are tiny, so one call takes many)."""
    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        plain = pdf.astype(object).where(pdf.notna(), None)
        found: dict[tuple, list] = {}
        columns = [plain[c].tolist() for c in
                   [*keys, *attributes, "n_a", "n_b", "fila_a", "fila_b"]]
        width = len(keys)
        for row in zip(*columns):
            found.setdefault(row[:width], []).append((row[width:-4], *row[-4:]))
        out = []
        for key, rows in found.items():
            rows.sort(key=lambda r: (r[3] is None, r[3] or 0, r[4] or 0))
            out.extend((*key, *e) for e in _solve_one(rows, threshold))
        result = pd.DataFrame(out, columns=keys + EVIDENCE)
        return result.astype({"fila_a": "Int64", "fila_b": "Int64"})
    return solve


def identity_evidence(rows: DataFrame, side: Column, row_id: str, keys: list[str],
                      attributes: list[str], threshold: int) -> DataFrame:
    """Evidence per assigned pair of profiles: score, pairs, candidates, stage, accepted.

    Accepted when the score reaches the threshold and occurs once in its row and column.
    ``n_pares`` is above one only for copies, which are never accepted; their row ids stay
    null because any copy could stand for the other."""
    every = profiles(rows, side, row_id, keys + attributes)
    summary = every.groupBy(*keys).agg(
        F.sum("n_a").alias("candidatos_a"), F.sum("n_b").alias("candidatos_b"),
        F.sum(F.greatest(F.col("n_a") - F.col("n_b"), F.lit(0))).alias("_resto_a"),
        F.sum(F.greatest(F.col("n_b") - F.col("n_a"), F.lit(0))).alias("_resto_b"),
        *[F.max(F.when(F.col("n_a") > 0, F.struct(c))).alias(f"_a_{c}") for c in attributes],
        *[F.max(F.when(F.col("n_b") > 0, F.struct(c))).alias(f"_b_{c}") for c in attributes],
        F.min("fila_a").alias("fila_a"), F.min("fila_b").alias("fila_b"),
    ).where((F.col("candidatos_a") > 0) & (F.col("candidatos_b") > 0))
    single = (F.col("candidatos_a") == 1) & (F.col("candidatos_b") == 1)
    stage = F.when(single, 1).otherwise(2)
    full = len(attributes)

    # both files hold the same profile: paired without comparing anything
    equal = every.where((F.col("n_a") > 0) & (F.col("n_b") > 0)).join(
        summary.select(*keys, "candidatos_a", "candidatos_b"), keys)
    alone = (F.col("n_a") == 1) & (F.col("n_b") == 1)
    equal = equal.select(
        *keys, F.when(F.col("n_a") == 1, F.col("fila_a")).alias("fila_a"),
        F.when(F.col("n_b") == 1, F.col("fila_b")).alias("fila_b"),
        F.lit(full).alias("coincidencias"), F.least("n_a", "n_b").alias("n_pares"),
        (alone & F.lit(full >= threshold)).alias("aceptado"), "candidatos_a", "candidatos_b",
        stage.alias("etapa"))

    # one row per file and they differ: a plain comparison
    agreement = F.lit(0)
    for c in attributes:
        agreement = agreement + F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}")).cast("int")
    ones = summary.where(single & (F.col("_resto_a") > 0) & (F.col("_resto_b") > 0)).select(
        *keys, "fila_a", "fila_b", agreement.alias("coincidencias"),
        F.lit(1).cast("bigint").alias("n_pares"), (agreement >= threshold).alias("aceptado"),
        "candidatos_a", "candidatos_b", F.lit(1).alias("etapa"))

    # several candidates left on both sides: exact assignment over the distinct profiles
    open_blocks = summary.where(~single & (F.col("_resto_a") > 0) & (F.col("_resto_b") > 0))
    fields = [every.schema[k] for k in keys]
    schema = T.StructType(fields + [
        T.StructField("fila_a", T.LongType()), T.StructField("fila_b", T.LongType()),
        T.StructField("coincidencias", T.IntegerType()), T.StructField("n_pares", T.LongType()),
        T.StructField("aceptado", T.BooleanType()), T.StructField("candidatos_a", T.LongType()),
        T.StructField("candidatos_b", T.LongType()), T.StructField("etapa", T.IntegerType())])
    contested = materialise(every.join(open_blocks.select(*keys), keys, "left_semi"), "contested")
    groups = max(contested.count() // BLOCKS_PER_GROUP, spark_cores(rows))
    several = contested.groupBy(F.pmod(F.xxhash64(*keys), F.lit(groups)).alias("_g")) \
        .applyInPandas(_solve_blocks(keys, attributes, threshold), schema)
    return equal.unionByName(ones).unionByName(several)


def identity_ids(rows: DataFrame, side: Column, row_id: str, evidence: DataFrame,
                 name: str = "estudiante_id") -> DataFrame:
    """Ids 1..n for the second file in file order; accepted partners inherit; the other rows
    of the first file continue the numbering."""
    second = dense_numbers(rows.where(~side), row_id, name)
    pairs = materialise(evidence.where("aceptado").select("fila_a", "fila_b"), "pairs")
    inherited = pairs.join(second.select(F.col(row_id).alias("fila_b"), name), "fila_b")
    first = rows.where(side)
    paired = first.join(inherited.select(F.col("fila_a").alias(row_id), name), row_id)
    start = rows.where(~side).count()
    alone = first.join(pairs.select(F.col("fila_a").alias(row_id)), row_id, "left_anti")
    fresh = dense_numbers(alone, row_id, name).withColumn(name, F.col(name) + start)
    return second.unionByName(paired).unionByName(fresh)


def unmatched(rows: DataFrame, side: Column, row_id: str, evidence: DataFrame) -> DataFrame:
    """Rows of both files that are in no accepted pair."""
    taken = evidence.where("aceptado").select(F.explode(F.array(
        F.struct(F.lit(True).alias("_a"), F.col("fila_a").alias(row_id)),
        F.struct(F.lit(False).alias("_a"), F.col("fila_b").alias(row_id)))).alias("x")).select("x.*")
    return rows.withColumn("_a", side).join(taken, ["_a", row_id], "left_anti") \
        .select(*rows.columns)


def near_misses(rows: DataFrame, side: Column, row_id: str, columns: list[str]) -> DataFrame:
    """Profiles of the two files agreeing on all columns but exactly one.

    Every profile is keyed once per column by its other columns; two profiles meet only when
    they agree on all the rest, so each meeting is a result and no pair is compared in vain."""
    every = profiles(rows, side, row_id, columns)
    keyed = []
    for c in columns:
        others = [x for x in columns if x != c]
        keyed.append(F.struct(F.lit(c).alias("atributo_distinto"),
                              F.col(c).cast("string").alias("valor"),
                              F.xxhash64(F.lit(c), *others).alias("_h"),
                              F.to_json(F.struct(*others), {"ignoreNullFields": "false"})
                              .alias("_resto")))
    cells = every.select("n_a", "n_b", "fila_a", "fila_b", F.explode(F.array(*keyed)).alias("x")) \
        .select("n_a", "n_b", "fila_a", "fila_b", "x.*")
    on = ["atributo_distinto", "_h", "_resto"]
    left = cells.where(F.col("n_a") > 0).select(*on, F.col("valor").alias("valor_a"), "fila_a",
                                                F.col("n_a").alias("filas_a"))
    right = cells.where(F.col("n_b") > 0).select(*on, F.col("valor").alias("valor_b"), "fila_b",
                                                 F.col("n_b").alias("filas_b"))
    return left.join(right, on).where(~F.col("valor_a").eqNullSafe(F.col("valor_b"))).select(
        "fila_a", "fila_b", "atributo_distinto", "valor_a", "valor_b", "filas_a", "filas_b")


def survivorship(rows: DataFrame, entity: str, rank: Column, columns: list[str]) -> DataFrame:
    """One row per entity; the file with the lower rank prevails."""
    best = F.min(F.struct(rank.alias("_r"), *columns)).alias("_x")
    return rows.groupBy(entity).agg(best).select(entity, *[F.col(f"_x.{c}").alias(c)
                                                           for c in columns])


def survivorship_conflicts(rows: DataFrame, entity: str, columns: list[str]) -> DataFrame:
    """Attributes that differ between the rows of one entity, counted per attribute."""
    spread = rows.groupBy(entity).agg(*[
        (F.coalesce(F.min(c) != F.max(c), F.lit(False))
         | (F.count(c).between(1, F.count(F.lit(1)) - 1))).alias(c) for c in columns])
    one = spread.agg(*[F.count_if(F.col(c)).alias(c) for c in columns])
    cells = [F.struct(F.lit(c).alias("atributo"), F.col(c).alias("conflictos")) for c in columns]
    return one.select(F.explode(F.array(*cells)).alias("x")).select("x.*")

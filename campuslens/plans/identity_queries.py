"""Registered queries for entity resolution: two part registers without a shared key."""

from __future__ import annotations

from pyspark.sql import functions as F

from campuslens.operators import identity as I
from campuslens.operators.running import dense_numbers
from campuslens.plans import testbed as B
from campuslens.plans.registry import query

KEYS = ["k1", "k2", "k3"]
ATTRIBUTES = ["d1", "d2", "d3"]
THRESHOLD = 2
SIDE = "archivo"

_AGREE = " + ".join(f"CAST(a.{c} = b.{c} AS INTEGER)" for c in ATTRIBUTES)
_ALL = " + ".join(f"CAST(a.{c} = b.{c} AS INTEGER)" for c in KEYS + ATTRIBUTES)
B.CTES["bloques"] = (["registros"], """
    SELECT k1, k2, k3, count(*) FILTER (WHERE archivo = 'A') AS candidatos_a,
      count(*) FILTER (WHERE archivo = 'B') AS candidatos_b FROM registros GROUP BY ALL
    HAVING count(*) FILTER (WHERE archivo = 'A') > 0 AND count(*) FILTER (WHERE archivo = 'B') > 0""")
B.CTES["parejas"] = (["registros", "bloques"], f"""
    SELECT *, s >= {THRESHOLD} AND count(*) OVER (PARTITION BY k1, k2, k3, fa, s) = 1
      AND count(*) OVER (PARTITION BY k1, k2, k3, fb, s) = 1 AS clara FROM (
      SELECT k1, k2, k3, candidatos_a, candidatos_b, a.fila AS fa, b.fila AS fb, {_AGREE} AS s,
        dense_rank() OVER (PARTITION BY k1, k2, k3 ORDER BY CASE WHEN candidatos_a <= candidatos_b THEN a.fila ELSE b.fila END) AS turno,
        CASE WHEN candidatos_a <= candidatos_b THEN b.fila ELSE a.fila END AS otra
      FROM registros a JOIN registros b USING (k1, k2, k3) JOIN bloques USING (k1, k2, k3)
      WHERE a.archivo = 'A' AND b.archivo = 'B')""")
# every way to give each row of the smaller file a row of the larger one, block by block
B.CTES["optimos"] = (["bloques", "parejas"], """
    WITH RECURSIVE elegir AS (
      SELECT k1, k2, k3, 0 AS i, least(candidatos_a, candidatos_b) AS m, [CAST(-1 AS BIGINT)] AS usadas, 0 AS total,
        CAST([] AS STRUCT(fa BIGINT, fb BIGINT, s INTEGER, clara BOOLEAN)[]) AS hechas FROM bloques
      UNION ALL SELECT k1, k2, k3, i + 1, m, list_append(usadas, otra), total + s,
        list_append(hechas, struct_pack(fa := fa, fb := fb, s := CAST(s AS INTEGER), clara := clara))
      FROM elegir JOIN parejas USING (k1, k2, k3) WHERE turno = i + 1 AND NOT list_contains(usadas, otra))
    SELECT k1, k2, k3, m, max(total) AS total, arg_max(hechas, total) AS hechas FROM elegir WHERE i = m GROUP BY ALL""")
B.CTES["aceptadas"] = (["optimos"], """
    SELECT k1, k2, k3, p.fa AS fila_a, p.fb AS fila_b, p.s AS coincidencias
    FROM (SELECT k1, k2, k3, unnest(hechas) AS p FROM optimos) WHERE p.clara""")
B.CTES["sin_pareja"] = (["registros", "aceptadas"], """
    SELECT * FROM registros WHERE CASE archivo WHEN 'A' THEN fila NOT IN (SELECT fila_a FROM aceptadas)
      ELSE fila NOT IN (SELECT fila_b FROM aceptadas) END""")


def first_file():
    return F.col(SIDE) == "A"


def evidence(spark, sf):
    return I.identity_evidence(B.registers(spark, sf), first_file(), "fila", KEYS, ATTRIBUTES,
                               THRESHOLD)


@query("naive_merge_size", B.sql("""
    SELECT CAST(sum(candidatos_a * candidatos_b) AS BIGINT) AS filas_merge, count(*) AS claves_comunes FROM bloques""",
    "bloques"))
def naive_merge_size(spark, sf):
    return I.naive_merge_size(B.registers(spark, sf), first_file(), KEYS)


@query("identity_candidates", B.sql("SELECT * FROM bloques", "bloques"))
def identity_candidates(spark, sf):
    return I.blocks(B.registers(spark, sf), first_file(), KEYS)


@query("identity_pairs_single", B.sql(f"""
    SELECT k1, k2, k3, a.fila AS fila_a, b.fila AS fila_b, {_AGREE} AS coincidencias, {_AGREE} >= {THRESHOLD} AS aceptado
    FROM registros a JOIN registros b USING (k1, k2, k3) JOIN bloques USING (k1, k2, k3)
    WHERE a.archivo = 'A' AND b.archivo = 'B' AND candidatos_a = 1 AND candidatos_b = 1""", "registros", "bloques"))
def identity_pairs_single(spark, sf):
    """Stage 1: one candidate per file."""
    return evidence(spark, sf).where("etapa = 1").select(
        *KEYS, "fila_a", "fila_b", "coincidencias", "aceptado")


@query("identity_pairs")
def identity_pairs(spark, sf):
    """Both stages, with the exact assignment in the ambiguous blocks."""
    return evidence(spark, sf)


@query("identity_totals", B.sql("""
    SELECT k1, k2, k3, CAST(m AS BIGINT) AS pares, CAST(total AS BIGINT) AS coincidencias FROM optimos""", "optimos"))
def identity_totals(spark, sf):
    """Pairs and total agreement of the assignment in every block; the SQL tries all assignments."""
    return evidence(spark, sf).groupBy(*KEYS).agg(
        F.sum("n_pares").alias("pares"),
        F.sum(F.col("coincidencias") * F.col("n_pares")).alias("coincidencias"))


@query("identity_accepted", B.sql("SELECT * FROM aceptadas", "aceptadas"))
def identity_accepted(spark, sf):
    """Pairs that reach the threshold with a score that is theirs alone in row and column."""
    return evidence(spark, sf).where("aceptado").select(*KEYS, "fila_a", "fila_b", "coincidencias")


@query("identity_ids", B.sql("""
    SELECT 'B' AS archivo, fila, row_number() OVER (ORDER BY fila) AS estudiante_id FROM registros WHERE archivo = 'B'""",
    "registros"))
def identity_ids(spark, sf):
    """Ids of the second file in file order."""
    second = B.registers(spark, sf).where(~first_file())
    return dense_numbers(second, "fila", "estudiante_id").select("archivo", "fila", "estudiante_id")


@query("identity_resolution", B.sql("""
    SELECT archivo, fila, row_number() OVER (ORDER BY fila) AS estudiante_id FROM registros WHERE archivo = 'B'
    UNION ALL SELECT 'A', fila_a, n FROM aceptadas JOIN (
      SELECT fila AS fila_b, row_number() OVER (ORDER BY fila) AS n FROM registros WHERE archivo = 'B') USING (fila_b)
    UNION ALL SELECT archivo, fila, row_number() OVER (ORDER BY fila) + (SELECT count(*) FROM registros WHERE archivo = 'B')
    FROM sin_pareja WHERE archivo = 'A'""", "registros", "aceptadas", "sin_pareja"))
def identity_resolution(spark, sf):
    """Every row of both files with its id."""
    rows = B.registers(spark, sf)
    return I.identity_ids(rows, first_file(), "fila", evidence(spark, sf)).select(
        "archivo", "fila", "estudiante_id")


@query("identity_near_miss", B.sql(f"""
    SELECT min(a.fila) AS fila_a, min(b.fila) AS fila_b, atributo AS atributo_distinto, va AS valor_a, vb AS valor_b,
      count(DISTINCT a.fila) AS filas_a, count(DISTINCT b.fila) AS filas_b FROM (
      SELECT a, b, {' '.join(['CASE'] + [f"WHEN a.{c} <> b.{c} THEN '{c}'" for c in KEYS + ATTRIBUTES] + ['END'])} AS atributo,
        {' '.join(['CASE'] + [f"WHEN a.{c} <> b.{c} THEN a.{c}" for c in KEYS + ATTRIBUTES] + ['END'])} AS va,
        {' '.join(['CASE'] + [f"WHEN a.{c} <> b.{c} THEN b.{c}" for c in KEYS + ATTRIBUTES] + ['END'])} AS vb
      FROM sin_pareja a JOIN sin_pareja b ON a.archivo = 'A' AND b.archivo = 'B' AND {_ALL} = {len(KEYS + ATTRIBUTES) - 1})
    GROUP BY atributo, va, vb, {', '.join(f'CASE WHEN atributo <> {chr(39)}{c}{chr(39)} THEN a.{c} END' for c in KEYS + ATTRIBUTES)}""",
    "sin_pareja"))
def identity_near_miss(spark, sf):
    """R-12b: only rows without an accepted partner can be missed pairs."""
    rows = I.unmatched(B.registers(spark, sf), first_file(), "fila", evidence(spark, sf))
    return I.near_misses(rows, first_file(), "fila", KEYS + ATTRIBUTES)


B.CTES["marcas"] = ([], """
    SELECT p_brand AS entidad, CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS rango, p_partkey, p_type, p_size,
      p_name FROM part""")


def brands(spark, sf):
    return B.table(spark, sf, "part").select(
        F.col("p_brand").alias("entidad"),
        F.when(F.col("p_partkey") % 2 == 0, 1).otherwise(0).alias("rango"),
        "p_partkey", "p_type", "p_size", "p_name")


@query("survivorship", B.sql("""
    SELECT entidad, p_partkey, p_type, p_size, p_name FROM (SELECT *,
      row_number() OVER (PARTITION BY entidad ORDER BY rango, p_partkey) AS rn FROM marcas) WHERE rn = 1""", "marcas"))
def survivorship(spark, sf):
    """One row per brand; the file with the lower rank prevails."""
    return I.survivorship(brands(spark, sf), "entidad", F.col("rango"),
                          ["p_partkey", "p_type", "p_size", "p_name"])


@query("survivorship_conflicts", B.sql("""
    SELECT atributo, conflictos FROM (SELECT count(*) FILTER (WHERE t > 1) AS t, count(*) FILTER (WHERE s > 1) AS s,
      count(*) FILTER (WHERE n > 1) AS n FROM (SELECT o_custkey, count(DISTINCT o_orderstatus) AS t,
        count(DISTINCT o_orderpriority) AS s, count(DISTINCT o_orderdate) AS n FROM orders GROUP BY o_custkey)) x,
      LATERAL (VALUES ('o_orderstatus', t), ('o_orderpriority', s), ('o_orderdate', n)) v(atributo, conflictos)"""))
def survivorship_conflicts(spark, sf):
    rows = B.table(spark, sf, "orders")
    return I.survivorship_conflicts(rows, "o_custkey",
                                    ["o_orderstatus", "o_orderpriority", "o_orderdate"])

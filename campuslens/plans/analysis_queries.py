"""Registered queries on the analytic dataset: descriptives, tests, risk profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campuslens.functions.stats import wilson
from campuslens.operators import bootstrap as S
from campuslens.operators import capacity as Z
from campuslens.operators import checks as K
from campuslens.operators import dataset as A
from campuslens.operators import documents as D
from campuslens.operators import nonparametric as N
from campuslens.operators import outliers as O
from campuslens.operators import relational as R
from campuslens.operators import running as U
from campuslens.operators.split import grouped_folds
from campuslens.plans import testbed as B
from campuslens.plans.document_queries import cleaned, cleaned_sessions
from campuslens.plans.registry import query
from campuslens.session import materialise

B.CTES["integrada"] = (["ancha", "actividad", "tutorias", "alertas"], """
    SELECT a.*, coalesce(l.e1, 0) AS sim_lms_eventos_p1, coalesce(l.m1, 0) AS sim_lms_minutos_p1,
      coalesce(l.d1, 0) AS sim_lms_dias_activos_p1, coalesce(l.r1, 0) AS sim_lms_tareas_revisadas_p1,
      coalesce(l.et, 0) AS sim_lms_eventos_total, coalesce(l.mt, 0) AS sim_lms_minutos_total,
      coalesce(t.n, 0) AS sim_n_tutorias, coalesce(t.c, 0) AS sim_n_tutorias_completadas,
      coalesce(g.n, 0) AS sim_n_alertas, coalesce(g.x, 0) AS sim_nivel_alerta_max, coalesce(g.c, FALSE) AS sim_alerta_cerrada
    FROM ancha a
    LEFT JOIN (SELECT estudiante_id, asignatura, sum(n_eventos) FILTER (WHERE periodo = 'P1') AS e1,
        sum(minutos) FILTER (WHERE periodo = 'P1') AS m1, sum(dias_activos) FILTER (WHERE periodo = 'P1') AS d1,
        sum(n_tareas_revisadas) FILTER (WHERE periodo = 'P1') AS r1, sum(n_eventos) AS et, sum(minutos) AS mt
      FROM actividad GROUP BY ALL) l USING (estudiante_id, asignatura)
    LEFT JOIN (SELECT estudiante_id, asignatura, count(*) AS n, count(*) FILTER (WHERE resultado = 'completada') AS c
      FROM tutorias GROUP BY ALL) t USING (estudiante_id, asignatura)
    LEFT JOIN (SELECT estudiante_id, asignatura, count(*) AS n, bool_or(estado = 'cerrada') AS c,
        max(CASE nivel WHEN 'bajo' THEN 1 WHEN 'medio' THEN 2 WHEN 'alto' THEN 3 ELSE 0 END) AS x
      FROM alertas GROUP BY ALL) g USING (estudiante_id, asignatura)""")
B.CTES["firmas"] = (["integrada"], """
    SELECT estudiante_id, (row_number() OVER (PARTITION BY n, k ORDER BY h, estudiante_id) - 1) % 5 + 1 AS pliegue
    FROM (SELECT estudiante_id, count(*) AS n, count(*) FILTER (WHERE nota_p3 < 10) AS k,
      md5('42-' || CAST(estudiante_id AS VARCHAR)) AS h FROM integrada GROUP BY estudiante_id)""")
_TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "tinyint": "TINYINT", "smallint": "SMALLINT",
          "int": "INTEGER", "boolean": "BOOLEAN"}
B.CTES["datos"] = (["integrada", "firmas"], f"""
    SELECT {', '.join(f'CAST({v.name} AS {_TYPES[v.type]}) AS {v.name}' for v in A.DICTIONARY)} FROM (
      SELECT i.*, reprobaciones_previas = 3 AS reprobaciones_3mas,
        faltas > q.q3 + 3 * (q.q3 - q.q1) AS faltas_atipicas,
        CASE WHEN nota_p3 < 10 THEN 1 WHEN nota_p3 >= 10 THEN 0 END AS en_riesgo,
        CASE WHEN NOT no_evaluado_p3 THEN nota_p3 > q.media END AS rendimiento_sobre_promedio,
        CASE WHEN pliegue = 1 THEN 'test' ELSE 'train' END AS particion
      FROM integrada i
      JOIN (SELECT asignatura, quantile_cont(faltas, 0.25) AS q1, quantile_cont(faltas, 0.75) AS q3,
          avg(nota_p3) FILTER (WHERE NOT no_evaluado_p3) AS media FROM integrada GROUP BY asignatura) q USING (asignatura)
      JOIN firmas f USING (estudiante_id))""")
B.CTES["completos"] = (["datos"], """
    SELECT * FROM datos WHERE nota_p1 IS NOT NULL AND nota_p2 IS NOT NULL AND nota_p3 IS NOT NULL""")
B.CTES["factores"] = (["completos"], """
    SELECT d.*, faltas >= a3 AS f_inasistencia, reprobaciones_previas >= 1 AS f_reprob_previas,
      sim_lms_minutos_p1 <= m1 AS f_bajo_lms,
      CAST(faltas >= a3 AS INTEGER) + CAST(reprobaciones_previas >= 1 AS INTEGER) AS n_factores_reales
    FROM completos d JOIN (SELECT asignatura, quantile_cont(faltas, 0.75) AS a3,
      quantile_cont(sim_lms_minutos_p1, 0.25) AS m1 FROM completos GROUP BY asignatura) USING (asignatura)""")


def integrated(spark, sf) -> DataFrame:
    """Every enrolment with its behaviour aggregates; a period without a grade stays null."""
    return A.integrate(R.wide_enrolment(B.tables(spark, sf)), D.lms_activity(cleaned(spark, sf).clean, periods=B.ACTIVITY_PERIODS),
                       D.sessions_per_enrolment(B.sessions(spark, sf)),
                       D.alerts_per_enrolment(B.alerts(spark, sf)))


def dataset(spark, sf) -> DataFrame:
    """The analytic dataset as a stage table: every analysis below reads it several times."""
    return materialise(A.typed(A.derive(materialise(integrated(spark, sf), "integrada"))), "datos")


def evaluated(spark, sf) -> DataFrame:
    """Rows with all three grades, for rates, tests and models that need the outcome."""
    return dataset(spark, sf).dropna(subset=["nota_p1", "nota_p2", "nota_p3"])


def graded(spark, sf) -> DataFrame:
    """The rows of ``evaluated`` in the columns that the register alone gives."""
    return A.register_columns(R.wide_enrolment(B.tables(spark, sf))).dropna(subset=["nota_p1", "nota_p2", "nota_p3"])


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("analytic_dataset", B.sql("SELECT * FROM datos", "datos"))
def analytic_dataset(spark, sf):
    return dataset(spark, sf)


@query("data_dictionary")
def data_dictionary(spark, sf):
    return A.profile_dictionary(dataset(spark, sf))


@query("dataset_contract", B.sql(f"""
    SELECT x.* FROM (SELECT
      (SELECT count(*) FROM (SELECT 1 FROM datos GROUP BY estudiante_id, asignatura HAVING count(*) > 1)) AS claves,
      count(*) FILTER (WHERE {' OR '.join(f'{c} IS NULL' for c in A.REQUIRED)}) AS nulos,
      count(*) - count(*) FILTER (WHERE nota_p1 BETWEEN 0 AND 20 AND nota_p2 BETWEEN 0 AND 20 AND nota_p3 BETWEEN 0 AND 20) AS notas,
      count(*) - count(*) FILTER (WHERE en_riesgo = CAST(nota_p3 < 10 AS INTEGER)) AS riesgo,
      count(*) - count(*) FILTER (WHERE no_evaluado_p3 = (nota_p3 = 0)) AS evaluado,
      count(*) FILTER (WHERE least({', '.join(v.name for v in A.DICTIONARY if v.name.startswith('sim_') and v.type != 'boolean')}) < 0) AS sims,
      count(*) - count(*) FILTER (WHERE nota_p3 <= 12) AS alta FROM datos),
      LATERAL (VALUES ('clave duplicada', claves), ('nulos en obligatorias', nulos), ('notas', notas), ('en_riesgo', riesgo),
        ('no_evaluado', evaluado), ('sim', sims), ('nota_alta', alta)) x(control, valor)""", "datos"))
def dataset_contract(spark, sf):
    """Rows against the contract: those without all grades count in every control on grades; the last
    control is tighter on purpose."""
    sims = [v.name for v in A.DICTIONARY if v.name.startswith("sim_") and v.type != "boolean"]
    grades = [F.col(f"nota_p{i}").between(0, 20) for i in (1, 2, 3)]
    return K.dataset_contract(dataset(spark, sf), A.KEY, A.REQUIRED, {
        "notas": reduce(lambda a, b: a & b, grades),
        "en_riesgo": F.col("en_riesgo") == (F.col("nota_p3") < 10).cast("int"),
        "no_evaluado": F.col("no_evaluado_p3") == (F.col("nota_p3") == 0),
        "sim": reduce(lambda a, b: a & b, [F.col(c) >= 0 for c in sims]),
        "nota_alta": F.col("nota_p3") <= 12})


@query("outlier_fence", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_extendedprice > q3 + 0.5 * (q3 - q1) AS atipico
    FROM lineitem JOIN (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1,
      quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY l_returnflag) USING (l_returnflag)""")
def outlier_fence(spark, sf):
    """Prices have a wide domain: the quartiles come from sliced running sums."""
    rows = B.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                                 "l_returnflag", "l_extendedprice")
    return O.outlier_fence(rows, ["l_returnflag"], "l_extendedprice", "atipico", 0.5) \
        .drop("l_returnflag")


@query("above_mean_flag", B.sql("""
    SELECT estudiante_id, asignatura_id, periodo_id, CASE WHEN NOT no_evaluado THEN nota > media END AS sobre
    FROM calificacion JOIN (SELECT asignatura_id, avg(nota) FILTER (WHERE NOT no_evaluado) AS media
      FROM calificacion GROUP BY asignatura_id) USING (asignatura_id)""", "calificacion"))
def above_mean_flag(spark, sf):
    rows = B.calificacion(spark, sf)
    return O.above_mean_flag(rows, ["asignatura_id"], "nota", ~F.col("no_evaluado"), "sobre") \
        .select("estudiante_id", "asignatura_id", "periodo_id", "sobre")


@query("risk_factors", B.sql("""
    SELECT estudiante_id, asignatura, f_inasistencia, f_reprob_previas, f_bajo_lms, n_factores_reales,
      n_factores_reales + CAST(f_bajo_lms AS INTEGER) AS n_factores_total FROM factores""", "factores"))
def risk_factors(spark, sf):
    return O.risk_factors(evaluated(spark, sf)).select(
        *A.KEY, "f_inasistencia", "f_reprob_previas", "f_bajo_lms", "n_factores_reales",
        "n_factores_total")


def _wilson_sql(k: str, n: str) -> str:
    z = 1.959963984540054
    c = f"({k}::DOUBLE / {n} + {z * z} / (2 * {n})) / (1 + {z * z} / {n})"
    h = (f"{z} * sqrt({k}::DOUBLE / {n} * (1 - {k}::DOUBLE / {n}) / {n} + {z * z} / (4 * {n}::DOUBLE * {n}))"
         f" / (1 + {z * z} / {n})")
    return f"round({c} - {h}, 6) AS ic_lo, round({c} + {h}, 6) AS ic_hi"


def with_rate(df: DataFrame, k: str, n: str) -> DataFrame:
    lo, hi = wilson(F.col(k), F.col(n))
    return df.withColumns({"tasa": F.col(k) / F.col(n), "ic_lo": lo, "ic_hi": hi})


@query("risk_profiles", B.sql(f"""
    SELECT f_inasistencia, f_reprob_previas, f_bajo_lms, n, reprobados, round(reprobados / n, 6) AS tasa,
      {_wilson_sql('reprobados', 'n')}, pct_con_alerta, media_tutorias, pct_con_tutoria, pct_alerta_cerrada FROM (
      SELECT f_inasistencia, f_reprob_previas, f_bajo_lms, count(*) AS n, CAST(sum(en_riesgo) AS BIGINT) AS reprobados,
        round(avg(CAST(sim_n_alertas > 0 AS INTEGER)), 6) AS pct_con_alerta, round(avg(sim_n_tutorias), 6) AS media_tutorias,
        round(avg(CAST(sim_n_tutorias > 0 AS INTEGER)), 6) AS pct_con_tutoria,
        round(avg(CAST(sim_alerta_cerrada AS INTEGER)), 6) AS pct_alerta_cerrada
      FROM factores WHERE faltas_confiable GROUP BY ALL)""", "factores"))
def risk_profiles(spark, sf):
    """Three flags, rate with Wilson interval, behaviour averages; reliable absences only."""
    rows = O.risk_factors(evaluated(spark, sf)).where("faltas_confiable")
    out = rows.groupBy("f_inasistencia", "f_reprob_previas", "f_bajo_lms").agg(
        F.count(F.lit(1)).alias("n"), F.sum("en_riesgo").alias("reprobados"),
        F.avg((F.col("sim_n_alertas") > 0).cast("int")).alias("pct_con_alerta"),
        F.avg("sim_n_tutorias").alias("media_tutorias"),
        F.avg((F.col("sim_n_tutorias") > 0).cast("int")).alias("pct_con_tutoria"),
        F.avg(F.col("sim_alerta_cerrada").cast("int")).alias("pct_alerta_cerrada"))
    out = with_rate(out, "reprobados", "n")
    return rounded(out, "tasa", "ic_lo", "ic_hi", "pct_con_alerta", "media_tutorias",
                   "pct_con_tutoria", "pct_alerta_cerrada").orderBy(F.desc("tasa"))


@query("risk_gradient", B.sql(f"""
    SELECT n_factores_reales, n, reprobados, round(reprobados / n, 6) AS tasa, {_wilson_sql('reprobados', 'n')}
    FROM (SELECT n_factores_reales, count(*) AS n, CAST(sum(en_riesgo) AS BIGINT) AS reprobados FROM factores
      WHERE faltas_confiable GROUP BY ALL)""", "factores"))
def risk_gradient(spark, sf):
    rows = O.risk_factors(evaluated(spark, sf)).where("faltas_confiable")
    out = rows.groupBy("n_factores_reales").agg(F.count(F.lit(1)).alias("n"),
                                                F.sum("en_riesgo").alias("reprobados"))
    return rounded(with_rate(out, "reprobados", "n"), "tasa", "ic_lo", "ic_hi")


@query("descriptives_with_total", B.sql(f"""
    SELECT coalesce(asignatura, 'Total') AS asignatura, n, en_riesgo, round(en_riesgo / n, 6) AS tasa,
      {_wilson_sql('en_riesgo', 'n')}, no_evaluados_p3, con_reprob_previas,
      CASE WHEN asignatura IS NOT NULL THEN CAST(round_even(fm, 0) AS INTEGER) || ' [' || CAST(round_even(f1, 0) AS INTEGER)
        || '–' || CAST(round_even(f3, 0) AS INTEGER) || ']' ELSE '' END AS faltas_mediana_ric,
      CASE WHEN asignatura IS NOT NULL THEN CAST(round_even(gm, 0) AS INTEGER) || ' [' || CAST(round_even(g1, 0) AS INTEGER)
        || '–' || CAST(round_even(g3, 0) AS INTEGER) || ']' ELSE '' END AS nota_p3_mediana_ric
    FROM (SELECT asignatura, count(*) AS n, CAST(sum(en_riesgo) AS BIGINT) AS en_riesgo,
      count(*) FILTER (WHERE no_evaluado_p3) AS no_evaluados_p3, count(*) FILTER (WHERE reprobaciones_previas > 0) AS con_reprob_previas,
      quantile_cont(faltas, 0.5) AS fm, quantile_cont(faltas, 0.25) AS f1, quantile_cont(faltas, 0.75) AS f3,
      quantile_cont(nota_p3, 0.5) FILTER (WHERE NOT no_evaluado_p3) AS gm,
      quantile_cont(nota_p3, 0.25) FILTER (WHERE NOT no_evaluado_p3) AS g1,
      quantile_cont(nota_p3, 0.75) FILTER (WHERE NOT no_evaluado_p3) AS g3
      FROM completos GROUP BY GROUPING SETS ((asignatura), ()))""", "completos"))
def descriptives_with_total(spark, sf):
    data = evaluated(spark, sf)
    counts = R.grand_total(data, "asignatura", [
        F.count(F.lit(1)).alias("n"), F.sum("en_riesgo").alias("en_riesgo"),
        F.count_if("no_evaluado_p3").alias("no_evaluados_p3"),
        F.count_if(F.col("reprobaciones_previas") > 0).alias("con_reprob_previas")])
    absences = R.spread_text(data, ["asignatura"], "faltas", "faltas_mediana_ric")
    grades = R.spread_text(data.where(~F.col("no_evaluado_p3")), ["asignatura"], "nota_p3",
                           "nota_p3_mediana_ric")
    out = with_rate(counts, "en_riesgo", "n").join(absences, "asignatura", "left") \
        .join(grades, "asignatura", "left")
    return rounded(out, "tasa", "ic_lo", "ic_hi").na.fill(
        "", ["faltas_mediana_ric", "nota_p3_mediana_ric"])


@query("wilson_rates", B.sql(f"""
    SELECT asignatura, escuela, n, reprobados, round(reprobados / n, 6) AS tasa, {_wilson_sql('reprobados', 'n')},
      {_wilson_sql('reprobados', 'n').split(', 6) AS ic_lo')[0].replace('round(', '', 1)} > g AS prioridad
    FROM (SELECT asignatura, escuela, count(*) AS n, CAST(sum(en_riesgo) AS BIGINT) AS reprobados FROM completos GROUP BY ALL),
      (SELECT avg(en_riesgo) AS g FROM completos)""", "completos"))
def wilson_rates(spark, sf):
    """Failure rate per subject and school; priority when the lower bound tops the overall rate.
    The overall rate comes from the same group sums."""
    groups = evaluated(spark, sf).groupBy("asignatura", "escuela").agg(
        F.count(F.lit(1)).alias("n"), F.sum("en_riesgo").alias("reprobados"))
    overall = groups.agg((F.sum("reprobados") / F.sum("n")).alias("g"))
    out = with_rate(groups, "reprobados", "n")
    return rounded(out.withColumn("prioridad", F.col("ic_lo") > overall.scalar()),
                   "tasa", "ic_lo", "ic_hi")


@query("persistence", B.sql(f"""
    SELECT asignatura, estado_p1, n, reprueban_p3, round(reprueban_p3 / n, 6) AS tasa, {_wilson_sql('reprueban_p3', 'n')}
    FROM (SELECT asignatura, CASE WHEN nota_p1 < 10 THEN 'reprueba_P1' ELSE 'aprueba_P1' END AS estado_p1,
      count(*) AS n, CAST(sum(en_riesgo) AS BIGINT) AS reprueban_p3 FROM completos GROUP BY ALL)""", "completos"))
def persistence(spark, sf):
    state = F.when(F.col("nota_p1") < 10, "reprueba_P1").otherwise("aprueba_P1")
    out = evaluated(spark, sf).groupBy("asignatura", state.alias("estado_p1")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("en_riesgo").alias("reprueban_p3"))
    return rounded(with_rate(out, "reprueban_p3", "n"), "tasa", "ic_lo", "ic_hi")


_CHI = """
    SELECT {g}, CAST(sum(o) AS BIGINT) AS n, round(sum((coalesce(o, 0) - e) * (coalesce(o, 0) - e) / e), 6) AS chi2,
      (count(DISTINCT r) - 1) * (count(DISTINCT c) - 1) AS gl,
      round(sqrt(sum((coalesce(o, 0) - e) * (coalesce(o, 0) - e) / e) / (sum(o) * (least(count(DISTINCT r), count(DISTINCT c)) - 1))), 6) AS v_cramer
    FROM (SELECT a.{g}, a.r, b.c, a.n::DOUBLE * b.n / t.n AS e FROM
      (SELECT {g}, {r} AS r, count(*) AS n FROM {t} GROUP BY ALL) a
      JOIN (SELECT {g}, {c} AS c, count(*) AS n FROM {t} GROUP BY ALL) b USING ({g})
      JOIN (SELECT {g}, count(*) AS n FROM {t} GROUP BY ALL) t USING ({g})) x
    LEFT JOIN (SELECT {g}, {r} AS r, {c} AS c, count(*) AS o FROM {t} GROUP BY ALL) y USING ({g}, r, c) GROUP BY {g}"""


@query("chi_square", B.sql(_CHI.format(g="asignatura", r="escuela", c="en_riesgo", t="completos"), "completos"))
def chi_square(spark, sf):
    out = N.chi_square(evaluated(spark, sf), ["asignatura"], "escuela", "en_riesgo")
    return rounded(out, "chi2", "v_cramer")


@query("chi_square_tests")
def chi_square_tests(spark, sf):
    """Chi-square with p value and Holm correction over the subjects."""
    tests = N.with_chi2_p(N.chi_square(evaluated(spark, sf), ["asignatura"], "escuela", "en_riesgo"))
    return N.holm_adjust(tests.withColumn("_f", F.lit(1)), ["_f"], tie=["asignatura"]).drop("_f")


_U = """
    SELECT {g}, n1, n - n1 AS n2, round(r1 - n1 * (n1 + 1) / 2, 6) AS u,
      round(2 * (r1 - n1 * (n1 + 1) / 2) / (n1 * (n - n1)::DOUBLE) - 1, 6) AS delta FROM (
      SELECT {g}, count(*) AS n, count(*) FILTER (WHERE x) AS n1, sum(rk) FILTER (WHERE x) AS r1 FROM (
        SELECT {g}, x, rank() OVER (PARTITION BY {g} ORDER BY v) + (count(*) OVER (PARTITION BY {g}, v) - 1) / 2.0::DOUBLE AS rk
        FROM ({rows})) GROUP BY {g})"""


@query("mann_whitney", _U.format(g="l_returnflag", rows="""
    SELECT l_returnflag, l_linestatus = 'O' AS x, l_extendedprice AS v FROM lineitem"""))
def mann_whitney(spark, sf):
    """Prices of open against closed lines: ranks over a wide domain, never over raw rows."""
    rows = B.table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_extendedprice")
    out = N.mann_whitney(rows, ["l_returnflag"], "l_extendedprice", F.col("l_linestatus") == "O")
    return rounded(out, "u", "delta").select("l_returnflag", "n1", "n2", "u", "delta")


@query("mann_whitney_tests")
def mann_whitney_tests(spark, sf):
    rows = B.table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_extendedprice")
    return N.with_normal_p(N.mann_whitney(rows, ["l_returnflag"], "l_extendedprice",
                                          F.col("l_linestatus") == "O"))


B.CTES["rangos"] = (["datos"], """
    SELECT asignatura, escuela, 1 + (b < a)::INT + (c < a)::INT + ((b = a)::INT + (c = a)::INT) / 2.0::DOUBLE AS r1,
      1 + (a < b)::INT + (c < b)::INT + ((a = b)::INT + (c = b)::INT) / 2.0::DOUBLE AS r2,
      1 + (a < c)::INT + (b < c)::INT + ((a = c)::INT + (b = c)::INT) / 2.0::DOUBLE AS r3,
      CASE WHEN a = b AND b = c THEN 24 WHEN a = b OR b = c OR a = c THEN 6 ELSE 0 END AS t
    FROM (SELECT asignatura, escuela, nota_p1 AS a, nota_p2 AS b, nota_p3 AS c FROM datos
      WHERE NOT (no_evaluado_p1 OR no_evaluado_p2 OR no_evaluado_p3))""")


def _friedman_sql(group: str) -> str:
    return f"""SELECT {group}, count(*) AS n, (12 / (3 * count(*)::DOUBLE * 4) * (sum(r1) * sum(r1)
      + sum(r2) * sum(r2) + sum(r3) * sum(r3)) - 12 * count(*)) / (1 - sum(t) / (count(*)::DOUBLE * 24)) AS x
    FROM rangos GROUP BY {group}"""


@query("friedman", B.sql(f"""
    SELECT asignatura, n, round(x, 6) AS chi2, round(x / (n * 2), 6) AS kendall_w, round(exp(-x / 2), 6) AS p
    FROM ({_friedman_sql('asignatura')})""", "rangos"))
def friedman(spark, sf):
    ok = ~(F.col("no_evaluado_p1") | F.col("no_evaluado_p2") | F.col("no_evaluado_p3"))
    out = N.friedman(dataset(spark, sf).where(ok), ["asignatura"],
                     ["nota_p1", "nota_p2", "nota_p3"])
    return rounded(out, "chi2", "kendall_w", "p")


@query("wilcoxon_signed", B.sql("""
    SELECT asignatura, count(*) AS n, round(sum(rk) FILTER (WHERE d > 0), 6) AS w_mas,
      round(sum(rk) FILTER (WHERE d < 0), 6) AS w_menos, round(least(sum(rk) FILTER (WHERE d > 0), sum(rk) FILTER (WHERE d < 0)), 6) AS t,
      round((sum(rk) FILTER (WHERE d > 0) - sum(rk) FILTER (WHERE d < 0)) / sum(rk), 6) AS r_rb FROM (
      SELECT asignatura, d, rank() OVER (PARTITION BY asignatura ORDER BY abs(d))
        + (count(*) OVER (PARTITION BY asignatura, abs(d)) - 1) / 2.0::DOUBLE AS rk FROM (
        SELECT asignatura, nota_p3 - nota_p1 AS d FROM datos WHERE NOT (no_evaluado_p1 OR no_evaluado_p2 OR no_evaluado_p3))
      WHERE d <> 0) GROUP BY asignatura""", "datos"))
def wilcoxon_signed(spark, sf):
    ok = ~(F.col("no_evaluado_p1") | F.col("no_evaluado_p2") | F.col("no_evaluado_p3"))
    out = N.wilcoxon_signed(dataset(spark, sf).where(ok), ["asignatura"],
                            F.col("nota_p3").cast("int") - F.col("nota_p1").cast("int"),
                            small_domain=True)
    return rounded(out, "w_mas", "w_menos", "t", "r_rb").drop("z")


@query("holm_adjust", B.sql(f"""
    SELECT asignatura, escuela, round(p, 6) AS p,
      round(max(paso) OVER (PARTITION BY asignatura ORDER BY p, escuela), 6) AS p_holm FROM (
      SELECT *, least(1.0, (count(*) OVER (PARTITION BY asignatura)
        - row_number() OVER (PARTITION BY asignatura ORDER BY p, escuela) + 1) * p) AS paso
      FROM (SELECT asignatura, escuela, exp(-x / 2) AS p FROM ({_friedman_sql('asignatura, escuela')})))""",
    "rangos"))
def holm_adjust(spark, sf):
    """Friedman p per subject and school, corrected inside each subject."""
    ok = ~(F.col("no_evaluado_p1") | F.col("no_evaluado_p2") | F.col("no_evaluado_p3"))
    tests = N.friedman(dataset(spark, sf).where(ok), ["asignatura", "escuela"],
                       ["nota_p1", "nota_p2", "nota_p3"])
    out = N.holm_adjust(tests.select("asignatura", "escuela", "p"), ["asignatura"], tie=["escuela"])
    return rounded(out, "p", "p_holm")


ORDINAL = ["tiempo_estudio", "faltas", "reprobaciones_previas", "sim_lms_minutos_p1",
           "sim_lms_eventos_p1"]
FLAGS = ["apoyo_escolar", "clases_pagadas", "desea_superior"]


def _long(names):
    return " UNION ALL ".join(
        f"SELECT asignatura || '/{c}' AS g, rendimiento_sobre_promedio AS x, CAST({c} AS INTEGER)::DOUBLE AS v "
        "FROM datos WHERE rendimiento_sobre_promedio IS NOT NULL" for c in names)


B.CTES["largas"] = (["datos"], _long(FLAGS))


@query("compare_groups", B.sql(f"""
    SELECT split_part(g, '/', 1) AS asignatura, split_part(g, '/', 2) AS variable, 'Mann-Whitney U' AS prueba,
      n1 AS n_sobre, n2 AS n_bajo, u AS estadistico, delta AS valor_efecto,
      CASE WHEN abs(delta) < 0.147 THEN 'despreciable' WHEN abs(delta) < 0.33 THEN 'pequeño'
        WHEN abs(delta) < 0.474 THEN 'mediano' ELSE 'grande' END AS magnitud
    FROM ({_U.format(g='g', rows=_long(ORDINAL))})
    UNION ALL SELECT split_part(g, '/', 1), split_part(g, '/', 2), 'Chi-cuadrado', s.a, s.b, chi2, v_cramer, ''
    FROM ({_CHI.format(g='g', r='x', c='v', t='largas')}) JOIN (SELECT g, count(*) FILTER (WHERE x) AS a,
      count(*) FILTER (WHERE NOT x) AS b FROM largas GROUP BY g) s USING (g)""", "datos", "largas"))
def compare_groups(spark, sf):
    out = N.compare_groups(dataset(spark, sf), "asignatura", "rendimiento_sobre_promedio",
                           ORDINAL, FLAGS)
    return rounded(out, "estadistico", "valor_efecto").drop("z", "gl")


@query("compare_groups_tests")
def compare_groups_tests(spark, sf):
    return N.comparison_p(N.compare_groups(dataset(spark, sf), "asignatura",
                                           "rendimiento_sobre_promedio", ORDINAL, FLAGS))


@query("bootstrap_ci")
def bootstrap_ci(spark, sf):
    """Grade change (mean), paid lessons (difference of shares) and absences (Cliff's delta)."""
    data = dataset(spark, sf)
    ok = ~(F.col("no_evaluado_p1") | F.col("no_evaluado_p3"))
    change = data.where(ok).withColumn("_d", F.col("nota_p3").cast("int") - F.col("nota_p1"))
    above = F.col("rendimiento_sobre_promedio")
    parts = {
        "cambio P1→P3": S.mean_ci(change, ["asignatura"], "_d"),
        "clases_pagadas": S.mean_difference_ci(
            data.withColumn("_v", F.col("clases_pagadas").cast("int")), ["asignatura"], "_v", above),
        "faltas": S.cliff_ci(data, ["asignatura"], "faltas", above)}
    return K.stack([df.withColumn("estadistico", F.lit(n)) for n, df in parts.items()])


@query("grouped_split", B.sql("""
    SELECT estudiante_id, pliegue FROM firmas""", "firmas"))
def grouped_split(spark, sf):
    rows = integrated(spark, sf).withColumn("en_riesgo", (F.col("nota_p3") < 10).cast("int"))
    return grouped_folds(rows, "estudiante_id", "en_riesgo")


SCENARIOS_OF_SIZE = {"actual": None, "red de 100 centros": 1_000_000, "red nacional": 10_000_000,
                     "red nacional con clickstream": 200_000_000}
NODE_MEMORY = 8e9


def capacity_base(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The clean log as a stage table, and one row with its rows, bytes and enrolments."""
    events = materialise(cleaned(spark, sf).clean, "limpios")
    size = B.enrolment_keys(spark, sf).agg(F.count(F.lit(1)).alias("m"))
    return events, events.agg(F.count(F.lit(1)).alias("n"), F.sum(Z.row_bytes(events)).alias("b")) \
        .withColumn("m", size.scalar())


@query("capacity_projection", B.sql("""
    SELECT escenario, round(base.n::DOUBLE / m.n * f, 4) AS eventos_anuales,
      round(base.n::DOUBLE / m.n * f * (base.b::DOUBLE / base.n) / 1e9, 6) AS memoria_gb,
      base.n::DOUBLE / m.n * f < 8e9 / (3 * (base.b::DOUBLE / base.n)) AS cabe_en_8gb
    FROM (SELECT count(*) AS n, sum(8 + 8 + 4 + 1 + strlen(evento_id) + strlen(asignatura) + strlen(tipo) + strlen(periodo)) AS b
        FROM limpios) base,
      (SELECT count(*) AS n FROM inscritos) m,
      (VALUES ('actual', NULL), ('red de 100 centros', 1000000), ('red nacional', 10000000),
        ('red nacional con clickstream', 200000000)) v(escenario, f0), LATERAL (SELECT coalesce(f0, m.n) AS f)""",
    "limpios", "inscritos"))
def capacity_projection(spark, sf):
    """Events per enrolment and bytes per event of the clean log, carried to larger systems."""
    return Z.project(capacity_base(spark, sf)[1], SCENARIOS_OF_SIZE, NODE_MEMORY)


@query("capacity_measured")
def capacity_measured(spark, sf):
    """The projection with the time of AG-01 at the rate that this session reaches on the log."""
    events, base = capacity_base(spark, sf)
    m = Z.measure(events, lambda e: D.lms_activity(e, periods=B.ACTIVITY_PERIODS))
    cost = F.lit(m.seconds / m.rows if m.rows else None).cast("double")
    return Z.project(base, SCENARIOS_OF_SIZE, NODE_MEMORY).select(
        "*", F.lit(m.rows).alias("filas"), F.lit(m.bytes).alias("bytes"),
        F.lit(m.bytes_per_row).cast("double").alias("bytes_por_fila"),
        F.lit(m.rows_per_second).alias("filas_por_s"),
        (F.col("eventos_anuales") * cost).alias("segundos"))


@query("stage_counts", B.sql("""
    SELECT etapa, entrada, duplicados, rechazados, salida, entrada = duplicados + rechazados + salida AS cuadra FROM (
      SELECT 'eventos' AS etapa, (SELECT count(*) FROM eventos) AS entrada,
        (SELECT CAST(sum(copias - 1) AS BIGINT) FROM primeros) AS duplicados,
        (SELECT count(*) FROM eventos WHERE fecha IS NULL) + (SELECT count(*) FROM juzgados WHERE regla IS NOT NULL) AS rechazados,
        (SELECT count(*) FROM limpios) AS salida
      UNION ALL SELECT 'tutorias', count(*), 0, count(*) FILTER (WHERE i.estudiante_id IS NULL OR """
    + B.period_case("fecha", B.SESSION_PERIODS) + """ IS NULL),
        count(*) FILTER (WHERE i.estudiante_id IS NOT NULL AND """ + B.period_case("fecha", B.SESSION_PERIODS)
    + """ IS NOT NULL) FROM tutorias_crudas LEFT JOIN inscritos i USING (estudiante_id, asignatura)
      UNION ALL SELECT 'integracion', (SELECT count(*) FROM matricula), 0, 0, (SELECT count(*) FROM datos))""",
    "eventos", "primeros", "juzgados", "limpios", "tutorias_crudas", "inscritos", "matricula", "datos"))
def stage_counts(spark, sf):
    """Rows into, dropped as copies, rejected and out of each stage, counted apart: they must add up."""
    def count(df, column):
        return df.agg(F.count(F.lit(1)).alias(column))

    none = F.lit(0).cast("bigint")
    # only counted: the joins and the split with the columns that these need
    joined = A.derive(materialise(integrated(spark, sf).select(*A.KEY, *A.DERIVED_FROM), "integrada"))
    stages = {
        "eventos": cleaned(spark, sf).counts(),
        "tutorias": cleaned_sessions(spark, sf).counts(),
        "integracion": count(B.matricula(spark, sf), "entrada").crossJoin(count(joined, "salida")).select(
            "entrada", none.alias("duplicados"), none.alias("rechazados"), "salida")}
    rows = [counts.select(F.lit(name).alias("etapa"), "entrada", "duplicados", "rechazados", "salida")
            for name, counts in stages.items()]
    return reduce(DataFrame.unionByName, rows).withColumn(
        "cuadra", F.col("entrada") == F.col("duplicados") + F.col("rechazados") + F.col("salida"))

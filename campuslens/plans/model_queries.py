"""Registered queries for metrics, models and their interpretation."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from campuslens.operators import bootstrap as S
from campuslens.operators import checks as K
from campuslens.operators import metrics as M
from campuslens.operators import models as L
from campuslens.operators import outliers as O
from campuslens.operators.features import CATEGORICAL, SCENARIOS, Encoder, leaked
from campuslens.operators.regression import odds_ratios_clustered
from campuslens.plans import testbed as B
from campuslens.plans.analysis_queries import dataset, evaluated, graded, rounded
from campuslens.plans.registry import query

_SCORED = "SELECT l_linestatus, l_returnflag, l_linenumber, l_suppkey, l_extendedprice AS p, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem"
_SHARE = "SELECT l_linestatus, l_linenumber, l_quantity / 50 AS p, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem"


def price_scores(spark, sf):
    """A wide score: the line price, against the returned flag."""
    return B.table(spark, sf, "lineitem").select(
        "l_linestatus", "l_suppkey", F.col("l_extendedprice").alias("p"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"))


def share_scores(spark, sf):
    """A score between 0 and 1: the quantity share."""
    return B.table(spark, sf, "lineitem").select(
        "l_linestatus", "l_linenumber", (F.col("l_quantity") / 50).alias("p"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"))


def _auc_sql(rows: str, keys: str) -> str:
    by = f"PARTITION BY {keys}" if keys else ""
    sel, grp = (f"{keys},", f"GROUP BY {keys}") if keys else ("", "")
    return f"""SELECT {sel} CAST(sum(pos) AS BIGINT) AS positivos, CAST(sum(neg) AS BIGINT) AS negativos,
      round(sum(pos * (nb + neg / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)), 6) AS auc_roc,
      round(sum(pos * tp::DOUBLE / (tp + fp)) / sum(pos), 6) AS auc_pr FROM (
      SELECT {sel} pos, neg, sum(neg) OVER ({by} ORDER BY p) - neg AS nb,
        sum(pos) OVER ({by} ORDER BY p DESC) AS tp, sum(neg) OVER ({by} ORDER BY p DESC) AS fp FROM (
        SELECT {sel} p, sum(y) AS pos, sum(1 - y) AS neg FROM ({rows}) GROUP BY ALL)) {grp}"""


@query("auc_roc_pr", _auc_sql(_SCORED, "l_linestatus"))
def auc_roc_pr(spark, sf):
    return rounded(M.auc_roc_pr(price_scores(spark, sf), "p", "y", ["l_linestatus"]),
                   "auc_roc", "auc_pr")


@query("threshold_for_recall", f"""
    SELECT max(p) AS umbral FROM (SELECT p, sum(pos) OVER (ORDER BY p DESC) / sum(pos) OVER () AS r FROM (
      SELECT p, sum(y) AS pos FROM ({_SCORED}) GROUP BY p)) WHERE r >= 0.8""")
def threshold_for_recall(spark, sf):
    return M.threshold_for_recall(price_scores(spark, sf), "p", "y")


_RATES = """count(*) FILTER (WHERE y = 1 AND p >= 0.5) AS tp, count(*) FILTER (WHERE y = 0 AND p >= 0.5) AS fp,
    count(*) FILTER (WHERE y = 1 AND p < 0.5) AS fn, count(*) FILTER (WHERE y = 0 AND p < 0.5) AS tn"""


@query("classification_metrics", f"""
    SELECT *, round(tp / (tp + fn), 6) AS recall, round(tp / (tp + fp), 6) AS precision,
      round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round(tn / (tn + fp), 6) AS especificidad FROM (
      SELECT {_RATES}, round(avg((p - y) * (p - y)), 6) AS brier FROM ({_SHARE}))""")
def classification_metrics(spark, sf):
    out = M.classification_metrics(share_scores(spark, sf), "p", "y", 0.5)
    return rounded(out, "brier", "recall", "precision", "f1", "especificidad")


_LONG = f"""SELECT 'l_linestatus' AS estrato, l_linestatus AS valor, p, y FROM ({_SHARE}) UNION ALL
    SELECT 'l_linenumber', CAST(l_linenumber AS VARCHAR), p, y FROM ({_SHARE})"""


@query("metrics_by_stratum", f"""
    SELECT estrato, valor, positivos + negativos AS n, round(positivos / (positivos + negativos), 6) AS prevalencia,
      auc_roc, round(tp / (tp + fn), 6) AS recall, round(tp / (tp + fp), 6) AS precision
    FROM ({_auc_sql(_LONG, 'estrato, valor')}) JOIN (SELECT estrato, valor, {_RATES} FROM ({_LONG}) GROUP BY ALL)
      USING (estrato, valor)""")
def metrics_by_stratum(spark, sf):
    out = M.metrics_by_stratum(share_scores(spark, sf), ["l_linestatus", "l_linenumber"], "p", "y",
                               0.5, small_domain=True)
    return rounded(out, "prevalencia", "auc_roc", "recall", "precision")


@query("calibration_bins", f"""
    SELECT (e[1] < p)::INT + (e[2] < p)::INT + (e[3] < p)::INT + (e[4] < p)::INT AS bin, count(*) AS n,
      round(avg(p), 4) AS prob_media, round(avg(y), 6) AS frecuencia
    FROM ({_SCORED}), (SELECT quantile_cont(p, [0.2, 0.4, 0.6, 0.8]) AS e FROM ({_SCORED})) GROUP BY ALL""")
def calibration_bins(spark, sf):
    out = M.calibration_bins(price_scores(spark, sf), "p", "y")
    return rounded(rounded(out, "prob_media", digits=4), "frecuencia")


@query("features_at_cut", B.sql("""
    SELECT particion, count(*) AS filas, round(avg(nota_p1), 6) AS nota_p1, round(avg(sim_lms_eventos_p1), 6) AS sim_lms_eventos_p1,
      round(avg(faltas), 6) AS faltas, 0 AS fugas FROM datos GROUP BY particion""", "datos"))
def features_at_cut(spark, sf):
    """Predictors per partition at the first cut; no scenario holds a leaked column."""
    leaks = sum(len(leaked(s)) for s in SCENARIOS.values())
    out = dataset(spark, sf).groupBy("particion").agg(
        F.count(F.lit(1)).alias("filas"),
        *[F.round(F.avg(c), 6).alias(c) for c in ("nota_p1", "sim_lms_eventos_p1", "faltas")])
    return out.withColumn("fugas", F.lit(leaks))


def parts(spark, sf):
    data = evaluated(spark, sf)
    return data.where("particion = 'train'"), data.where("particion = 'test'")


@query("encode_features")
def encode_features(spark, sf):
    """Encoded test vectors with the encoder fitted on the training rows."""
    train, test = parts(spark, sf)
    encoder = Encoder.fit(train, SCENARIOS["A_corte_P1"])
    return encoder.transform(test).select(
        "estudiante_id", "asignatura", F.lit(len(encoder.names())).alias("columnas"),
        vector_to_array("features").cast("string").alias("vector"))


_SCENARIO = SCENARIOS["A_corte_P1"]


B.CTES["categorias"] = (["completos"], " UNION ".join(
    f"SELECT '{c}' AS c, {c} AS v FROM completos WHERE particion = 'train'" for c in CATEGORICAL))
B.CTES["vistos"] = (["completos"], " UNION ALL ".join(
    f"SELECT '{c}' AS c, {c} AS v FROM completos WHERE particion = 'test'" for c in CATEGORICAL))


def _scaled_mean_sql(c: str) -> str:
    train, test = (f"(CAST({c} AS DOUBLE)) FILTER (WHERE particion = '{p}')" for p in ("train", "test"))
    return (f"SELECT '{c}' AS columna, round((avg{test} - avg{train}) / coalesce(nullif(stddev_pop{train}, 0), 1), 6) "
            "AS media FROM completos")


@query("encoded_means", B.sql(f"""
    SELECT x.c || '=' || x.v AS columna, round((SELECT count(*) FROM vistos w WHERE w.c = x.c AND w.v = x.v)
      / (SELECT count(*) FROM completos WHERE particion = 'test'), 6) AS media
    FROM (SELECT *, count(*) OVER (PARTITION BY c) AS k, min(v) OVER (PARTITION BY c) AS primera FROM categorias) x
    WHERE k <> 2 OR v <> primera
    UNION ALL {' UNION ALL '.join(map(_scaled_mean_sql, (*_SCENARIO.numeric, *_SCENARIO.flags)))}""",
    "categorias", "vistos", "completos"))
def encoded_means(spark, sf):
    """Mean of every encoded column over the test rows: shares of the categories, standardised numbers."""
    train, test = parts(spark, sf)
    encoder = Encoder.fit(train, _SCENARIO)
    cells = encoder.transform(test).select(F.posexplode(vector_to_array("features")).alias("k", "x"))
    names = F.array(*[F.lit(n) for n in encoder.names()])
    return cells.groupBy("k").agg(F.round(F.avg("x"), 6).alias("media")).select(
        F.element_at(names, F.col("k") + 1).alias("columna"), "media")


@query("oof_metrics")
def oof_metrics(spark, sf):
    """Logistic regression in all six scenarios: fold summary, threshold, test metrics."""
    train, test = parts(spark, sf)
    train = L.with_folds(train)
    return L.evaluate_all(train, test, list(SCENARIOS.values()), L.LOGISTIC)


@query("model_metrics")
def model_metrics(spark, sf):
    """Baseline, logistic and forest fitted at the first cut and compared on the test rows."""
    return compare_models(*parts(spark, sf), (L.PRIOR, L.LOGISTIC, L.FOREST))


@query("boosting_metrics")
def boosting_metrics(spark, sf):
    """Boosted trees (200 steps) against the baseline."""
    return compare_models(*parts(spark, sf), (L.PRIOR, L.BOOSTING))


def compare_models(train, test, models):
    out = test
    names = {}
    for i, m in enumerate(models):
        out = L.fit(train, SCENARIOS["A_corte_P1"], m).score(out, f"p{i}")
        names[f"p{i}"] = m
    long = L.materialise(out, "scored").select("en_riesgo", F.explode(F.array(*[
        F.struct(F.lit(m).alias("modelo"), F.col(c).alias("p")) for c, m in names.items()]))
        .alias("x")).select("en_riesgo", "x.*")
    rates = M.classification_metrics(long, "p", "en_riesgo", 0.5, ["modelo"])
    return M.auc_roc_pr(long, "p", "en_riesgo", ["modelo"]).join(rates, "modelo")


@query("cluster_bootstrap_auc")
def cluster_bootstrap_auc(spark, sf):
    """AUC interval of the quantity share, clustered by line number and status."""
    rows = share_scores(spark, sf).withColumn("g", F.concat_ws("/", "l_linestatus", "l_linenumber"))
    return S.cluster_auc_ci(rows, "p", "y", "g")


PAIRS = [("A_mas_sim", "A_corte_P1"), ("C_mas_sim", "C_matricula"), ("A_mas_faltas", "A_corte_P1"),
         ("B_corte_P2", "A_corte_P1"), ("A_corte_P1", "C_matricula")]


@query("auc_delta")
def auc_delta(spark, sf):
    """Paired AUC differences between the scenarios, clustered by student."""
    train, test = parts(spark, sf)
    scored = L.scored_test(train, test, list(SCENARIOS.values()), L.LOGISTIC)
    return S.cluster_auc_delta_ci(scored, PAIRS, "en_riesgo", "estudiante_id")


@query("leakage_counterfactual")
def leakage_counterfactual(spark, sf):
    """AUC with and without a predictor built from the target."""
    train, test = (L.circular_feature(d) for d in parts(spark, sf))
    honest = [SCENARIOS["C_matricula"], SCENARIOS["A_corte_P1"]]
    circular = [s.plus(f"{s.name}_mas_circular", "sim_circular") for s in honest]
    scored = L.scored_test(train, test, honest + circular, L.LOGISTIC)
    long = scored.select("en_riesgo", F.explode(F.array(*[
        F.struct(F.lit(s.name).alias("escenario"), F.col(s.name).alias("p"))
        for s in honest + circular])).alias("x")).select("en_riesgo", "x.*")
    return M.auc_roc_pr(long, "p", "en_riesgo", ["escenario"])


@query("permutation_importance")
def permutation_importance(spark, sf):
    """AUC drop per predictor of the boosted trees on the test rows, 30 repeats."""
    train, test = parts(spark, sf)
    scenario = SCENARIOS["A_corte_P1"]
    fitted = L.fit(train, scenario, L.BOOSTING)
    return L.permutation_importance(fitted, test, scenario.predictors)


@query("odds_ratios_clustered")
def odds_ratios_clustered_query(spark, sf):
    """Risk factors with standard errors clustered by student: reliable absences, then all."""
    # none of the factors looks at the behaviour
    columns = ["estudiante_id", "asignatura", "faltas", "faltas_confiable", "reprobaciones_previas", "en_riesgo"]
    rows = L.materialise(O.register_factors(L.materialise(graded(spark, sf).select(*columns), "registro")), "factores")
    predictors = {"alta_inasistencia": F.col("f_inasistencia").cast("int"),
                  "reprob_previas": F.col("f_reprob_previas").cast("int"),
                  "asignatura_P": (F.col("asignatura") == "P").cast("int")}
    samples = {"faltas confiables (principal)": rows.where("faltas_confiable"),
               "todas las matrículas (sensibilidad)": rows}
    return K.stack([odds_ratios_clustered(d, predictors, "en_riesgo", "estudiante_id")
                    .withColumn("muestra", F.lit(n)) for n, d in samples.items()])


@query("odds_ratios_train")
def odds_ratios_train(spark, sf):
    """Twelve pre-specified predictors on the training rows."""
    train, _ = parts(spark, sf)
    numeric = ["nota_p1", "reprobaciones_previas", "tiempo_estudio", "edad", "salidas",
               "alcohol_finde"]
    flags = {"asignatura_P": F.col("asignatura") == "P", "escuela_1": F.col("escuela") == "ASIA",
             "sexo_M": F.col("sexo") == "M", "desea_superior": F.col("desea_superior"),
             "apoyo_escolar": F.col("apoyo_escolar"), "zona_rural": F.col("zona") == "Rural"}
    predictors = {c: F.col(c) for c in numeric} | {n: c.cast("int") for n, c in flags.items()}
    return odds_ratios_clustered(train, predictors, "en_riesgo", "estudiante_id")



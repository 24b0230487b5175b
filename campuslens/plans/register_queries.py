"""Registered queries on the normalised register: view, analytic queries, checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from campuslens.functions.stats import t_point
from campuslens.operators import checks as K
from campuslens.operators import dedup as D
from campuslens.operators import relational as R
from campuslens.operators import reshape as L
from campuslens.plans import testbed as B
from campuslens.plans.document_queries import cleaned
from campuslens.plans.registry import query


@query("grade_stats", B.sql("""
    SELECT asignatura, periodo, count(*) FILTER (WHERE NOT no_evaluado) AS n_evaluados,
      round(avg(nota) FILTER (WHERE NOT no_evaluado), 2) AS media,
      round(stddev_samp(nota) FILTER (WHERE NOT no_evaluado), 2) AS desv_est,
      percentile_cont(0.5) WITHIN GROUP (ORDER BY nota) FILTER (WHERE NOT no_evaluado) AS mediana,
      count(*) FILTER (WHERE no_evaluado) AS n_no_evaluados
    FROM calificacion JOIN asignatura USING (asignatura_id) JOIN periodo USING (periodo_id)
    GROUP BY ALL""", "calificacion", "asignatura", "periodo"))
def grade_stats(spark, sf):
    return R.grade_stats(B.tables(spark, sf))


@query("fail_rate_by_school", B.sql("""
    SELECT escuela, asignatura, count(*) AS n_matriculas,
      count(*) FILTER (WHERE nota < 10) AS n_reprobados,
      count(*) FILTER (WHERE no_evaluado) AS n_no_evaluados,
      round(avg(CASE WHEN nota < 10 THEN 1.0 ELSE 0 END), 4) AS tasa_reprobacion
    FROM calificacion c JOIN periodo p ON p.periodo_id = c.periodo_id AND p.periodo = 'P3'
    JOIN matricula m USING (estudiante_id, asignatura_id)
    JOIN estudiante s USING (estudiante_id) JOIN escuela e USING (escuela_id)
    JOIN asignatura a USING (asignatura_id) GROUP BY ALL""",
    "calificacion", "periodo", "matricula", "estudiante", "escuela", "asignatura"))
def fail_rate_by_school(spark, sf):
    return R.fail_rate_by_school(B.tables(spark, sf))


@query("p1_p3_transition", B.sql("""
    SELECT asignatura, CASE WHEN c1.nota >= 10 THEN 'aprueba_P1' ELSE 'reprueba_P1' END AS estado_p1,
      CASE WHEN c3.nota >= 10 THEN 'aprueba_P3' ELSE 'reprueba_P3' END AS estado_p3, count(*) AS n
    FROM calificacion c1 JOIN calificacion c3 ON c3.estudiante_id = c1.estudiante_id
      AND c3.asignatura_id = c1.asignatura_id AND c3.periodo_id = 3
    JOIN asignatura a ON a.asignatura_id = c1.asignatura_id
    WHERE c1.periodo_id = 1 GROUP BY ALL""", "calificacion", "asignatura"))
def p1_p3_transition(spark, sf):
    return R.p1_p3_transition(B.tables(spark, sf))


@query("fail_rate_by_prior", B.sql("""
    SELECT reprobaciones_previas, count(*) AS n_matriculas,
      round(avg(CASE WHEN nota < 10 THEN 1.0 ELSE 0 END), 4) AS tasa_reprobacion
    FROM matricula m JOIN calificacion c ON c.estudiante_id = m.estudiante_id
      AND c.asignatura_id = m.asignatura_id AND c.periodo_id = 3 GROUP BY ALL""",
    "matricula", "calificacion"))
def fail_rate_by_prior(spark, sf):
    return R.fail_rate_by_prior(B.tables(spark, sf))


@query("wide_enrolment", B.sql("SELECT * FROM ancha", "ancha"))
def wide_enrolment(spark, sf):
    return R.wide_enrolment(B.tables(spark, sf))


@query("check_three_grades", B.sql("""
    SELECT estudiante_id, asignatura_id, count(c.periodo_id) AS n FROM matricula m
    LEFT JOIN calificacion c USING (estudiante_id, asignatura_id)
    GROUP BY ALL HAVING count(c.periodo_id) <> 3""", "matricula", "calificacion"))
def check_three_grades(spark, sf):
    return K.not_three_grades(B.tables(spark, sf))


@query("check_orphan_students", B.sql("""
    SELECT estudiante_id FROM estudiante s WHERE NOT EXISTS
      (SELECT 1 FROM matricula m WHERE m.estudiante_id = s.estudiante_id)""", "estudiante", "matricula"))
def check_orphan_students(spark, sf):
    return K.orphan_students(B.tables(spark, sf)).select("estudiante_id")


@query("check_orphan_enrolments", """
    SELECT e.user_id AS estudiante_id, count(*) AS n FROM events e LEFT JOIN supplier s ON s.s_suppkey = e.user_id
    WHERE s.s_suppkey IS NULL GROUP BY e.user_id""")
def check_orphan_enrolments(spark, sf):
    """Anti-join that finds rows: log entries whose user is no supplier."""
    log = B.table(spark, sf, "events").select(F.col("user_id").alias("estudiante_id"))
    known = B.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("estudiante_id"))
    per_key = log.groupBy("estudiante_id").agg(F.count(F.lit(1)).alias("n"))
    return per_key.join(known, "estudiante_id", "left_anti")


@query("check_duplicate_lineage", """
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def check_duplicate_lineage(spark, sf):
    return K.duplicate_groups(B.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("table_counts", B.sql("""
    SELECT 'escuela' AS tabla, count(*) AS filas FROM escuela UNION ALL
    SELECT 'asignatura', count(*) FROM asignatura UNION ALL SELECT 'periodo', count(*) FROM periodo UNION ALL
    SELECT 'estudiante', count(*) FROM estudiante UNION ALL SELECT 'matricula', count(*) FROM matricula
    UNION ALL SELECT 'calificacion', count(*) FROM calificacion""",
    "escuela", "asignatura", "periodo", "estudiante", "matricula", "calificacion"))
def table_counts(spark, sf):
    return K.table_counts(B.tables(spark, sf))


@query("integrity_report", B.sql("""
    SELECT 'I-01 estudiantes' AS control, count(*) AS valor, 0 AS esperado FROM estudiante UNION ALL
    SELECT 'I-02 matriculas', count(*), 0 FROM matricula UNION ALL
    SELECT 'I-03 calificaciones', count(*), 0 FROM calificacion UNION ALL
    SELECT 'I-04 matriculas_sin_3_notas', count(*), 0 FROM (SELECT 1 FROM matricula m LEFT JOIN calificacion c
      USING (estudiante_id, asignatura_id) GROUP BY estudiante_id, asignatura_id HAVING count(c.periodo_id) <> 3) UNION ALL
    SELECT 'I-05 estudiantes_sin_matricula', count(*), 0 FROM estudiante WHERE estudiante_id NOT IN
      (SELECT estudiante_id FROM matricula) UNION ALL
    SELECT 'I-06 matriculas_huerfanas', count(*), 0 FROM matricula m LEFT JOIN estudiante s USING (estudiante_id)
      WHERE s.escuela_id IS NULL UNION ALL
    SELECT 'I-07 estudiantes_en_ambas', count(*), 0 FROM (SELECT 1 FROM matricula GROUP BY estudiante_id HAVING count(*) = 2) UNION ALL
    SELECT 'I-08 notas_fuera_dominio', count(*), 0 FROM calificacion WHERE nota NOT BETWEEN 0 AND 20 UNION ALL
    SELECT 'I-09 calificaciones_no_evaluadas', count(*), 0 FROM calificacion WHERE no_evaluado UNION ALL
    SELECT 'I-10 filas_origen_duplicadas', count(*), 0 FROM (SELECT 1 FROM matricula GROUP BY archivo_origen, fila_origen HAVING count(*) > 1) UNION ALL
    SELECT 'I-11 filas_vista_integracion', count(*), 0 FROM ancha""", "ancha"))
def integrity_report(spark, sf):
    return K.integrity_report(B.tables(spark, sf))


@query("constraint_report", B.sql("""
    SELECT control, coalesce(valor, 0) AS valor FROM (
    SELECT 'pk estudiante' AS control, count(*) - count(DISTINCT estudiante_id) AS valor FROM estudiante
    UNION ALL SELECT 'pk matricula', count(*) FROM (SELECT 1 FROM matricula GROUP BY estudiante_id, asignatura_id HAVING count(*) > 1)
    UNION ALL SELECT 'pk calificacion', count(*) FROM (SELECT 1 FROM calificacion GROUP BY estudiante_id, asignatura_id, periodo_id HAVING count(*) > 1)
    UNION ALL SELECT 'uq matricula origen', count(*) FROM (SELECT 1 FROM matricula GROUP BY archivo_origen, fila_origen HAVING count(*) > 1)
    UNION ALL SELECT 'fk estudiante escuela', count(*) FROM estudiante WHERE escuela_id NOT IN (SELECT escuela_id FROM escuela)
    UNION ALL SELECT 'fk matricula estudiante', count(*) FROM matricula WHERE estudiante_id NOT IN (SELECT estudiante_id FROM estudiante)
    UNION ALL SELECT 'fk matricula asignatura', count(*) FROM matricula WHERE asignatura_id NOT IN (SELECT asignatura_id FROM asignatura)
    UNION ALL SELECT 'fk calificacion matricula', count(*) FROM calificacion c LEFT JOIN matricula m USING (estudiante_id, asignatura_id) WHERE m.faltas IS NULL
    UNION ALL SELECT 'fk calificacion periodo', count(*) FROM calificacion WHERE periodo_id NOT IN (SELECT periodo_id FROM periodo)
    UNION ALL SELECT 'ck reprobaciones_previas', count(*) FROM matricula WHERE reprobaciones_previas NOT BETWEEN 0 AND 3
    UNION ALL SELECT 'ck faltas', count(*) FROM matricula WHERE faltas NOT BETWEEN 0 AND 60
    UNION ALL SELECT 'ck fila_origen', count(*) FROM matricula WHERE fila_origen < 2
    UNION ALL SELECT 'ck nota', count(*) FROM calificacion WHERE nota NOT BETWEEN 3 AND 17
    UNION ALL SELECT 'ck no_evaluado', count(*) FROM calificacion WHERE no_evaluado AND nota <> 0
    UNION ALL SELECT 'ck edad', count(*) FROM estudiante WHERE edad NOT BETWEEN 15 AND 22
    UNION ALL SELECT 'ck sexo', count(*) FROM estudiante WHERE sexo NOT IN ('F', 'M')
    UNION ALL SELECT 'ck zona', count(*) FROM estudiante WHERE zona NOT IN ('Urbana', 'Rural')
    UNION ALL SELECT 'ck educ', count(*) FROM estudiante WHERE educ_madre NOT BETWEEN 0 AND 4 OR educ_padre NOT BETWEEN 0 AND 4
    UNION ALL SELECT 'ck ordinales', count(*) FROM estudiante WHERE tiempo_viaje NOT BETWEEN 1 AND 4
      OR tiempo_estudio NOT BETWEEN 1 AND 4 OR salud NOT BETWEEN 1 AND 5)""",
    "estudiante", "matricula", "calificacion", "escuela", "asignatura", "periodo"))
def constraint_report(spark, sf):
    """Tighter ranges than the domain's, so that some checks do count rows."""
    return K.constraint_report(B.tables(spark, sf), grade_range=(3, 17), absences=(0, 60))


@query("unpivot_grades", B.sql("""
    SELECT estudiante_id, asignatura, p AS periodo_id, nota, nota = 0 AS no_evaluado FROM (
      SELECT estudiante_id, asignatura, unnest([1, 2, 3]) AS p, unnest([nota_p1, nota_p2, nota_p3]) AS nota FROM ancha)""",
    "ancha"))
def unpivot_grades(spark, sf):
    wide = R.wide_enrolment(B.tables(spark, sf))
    return R.unpivot_grades(wide, ["estudiante_id", "asignatura"],
                            {"nota_p1": 1, "nota_p2": 2, "nota_p3": 3})


_MOMENTS = """n, round(media, 6) AS media, round(de, 6) AS de, round(media_con_ceros, 6) AS media_con_ceros"""


@query("period_means", B.sql(f"""
    SELECT asignatura, periodo, {_MOMENTS} FROM (SELECT asignatura, periodo,
      count(nota) FILTER (WHERE NOT ne) AS n, avg(nota) FILTER (WHERE NOT ne) AS media,
      stddev_samp(nota) FILTER (WHERE NOT ne) AS de, avg(nota) AS media_con_ceros FROM (
      SELECT asignatura, unnest(['P1', 'P2', 'P3']) AS periodo, unnest([nota_p1, nota_p2, nota_p3]) AS nota,
        unnest([no_evaluado_p1, no_evaluado_p2, no_evaluado_p3]) AS ne FROM ancha) GROUP BY ALL)""", "ancha"))
def period_means(spark, sf):
    out = R.period_means(R.wide_enrolment(B.tables(spark, sf)), ["asignatura"])
    return out.select("asignatura", "periodo", "n", *[F.round(c, 6).alias(c) for c in (
        "media", "de", "media_con_ceros")])


@query("period_mean_intervals")
def period_mean_intervals(spark, sf):
    """Means per subject, school and period with the 95 % Student interval."""
    out = R.period_means(R.wide_enrolment(B.tables(spark, sf)), ["asignatura", "escuela"])
    half = t_point(F.col("n") - 1) * F.col("de") / F.sqrt("n")
    return out.withColumns({"ic_lo": F.col("media") - half, "ic_hi": F.col("media") + half})


@query("early_alert_level", B.sql("""
    SELECT nivel, count(*) AS n FROM (SELECT CASE WHEN nota_p1 < 8 THEN 'alto' WHEN nota_p1 < 10
      OR reprobaciones_previas >= 2 THEN 'medio' ELSE 'ninguno' END AS nivel FROM ancha) GROUP BY nivel""", "ancha"))
def early_alert_level(spark, sf):
    wide = R.wide_enrolment(B.tables(spark, sf))
    return wide.groupBy(R.early_alert_level().alias("nivel")).agg(F.count(F.lit(1)).alias("n"))


@query("rename_relabel", """
    SELECT o_orderkey AS matricula, o_custkey AS estudiante_id, o_orderpriority = '1-URGENT' AS urgente,
      CASE o_orderstatus WHEN 'F' THEN 'cerrada' WHEN 'O' THEN 'abierta' WHEN 'P' THEN 'en_seguimiento' END AS estado
    FROM orders""")
def rename_relabel(spark, sf):
    raw = B.table(spark, sf, "orders").withColumn(
        "o_orderpriority", F.when(F.col("o_orderpriority") == "1-URGENT", "yes").otherwise("no"))
    return L.relabel(raw, {"o_orderkey": "matricula", "o_custkey": "estudiante_id",
                           "o_orderpriority": "urgente", "o_orderstatus": "estado"},
                     ["o_orderpriority"],
                     {"estado": {"F": "cerrada", "O": "abierta", "P": "en_seguimiento"}})


@query("domain_violations", """
    SELECT 'o_orderstatus' AS columna, 'R-04' AS regla, count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS violaciones FROM orders
    UNION ALL SELECT 'o_orderpriority', 'R-04', count(*) FILTER (WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')) FROM orders
    UNION ALL SELECT 'o_totalprice', 'R-05', count(*) FILTER (WHERE NOT o_totalprice BETWEEN 1000 AND 400000) FROM orders""")
def domain_violations(spark, sf):
    return K.domain_violations(
        B.table(spark, sf, "orders"),
        {"o_orderstatus": ["F", "O"],
         "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]},
        {"o_totalprice": (1000, 400000)})


@query("null_profile", B.sql("""
    SELECT unnest(['evento_id', 'fecha', 'tipo', 'revisada']) AS columna,
      unnest([count(*) - count(evento_id), count(*) - count(fecha), count(*) - count(tipo), count(*) - count(revisada)]) AS nulos
    FROM eventos""", "eventos"))
def null_profile(spark, sf):
    return K.null_profile(B.events_raw(spark, sf), ["evento_id", "fecha", "tipo", "revisada"])


@query("exact_duplicates", """
    SELECT source, CAST(sum(n) AS BIGINT) AS filas, CAST(sum(n - 1) AS BIGINT) AS duplicados FROM (
      SELECT source, count(*) AS n FROM documents GROUP BY source, lang, text) GROUP BY source""")
def exact_duplicates(spark, sf):
    """Copies of whole texts inside a source, keyed by a digest instead of the text."""
    docs = B.table(spark, sf, "documents").select("source", "lang", F.sha2("text", 256).alias("h"))
    return D.exact_duplicates(docs, ["source"], ["lang", "h"])


@query("intra_file_key_dups", B.sql("""
    SELECT archivo, CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS filas,
      count(*) FILTER (WHERE n > 1) AS grupos, CAST(sum(n - 1) AS BIGINT) AS perdidas_si_fusion FROM (
      SELECT archivo, count(*) AS n FROM registros GROUP BY archivo, k1, k2, k3) GROUP BY archivo""", "registros"))
def intra_file_key_dups(spark, sf):
    return D.repeated_keys(B.registers(spark, sf), ["archivo"], ["k1", "k2", "k3"])


@query("union_sources", """
    SELECT fuente, count(*) AS n, round(sum(saldo), 2) AS saldo FROM (
      SELECT 'cliente' AS fuente, c_acctbal AS saldo FROM customer UNION ALL
      SELECT 'proveedor', s_acctbal FROM supplier) GROUP BY fuente""")
def union_sources(spark, sf):
    a = B.table(spark, sf, "customer").select(F.lit("cliente").alias("fuente"),
                                              F.col("c_acctbal").alias("saldo"))
    b = B.table(spark, sf, "supplier").select(F.col("s_acctbal").alias("saldo"),
                                              F.lit("proveedor").alias("fuente"))
    return a.unionByName(b).groupBy("fuente").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("saldo"), 2).alias("saldo"))


@query("common_keys", """
    SELECT 'interseccion' AS conjunto, count(*) AS n FROM (SELECT c_custkey FROM customer INTERSECT SELECT user_id FROM events)
    UNION ALL SELECT 'union', count(*) FROM (SELECT c_custkey FROM customer UNION SELECT user_id FROM events)
    UNION ALL SELECT 'diferencia', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT user_id FROM events)""")
def common_keys(spark, sf):
    a = B.table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    b = B.table(spark, sf, "events").select(F.col("user_id").alias("k")).distinct()
    sets = {"interseccion": a.intersect(b), "union": a.union(b).distinct(),
            "diferencia": a.subtract(b)}
    return K.stack([df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("conjunto"), "n")
                    for n, df in sets.items()])


@query("dedup_keep_last", """
    SELECT estudiante_id, orden, fecha FROM (SELECT user_id AS estudiante_id, event_id AS orden, ts AS fecha,
      row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1""")
def dedup_keep_last(spark, sf):
    rows = B.table(spark, sf, "events").select(
        F.col("user_id").alias("estudiante_id"), F.col("event_id").alias("orden"),
        F.col("ts").alias("fecha"))
    return D.keep_last(rows, ["estudiante_id"], ["orden"])


@query("replicate_scale", B.sql("""
    SELECT copia, count(*) AS n_eventos, count(DISTINCT estudiante_id) AS estudiantes,
      min(estudiante_id) AS primero FROM (SELECT k AS copia, estudiante_id + CAST(k AS BIGINT) * 1000000000 AS estudiante_id
      FROM limpios CROSS JOIN (VALUES (0), (1), (2), (3)) v(k)) GROUP BY copia""", "limpios"))
def replicate_scale(spark, sf):
    """Four-fold scale-up with fresh student keys."""
    rows = L.replicate(cleaned(spark, sf).clean, 4, "estudiante_id", 1_000_000_000, "copia")
    return rows.groupBy("copia").agg(
        F.count(F.lit(1)).alias("n_eventos"), F.countDistinct("estudiante_id").alias("estudiantes"),
        F.min("estudiante_id").alias("primero"))

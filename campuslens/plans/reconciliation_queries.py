"""Reconciliation of nine rules: what the source tables plant against what the cleaning finds.

The planted counts come from the columns that select each defect, without any cleaned row, so a
rule that misses or takes too much shows as a difference."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campuslens.functions.calendar import period_of
from campuslens.operators import cleaning as C
from campuslens.plans import testbed as B
from campuslens.plans.alert_queries import loaded
from campuslens.plans.document_queries import cleaned, cleaned_sessions
from campuslens.plans.registry import query
from campuslens.vocabulary import ALERT_STATES, MAX_MINUTES

RULES = ["R-15", "R-16", "R-17", "R-18", "R-20", "R-21", "R-22", "R-23", "R-24"]


def long_form(one: DataFrame, name: str) -> DataFrame:
    """A row per rule from a row with a column per rule."""
    cells = [F.struct(F.lit(c).alias("regla"), F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("bigint")
                      .alias(name)) for c in one.columns]
    return one.select(F.explode(F.array(*cells)).alias("x")).select("x.*")


def enrolled(df: DataFrame, keys: DataFrame) -> DataFrame:
    """``_matriculado``: whether (student, subject) of a row of counts has an enrolment."""
    known = keys.withColumn("_matriculado", F.lit(True))
    return df.join(known, C.ENROLMENT, "left").withColumn(
        "_matriculado", F.coalesce("_matriculado", F.lit(False)))


def planted_events(spark, sf) -> DataFrame:
    """Defects of the log. Events fold to one row of counts per enrolment and place in the calendar
    before they meet the enrolments; a defect counts where no earlier rule takes the event."""
    k = F.get_json_object("props", "$.k").cast("int")
    copies = F.when(F.col("value") >= 200, 2).otherwise(1)
    minutes, dated = F.floor("value"), F.coalesce(k != 0, F.lit(False))
    odd = ~F.coalesce(F.col("event_type").isin("view", "click"), F.lit(False))

    def total(amount: Column, name: str) -> Column:
        return F.sum(amount.cast("bigint")).alias(name)

    folded = B.table(spark, sf, "events").groupBy(
        F.col("user_id").alias("estudiante_id"),
        F.when(k < 33, "F").when(k < 66, "O").otherwise("P").alias("asignatura"),
        period_of(F.col("ts"), B.ACTIVITY_PERIODS).isNotNull().alias("_dentro")).agg(
        total(F.when(~dated, copies), "_sin_fecha"), total(F.when(dated, copies - 1), "_copias"),
        total(dated, "_eventos"), total(dated & odd, "_tipo"),
        total(dated & (k == 1) & (minutes > 0), "_negativa"),
        total(dated & (k != 1) & (minutes > MAX_MINUTES), "_excesiva"))
    known, inside = F.col("_matriculado"), F.col("_dentro")
    return enrolled(folded, B.enrolment_keys(spark, sf)).agg(
        F.sum("_sin_fecha").alias("R-15"), F.sum("_copias").alias("R-16"),
        F.sum(F.when(~known, F.col("_eventos"))).alias("R-17"),
        F.sum(F.when(known & ~inside, F.col("_eventos"))).alias("R-18"),
        *[F.sum(F.when(known & inside, F.col(c))).alias(r)
          for r, c in (("R-20", "_tipo"), ("R-21", "_negativa"), ("R-22", "_excesiva"))])


def planted_sessions(spark, sf) -> DataFrame:
    """Every session is written with a result outside the catalogue; those without an enrolment or
    outside the calendar count once more."""
    folded = B.table(spark, sf, "lineitem").groupBy(
        F.col("l_suppkey").alias("estudiante_id"), F.col("l_linestatus").alias("asignatura")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(period_of(F.col("l_shipdate"), B.SESSION_PERIODS).isNull()).alias("_fuera"))
    return enrolled(folded, B.enrolment_keys(spark, sf)).agg(F.sum(
        F.col("_n") + F.when(F.col("_matriculado"), F.col("_fuera")).otherwise(F.col("_n"))).alias("R-23"))


def planted_alerts(spark, sf) -> DataFrame:
    """Incoherent alerts on flat rows: update time before one of the dates, states out of the order
    of their dates, state other than the last one."""
    price = F.floor("o_totalprice").cast("bigint")
    orders = B.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("o"), F.col("o_orderdate").alias("creada"), (price % 97).alias("g"),
        (F.col("o_orderdate") + F.make_dt_interval((price % 61 - 10).cast("int"))).alias("act"),
        F.when(F.col("o_totalprice") < 150000, "abierta").when(F.col("o_totalprice") < 300000, "en_seguimiento")
        .otherwise("cerrada").alias("estado")).where("g <> 5")
    listed = orders.where("g <> 2")
    flag = F.col("l_returnflag")
    place = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    first = listed.select("o", F.col("creada").alias("fecha"), F.lit(0).alias("_n"),
                          F.when(F.col("g") == 6, "reabierta").otherwise("abierta").alias("s"),
                          *[F.lit(None).alias(c) for c in place])
    steps = B.table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o").join(
        listed.select("o", "creada"), "o").select(
        "o", F.greatest("creada", "l_shipdate").alias("fecha"), F.lit(1).alias("_n"),
        F.when(flag == "A", "abierta").when(flag == "N", "en_seguimiento").otherwise("cerrada").alias("s"),
        *place)
    rank = F.coalesce(C.state_rank(F.col("s")), F.lit(len(ALERT_STATES)))
    # a step is sorted by its place in the text and by its date: the states must come out alike
    listing = F.array_sort(F.collect_list(F.struct("_n", *place, "s")))
    dated = F.array_sort(F.collect_list(F.struct("fecha", rank.alias("r"), "s")))
    both = first.unionByName(steps).groupBy("o").agg(
        listing.alias("i"), dated.alias("j"), F.max("fecha").alias("cambio"))
    history = both.select("o", (F.col("i.s") != F.col("j.s")).alias("desorden"), "cambio",
                          F.element_at("j", F.lit(-1))["s"].alias("ultimo"))
    days = (F.col("turn") - F.col("conv_id") % 2).alias("dias")
    notes = B.table(spark, sf, "conversations").select(F.col("conv_id").alias("o"), days) \
        .groupBy("o").agg(F.max("dias").cast("int").alias("dias"))
    row = orders.join(history, "o", "left").join(notes, "o", "left")
    noted = F.greatest(F.col("creada") + F.make_dt_interval(days=F.col("dias")),
                       F.when(F.col("g") == 4, F.col("creada")))
    flags = [F.col("act") < F.greatest("creada", "cambio", noted), F.col("desorden"),
             F.col("ultimo") != F.col("estado")]
    return row.agg(reduce(lambda a, b: a + b, [F.count_if(f) for f in flags]).alias("R-24"))


_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
B.CTES["plantados"] = (["inscritos"], f"""
    SELECT {_K} AS k, floor(value) AS minutos, event_type, CASE WHEN value >= 200 THEN 2 ELSE 1 END AS c,
      coalesce({_K} <> 0, false) AS fechado, i.estudiante_id IS NOT NULL AS conocido,
      {B.period_case('ts', B.ACTIVITY_PERIODS)} IS NOT NULL AS dentro
    FROM events LEFT JOIN inscritos i ON i.estudiante_id = user_id
      AND i.asignatura = CASE WHEN {_K} < 33 THEN 'F' WHEN {_K} < 66 THEN 'O' ELSE 'P' END""")
_OUT = B.period_case("fecha", B.SESSION_PERIODS) + " IS NULL"


@query("rule_reconciliation", B.sql(f"""
    SELECT regla, CAST(coalesce(inyectados, 0) AS BIGINT) AS inyectados, CAST(coalesce(afectados, 0) AS BIGINT) AS afectados,
      coalesce(inyectados, 0) = coalesce(afectados, 0) AS iguales FROM (
      SELECT 'R-15' AS regla, (SELECT sum(c) FROM plantados WHERE NOT fechado) AS inyectados,
        (SELECT count(*) FROM eventos WHERE fecha IS NULL) AS afectados
      UNION ALL SELECT 'R-16', (SELECT sum(c - 1) FROM plantados WHERE fechado), (SELECT sum(copias - 1) FROM primeros)
      UNION ALL SELECT 'R-17', (SELECT count(*) FROM plantados WHERE fechado AND NOT conocido),
        (SELECT count(*) FROM juzgados WHERE regla = 'R-17')
      UNION ALL SELECT 'R-18', (SELECT count(*) FROM plantados WHERE fechado AND conocido AND NOT dentro),
        (SELECT count(*) FROM juzgados WHERE regla = 'R-18')
      UNION ALL SELECT 'R-20', (SELECT count(*) FROM plantados WHERE fechado AND conocido AND dentro
          AND coalesce(event_type NOT IN ('view', 'click'), true)),
        (SELECT count(*) FROM juzgados WHERE regla IS NULL AND tipo NOT IN ('recurso', 'tarea', 'foro', 'cuestionario'))
      UNION ALL SELECT 'R-21', (SELECT count(*) FROM plantados WHERE fechado AND conocido AND dentro AND k = 1 AND minutos > 0),
        (SELECT count(*) FROM juzgados WHERE regla IS NULL AND duracion_min < 0)
      UNION ALL SELECT 'R-22', (SELECT count(*) FROM plantados WHERE fechado AND conocido AND dentro AND k <> 1 AND minutos > {MAX_MINUTES}),
        (SELECT count(*) FROM juzgados WHERE regla IS NULL AND duracion_min > {MAX_MINUTES})
      UNION ALL SELECT 'R-23', (SELECT count(*) FROM lineitem) + (SELECT count(*) FROM tutorias_crudas t
          WHERE {_OUT} OR NOT EXISTS (SELECT 1 FROM inscritos i WHERE i.estudiante_id = t.estudiante_id AND i.asignatura = t.asignatura)),
        (SELECT count(*) FILTER (WHERE resultado NOT IN ('completada', 'no_asistio', 'reprogramada'))
          + count(*) FILTER (WHERE i.estudiante_id IS NULL OR {_OUT})
          FROM tutorias_crudas LEFT JOIN inscritos i USING (estudiante_id, asignatura))
      UNION ALL SELECT 'R-24', (SELECT count(*) FILTER (WHERE antes <> despues) + count(*) FILTER (WHERE despues[-1] <> estado0)
          + count(*) FILTER (WHERE act0 < greatest(o_orderdate, ultimo_cambio, ultima_nota)) FROM doc_resumen WHERE g <> 5),
        (SELECT sum(CAST(orden_corregido AS INTEGER) + CAST(estado_corregido AS INTEGER)
          + CAST(act_corregido AS INTEGER)) FROM doc_reparados))""",
    "eventos", "primeros", "plantados", "juzgados", "tutorias_crudas", "inscritos", "doc_resumen", "doc_reparados"))
def rule_reconciliation(spark, sf):
    """Planted against detected, for every rule with a planted defect."""
    planted = [planted_events(spark, sf), planted_sessions(spark, sf), planted_alerts(spark, sf)]
    injected = reduce(DataFrame.unionByName, [long_form(p, "inyectados") for p in planted])
    found = [cleaned(spark, sf).ledger(), cleaned_sessions(spark, sf).ledger(), loaded(spark, sf).ledger()]
    detected = reduce(DataFrame.unionByName, [f.select("regla", "afectados") for f in found])
    return C.reconcile(detected.where(F.col("regla").isin(*RULES)), injected)

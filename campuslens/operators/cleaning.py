"""Quality cascade for events, sessions and alerts (rules R-15 to R-25).

Every record is charged to the first rule it fails. Nothing is lost: raw rows equal clean
rows plus quarantined rows plus dropped duplicates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campuslens.functions import text as T
from campuslens.functions.calendar import SCHOOL_YEAR, period_of
from campuslens.operators.dedup import keep_first
from campuslens.session import bounded
from campuslens.vocabulary import (ALERT_STATES, EVENT_TYPE_MAP, EVENT_TYPES, MAX_MINUTES,
                                   SESSION_RESULT_MAP, SESSION_RESULTS)

ENROLMENT = ["estudiante_id", "asignatura"]
EVENT_REQUIRED = ["evento_id", "estudiante_id", "asignatura", "fecha", "tipo"]
QUARANTINE = ["fuente", "regla", "registro"]


def is_blank(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column).cast("string") == "")


def any_blank(columns: list[str]) -> Column:
    out = is_blank(columns[0])
    for c in columns[1:]:
        out = out | is_blank(c)
    return out


def mark_orphans(rows: DataFrame, enrolments: DataFrame, flag: str = "_huerfano",
                 keys_from: DataFrame | None = None) -> DataFrame:
    """Flags rows whose (student, subject) has no enrolment. ``keys_from`` names a cheaper frame
    with at least the keys of ``rows``.

    Only the distinct keys without enrolment travel: the rows themselves are not shuffled by
    a key that one student may dominate, unless the orphan set is too large to broadcast."""
    known = enrolments.select(*ENROLMENT)
    source = rows if keys_from is None else keys_from
    orphans = bounded(
        source.select(*ENROLMENT).distinct().join(known, ENROLMENT, "left_anti")
        .where(F.col("estudiante_id").isNotNull() & F.col("asignatura").isNotNull())
        .withColumn(flag, F.lit(True)), "orphans")
    missing = F.col("estudiante_id").isNull() | F.col("asignatura").isNull()
    return rows.join(orphans, ENROLMENT, "left").withColumn(
        flag, F.coalesce(F.col(flag), F.lit(False)) | missing)


def quarantined(rows: DataFrame, source: str, rule: Column, columns: list[str]) -> DataFrame:
    """Rejected records kept whole as JSON."""
    record = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return rows.select(F.lit(source).alias("fuente"), rule.alias("regla"),
                       record.alias("registro"))


def keep_first_events(events: DataFrame, order: str = "orden_llegada") -> DataFrame:
    """R-15 survivors reduced to the first copy per event id, with the number of copies."""
    return keep_first(events.where(~any_blank(EVENT_REQUIRED)), ["evento_id"], [order], "_copias")


@dataclass
class CleanedEvents:
    raw: DataFrame
    incomplete: DataFrame
    judged: DataFrame
    columns: list[str]

    @property
    def clean(self) -> DataFrame:
        """Accepted events with standard type, period and bounded minutes."""
        minutes = F.col("duracion_min")
        return (self.judged.where(F.col("_regla").isNull())
                .withColumns({
                    "tipo": F.col("_tipo"),
                    "duracion_min": F.when(minutes < 0, None).when(minutes > MAX_MINUTES,
                                                                   MAX_MINUTES).otherwise(minutes)})
                .select(*self.columns, "periodo"))

    @property
    def quarantine(self) -> DataFrame:
        late = self.judged.where(F.col("_regla").isNotNull())
        return (quarantined(self.incomplete, "lms", F.lit("R-15"), self.columns)
                .unionByName(quarantined(late, "lms", F.col("_regla"), self.columns)))

    def counts(self) -> DataFrame:
        """Rows in, dropped as copies, rejected and out, counted apart in one pass over the raw and one over
        the judged rows."""
        bad = F.col("_regla").isNotNull()
        came = self.raw.agg(F.count(F.lit(1)).alias("entrada"),
                            F.count_if(any_blank(EVENT_REQUIRED)).alias("_incompletos"))
        judged = self.judged.agg(
            F.coalesce(F.sum((F.col("_copias") - 1).cast("bigint")), F.lit(0)).alias("duplicados"),
            F.count_if(bad).alias("_malos"), F.count_if(~bad).alias("salida"))
        return came.crossJoin(judged).select("entrada", "duplicados", (
            F.col("_incompletos") + F.col("_malos")).alias("rechazados"), "salida")

    def ledger(self) -> DataFrame:
        """Affected records per rule (regla, afectados)."""
        ok = F.col("_regla").isNull()
        measures = {
            "R-16": F.col("_copias") - 1,
            "R-17": (F.col("_regla") == "R-17").cast("int"),
            "R-18": (F.col("_regla") == "R-18").cast("int"),
            "R-19": ok.cast("int"),
            "R-20": (ok & ~F.col("tipo").isin(*EVENT_TYPES)).cast("int"),
            "R-21": (ok & (F.col("duracion_min") < 0)).cast("int"),
            "R-22": (ok & (F.col("duracion_min") > MAX_MINUTES)).cast("int"),
        }
        late = self.judged.agg(*[F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(r)
                                 for r, m in measures.items()])
        late = late.select(F.explode(F.array(*[
            F.struct(F.lit(r).alias("regla"), F.col(f"`{r}`").alias("afectados"))
            for r in measures])).alias("x")).select("x.*")
        first = self.incomplete.agg(F.count(F.lit(1)).alias("afectados")) \
            .select(F.lit("R-15").alias("regla"), "afectados")
        return first.unionByName(late)


def clean_events(events: DataFrame, enrolments: DataFrame, periods=SCHOOL_YEAR,
                 order: str = "orden_llegada") -> CleanedEvents:
    """R-15 required fields, R-16 first copy, R-17 enrolment, R-18 calendar, R-19 period,
    R-20 type, R-21 negative minutes, R-22 cap."""
    columns = [c for c in events.columns if c != order]
    first = mark_orphans(keep_first_events(events, order), enrolments, keys_from=events)
    judged = first.withColumns({
        "periodo": period_of(F.col("fecha"), periods),
        "_tipo": T.standardise(F.col("tipo"), EVENT_TYPE_MAP),
    }).withColumn("_regla", F.when(F.col("_huerfano"), "R-17")
                  .when(F.col("periodo").isNull(), "R-18")).drop("_huerfano", order)
    return CleanedEvents(events, events.where(any_blank(EVENT_REQUIRED)).drop(order), judged,
                         columns)


@dataclass
class CleanedSessions:
    raw: DataFrame
    judged: DataFrame
    columns: list[str]

    @property
    def clean(self) -> DataFrame:
        return (self.judged.where(~F.col("_malo"))
                .withColumn("resultado", F.col("_resultado"))
                .select(*self.columns, "periodo"))

    @property
    def quarantine(self) -> DataFrame:
        bad = self.judged.where(F.col("_malo")).withColumn("resultado", F.col("_resultado"))
        return quarantined(bad, "tutorias", F.lit("R-23"), self.columns + ["periodo"])

    def counts(self) -> DataFrame:
        """Rows in, dropped as copies (none), rejected and out, counted apart."""
        judged = self.judged.agg(F.count_if("_malo").alias("rechazados"), F.count_if(~F.col("_malo")).alias("salida"))
        return self.raw.agg(F.count(F.lit(1)).alias("entrada")).crossJoin(judged).select(
            "entrada", F.lit(0).cast("bigint").alias("duplicados"), "rechazados", "salida")

    def ledger(self) -> DataFrame:
        """Non-standard results over all rows, rejected rows, and their sum (R-23)."""
        mapped = (~F.coalesce(F.col("resultado").isin(*SESSION_RESULTS), F.lit(False)))
        out = self.judged.agg(
            F.coalesce(F.sum(mapped.cast("bigint")), F.lit(0)).alias("mapeados"),
            F.coalesce(F.sum(F.col("_malo").cast("bigint")), F.lit(0)).alias("cuarentena"))
        return out.select(F.lit("R-23").alias("regla"), "mapeados", "cuarentena",
                          (F.col("mapeados") + F.col("cuarentena")).alias("afectados"))


def clean_sessions(sessions: DataFrame, enrolments: DataFrame,
                   periods=SCHOOL_YEAR) -> CleanedSessions:
    """R-23: result to the catalogue; outside the calendar, no date or no enrolment → quarantine."""
    judged = mark_orphans(sessions, enrolments).withColumns({
        "periodo": period_of(F.col("fecha"), periods),
        "_resultado": T.standardise(F.col("resultado"), SESSION_RESULT_MAP, fold=True),
    }).withColumn("_malo", F.col("periodo").isNull() | F.col("_huerfano")).drop("_huerfano")
    return CleanedSessions(sessions, judged, sessions.columns)


def off_catalogue(df: DataFrame, column: str, catalogue: list[str]) -> DataFrame:
    """Count of values outside a closed catalogue; must be zero after standardising."""
    bad = ~F.coalesce(F.col(column).isin(*catalogue), F.lit(False))
    return df.agg(F.coalesce(F.sum(bad.cast("bigint")), F.lit(0)).alias("fuera_catalogo"))


def state_rank(state: Column) -> Column:
    """Order of alert states at the same instant."""
    out = F.lit(None).cast("int")
    for i, s in enumerate(ALERT_STATES):
        out = F.when(state == s, F.lit(i)).otherwise(out)
    return out


def fix_alert_documents(alerts: DataFrame, normalise=T.normalise_text,
                        categorise=T.categorise) -> DataFrame:
    """R-24 and R-25 on nested alert documents, without a shuffle: history sorted by
    (date, state rank; unknown states last), state = last of the history (kept if that is empty),
    update time not before any date, note texts normalised and categorised. Adds ``_orden``,
    ``_estado``, ``_act`` flags."""
    keyed = F.transform("historial_estados", lambda h: F.struct(
        h["fecha"].alias("fecha"),
        F.coalesce(state_rank(h["estado"]), F.lit(len(ALERT_STATES))).alias("r"),
        h["estado"].alias("estado")))
    ordered = F.transform(F.array_sort(keyed), lambda h: F.struct(
        h["estado"].alias("estado"), h["fecha"].alias("fecha")))
    notes = F.transform("notas", lambda n: F.struct(
        n["nota_id"].alias("nota_id"), n["fecha"].alias("fecha"), n["autor"].alias("autor"),
        n["texto"].alias("texto"), normalise(n["texto"]).alias("texto_normalizado")))
    noted = F.transform("notas", lambda n: F.struct(
        *[n[c].alias(c) for c in ("nota_id", "fecha", "autor", "texto", "texto_normalizado")],
        categorise(n["texto_normalizado"]).alias("categoria")))
    out = alerts.withColumn("_orden", ordered).withColumn("notas", notes).withColumn("notas", noted)
    last_state = F.coalesce(F.try_element_at("_orden", F.lit(-1))["estado"], F.col("estado"))
    latest = F.greatest("creada_en", F.array_max(F.transform("_orden", lambda h: h["fecha"])),
                        F.array_max(F.transform("notas", lambda n: n["fecha"])))
    before = F.transform("historial_estados", lambda h: h["estado"])
    after = F.transform("_orden", lambda h: h["estado"])
    return out.withColumns({
        "_orden_corregido": ~before.eqNullSafe(after),
        "_estado_corregido": ~F.col("estado").eqNullSafe(last_state),
        "_act_corregido": F.coalesce(F.col("actualizado_en") < latest, latest.isNotNull()),
    }).withColumns({
        "historial_estados": F.col("_orden"),
        "estado": last_state,
        "actualizado_en": F.greatest("actualizado_en", latest),
    }).drop("_orden")


def alert_ledger(fixed: DataFrame) -> DataFrame:
    """Corrections of R-24 (order + state + update time) and notes handled by R-25."""
    flags = ["_act_corregido", "_orden_corregido", "_estado_corregido"]
    total = sum(F.col(f).cast("bigint") for f in flags)
    out = fixed.agg(F.coalesce(F.sum(total), F.lit(0)).alias("R-24"),
                    F.coalesce(F.sum(F.size("notas")), F.lit(0)).cast("bigint").alias("R-25"))
    return out.select(F.explode(F.array(*[
        F.struct(F.lit(r).alias("regla"), F.col(f"`{r}`").alias("afectados"))
        for r in ("R-24", "R-25")])).alias("x")).select("x.*")


def last_state_per_alert(history: DataFrame, key: str, moment: str, state: str,
                         rank: Column) -> DataFrame:
    """R-24 on a flat history table: first, last state and size per alert, by partial
    aggregation, so that an alert with a huge history needs no collected array."""
    step = F.struct(F.col(moment).alias("m"), rank.alias("r"), F.col(state).alias("s"))
    return history.groupBy(key).agg(
        F.min(step).alias("_first"), F.max(step).alias("_last"),
        F.count(F.lit(1)).alias("n_estados")).select(
        key, F.col("_first.s").alias("primer_estado"), F.col("_last.s").alias("estado"),
        F.col("_last.m").alias("ultimo_cambio"), "n_estados")


def quarantine_by_rule(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy("fuente", "regla").agg(F.count(F.lit(1)).alias("n"))


def reconcile(detected: DataFrame, injected: DataFrame) -> DataFrame:
    """Rule by rule: detected against injected counts."""
    return (injected.join(detected, "regla", "full_outer")
            .select("regla", F.coalesce("inyectados", F.lit(0)).cast("bigint").alias("inyectados"),
                    F.coalesce("afectados", F.lit(0)).cast("bigint").alias("afectados"))
            .withColumn("iguales", F.col("inyectados") == F.col("afectados")))

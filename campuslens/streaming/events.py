"""Streaming forms of the event cleaning and the activity aggregate (an extension: the batch
jobs stay the reference). Timestamps are cast to TIMESTAMP under UTC for the watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campuslens.functions.calendar import SCHOOL_YEAR, period_of
from campuslens.functions.text import standardise
from campuslens.operators.cleaning import EVENT_REQUIRED, any_blank
from campuslens.vocabulary import EVENT_TYPE_MAP, MAX_MINUTES


def clean_stream(events: DataFrame, periods=SCHOOL_YEAR, delay: str = "2 days") -> DataFrame:
    """Stateless rules plus first copy per event id within the watermark."""
    minutes = F.col("duracion_min")
    ok = events.where(~any_blank(EVENT_REQUIRED)).withColumns({
        "periodo": period_of(F.col("fecha"), periods), "fecha": F.col("fecha").cast("timestamp"),
        "tipo": standardise(F.col("tipo"), EVENT_TYPE_MAP),
        "duracion_min": F.when(minutes < 0, None).when(minutes > MAX_MINUTES, MAX_MINUTES)
        .otherwise(minutes)}).where(F.col("periodo").isNotNull())
    return ok.withWatermark("fecha", delay).dropDuplicatesWithinWatermark(["evento_id"])


def daily_activity(clean: DataFrame) -> DataFrame:
    """Events and minutes per enrolment, period and day, emitted when the day is closed."""
    return clean.groupBy("estudiante_id", "asignatura", "periodo",
                         F.window("fecha", "1 day").alias("_w")).agg(
        F.count(F.lit(1)).alias("n_eventos"),
        F.sum(F.coalesce(F.col("duracion_min"), F.lit(0))).alias("minutos")).select(
        "estudiante_id", "asignatura", "periodo", F.to_date(F.col("_w.start")).alias("dia"),
        "n_eventos", "minutos")

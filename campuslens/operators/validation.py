"""Document validators: boolean columns instead of server-side schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campuslens import vocabulary as V


def holds(c: Column) -> Column:
    """Null never passes a check."""
    return F.coalesce(c, F.lit(False))


def every(array: str, test) -> Column:
    """All elements pass; true on an empty array."""
    return holds(F.forall(array, lambda e: holds(test(e))))


@dataclass(frozen=True)
class Rules:
    """Patterns and enumerations of the documents (fixed values by default)."""
    event_id: str = "^EV-[0-9]{7}$"
    session_id: str = "^TU-[0-9]{5}$"
    tutor: str = "^TUT-[0-9]{2}$"
    alert_id: str = "^AL-[0-9]{5}$"
    author: str = "^ORI-[0-9]{2}$"
    subjects: tuple = ("MAT", "POR")
    event_types: tuple = tuple(V.EVENT_TYPES)
    modes: tuple = tuple(V.SESSION_MODES)
    topics: tuple = tuple(V.SESSION_TOPICS)
    results: tuple = tuple(V.SESSION_RESULTS)
    min_student: int = 1
    first_state: str = "abierta"
    states: tuple = tuple(V.ALERT_STATES)
    levels: tuple = tuple(V.ALERT_LEVELS)
    categories: tuple = tuple(V.NOTE_CATEGORIES)


def followup_checks(r: Rules = Rules()) -> dict[str, Column]:
    def inside(e):
        return (e["fecha"] >= F.col("periodo_inicio")) & (e["fecha"] <= F.col("periodo_fin"))
    ev, tu = "interacciones_lms", "tutorias"
    return {
        "estudiante": holds(F.col("estudiante_id") >= r.min_student),
        "periodo": holds(F.col("periodo").isin(*V.PERIOD_CODES)),
        "simulado": holds(F.col("es_simulado") & F.col("fuente").isNotNull()),
        "evento_id": every(ev, lambda e: e["evento_id"].rlike(r.event_id)),
        "evento_catalogo": every(ev, lambda e: e["asignatura"].isin(*r.subjects)
                                 & e["tipo"].isin(*r.event_types)),
        "evento_duracion": every(ev, lambda e: e["duracion_min"].isNull()
                                 | e["duracion_min"].between(1, V.MAX_MINUTES)),
        "evento_fecha": every(ev, inside),
        "tutoria_id": every(tu, lambda e: e["tutoria_id"].rlike(r.session_id)
                            & e["tutor"].rlike(r.tutor)),
        "tutoria_catalogo": every(tu, lambda e: e["asignatura"].isin(*r.subjects)
                                  & e["modalidad"].isin(*r.modes) & e["tema"].isin(*r.topics)
                                  & e["resultado"].isin(*r.results)),
        "tutoria_fecha": every(tu, inside),
    }


ALERT_DATES = ["actualizado_en", "creada_en", "ultimo_cambio", "primera_nota", "ultima_nota"]


def summarise_alert_documents(docs: DataFrame) -> DataFrame:
    """Lifecycle summary of nested alert documents, row by row."""
    def dates(array):
        return F.transform(array, lambda x: x["fecha"])
    return docs.withColumns({
        "n_estados": F.size("historial_estados"),
        "primer_estado": F.try_element_at("historial_estados", F.lit(1))["estado"],
        "ultimo_estado": F.try_element_at("historial_estados", F.lit(-1))["estado"],
        "ultimo_cambio": F.array_max(dates("historial_estados")),
        "primera_nota": F.array_min(dates("notas")),
        "ultima_nota": F.array_max(dates("notas")),
        "texto_minimo": F.array_min(F.transform("notas", lambda n: F.length(n["texto"]))),
    })


def lifecycle_checks(r: Rules = Rules()) -> dict[str, Column]:
    """Coherence checks on the summary columns, for nested and flat histories alike."""
    updated, created = F.col("actualizado_en"), F.col("creada_en")
    return {
        "actualizado_tras_crear": holds(updated >= created),
        "actualizado_tras_historial": holds(updated >= F.col("ultimo_cambio")),
        "actualizado_tras_notas": holds(updated >= F.coalesce("ultima_nota", created)),
        "notas_tras_crear": holds(F.coalesce("primera_nota", created) >= created),
        "estado_es_ultimo": holds(F.col("estado") == F.col("ultimo_estado")),
        "abre_en_inicial": holds(F.col("primer_estado") == r.first_state),
        "historial_no_vacio": holds(F.col("n_estados") >= 1),
        "texto_suficiente": F.coalesce(F.col("texto_minimo"), F.lit(5)) >= 5,
    }


def alert_checks(r: Rules = Rules()) -> dict[str, Column]:
    """Catalogue and pattern checks of nested alert documents."""
    return {
        "alerta_id": holds(F.col("alerta_id").rlike(r.alert_id)),
        "estudiante": holds(F.col("estudiante_id") >= r.min_student),
        "catalogos": holds(F.col("asignatura").isin(*r.subjects)
                           & F.col("periodo").isin(*V.PERIOD_CODES)
                           & F.col("nivel").isin(*r.levels) & F.col("estado").isin(*r.states)),
        "simulado": holds(F.col("es_simulado") & F.col("fuente").isNotNull()),
        "estados": every("historial_estados", lambda h: h["estado"].isin(*r.states)
                         & h["fecha"].isNotNull()),
        "notas": every("notas", lambda n: n["nota_id"].isNotNull() & n["autor"].rlike(r.author)
                       & n["fecha"].isNotNull() & n["texto_normalizado"].isNotNull()
                       & n["categoria"].isin(*r.categories)),
    }


def validate(docs: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Adds ``_fallos`` (names of failed checks) and ``valido``."""
    failed = F.array_compact(F.array(*[F.when(~c, F.lit(n)) for n, c in checks.items()]))
    return docs.withColumn("_fallos", failed).withColumn("valido", F.size("_fallos") == 0)


def validate_alert_documents(docs: DataFrame, r: Rules = Rules()) -> DataFrame:
    return validate(summarise_alert_documents(docs), alert_checks(r) | lifecycle_checks(r))


def split_valid(validated: DataFrame, source: str, columns: list[str]):
    """Accepted documents, and rejected ones kept whole for the quarantine."""
    good = validated.where("valido").select(*columns)
    record = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    bad = validated.where(~F.col("valido")).select(
        F.lit(source).alias("fuente"), F.concat_ws(",", "_fallos").alias("regla"),
        record.alias("registro"))
    return good, bad


def unknown_fields(raw: Column, allowed: list[str]) -> Column:
    """Fields of a raw JSON object outside the declared ones (lost under a read schema)."""
    return F.array_except(F.json_object_keys(raw), F.array(*[F.lit(a) for a in allowed]))


def failures_by_check(validated: DataFrame, checks: dict[str, Column],
                      document: list[str] | None = None) -> DataFrame:
    """Documents failing each check, zero included. ``document`` names the keys of documents that
    are stored in parts; one fails when any of its parts does."""
    failed = {n: F.array_contains("_fallos", n) for n in checks}
    if document:
        # numbered names: a control may be called like a key
        validated = validated.groupBy(*document).agg(*[
            F.bool_or(c).alias(f"_control{i}") for i, c in enumerate(failed.values())])
        failed = {n: F.col(f"_control{i}") for i, n in enumerate(checks)}
    one = validated.agg(*[F.count_if(c).alias(n) for n, c in failed.items()])
    cells = [F.struct(F.lit(n).alias("control"), F.col(n).alias("rechazados")) for n in checks]
    return one.select(F.explode(F.array(*cells)).alias("x")).select("x.*")

"""Loading of raw alert documents: JSON text to repaired, validated and split documents.

A document is one row, as it comes from its store; nothing here shuffles but the look at the
enrolments. Histories that are rows of a table are judged by ``cleaning.last_state_per_alert``."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campuslens.functions import text as T
from campuslens.operators import cleaning as C
from campuslens.operators import validation as V
from campuslens.session import materialise

SCHEMA = ("alerta_id string, estudiante_id bigint, asignatura string, periodo string, "
          "nivel string, estado string, creada_en timestamp_ntz, actualizado_en timestamp_ntz, "
          "historial_estados array<struct<estado:string,fecha:timestamp_ntz>>, "
          "notas array<struct<nota_id:string,fecha:timestamp_ntz,autor:string,texto:string>>, "
          "es_simulado boolean, fuente string")
FIELDS = [f.split()[0] for f in SCHEMA.split(", ")]
NOTE = ["nota_id", "fecha", "autor", "texto", "texto_normalizado", "categoria"]
RECORD = SCHEMA.replace("texto:string", "texto:string,texto_normalizado:string,categoria:string")
EXTRA = "_ajenos"


def parse(raw: DataFrame, column: str) -> DataFrame:
    """Typed documents; ``_ajenos`` has the fields outside the declared ones, which a read schema
    loses. Unreadable text gives a document of nulls, missing arrays are empty."""
    document = F.from_json(F.col(column), SCHEMA)
    typed = raw.select(document.alias("_d"), F.coalesce(
        V.unknown_fields(F.col(column), FIELDS), F.array().cast("array<string>")).alias(EXTRA)
    ).select("_d.*", EXTRA)
    return typed.withColumns({a: F.coalesce(a, F.array().cast(typed.schema[a].dataType))
                              for a in ("historial_estados", "notas")})


def no_extra_fields() -> dict[str, Column]:
    return {"campos_ajenos": F.size(EXTRA) == 0}


def raw_checks(rules: V.Rules) -> dict[str, Column]:
    """Controls that documents can be held to before their repair."""
    checks = V.alert_checks(rules)
    del checks["notas"]  # the repair adds what it looks at
    return no_extra_fields() | checks | V.lifecycle_checks(rules)


def checks(rules: V.Rules) -> dict[str, Column]:
    return no_extra_fields() | V.alert_checks(rules) | V.lifecycle_checks(rules)


@dataclass
class AlertLoad:
    """Repaired documents of enrolled students, and those of nobody. Only what is judged is staged; the
    ledger counts the repairs where they arise."""
    fixed: DataFrame
    orphans: DataFrame
    rules: V.Rules

    @cached_property
    def judged(self) -> DataFrame:
        """Repaired documents with their failed controls."""
        fixed = materialise(self.fixed, "alertas-reparadas")
        return V.validate(V.summarise_alert_documents(fixed), checks(self.rules))

    @property
    def accepted(self) -> DataFrame:
        return V.split_valid(self.judged, "alertas", FIELDS)[0]

    @property
    def quarantine(self) -> DataFrame:
        """Rejected documents whole, with the names of all controls they fail."""
        return self.orphans.unionByName(V.split_valid(self.judged, "alertas", FIELDS)[1])

    def ledger(self) -> DataFrame:
        return C.alert_ledger(self.fixed)


def load(documents: DataFrame, enrolments: DataFrame, rules: V.Rules = V.Rules(),
         normalise=T.normalise_text, categorise=T.categorise) -> AlertLoad:
    """R-17, then the repairs R-24 and R-25, then the validators: every document is accepted or
    lies in the quarantine."""
    # staged twice: the planner would otherwise copy the parser and the text expressions into
    # every control that looks at their results
    marked = C.mark_orphans(materialise(documents, "alertas"), enrolments)
    orphans = C.quarantined(marked.where("_huerfano"), "alertas", F.lit("R-17"), FIELDS)
    fixed = C.fix_alert_documents(marked.where("NOT _huerfano").drop("_huerfano"),
                                  normalise, categorise)
    return AlertLoad(fixed, orphans, rules)


def read_back(quarantine: DataFrame) -> DataFrame:
    """Quarantined records as documents again, with ``regla``."""
    return quarantine.select("regla", F.from_json("registro", RECORD).alias("_d")).select(
        "regla", "_d.*")

"""End-to-end job on the domain inputs: two register CSVs, event and session logs, alert
documents. Stages: read, diagnose, resolve identity, normalise, clean, nest, integrate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from campuslens import vocabulary as V
from campuslens.functions.calendar import SCHOOL_YEAR, period_table
from campuslens.operators import checks as K
from campuslens.operators import cleaning as C
from campuslens.operators import dataset as A
from campuslens.operators import documents as D
from campuslens.operators import identity as I
from campuslens.operators import validation as W
from campuslens.operators.relational import Tables, unpivot_grades, wide_enrolment
from campuslens.operators.reshape import label, yes_no
from campuslens.session import bounded, materialise
from campuslens.sources import json as J
from campuslens.sources.register import read_register

ROW_ID = "_fila"
LINE_BITS = 40  # lines of one file


def diagnose(register: DataFrame) -> DataFrame:
    """R-02, R-04 and R-05 counts; any domain violation aborts."""
    found = K.domain_violations(register, V.NOMINAL_DOMAINS, V.NUMERIC_DOMAINS)
    total = found.agg(F.sum("violaciones")).first()[0]
    if total:
        raise ValueError(f"{total} register values outside their domains")
    return K.null_profile(register, V.REGISTER_COLUMNS)


def resolve(register: DataFrame) -> DataFrame:
    """R-12: register rows with ``estudiante_id``; POR numbers first, MAT rows inherit. Rows are
    told apart by file and line over all files of both registers."""
    rows = materialise(numbered(register), "numerado")
    evidence = I.identity_evidence(rows, F.col("asignatura") == "MAT", ROW_ID,
                                   V.IDENTITY_KEY, V.PERSONAL_ATTRIBUTES, V.MIN_AGREEMENT)
    ids = materialise(I.identity_ids(rows, F.col("asignatura") == "MAT", ROW_ID,
                                     materialise(evidence, "evidencia")), "identificado")
    before, after = rows.count(), ids.count()
    if before != after:
        raise ValueError(f"identity resolution made {after} rows of {before}")
    return ids.drop(ROW_ID)


def numbered(register: DataFrame) -> DataFrame:
    """A number for every row: place of its file among all files, then its line. The files are
    one row each."""
    files = register.select("ruta_origen").distinct().select(
        "ruta_origen", F.row_number().over(Window.orderBy("ruta_origen")).alias("_archivo"))
    place = F.shiftleft(F.col("_archivo").cast("bigint"), LINE_BITS)
    return register.join(bounded(files, "archivos"), "ruta_origen").withColumn(
        ROW_ID, place + F.col("fila_origen")).drop("_archivo")


def unmatched(ids: DataFrame) -> DataFrame:
    """Rows whose student occurs once: the ones that a near miss may concern."""
    single = ids.groupBy("estudiante_id").agg(F.count(F.lit(1)).alias("_n")).where("_n = 1")
    return ids.join(single.select("estudiante_id"), "estudiante_id", "left_semi")


def register_near_misses(ids: DataFrame) -> DataFrame:
    """R-12b over the unmatched rows of a resolved register."""
    rows = numbered(unmatched(ids))
    return I.near_misses(rows, F.col("asignatura") == "MAT", ROW_ID,
                         [*V.IDENTITY_KEY, *V.PERSONAL_ATTRIBUTES])


def assert_closed(df: DataFrame, column: str, catalogue: list[str], rule: str) -> None:
    """R-20 and R-23: a value outside its closed catalogue ends the load."""
    outside = C.off_catalogue(df, column, catalogue).first()[0]
    if outside:
        raise ValueError(f"{rule}: {outside} values of {column} outside the catalogue")


def dimension(spark: SparkSession, names: dict[str, str], key: str) -> DataFrame:
    rows = [(i, code, name) for i, (code, name) in enumerate(names.items(), 1)]
    return spark.createDataFrame(rows, f"{key} smallint, codigo string, nombre string")


def code_id(column: str, names: dict[str, str]):
    out = F.lit(None).cast("smallint")
    for i, code in enumerate(names, 1):
        out = F.when(F.col(column) == code, F.lit(i).cast("smallint")).otherwise(out)
    return out


def normalise(rows: DataFrame) -> Tables:
    """R-06 to R-09 and R-14: the six normalised tables."""
    spark = rows.sparkSession
    flagged = rows.select(*[yes_no(c).alias(c) if c in V.YES_NO else F.col(c) for c in rows.columns])
    best = I.survivorship(flagged, "estudiante_id", F.when(F.col("asignatura") == "POR", 0)
                          .otherwise(1), ["school", *V.STUDENT_COLUMNS])
    students = best.select("estudiante_id", code_id("school", V.SCHOOLS).alias("escuela_id"), *[
        (label(F.col(old), V.LABELS[new]) if new in V.LABELS else F.col(old)).alias(new)
        for old, new in V.STUDENT_COLUMNS.items()])
    subject = code_id("asignatura", V.SUBJECTS).alias("asignatura_id")
    enrolments = flagged.select(
        "estudiante_id", subject, F.col("failures").alias("reprobaciones_previas"),
        F.col("paid").alias("clases_pagadas"), F.col("absences").alias("faltas"),
        (~((F.col("G3") == 0) & (F.col("absences") == 0))).alias("faltas_confiable"),
        "archivo_origen", "fila_origen")
    grades = unpivot_grades(flagged.withColumn("asignatura_id", subject),
                            ["estudiante_id", "asignatura_id"], {"G1": 1, "G2": 2, "G3": 3})
    return Tables(dimension(spark, V.SCHOOLS, "escuela_id"),
                  dimension(spark, V.SUBJECTS, "asignatura_id"), period_table(spark), students,
                  enrolments, grades)


def expected_counts(register_rows: int, students: int, pairs: int, not_evaluated: int) -> dict:
    return {"I-01": students, "I-02": register_rows, "I-03": 3 * register_rows, "I-07": pairs,
            "I-09": not_evaluated, "I-11": register_rows}


@dataclass
class Behaviour:
    events: C.CleanedEvents
    sessions: C.CleanedSessions
    alerts: DataFrame
    alert_quarantine: DataFrame

    @property
    def quarantine(self) -> DataFrame:
        return self.events.quarantine.unionByName(self.sessions.quarantine).unionByName(
            self.alert_quarantine)


def with_moments(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: J.moment(F.col(c)) for c in columns})


def alert_moments(raw: DataFrame) -> DataFrame:
    """ISO texts of alert documents to timestamps, inside the arrays too."""
    history = F.transform("historial_estados", lambda h: F.struct(
        h["estado"].alias("estado"), J.moment(h["fecha"]).alias("fecha")))
    notes = F.transform("notas", lambda n: F.struct(
        n["nota_id"].alias("nota_id"), J.moment(n["fecha"]).alias("fecha"),
        n["autor"].alias("autor"), n["texto"].alias("texto")))
    return with_moments(raw, "creada_en", "actualizado_en").withColumns(
        {"historial_estados": history, "notas": notes})


def clean_behaviour(spark: SparkSession, events_path: str, sessions_path: str, alerts_path: str,
                    tables: Tables, periods=SCHOOL_YEAR, source: str = "simulado") -> Behaviour:
    """R-15 to R-25 over the three sources, against the enrolments of the register."""
    enrolled = tables.matricula.join(tables.subject_codes(), "asignatura_id").select(
        "estudiante_id", "asignatura")
    log = J.with_arrival(J.read_json_lines(spark, events_path, J.EVENT_SCHEMA, None))
    events = C.clean_events(with_moments(log, "fecha"), enrolled, periods)
    talks = with_moments(J.read_json_lines(spark, sessions_path, J.SESSION_SCHEMA, None), "fecha")
    sessions = C.clean_sessions(talks, enrolled, periods)
    assert_closed(events.clean, "tipo", V.EVENT_TYPES, "R-20")
    assert_closed(sessions.clean, "resultado", V.SESSION_RESULTS, "R-23")
    raw = C.mark_orphans(J.read_json_array(spark, alerts_path, J.ALERT_SCHEMA), enrolled)
    columns = [c for c in raw.columns if c != "_huerfano"]
    bad = C.quarantined(raw.where("_huerfano"), "alertas", F.lit("R-17"), columns)
    good = C.fix_alert_documents(alert_moments(raw.where("NOT _huerfano").select(*columns)))
    good = good.withColumns({"es_simulado": F.lit(True), "fuente": F.lit(source)})
    return Behaviour(events, sessions, good, bad)


@dataclass
class Documents:
    """Accepted documents of both collections, and the rejected ones whole."""
    followup: DataFrame
    alerts: DataFrame
    quarantine: DataFrame


def store_documents(tables: Tables, behaviour: Behaviour, periods=SCHOOL_YEAR,
                    source: str = "simulado", rules: W.Rules = W.Rules()) -> Documents:
    """Nests the cleaned events and sessions and holds both collections to their validators. A part
    of a follow-up document that fails is rejected alone, with its number."""
    nested = materialise(D.build_followup_docs(
        tables.estudiante.select("estudiante_id"), behaviour.events.clean,
        behaviour.sessions.clean, periods, source), "seguimiento")
    followup, bad = W.split_valid(W.validate(nested, W.followup_checks(rules)), "seguimiento",
                                  nested.columns)
    alerts = materialise(behaviour.alerts, "alertas")
    fields = [c for c in alerts.columns if not c.startswith("_")]
    good, worse = W.split_valid(W.validate_alert_documents(alerts, rules), "alertas", fields)
    return Documents(followup, good, bad.unionByName(worse))


def analytic_dataset(tables: Tables, behaviour: Behaviour) -> DataFrame:
    """58 typed columns, one row per enrolment."""
    wide = wide_enrolment(tables)
    alerts = D.alerts_per_enrolment(behaviour.alerts.withColumn("n_notas", F.size("notas")))
    merged = A.integrate(wide, D.lms_activity(behaviour.events.clean),
                         D.sessions_per_enrolment(behaviour.sessions.clean), alerts)
    staged = materialise(merged, "integrada")
    before, after = tables.matricula.count(), staged.count()
    if before != after:
        raise ValueError(f"integration made {after} rows of {before} enrolments")
    return A.typed(A.derive(staged))


@dataclass
class Register:
    """The six tables with the reports of the identity stage (R-11, R-12b, R-13)."""
    tables: Tables
    repeated_keys: DataFrame
    near_misses: DataFrame
    conflicts: DataFrame


def load_register(spark: SparkSession, paths: dict[str, str]) -> Register:
    """Register CSVs (by subject code) to the six normalised tables and the identity reports."""
    parts = [read_register(spark, path, subject) for subject, path in paths.items()]
    register = parts[0]
    for p in parts[1:]:
        register = register.unionByName(p)
    register = materialise(register, "registro")
    diagnose(register)
    ids = materialise(resolve(register), "identidad")
    repeated = ids.groupBy("asignatura", *V.IDENTITY_KEY).agg(F.count(F.lit(1)).alias("filas")) \
        .where("filas > 1")
    return Register(normalise(ids), repeated, register_near_misses(ids),
                    I.survivorship_conflicts(ids, "estudiante_id", V.PERSONAL_ATTRIBUTES))


def register_tables(spark: SparkSession, paths: dict[str, str]) -> Tables:
    """The six normalised tables of the register CSVs."""
    return load_register(spark, paths).tables

"""Table sinks: staged writes that are published only after their checks pass."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from campuslens.operators.checks import require
from campuslens.operators.relational import Tables

MANIFEST = "_published"
#: Text forms with every digit of a moment; Spark's own ones stop at milliseconds.
MOMENTS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
           "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def write_parquet(df: DataFrame, path: str, partition_by: list[str] = []) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Blanks at the ends of a text are part of it."""
    df.write.mode("overwrite").option("header", True).option("escape", '"') \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).options(**MOMENTS).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """Nested documents as JSON Lines; dates stay typed under the read schema."""
    df.write.mode("overwrite").option("ignoreNullFields", False).options(**MOMENTS).json(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """What ``write_csv`` wrote, typed; a value that does not fit its column ends the read. An empty
    text and a missing one are both read as missing, as CSV does not tell them apart."""
    return spark.read.option("header", True).option("mode", "FAILFAST").option("enforceSchema", False) \
        .option("escape", '"').option("multiLine", True).options(**MOMENTS).schema(schema).csv(path)


def read_json(spark: SparkSession, path: str, schema) -> DataFrame:
    """What ``write_json`` wrote, under the schema of the documents."""
    return spark.read.schema(schema).option("mode", "FAILFAST").options(**MOMENTS).json(path)


class PublicationConflict(RuntimeError):
    """Another load has published since this one began."""


def _store(spark: SparkSession, path: str):
    """File system of a path, and a maker of paths on it."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), make


def versions(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """Published (number, version) pairs, ascending. A claim without a version in it, left by a
    load that died, counts as a number taken and names an empty version."""
    files, make = _store(spark, root)
    folder = make(f"{root}/{MANIFEST}")
    if not files.exists(folder):
        return []
    numbers = sorted(int(s.getPath().getName()) for s in files.listStatus(folder)
                     if s.getPath().getName().isdigit())
    out = []
    for n in numbers:
        stream = files.open(make(f"{root}/{MANIFEST}/{n:08d}"))
        try:
            out.append((n, bytes(stream.readAllBytes()).decode()))
        finally:
            stream.close()
    return out


def latest(found: list[tuple[int, str]]) -> str | None:
    return next((version for _, version in reversed(found) if version), None)


def claim(spark: SparkSession, root: str, number: int, version: str) -> None:
    """Makes ``version`` the published one with this number. The file of a number is created only
    where none is there, which the store decides, so one of several loads wins."""
    files, make = _store(spark, root)
    try:
        out = files.create(make(f"{root}/{MANIFEST}/{number:08d}"), False)
    except Py4JJavaError as e:
        if "AlreadyExists" not in str(e.java_exception):
            raise
        raise PublicationConflict(f"{root}: version {number} is taken") from e
    try:
        out.write(bytearray(version.encode()))
    finally:
        out.close()


def discard(spark: SparkSession, root: str, version: str) -> None:
    files, make = _store(spark, root)
    files.delete(make(f"{root}/{version}"), True)


def stage(tables: Tables, root: str) -> tuple[str, Tables]:
    """Writes the six tables under a fresh version folder and reads them back."""
    version = uuid.uuid4().hex
    written = {}
    for name, df in tables.named().items():
        path = f"{root}/{version}/{name}"
        df.write.parquet(path)
        written[name] = df.sparkSession.read.schema(df.schema).parquet(path)
    return version, Tables(**written)


def publish(spark: SparkSession, tables: Tables, root: str, report=None,
            base: int | None = None) -> Tables:
    """Stages, runs ``report`` (a function of the staged tables), and claims the number after
    ``base`` (default: the last one when the call begins) when every control holds.

    A failed control or a number that another load has claimed leaves the published data
    untouched, removes what was staged and raises."""
    if base is None:
        base = max((n for n, _ in versions(spark, root)), default=0)
    version, staged = stage(tables, root)
    try:
        if report is not None:
            require(report(staged))
        claim(spark, root, base + 1, version)
    except Exception:
        discard(spark, root, version)
        raise
    return staged


def published(spark: SparkSession, root: str) -> Tables:
    """The latest published version."""
    version = latest(versions(spark, root))
    if version is None:
        raise ValueError(f"nothing is published under {root}")
    names = Tables.__dataclass_fields__
    return Tables(**{n: spark.read.parquet(f"{root}/{version}/{n}") for n in names})


def prune(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Removes the tables of all but the ``keep`` latest published versions. Their numbers stay
    taken; what a running load has staged is in no claim and is not touched."""
    if keep < 1:
        raise ValueError("the published version cannot be removed")
    files, make = _store(spark, root)
    old = [v for _, v in versions(spark, root) if v][:-keep]
    gone = [v for v in old if files.exists(make(f"{root}/{v}"))]
    for version in gone:
        discard(spark, root, version)
    return gone

"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
MAX_BROADCAST_ROWS = 200_000


def local_session(app: str = "campuslens", cores: str = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and benches; a cluster brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder named by the cluster; a local session without one gets a fresh folder."""
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_KEY} must name a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="campuslens-")
    spark.conf.set(CHECKPOINT_KEY, folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a frame once to the shared folder and read it back: cuts lineage, and the
    planner then sees the true size on disk."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, label: str, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Lookup side of a join: broadcast only when its counted size is within ``max_rows``;
    above it the join stays a shuffle join, which adaptive execution can split on skew."""
    saved = materialise(df, label)
    return F.broadcast(saved) if saved.count() <= max_rows else saved


def spark_cores(df: DataFrame) -> int:
    return df.sparkSession.sparkContext.defaultParallelism


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out over all cores when the source has fewer splits than that (one small
    file); a table with many splits passes unchanged."""
    cores = spark_cores(df)
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df

"""Corpus pipeline: documents to a token file, one operator of ``campuslens.llm`` per stage."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from campuslens.llm import decontaminate, language, mixing, near_copies, token_file
from campuslens.llm.common import table
from campuslens.session import scratch_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language can be told (null text, no letter) go."""
    return language.in_known_language(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (5-word shingles, similarity 0.8) the smallest id stays."""
    return near_copies.one_per_group(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, left out or cut to the budget of their source."""
    return mixing.mixed_documents(docs)


def write_token_file(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as a token file; a row per document as read back from it."""
    return token_file.tokens_round_trip(docs)


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", remove_near_copies),
    ("decontamination", remove_benchmark),
    ("mixing", mix),
    ("token_output", write_token_file),
]

#: Models, fingerprints and a tokenizer: SQL cannot express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{scratch_dir(spark).rstrip('/')}/pipeline-{uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""Registered queries of the training-data operators. Each one runs its operator, with production
parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campuslens.llm import (
    ball_tree,
    chat,
    decontaminate,
    language,
    merkle,
    mixing,
    page_text,
    personal_data,
    repeats,
    runs,
    simhash,
    token_count,
    token_file,
)
from campuslens.llm.common import table
from campuslens.llm.merkle_sql import OP13_SQL

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file.tokens_round_trip(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"))


def op3_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.document_languages(table(spark, sf_dir, "documents"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op5_simhash_covering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


#: A conversation of control strings, added to the table's.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op6_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)],
                                  turns.schema)
    parts = turns.union(extra).select("conv_id", "turn", "role",
                                      chat.text_part(F.col("text")).alias("parts"))
    return chat.chat_round_trip(parts)


def op7_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract_pages(table(spark, sf_dir, "pages"))


def op8_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op9_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"),
                                       table(spark, sf_dir, "benchmark"))


def op11_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.span_digests(personal_data.find_spans(table(spark, sf_dir, "documents")))


def op12_lyndon_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = runs.with_planted_runs(table(spark, sf_dir, "documents"))
    return runs.run_digests(runs.periodic_runs(docs))


def op13_merkle_proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_token_file": op1_token_file,
    "op2_token_counts": op2_token_counts,
    "op3_language_mixture": op3_language_mixture,
    "op4_mix_sources": op4_mix_sources,
    "op5_simhash_covering": op5_simhash_covering,
    "op6_chat_parts": op6_chat_parts,
    "op7_page_text": op7_page_text,
    "op8_suffix_repeats": op8_suffix_repeats,
    "op9_ball_tree": op9_ball_tree,
    "op10_winnowing": op10_winnowing,
    "op11_weak_supervision": op11_weak_supervision,
    "op12_lyndon_runs": op12_lyndon_runs,
    "op13_merkle_proofs": op13_merkle_proofs,
}

#: The mix in SQL: md5 keys order each source, sums before a document place it in the sequence.
OP4_SQL = r"""
WITH sized AS (
  SELECT doc_id, source IS NULL AS nosrc, coalesce(source, '') AS src,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || '|' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS key
  FROM documents),
sources AS (SELECT nosrc, src, sum(size)::BIGINT AS source_size FROM sized GROUP BY 1, 2),
ranked AS (
  SELECT *, CASE (row_number() OVER (ORDER BY nosrc, encode(src)) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sources),
caps AS (SELECT *, source_size * 3 AS cap, (source_size * 3)::DOUBLE / weight AS bound FROM ranked),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))::DOUBLE AS level
  FROM caps WINDOW b AS (ORDER BY bound, nosrc, encode(src) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
picked AS (SELECT level FROM levels WHERE level <= bound ORDER BY bound, nosrc, encode(src) LIMIT 1),
targets AS (
  SELECT nosrc, src, source_size, least(cap::DOUBLE, picked.level * weight) AS target FROM levels, picked),
placed AS (
  SELECT doc_id, size, source_size, target, floor(target + 0.5)::BIGINT AS budget,
         coalesce(sum(size) OVER (PARTITION BY nosrc, src ORDER BY key, doc_id NULLS FIRST
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place
  FROM sized JOIN targets USING (nosrc, src))
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, budget - place)) + greatest(0, least(size, budget - place - source_size))
        + greatest(0, least(size, budget - place - 2 * source_size)))::BIGINT AS taken
FROM placed
"""

ORACLES: dict[str, str] = {"op4_mix_sources": OP4_SQL, "op13_merkle_proofs": OP13_SQL}

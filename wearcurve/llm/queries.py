"""Registered queries of this package, each over its whole table, and their SQL for another engine."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wearcurve.llm import alignment, chat, classifier, mixing, periods, quality, secret_scan, sentence_pieces, sharding, simhash, token_counts, token_files, vectors
from wearcurve.sources.sinks import shared_dir

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    assessed = quality.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return assessed.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op2_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    probe = [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.round_trip(turns.union(spark.createDataFrame(probe, "conv_id long, turn long, role string, text string")))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "shards")
    written = sharding.write_shards(table(spark, sf_dir, "documents"), path)
    return sharding.shard_table(spark, path, written)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, WORD_VOCABULARY)
    return token_files.token_starts(spark, path)


def op7_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.round_trip(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_copies(table(spark, sf_dir, "embeddings"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.over_budget(table(spark, sf_dir, "documents"), WORD_VOCABULARY)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.report(periods.with_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(table(spark, sf_dir, "documents"), BYTE_VOCABULARY, PIECE_MODEL)


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_chat_windows": op2_chat_windows,
    "op3_mixing": op3_mixing,
    "op4_simhash": op4_simhash,
    "op5_sharding": op5_sharding,
    "op6_token_files": op6_token_files,
    "op7_sentence_pieces": op7_sentence_pieces,
    "op8_embeddings": op8_embeddings,
    "op9_token_counts": op9_token_counts,
    "op10_secret_scan": op10_secret_scan,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_token_alignment": op12_token_alignment,
    "op13_quality_classifier": op13_quality_classifier,
}

#: Queries whose result SQL can express.
ORACLES: dict[str, str] = {
    "op3_mixing": """
WITH sized AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
own AS (SELECT source, sum(size) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size,
         [1, 2, 3][CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight
  FROM own),
rated AS (
  SELECT source, source_size, weight,
         CAST(sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (
                ORDER BY source_size / weight, source ASC NULLS LAST
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
         / CAST(sum(weight) OVER (ORDER BY source_size / weight, source ASC NULLS LAST
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS rate
  FROM weighed),
share AS (
  SELECT rate AS share FROM rated WHERE rate * weight <= 3 * source_size ORDER BY source_size / weight LIMIT 1),
target AS (
  SELECT source, CAST(source_size AS BIGINT) AS source_size,
         least(share * weight, CAST(3 * source_size AS DOUBLE)) AS target
  FROM weighed, share),
due AS (
  SELECT *, CAST(floor(ratio) AS INT) AS whole, ratio - floor(ratio) AS part
  FROM (SELECT *, coalesce(target / nullif(source_size, 0), 0) AS ratio FROM target)),
drawn AS (
  SELECT s.doc_id, s.source, s.size, source_size, target, whole, part,
         (CAST(CAST('0x' || substr(md5('11|' || coalesce(CAST(s.doc_id AS VARCHAR), '-')), 1, 13) AS BIGINT) AS DOUBLE)
          + 0.5) / 4503599627370496.0 AS u
  FROM sized s JOIN due d ON s.source IS NOT DISTINCT FROM d.source),
ranked AS (
  SELECT *, CASE WHEN part > 0 THEN u * (1 - part) / (u * (1 - part) + (1 - u) * part) ELSE 1 END AS rank FROM drawn),
run AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank, doc_id, size
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS words
  FROM ranked)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN part > 0 AND 2 * words - size <= 2 * (target - whole * source_size)
                                 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM run
""",
}

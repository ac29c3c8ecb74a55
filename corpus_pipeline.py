"""A corpus from raw documents to ids: rules, near copies, secrets, mix, encoding.

Each stage works on all its predecessor kept. Its result is written as Parquet and read again by the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wearcurve.llm import mixing, quality, secret_scan, sentence_pieces, simhash
from wearcurve.llm.queries import PIECE_MODEL, table
from wearcurve.llm.work import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned list reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return simhash.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with confirmed secrets masked."""
    return secret_scan.redact(docs, secret_scan.findings(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the sources' target weights take them."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's ids, and digest of the text they decode to."""
    return sentence_pieces.round_trip(docs, PIECE_MODEL)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near copies", near_copies),
    ("secrets", secrets),
    ("mix", mix),
    ("encode", encode),
]

#: Digests of encodings and fingerprints have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

"""Corpus pipeline: the stages that turn ``documents`` into encoded training text.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.llm import decontam, line_dedup, queries, simhash
from scorewright.llm.common import read, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    scored = queries.quality_scores(spark, docs, sf_dir)
    return scored.where(F.col("score") >= queries.QUALITY_THRESHOLD).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that recur in many of them; n_chars follows the text."""
    kept = line_dedup.drop_frequent_lines(docs, queries.LINE_MIN_CHARS, queries.LINE_MIN_DOCS)
    return kept.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest doc_id. Of rows that share this doc_id one
    stays; rows without doc_id stay only where their whole group has none, and then one of them."""
    return simhash.keep_one(docs, queries.SIMHASH_SHINGLE, queries.SIMHASH_DISTANCE).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passages beyond the contract's share."""
    return decontam.decontaminate(docs, read(spark, sf_dir, "benchmark")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded texts."""
    return queries.bpe_digests(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_filter),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]

ORACLE_SQL = None  # trained scores and linked fingerprints are beyond SQL; tests/llm holds a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs

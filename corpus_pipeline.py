"""A training-data pipeline over ``documents``: each stage works on all that the stage before
kept, its decisions take effect, and its result is written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from genomill.llm import langid, linededup, minhash, packing, pii
from genomill.llm.common import save, table

#: Links of the near-duplicate stage have this similarity, in percent, or more.
SIMILARITY = 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear."""
    return langid.filter_language(docs, langid.train(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the lines that an earlier line matches; those left without a line go."""
    return linededup.without_lines(docs, linededup.removed_lines(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest id, of each group of near copies."""
    found = minhash.near_duplicates(docs, SIMILARITY)
    return docs.join(found.filter("not kept").select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii.redact(docs)


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in training sequences."""
    return packing.best_fit(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("best_fit", best_fit),
]

#: SQL has no tokenizer, no compressor and no iteration; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

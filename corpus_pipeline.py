"""A training-corpus pipeline over documents; each stage calls one operator and is written and reread."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkstrata.llm import decontaminate, exact_dedup, language, near_dedup, packing
from inkstrata.llm.queries import tokenizer_path
from inkstrata.llm.store import bounded_batches, small, stage_tables, table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
NEAR = 80  # percent of shingles that near duplicates share at least


def _keyed(docs: DataFrame) -> DataFrame:
    """docs written with a key of its own for each row: whatever doc_ids are null or shared, and however later scans are split, a row keeps its key."""
    return written(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row_key")), "keyed")


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of a keyed docs whose key is not in gone, a written table."""
    return docs.join(small(gone, 1_000_000), "row_key", "left_anti").select(*COLUMNS)


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found; it becomes lang where lang is null. Null texts and texts without any letter are rejected.

    Each row is judged by its own text: repeated rows and null or shared doc_ids change nothing. An empty table stays empty;
    columns beyond those of documents are ignored, here and in every stage."""
    bounded_batches(spark)
    docs = docs.select(*COLUMNS)
    found = language.identify(docs, language.fit(docs)).filter(F.col("lang_pred") != language.UNDETERMINED)
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: that of the smallest doc_id, one of them if it is repeated; one without an id only where no row has one.

    Null counts as an empty text. Other rows that share a dropped row's doc_id stay."""
    docs = _keyed(docs)
    gone = written(exact_dedup.exact_dedup(docs, row_key="row_key").filter("not kept").select("row_key"), "copies")
    return _without(docs, gone)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked by a similarity of NEAR percent or more: that of the smallest doc_id (null last).

    Rows without words, null texts among them, are linked with nothing and stay; so do rows that only share a dropped row's doc_id."""
    bounded_batches(spark)
    docs = _keyed(docs)
    gone = written(near_dedup.near_duplicates(docs, percent=NEAR, row_key="row_key").filter("not kept").select("row_key"), "near_copies")
    return _without(docs, gone)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that no benchmark passage contaminates, each judged by its own text; null and empty texts stay."""
    docs = _keyed(docs)
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), row_key="row_key")
    return _without(docs, written(found.filter("contaminated").select("row_key"), "contaminated"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows in training sequences; a null or empty text is its end token alone."""
    bounded_batches(spark)
    return packing.pack_documents(docs, tokenizer_path())


def _stage(run: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """run, whose own tables go when the next stage begins: by then its result is written."""

    @wraps(run)
    def staged(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with stage_tables(spark):
            return run(spark, docs, sf_dir)

    return staged


STAGES = [
    (name, _stage(run))
    for name, run in (
        ("language", by_language),
        ("exact_dedup", without_copies),
        ("near_dedup", without_near_copies),
        ("decontaminate", without_benchmark),
        ("pack", packed),
    )
]

#: Training-sample hashes, MinHash components and tokenizer ids have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

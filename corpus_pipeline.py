"""Documents to an encoded training mix, one written table after another.

``STAGES`` run in order; each gets the documents its predecessor kept, and all but the last return
the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm import bpe, jaccard_join, mixing, quality
from tickloom.llm.queries import TOKENIZER, quality_labels
from tickloom.sources.shared import written_once

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: SQL cannot express the classifier.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    scored = quality.classify(docs, quality_labels(spark, sf_dir), keep=COLUMNS)
    return scored.filter("predicted = 1").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays: that with the smallest id, null ids last.

    Rows are told apart by their place in the table, so repeated and missing ids count row by row. Documents without words link
    with nothing and stay.
    """
    rows = docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_row"))
    found = jaccard_join.near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text")).filter("n_shingles > 0")
    grouped = rows.select("_row", "doc_id").join(
        found.select(F.col("doc_id").alias("_row"), F.col("component_id").alias("_group")), "_row")
    grouped = written_once(grouped, "grouped")
    first = grouped.groupBy("_group").agg(
        F.min(F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id", "_row")).alias("first"), F.count("*").alias("n"))
    first = first.filter("n > 1").select("_group", F.col("first._row").alias("_kept"))
    dropped = written_once(grouped.join(first, "_group").filter("_row <> _kept").select("_row"), "dropped")
    return rows.join(dropped, "_row", "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each pass of the mix over a document, in training order.

    The document at a source's cut is taken whole or left, whichever is nearer to the target; one that is longer than its source's
    whole target has only the words the mix takes of it. Documents the mix does not take, and those without words, go.
    """
    rows = docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_row"))
    # The mix is made of sizes and row numbers; the texts join it once.
    mixed = mixing.in_training_order(mixing.with_whole_cuts(mixing.mix(rows, keep=("_row",))))
    passes = written_once(mixed.select("kept._row", "size", "number", "time", "words"), "passes")
    first = mixing.first_words(F.col("text"), F.col("words"))
    joined = passes.join(rows, "_row").withColumn("_first", F.when(F.col("words") < F.col("size"), first))
    return joined.orderBy("time", "doc_id", "number").select(
        "doc_id", F.coalesce("_first", "text").alias("text"), "lang", "source",
        F.coalesce(F.length("_first").cast("bigint"), "n_chars").alias("n_chars"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of each row's ids and of the text they decode to."""
    return bpe.token_digests(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", keep_good),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written_once(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: toxicity, line deduplication, n-gram Jaccard join, benchmark decontamination, byte-level BPE.

Every stage works on all rows that the one before it kept; run() writes each result as Parquet and reads it again. The
first four return the columns of documents (n_chars follows the text), the last adds the token ids. No SQL can express
the first stage, so ORACLE_SQL is None; tests hold the pipeline against brute force.

A document whose lines are all later copies stays as a row with an empty text, which no later stage removes.

Edges: null and empty texts are never toxic, repeated, similar or contaminated, so their rows stay; a null doc_id is a
document that no stage can single out by its id, so it stays unless its text is toxic or contaminated; rows equal in
doc_id and text are one document and stay or go together; other rows of one doc_id go together in the similarity stage;
very long texts are one row's work; empty tables give an empty result, and without labels or benchmark nothing is toxic
or contaminated; columns beyond those of documents are dropped, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.llm import byte_bpe, decontaminate, jaccard_join, line_dedup, toxicity
from tickframe.llm.common import dropped, stored
from tickframe.llm.queries import rank_file, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models reject go."""
    return toxicity.clean(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows leave the texts."""
    out = line_dedup.dedup_lines(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents the smallest doc_id stays."""
    return jaccard_join.one_of_each(docs.select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window with the benchmark go."""
    return decontaminate.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text's token ids."""
    return byte_bpe.encode(docs.select(*COLUMNS), rank_file()).drop("text")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", keep_one_of_similar),
    ("decontaminate", drop_contaminated),
    ("byte_bpe", tokenize),
]
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; a stage's table goes once the next one is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            dropped(before)
        before = docs
    return docs

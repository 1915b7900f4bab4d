"""A corpus pipeline: each stage reads what the stage before it wrote, and its decisions take effect.

Rows that a filtering stage drops are gone, the line stage changes texts; all columns of documents stay until
the last stage, which returns the digests of the token ids. An empty table gives an empty table in every stage, repeated
rows are treated alike, and columns are found by position, so that further ones may be called as they like (Parquet,
in which ``run`` stores each stage, holds no names that differ in case only).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard, leaks, line_chunks, quality, workload
from tidemark.llm.common import by_position, documents, store, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; null and empty texts are rejected."""
    return quality.keep_good(docs)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without line chunks and runs of lines that another one holds; those of which nothing is left go.

    Copies of a document as a whole stay as they are for the next stage, which keeps one of them. Null and empty texts
    stay; ``n_chars``, if there is one, follows the text.
    """
    found = line_chunks.remove_repeated(docs, line_chunks.Chunking(copy_share=0.8), removed="line_chunks_removed")
    plain, at = by_position(found)
    body, removed = F.col(at["text"]), F.col(at["line_chunks_removed"])
    plain = plain.where((removed == 0) | (body != ""))
    if "n_chars" in docs.columns:
        length = F.length(body).cast(docs.schema["n_chars"].dataType)
        plain = plain.withColumn(at["n_chars"], F.when(removed > 0, length).otherwise(F.col(at["n_chars"])))
    return plain.drop(at["line_chunks_removed"]).toDF(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group linked by 5-word shingles at a similarity of 0.8; null and empty texts, linked with
    nothing, and rows without an id stay, of rows that repeat an id one."""
    return jaccard.keep_one(docs, jaccard.Rule(words=5, share=80, per=100))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null and empty texts stay."""
    return leaks.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the token ids of every document that is left; a null text counts as empty."""
    return workload.byte_bpe_digest(spark, docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_documents),
    ("line_chunks", without_repeated_lines),
    ("jaccard", one_of_each_group),
    ("leaks", without_benchmark),
    ("byte_bpe", tokens),
]

# Learned weights, rolling hashes, similarity joins and prefix tables have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each written as Parquet and read again."""
    found = documents(spark, sf_dir)
    for name, stage in STAGES:
        found = store(stage(spark, found, sf_dir), name)
    return found

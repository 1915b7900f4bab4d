"""SparkSession settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE re-plans joins and splits skewed shuffle partitions from run-time sizes; ANSI makes overflow and
# bad casts fail instead of turning into wrong numbers (the operators use try_* where bad input is data).
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
}


MEBIBYTE = 1024 * 1024


def sized(input_bytes: int, cores: int, partition_bytes: int = 256 * MEBIBYTE) -> dict[str, str]:
    """Settings that make partitions of about ``partition_bytes`` for a job over ``input_bytes``.

    The default of 200 shuffle partitions would put half a terabyte of a 100 TB shuffle into each task.
    AQE merges what turns out small, so the starting number follows the input, between two waves of
    tasks and a bound on the number of shuffle blocks.
    """
    partitions = min(max(-(-input_bytes // partition_bytes), 2 * cores), 200_000)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
    }


def build(app: str = "tidemark", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with ``SETTINGS``; ``master`` is left to spark-submit unless given (tests, bench)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**SETTINGS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

"""Sinks. Results are written in parallel, one file per task; order inside a sorted export follows file order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_delimited(df: DataFrame, path: str, mode: str = "overwrite", encoding: str = "UTF-8") -> None:
    """CSV folder with header lines."""
    writer = df.write.mode(mode).option("header", True).option("encoding", encoding)
    writer.option("quote", '"').option("escape", '"').csv(path)


def write_lines(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Text folder from the string column ``line`` (sorted by ``line_no`` where that column exists)."""
    if "line_no" in lines.columns:
        lines = lines.orderBy("line_no")
    lines.select(F.col("line").alias("value")).write.mode(mode).text(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> int:
    """Parquet folder, optionally partitioned; returns the rows written, counted while writing."""
    observed = Observation("write")
    counted = df.observe(observed, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return observed.get["rows"]

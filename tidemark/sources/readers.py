"""Delimited text and Parquet sources."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import POSITION, blank_to_null, finite, parse_number


def row_position(row: Column) -> Column:
    """The place of a row in its source: file, block of the file, and a number that grows along the block.

    A block is read in order by one task, so ordering by this struct is the order of the files, by path, and of
    the lines in each, however the files are split and whatever machine reads them. Rows that are read in order
    are not deterministic to Spark: store the table where it feeds scalar subqueries within aggregates.
    """
    meta = lambda name: F.col(f"_metadata.{name}")
    return F.struct(meta("file_path").alias("file"), meta("file_block_start").alias("block"), row.alias("row")).alias(POSITION)


def read_delimited(
    spark: SparkSession,
    path: str,
    types: Mapping[str, str] | None = None,
    encoding: str = "UTF-8",
    delimiter: str = ",",
    multiline: bool = False,
    position: bool = False,
) -> DataFrame:
    """CSV with header. Every field is read as text, missing-value texts become NULL, then ``types`` apply.

    ``types`` maps column names (header names, stripped) to numeric Spark types; a text that is no number
    becomes NULL. Columns not named stay strings. Nothing is inferred, so the file is read only once.
    Files are split across tasks unless ``multiline`` (quoted line breaks) asks for whole files. With ``position``
    the rows carry their place in the files (see ``row_position``), for steps that go by the order of the file.
    """
    raw = (
        spark.read.option("header", True)
        .option("encoding", encoding)
        .option("sep", delimiter)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .csv(path)
    )
    types = dict(types or {})
    columns = []
    for name in raw.columns:
        text = blank_to_null(F.col(f"`{name}`"))
        wanted = types.get(name.strip())
        columns.append((parse_number(text, wanted) if wanted else text).alias(name))
    if position:
        columns.append(row_position(F.monotonically_increasing_id()))
    return raw.select(*columns)


def read_table(spark: SparkSession, folder: str, name: str, schema: str | None = None, position: bool = False) -> DataFrame:
    """One of the Parquet tables of a folder (``<folder>/<name>.parquet``).

    With a schema no job is run to read file footers before the query itself. NaN reads as NULL. With ``position`` the
    rows carry their place in the files, which Parquet numbers itself.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    found = reader.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    if position:
        # The number counts along the whole file, so the block has nothing to add.
        place = F.struct(F.col("_metadata.file_path").alias("file"), F.lit(0).cast("bigint").alias("block"), F.col("_metadata.row_index").alias("row"))
        found = found.select("*", place.alias(POSITION))
    return found.withColumns({c: finite(F.col(f"`{c}`")) for c, kind in found.dtypes if kind in ("double", "float")})


def long_lines(spark: SparkSession, path: str, encoding: str = "UTF-8", delimiter: str = ",") -> DataFrame:
    """One row: lines with more fields than the header has. The CSV reader cuts such lines to the header's width."""
    header = spark.read.option("header", True).option("encoding", encoding).option("sep", delimiter).csv(path).columns
    wide = ", ".join(f"c{i} string" for i in range(len(header) + 1))
    reader = spark.read.schema(wide).option("header", True).option("enforceSchema", True).option("encoding", encoding)
    rows = reader.option("sep", delimiter).option("quote", '"').option("escape", '"').csv(path)
    return rows.agg(F.count(f"c{len(header)}").alias("long_lines"))

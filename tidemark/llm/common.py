"""What the text operators share: choosing columns, bounded batches, UTF-8 views, stored tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.checkpoints import store

__all__ = ["BATCH_BYTES", "by_position", "documents", "kept", "map_batches", "pick", "slices", "store", "table", "texts"]

# Text given to one call of a Python batch function; a longer text is a batch of its own.
BATCH_BYTES = 8 * 1024 * 1024
# Rows that Spark hands to a Python worker at once; its own default of 10,000 whole texts takes room in both processes.
BATCH_ROWS = 1_000
ROWS_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a folder, read by Spark from wherever the folder is."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def pick(df: DataFrame, **names: str) -> DataFrame:
    """The named columns under new names: ``pick(df, doc_id="id", text="body")``.

    Columns are found by position and exact spelling, the first one of equal names, so that further
    columns whose names clash (or differ in case only) do no harm.
    """
    at = {}
    for new, old in names.items():
        if old not in df.columns:
            raise ValueError(f"no column {old} in {df.columns}")
        at[new] = df.columns.index(old)
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"c{i}").alias(new) for new, i in at.items()])


def by_position(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The table with columns called c0, c1 and so on, and the new name of each old one, the first of equal names.

    Names that differ in case only, or clash with those an operator uses, do no harm in it; ``toDF`` gives the old
    names back.
    """
    names: dict[str, str] = {}
    for i, c in enumerate(df.columns):
        names.setdefault(c, f"c{i}")
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), names


def slices(batch: pa.RecordBatch, text: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``limit`` bytes of text, and one row at least."""
    rows, begin, size = batch.num_rows, 0, 0
    lengths = pa.compute.binary_length(batch.column(text)).fill_null(0).to_pylist()
    for i in range(rows):
        if size and size + lengths[i] > limit:
            yield batch.slice(begin, i - begin)
            begin, size = i, 0
        size += lengths[i]
    if begin < rows:
        yield batch.slice(begin, rows - begin)


# What one operator keeps between the tasks of this Python worker, by its name and key.
_kept: dict[str, tuple[object, object]] = {}


def kept(owner: str, key: object, make: Callable[[], object]) -> object:
    """What ``make`` gives for ``key``, made once in this Python worker and kept until another operator's tasks run here."""
    if owner not in _kept or _kept[owner][0] != key:
        _kept.clear()
        _kept[owner] = key, make()
    return _kept[owner][1]


def map_batches(
    df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, text: str = "text", owner: str = ""
) -> DataFrame:
    """Apply ``work`` to byte-bounded Arrow batches; no shuffle, no state between batches but what ``owner`` has ``kept``.

    Workers outlive their tasks, so they give back what others have kept, and free buffers at the end of each task.
    """
    conf = df.sparkSession.conf
    if int(conf.get(ROWS_SETTING)) > BATCH_ROWS:
        conf.set(ROWS_SETTING, str(BATCH_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if owner not in _kept:
            _kept.clear()
        for batch in batches:
            for part in slices(batch, text):
                yield work(part)
            del batch
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch, a null as the empty text."""
    return [t or "" for t in batch.column(name).to_pylist()]

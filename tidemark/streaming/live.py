"""Windowed KPIs and alerts over an event-time stream, and scoring of a stream with stored statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.functions import percent, total
from tidemark.operators import anomaly
from tidemark.operators.kpi import target_alerts
from tidemark.sources.checkpoints import fresh_path


def read_stream(spark: SparkSession, path: str, schema: StructType | str, files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files below a path (a folder or a pattern of files and folders) as a stream.

    Without ``files_per_trigger`` all that has arrived is one micro-batch. A cap cuts a backlog into several, in
    the order of file times; see ``run_available`` for what that means for late rows.
    """
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(path)


def with_event_time(df: DataFrame, column: str, late: str = "1 hour") -> DataFrame:
    """Watermark on a timestamp column (zone-less timestamps are taken in the session time zone)."""
    return df.withColumn("event_time", F.col(column).cast("timestamp")).withWatermark("event_time", late)


def windowed_totals(
    events: DataFrame, keys: Sequence[str], value: str, window: str = "1 day", slide: str | None = None, scale: int | None = None
) -> DataFrame:
    """Rows and value sum per event-time window and key. State holds one row per open window and key."""
    span = F.window("event_time", window, slide) if slide else F.window("event_time", window)
    return (
        events.groupBy(span.alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("rows"), total(F.col(value), scale).alias("actual_value"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "rows", "actual_value")
    )


def windowed_on_time(events: DataFrame, unit: str, flag: str = "on_time", window: str = "1 day") -> DataFrame:
    """On-time share per event-time window and unit."""
    return (
        events.groupBy(F.window("event_time", window).alias("w"), F.col(unit))
        .agg(F.sum(flag).cast("bigint").alias("on_time_count"), F.count(flag).alias("total_orders"))
        .select(
            F.col("w.start").alias("window_start"),
            unit,
            "on_time_count",
            "total_orders",
            percent(F.col("on_time_count"), F.col("total_orders")).alias("on_time_pct"),
        )
    )


def live_alerts(windows: DataFrame, targets: DataFrame, keys: Sequence[str], threshold: float = 15.0) -> DataFrame:
    """Windows whose value deviates from the target of their key by more than ``threshold`` percent.

    ``targets`` is a static table (keys, target_value), joined to the stream as it stands.
    """
    return target_alerts(windows.join(targets, list(keys)), threshold)


def frozen_statistics(history: DataFrame, components: Sequence[anomaly.Component] = anomaly.CARD_COMPONENTS) -> dict[str, float]:
    """The few column statistics of past data that scoring needs (one row, read once)."""
    return anomaly.score_statistics(history, components).first().asDict()


def score_stream(
    rows: DataFrame,
    statistics: Mapping[str, float],
    components: Sequence[anomaly.Component] = anomaly.CARD_COMPONENTS,
    at_least: float = anomaly.FLAG_SCORE,
) -> DataFrame:
    """Row-by-row risk score, level and flag with fixed statistics: no state, no shuffle."""
    out = anomaly.risk_level(anomaly.risk_score(rows, components, statistics=statistics))
    return anomaly.combine_flags(out, flags=(), at_least=at_least)


class RowsDropped(RuntimeError):
    """Rows came after their window had closed, and the result lacks them."""


def _finish(query: StreamingQuery) -> int:
    """Wait for the end; rows that the watermark dropped, summed over all micro-batches."""
    dropped: dict[int, int] = {}
    while True:
        ended = query.awaitTermination(0.5)
        for progress in query.recentProgress:
            dropped[progress["batchId"]] = sum(op["numRowsDroppedByWatermark"] for op in progress["stateOperators"])
        if ended:
            return sum(dropped.values())


def run_available(stream: DataFrame, name: str, mode: str = "append", state: str | None = None, path: str | None = None) -> DataFrame:
    """Process everything that has arrived, write it to Parquet in the shared folder, and read it back.

    ``append`` writes a window once its watermark has passed: windows still open stay in the state, and rows
    that come later than the watermark allows are dropped. Dropped rows raise ``RowsDropped``. ``complete``
    keeps every window, drops nothing whatever the order or number of files, and returns open windows too; its
    result is the whole table as of the last micro-batch. With ``state`` (and, for ``append``, ``path``) a later
    call goes on where this one ended; they are folders all executors share.
    """
    spark = stream.sparkSession
    path = path or fresh_path(spark, name)
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", state or fresh_path(spark, f"{name}-state"))
    if mode == "complete":
        last: list[str] = []

        def write(batch: DataFrame, batch_id: int) -> None:
            target = f"{path}/batch={batch_id}"
            batch.write.mode("overwrite").parquet(target)
            last[:] = [target]

        dropped = _finish(writer.foreachBatch(write).trigger(availableNow=True).start())
        if not last:
            return spark.createDataFrame([], stream.schema)
        path = last[0]
    else:
        dropped = _finish(writer.format("parquet").option("path", path).trigger(availableNow=True).start())
    if dropped:
        raise RowsDropped(f"{dropped} rows of {name} were later than the watermark allows")
    return spark.read.schema(stream.schema).parquet(path)

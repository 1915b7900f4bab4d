"""Tables that grow with each micro-batch of a stream: KPI totals, sessions, scores.

A micro-batch is reduced to partial results, which are merged with those of all batches before it and written as the
next version of the table. A batch is named by its number: one that is replayed after a failure finds its
version written and changes nothing. Rows later than allowed are kept in a table of their own instead of being
dropped or failing the run. What has been seen so far, by which lateness is judged, is a version as well, so a
restart judges as the run before it did.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators import anomaly
from tidemark.sources.checkpoints import drop_versions, read_version, versions, write_version

# Versions that stay: the newest one, and the one before it for readers that have begun.
KEPT = 2
Merge = Callable[[DataFrame, int], None]


class Kept(NamedTuple):
    """A table kept below ``folder``: grouped by ``keys``, sums of ``value`` with ``scale`` decimals, rows up to ``late``
    behind the newest one merged, later ones put aside."""

    folder: str
    keys: tuple[str, ...]
    value: str
    late: str = "1 hour"
    scale: int = 2
    time: str = "event_time"

    def at(self, part: str) -> str:
        return f"{self.folder.rstrip('/')}/{part}"


# -- partial results ----------------------------------------------------------------------------------


def _measures(kept: Kept) -> list[Column]:
    """Rows, values, their exact sum in units of the last decimal, least and greatest value."""
    v = F.col(kept.value)
    units = F.round(v * 10**kept.scale).cast("decimal(38,0)")
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count(v).alias("present"),
        F.coalesce(F.sum(units), F.lit(0)).cast("decimal(38,0)").alias("units"),
        F.min(v).alias("least"),
        F.max(v).alias("greatest"),
    ]


def _merged() -> list[Column]:
    """The measures of several partial results together."""
    return [
        F.sum("rows").alias("rows"),
        F.sum("present").alias("present"),
        F.sum("units").cast("decimal(38,0)").alias("units"),
        F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
    ]


def _shown(kept: Kept) -> list[Column]:
    value = F.col("units").cast("double") / 10**kept.scale
    return [
        F.col("rows"),
        value.alias("actual_value"),
        F.try_divide(value, F.col("present").cast("double")).alias("mean_value"),
        F.col("least").alias("min_value"),
        F.col("greatest").alias("max_value"),
    ]


# -- lateness ------------------------------------------------------------------------------------------


def _split(batch: DataFrame, number: int, kept: Kept, end: Column) -> DataFrame:
    """The rows of a batch that are in time; the others are written to the late table.

    A row is late if ``end``, when what it belongs to is over, is not after the newest time of all earlier batches
    less the lateness allowed.
    """
    spark = batch.sparkSession
    before = [n for n in versions(spark, kept.at("clock")) if n < number]
    clock = read_version(spark, kept.at("clock"), before[-1]) if before else None
    timed = batch.where(F.col(kept.time).isNotNull())
    newest = timed.agg(F.max(kept.time).alias("newest"))
    if clock is None:
        write_version(newest, kept.at("clock"), number)
        return timed
    passed = clock.first()["newest"]
    write_version(clock.unionByName(newest).agg(F.max("newest").alias("newest")).coalesce(1), kept.at("clock"), number)
    drop_versions(spark, kept.at("clock"), before[-1])
    if passed is None:
        return timed
    late = end <= F.lit(passed) - F.expr(f"interval {kept.late}")
    write_version(timed.where(late), kept.at("late"), number)
    return timed.where(~late)


def late_rows(spark: SparkSession, kept: Kept) -> DataFrame | None:
    """All rows that came too late, with the ``version`` of their batch; None if every batch came in time."""
    found = versions(spark, kept.at("late"))
    paths = [f"{kept.at('late')}/version={n}" for n in found]
    return spark.read.option("basePath", kept.at("late")).parquet(*paths) if paths else None


def _publish(table: DataFrame, kept: Kept, number: int) -> None:
    spark = table.sparkSession
    write_version(table, kept.at("table"), number)
    known = versions(spark, kept.at("table"))
    drop_versions(spark, kept.at("table"), known[-KEPT:][0])


def _before(spark: SparkSession, kept: Kept, number: int) -> DataFrame | None:
    known = [n for n in versions(spark, kept.at("table")) if n < number]
    return read_version(spark, kept.at("table"), known[-1]) if known else None


# -- KPI totals ----------------------------------------------------------------------------------------


def merge_totals(kept: Kept, window: str = "1 day") -> Merge:
    """Totals per event-time window and key; the state is the table itself, a row a window and key."""
    keys = [F.col(k) for k in kept.keys]

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if number in versions(spark, kept.at("table")):
            return
        spanned = batch.withColumn("_w", F.window(kept.time, window))
        timely = _split(spanned, number, kept, F.col("_w.end"))
        new = timely.groupBy(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *keys).agg(*_measures(kept))
        old = _before(spark, kept, number)
        both = new if old is None else old.unionByName(new)
        _publish(both.groupBy("window_start", "window_end", *kept.keys).agg(*_merged()), kept, number)

    return merge


def totals(spark: SparkSession, kept: Kept) -> DataFrame:
    """The newest version of the totals."""
    return read_version(spark, kept.at("table")).select("window_start", "window_end", *kept.keys, *_shown(kept))


# -- sessions ------------------------------------------------------------------------------------------


def _islands(sessions: DataFrame, by: Sequence[str], gap: str) -> DataFrame:
    """Sessions of equal ``by`` at most ``gap`` apart made one, as Spark's own session windows are; a NULL key is a key like others."""
    order = Window.partitionBy(*by).orderBy("session_start", "session_last")
    until = F.max("session_last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.col("session_start") > until + F.expr(f"interval {gap}"), F.lit(True))
    marked = sessions.withColumn("_begins", begins.cast("int"))
    numbered = marked.withColumn("_island", F.sum("_begins").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return (
        numbered.groupBy(*by, "_island")
        .agg(F.min("session_start").alias("session_start"), F.max("session_last").alias("session_last"), *_merged())
        .drop("_island")
    )


def merge_sessions(kept: Kept, gap: str = "30 minutes") -> Merge:
    """Sessions per key: rows at most ``gap`` apart, whatever batch brings them; a row may join two sessions.

    Rows are summed per key and time, joined within each hour, so that the hours of a hot key are dealt to many
    tasks, and only then across hours and with the sessions known.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if number in versions(spark, kept.at("table")):
            return
        timely = _split(batch, number, kept, F.col(kept.time) + F.expr(f"interval {gap}"))
        points = timely.groupBy(*kept.keys, F.col(kept.time).alias("session_start")).agg(*_measures(kept))
        points = points.withColumns({"session_last": F.col("session_start"), "_hour": F.date_trunc("hour", "session_start")})
        new = _islands(points, [*kept.keys, "_hour"], gap).drop("_hour")
        old = _before(spark, kept, number)
        both = new if old is None else old.unionByName(new)
        _publish(_islands(both, kept.keys, gap), kept, number)

    return merge


def sessions(spark: SparkSession, kept: Kept, gap: str = "30 minutes") -> DataFrame:
    """The newest version of the sessions; a session ends ``gap`` after its last row."""
    end = (F.col("session_last") + F.expr(f"interval {gap}")).alias("session_end")
    return read_version(spark, kept.at("table")).select(*kept.keys, "session_start", end, *_shown(kept))


# -- scores with statistics that may change --------------------------------------------------------------


def publish_statistics(
    history: DataFrame, folder: str, version: int, components: Sequence[anomaly.Component] = anomaly.CARD_COMPONENTS
) -> None:
    """One row of statistics as a new version; running streams score with it from their next micro-batch on."""
    write_version(anomaly.score_statistics(history, components).coalesce(1), folder, version)


def merge_scores(
    statistics: str, out: str, components: Sequence[anomaly.Component] = anomaly.CARD_COMPONENTS, at_least: float = anomaly.FLAG_SCORE
) -> Merge:
    """Score every micro-batch with the newest statistics; ``statistics_version`` says which these were."""

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if number in versions(spark, out):
            return
        version = versions(spark, statistics)[-1]
        values = read_version(spark, statistics, version).first().asDict()
        scored = anomaly.risk_level(anomaly.risk_score(batch, components, statistics=values))
        scored = anomaly.combine_flags(scored, flags=(), at_least=at_least)
        write_version(scored.withColumn("statistics_version", F.lit(version)), out, number)

    return merge


def scores(spark: SparkSession, out: str) -> DataFrame:
    """The scores of all micro-batches."""
    paths = [f"{out}/version={n}" for n in versions(spark, out)]
    return spark.read.parquet(*paths)


# -- running -------------------------------------------------------------------------------------------


def run_available(stream: DataFrame, merge: Merge, checkpoint: str) -> None:
    """Merge everything that has arrived since the last run with this checkpoint, micro-batch by micro-batch."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge)
    writer.trigger(availableNow=True).start().awaitTermination()

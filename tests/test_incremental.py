"""Tables merged micro-batch by micro-batch, against the whole at once."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import anomaly
from tidemark.sources.checkpoints import fresh_path, versions
from tidemark.streaming import incremental, live
from tidemark.streaming.incremental import Kept

START = datetime.datetime(2024, 1, 1)
SCHEMA = "id int, ts timestamp_ntz, k string, value double"


def events(seed):
    rng = random.Random(seed)
    made = [(i, START + datetime.timedelta(minutes=rng.choice([0, 5, 30]) + 30 * rng.randrange(400)), rng.choice(["a", "a", "a", "b", None]), rng.choice([None, 0.1, 2.25, -3.0])) for i in range(400)]
    return [*made, (900, None, "a", 1.0), (901, START, "c", 1.0), (902, START + datetime.timedelta(minutes=30), "c", 1.0)]


def timed(df):
    return df.withColumn("event_time", F.col("ts").cast("timestamp"))


def batches(spark, data, parts):
    size = -(-len(data) // parts)
    return [timed(spark.createDataFrame(data[i : i + size], SCHEMA)) for i in range(0, len(data), size)]


def merged(spark, data, kept, merge, parts=4):
    for n, batch in enumerate(batches(spark, data, parts)):
        merge(batch, n)
        merge(batch, n)  # a replay changes nothing


@pytest.mark.parametrize("seed", [1, 2])
def test_totals_equal_the_whole_in_any_order(spark, seed):
    data = events(seed)
    random.Random(seed).shuffle(data)
    kept = Kept(fresh_path(spark, "totals"), ("k",), "value", late="1000 days")
    merged(spark, data, kept, incremental.merge_totals(kept, "6 hours"))
    whole = Kept(fresh_path(spark, "whole"), ("k",), "value")
    incremental.merge_totals(whole, "6 hours")(timed(spark.createDataFrame(data, SCHEMA)), 0)
    got = rows(incremental.totals(spark, kept))
    assert got == rows(incremental.totals(spark, whole))
    want = {}
    for _, ts, k, v in data:
        if ts is not None:
            at = START + datetime.timedelta(hours=(ts - START).total_seconds() // 21600 * 6)
            want.setdefault((at, k), []).append(v)
    assert len(got) == len(want)
    assert sum(r[3] for r in got) == sum(len(v) for v in want.values())
    assert {(repr(r[2]), r[3], round(r[4], 6)) for r in got} == {(repr(k), len(v), round(sum(x or 0 for x in v), 6)) for (_, k), v in want.items()}
    assert incremental.late_rows(spark, kept) is None or incremental.late_rows(spark, kept).count() == 0
    assert len(versions(spark, kept.at("table"))) == incremental.KEPT


@pytest.mark.parametrize("seed", [3, 4])
def test_sessions_equal_the_built_in_ones_in_any_order(spark, seed):
    data = events(seed)
    random.Random(seed).shuffle(data)
    kept = Kept(fresh_path(spark, "sessions"), ("k",), "value", late="1000 days")
    merged(spark, data, kept, incremental.merge_sessions(kept))
    whole = timed(spark.createDataFrame(data, SCHEMA)).where("event_time is not null")
    want = whole.groupBy("k", F.session_window("event_time", "30 minutes").alias("w")).agg(F.count("*").alias("n"))
    want = want.select("k", F.col("w.start").alias("a"), F.col("w.end").alias("b"), "n")
    assert rows(incremental.sessions(spark, kept).select("k", "session_start", "session_end", "rows")) == rows(want)


def test_late_rows_are_put_aside(spark):
    rng = random.Random(5)
    data = [(i, START + datetime.timedelta(minutes=10 * i - (rng.random() < 0.2) * rng.randrange(900)), "a", 1.0) for i in range(300)]
    kept = Kept(fresh_path(spark, "late"), ("k",), "value", late="2 hours")
    merged(spark, data, kept, incremental.merge_totals(kept, "1 hour"), parts=6)
    newest, late, timely = None, [], {}
    for begin in range(0, 300, 50):
        for i, ts, *_ in data[begin : begin + 50]:
            hour = ts.replace(minute=0)
            if newest and hour + datetime.timedelta(hours=1) <= newest - datetime.timedelta(hours=2):
                late.append(i)
            else:
                timely[hour] = timely.get(hour, 0) + 1
        newest = max([ts for _, ts, *_ in data[: begin + 50]])
    assert late and sorted(r["id"] for r in incremental.late_rows(spark, kept).collect()) == late
    assert sorted(r["rows"] for r in incremental.totals(spark, kept).collect()) == sorted(timely.values())


def test_runs_go_on_from_the_checkpoint(spark, tmp_path):
    data = [e for e in events(6) if e[1] is not None]
    folder = str(tmp_path / "feed")
    kept = Kept(fresh_path(spark, "run"), ("k",), "value", late="1000 days")
    for part in (data[:150], data[150:300], data[300:]):
        spark.createDataFrame(part, SCHEMA).repartition(3).write.mode("append").parquet(folder)
        stream = timed(live.read_stream(spark, folder, SCHEMA, files_per_trigger=2))
        incremental.run_available(stream, incremental.merge_sessions(kept), kept.at("checkpoint"))
    whole = Kept(fresh_path(spark, "whole"), ("k",), "value")
    incremental.merge_sessions(whole)(timed(spark.createDataFrame(data, SCHEMA)), 0)
    assert rows(incremental.sessions(spark, kept)) == rows(incremental.sessions(spark, whole))


def test_new_statistics_take_effect_in_the_next_batch(spark):
    components = [anomaly.RangeShare("value", 100)]
    folder, out = fresh_path(spark, "statistics"), fresh_path(spark, "scores")
    made = lambda *v: spark.createDataFrame([(x,) for x in v], "value double")
    merge = incremental.merge_scores(folder, out, components)
    incremental.publish_statistics(made(0.0, 10.0), folder, 1, components)
    merge(made(5.0), 0)
    incremental.publish_statistics(made(0.0, 20.0), folder, 2, components)
    merge(made(5.0), 0)
    merge(made(5.0), 1)
    got = sorted((r["statistics_version"], r["risk_score"]) for r in incremental.scores(spark, out).collect())
    assert got == [(1, 50.0), (2, 25.0)]

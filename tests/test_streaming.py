from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import anomaly
from tidemark.streaming import live


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("feed"))
    start = datetime.datetime(2024, 1, 1)
    data = [(i, start + datetime.timedelta(minutes=40 * i), "a" if i % 3 else "b", float(i % 7 + 1), i % 2) for i in range(150)]
    df = spark.createDataFrame(data, "id int, ts timestamp_ntz, kind string, value double, on_time int")
    df.filter("id < 100").coalesce(1).write.mode("append").parquet(folder)
    df.filter("id >= 100").coalesce(1).write.mode("append").parquet(folder)
    return folder, df


def stream(spark, feed):
    return live.read_stream(spark, feed[0], feed[1].schema, files_per_trigger=1)


def test_closed_windows_equal_the_batch(spark, feed):
    events = live.with_event_time(stream(spark, feed), "ts")
    got = live.run_available(live.windowed_totals(events, ["kind"], "value"), "windows")
    batch = feed[1].withColumn("event_time", F.col("ts").cast("timestamp"))
    want = live.windowed_totals(batch, ["kind"], "value").filter("window_end <= timestamp'2024-01-05 02:20:00' - interval 1 hour")
    assert rows(got) == rows(want) and got.count() == 8


def test_sliding_windows_and_on_time(spark, feed):
    events = live.with_event_time(stream(spark, feed), "ts")
    sliding = live.run_available(live.windowed_totals(events, [], "value", "2 days", "1 day"), "sliding")
    assert sliding.count() >= 4
    shares = live.run_available(live.windowed_on_time(live.with_event_time(stream(spark, feed), "ts"), "kind"), "on-time")
    assert {r["on_time_pct"] for r in shares.collect()} == {50.0}


def test_alerts_against_static_targets(spark, feed):
    targets = spark.createDataFrame([("a", 96.0), ("b", 1.0)], "kind string, target_value double")
    events = live.with_event_time(stream(spark, feed), "ts")
    alerts = live.run_available(live.live_alerts(live.windowed_totals(events, ["kind"], "value"), targets, ["kind"], 20.0), "alerts")
    assert {r["kind"] for r in alerts.collect()} == {"b"}


def test_stream_scores_equal_batch_scores(spark, feed):
    components = [anomaly.RangeShare("value", 80), anomaly.NightHours("hour", 20)]
    batch = feed[1].withColumn("hour", F.hour("ts"))
    statistics = live.frozen_statistics(batch, components)
    scored = live.score_stream(stream(spark, feed).withColumn("hour", F.hour("ts")), statistics, components)
    got = live.run_available(scored.select("id", "risk_score", "flagged"), "scores")
    want = anomaly.combine_flags(anomaly.risk_score(batch, components), flags=()).select("id", "risk_score", "flagged")
    assert rows(got) == rows(want)

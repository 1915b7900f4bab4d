"""Behaviour on inputs that one clean file does not show."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.__main__ import input_bytes, run
from tidemark.functions import parse_number
from tidemark.operators import trends
from tidemark.operators.statistics import histogram
from tidemark.plans import supply
from tidemark.sources import checkpoints, readers
from tidemark.streaming import live

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def scattered(spark, tmp_path_factory):
    """The events in 60 files, in no order of time."""
    folder = str(tmp_path_factory.mktemp("scattered") / "events")
    events = readers.read_table(spark, FOLDER, "events").select("ts", "event_type", "value")
    events.repartition(60, F.xxhash64("ts")).write.parquet(folder)
    return folder, events


def daily(stream):
    return live.windowed_totals(live.with_event_time(stream, "ts"), ["event_type"], "value", scale=2)


def test_streams_lose_nothing_whatever_the_files(spark, scattered):
    folder, events = scattered
    want = rows(live.windowed_totals(events.withColumn("event_time", F.col("ts").cast("timestamp")), ["event_type"], "value", scale=2))
    for cap in (None, 25):
        stream = live.read_stream(spark, folder, events.schema, cap)
        assert rows(live.run_available(daily(stream), "daily", mode="complete")) == want


def test_dropped_rows_are_reported(spark, scattered):
    folder, events = scattered
    with pytest.raises(live.RowsDropped):
        live.run_available(daily(live.read_stream(spark, folder, events.schema, 10)), "daily")


def test_a_stream_goes_on_where_it_ended(spark, tmp_path):
    folder, state, out = (str(tmp_path / n) for n in ("in", "state", "out"))
    for batch in ([1, 2], [3]):
        spark.createDataFrame([(i,) for i in batch], "i int").coalesce(1).write.mode("append").parquet(folder)
        got = live.run_available(live.read_stream(spark, folder, "i int"), "ids", state=state, path=out)
    assert rows(got) == [(1,), (2,), (3,)]


def test_pivot_keeps_every_value(spark):
    data = [("N", "Toys", 5.0), ("N", "Technology", 1.0), ("S", "Toys", 2.5), ("S", None, 9.0), (None, "Toys", 9.0)]
    df = spark.createDataFrame(data, "Region string, Category string, Sales double")
    every = {r["Region"]: (r["Technology"], r["Toys"]) for r in trends.revenue_pivot(df, scale=2).collect()}
    assert every == {"N": (1.0, 5.0), "S": (None, 2.5)}
    fixed = {r["Region"]: (r["Technology"], r["other"]) for r in trends.revenue_pivot(df, values=["Technology"]).collect()}
    assert fixed == {"N": (1.0, 5.0), "S": (None, 2.5)}


def test_histogram_plans_its_input_once(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(rng.random(),) for _ in range(500)], "v double")
    plan = histogram(df, "v", 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") < 10
    assert sum(r["rows"] for r in histogram(df, "v", 5).collect()) == 500


def test_nan_reads_as_null(spark, tmp_path):
    spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "v double").write.parquet(str(tmp_path / "t.parquet"))
    assert readers.read_table(spark, str(tmp_path), "t").where("v is null").count() == 2


def test_whole_numbers_may_have_a_fraction_of_zero(spark):
    df = spark.createDataFrame([(t,) for t in ("3.0", "3", "3.5", "1e3", "9007199254740993", "99999999999", "x", None)], "t string")
    got = [r[0] for r in df.select(parse_number(F.col("t"), "int")).collect()]
    assert got == [3, 3, None, 1000, None, None, None, None]
    assert df.select(parse_number(F.col("t"), "bigint")).collect()[4][0] == 9007199254740993


def test_long_csv_lines_are_counted(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,2\n3,4,5\n"x,y",2\n')
    assert readers.long_lines(spark, str(tmp_path / "a.csv")).first()[0] == 1


def test_only_a_local_master_gets_a_temporary_folder():
    class Conf:
        def __init__(self, master):
            self.master = master

        def get(self, key, default=None):
            return self.master if key == "spark.master" and self.master else default

        def isModifiable(self, key):
            return False

    class Session:
        def __init__(self, master):
            self.conf = Conf(master)

    for master in (None, "local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(RuntimeError):
            checkpoints.shared_folder(Session(master))
    assert checkpoints.shared_folder(Session("local[2]"))


def test_activity_job(spark, tmp_path):
    lines = ["amount,hour,frequency_per_day,type,is_fraud"] + [f"{i},{i % 24},{i % 9},{'online' if i % 2 else 'ATM'},{int(i > 95)}" for i in range(100)]
    (tmp_path / "a.csv").write_text("\n".join(lines))
    run(spark, "activity", str(tmp_path / "a.csv"), str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(f"{tmp_path}/out/scores").count() == 100
    assert input_bytes(spark, str(tmp_path / "a.csv")) == (tmp_path / "a.csv").stat().st_size


def test_ledger_columns_by_map(spark, tmp_path):
    (tmp_path / "r.csv").write_text(
        "id,date,vendor_id,sum,currency,region,invoice_ref,payment_status,delivery_date,created_by\n"
        "R1,2024-01-01,V1,5,USD,N,I1,paid,2024-01-02,u\nR1,2024-01-01,V1,-1,USD,N,I2,paid,2024-01-02,u\n"
    )
    (tmp_path / "v.csv").write_text("vendor_id\nV1\n")
    run(spark, "ledger", str(tmp_path / "r.csv"), str(tmp_path / "out"), str(tmp_path / "v.csv"), {"id": "record_id", "sum": "amount"})
    report = readers.read_delimited(spark, f"{tmp_path}/out/integrity_report", {"violations": "int"})
    found = {r["rule"].split(".")[0]: r["violations"] for r in report.collect()}
    assert found["2"] > 0 and found["5"] == 1 and found["1"] == 0


def test_missing_key_columns_are_reported(spark):
    given = supply.KEY_COLUMNS[0]
    df = spark.createDataFrame([(1,)], f"` {given}` int")
    assert {r[0] for r in supply.missing_key_columns(df).collect()} == set(supply.KEY_COLUMNS) - {given}


def test_stored_tables_can_be_discarded(spark, monkeypatch):
    monkeypatch.setattr(checkpoints, "_stored", [])
    table = checkpoints.store(spark.range(3).toDF("i"), "gone")
    folder = table.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(folder)
    assert checkpoints.discard(spark) == 1 and not os.path.exists(folder)

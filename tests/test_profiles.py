"""Profiles of parts put together are those of the whole table; date formats are tried on classes of texts."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions import date_class, parse_timestamp
from tidemark.operators import cleaning, profiles, statistics

FORMATS = ("d/M/yyyy", "M/d/yyyy H:mm", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "MM/dd/yyyy hh:mm:ss a")


@pytest.fixture(scope="module")
def table(spark):
    made = random.Random(5)
    data = [
        (made.randrange(12), made.randrange(20_000), made.choice([None, 1e9 + made.random(), -0.0, 0.0]), made.choice(["a", "b", None]))
        for _ in range(60_000)
    ]
    return spark.createDataFrame(data, "month int, id long, v double, s string").repartition(7).cache()


def test_merged_parts_equal_the_whole(table):
    columns = ["id", "v", "s"]
    whole = profiles.merge_profiles(profiles.partial_profiles(table, columns))
    parts = profiles.partial_profiles(table, columns, ["month"])
    quarters = profiles.merge_profiles(parts.withColumn("quarter", F.floor(F.col("month") / 3)), ["quarter"])
    want = {r["column"]: r for r in profiles.read_profiles(whole).collect()}
    for merged in (profiles.merge_profiles(parts), profiles.merge_profiles(quarters)):
        got = {r["column"]: r for r in profiles.read_profiles(merged).collect()}
        assert set(got) == set(columns)
        for name in columns:
            for measure in ("rows", "nulls", "complete_pct", "distinct_estimate", "min", "max"):
                assert got[name][measure] == want[name][measure]
            for measure in ("mean", "std"):
                known = want[name][measure]
                assert got[name][measure] == (known if known is None else pytest.approx(known, rel=1e-9))


def test_figures_are_those_of_the_table(table):
    columns = ["id", "v", "s"]
    got = {r["column"]: r for r in profiles.read_profiles(profiles.merge_profiles(profiles.partial_profiles(table, columns, ["month"]))).collect()}
    exact = {r["column"]: r["distinct_values"] for r in statistics.distinct_counts(table, columns).collect()}
    values = [r.v for r in table.collect() if r.v is not None]
    mean = math.fsum(values) / len(values)
    sd = math.sqrt(math.fsum((v - mean) ** 2 for v in values) / (len(values) - 1))
    assert got["v"]["mean"] == pytest.approx(mean, rel=1e-12) and got["v"]["std"] == pytest.approx(sd, rel=1e-9)
    assert got["v"]["nulls"] == 60_000 - len(values)
    assert (got["s"]["mean"], got["s"]["min"], got["s"]["distinct_estimate"]) == (None, None, 2)
    for name in columns:
        assert abs(got[name]["distinct_estimate"] - exact[name]) <= 4 * profiles.ERROR * exact[name]


def test_small_deviations_of_large_values_survive(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("part"), (F.lit(1e12) + F.col("id") % 2).alias("v"))
    got = profiles.read_profiles(profiles.merge_profiles(profiles.partial_profiles(df, ["v"], ["part"]))).first()
    assert got["std"] == pytest.approx(math.sqrt(0.25 * 1000 / 999), rel=1e-6)


def test_empty_tables_and_missing_keys(spark):
    empty = spark.createDataFrame([], "k int, v double")
    got = profiles.read_profiles(profiles.merge_profiles(profiles.partial_profiles(empty, ["v"]))).first()
    assert (got["rows"], got["nulls"], got["complete_pct"], got["distinct_estimate"], got["mean"], got["std"]) == (0, 0, None, 0, None, None)
    assert profiles.merge_profiles(profiles.partial_profiles(empty, ["v"], ["k"]), ["k"]).count() == 0
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), (1, None)], "k int, v double")
    merged = profiles.read_profiles(profiles.merge_profiles(profiles.partial_profiles(df, ["v"], ["k"]), ["k"]))
    assert rows(merged.select("k", "rows", "nulls", "mean", "std")) == [(1, 1, 1, None, None), (None, 2, 0, 2.0, math.sqrt(2))]


def test_a_part_profiled_again_replaces_its_row_only(spark, tmp_path):
    folder = str(tmp_path / "profiles")

    def profile(data):
        df = spark.createDataFrame(data, "month string, v int")
        profiles.keep_profiles(profiles.partial_profiles(df, ["v"], ["month"]), folder, ["month"])
        merged = profiles.merge_profiles(profiles.kept_profiles(spark, folder, "month string"))
        found = profiles.read_profiles(merged).first()
        return found["rows"], found["distinct_estimate"], found["min"], found["max"]

    assert profile([("2024-01", 1), ("2024-01", 2), ("2024-02", 9)]) == (3, 3, 1.0, 9.0)
    assert profile([("2024-02", 9)]) == (3, 3, 1.0, 9.0)
    assert profile([("2024-02", 5), ("2024-03", 5)]) == (4, 3, 1.0, 5.0)


def texts():
    made = random.Random(11)
    found = [None, "", "n/a", "24:00", "1/1/2024 7:5", "29/2/2023", "29/2/2024", "2/29/2024 23:59", "2024-02-30", "1/2/2024 10:600"]
    for _ in range(1500):
        y, m, d = made.choice([1999, 2000, 2023, 2024, 20245]), made.randrange(0, 14), made.randrange(0, 33)
        h, n, s = made.randrange(0, 26), made.randrange(0, 62), made.randrange(0, 62)
        found.append(
            made.choice(
                [
                    f"{d}/{m}/{y}",
                    f"{m}/{d}/{y} {h}:{n:02}",
                    f"{y}-{m:02}-{d:02} {h:02}:{n:02}:{s:02}",
                    f"{y}-{m:02}-{d:02}",
                    f"{m:02}/{d:02}/{y} {h:02}:{n:02}:{s:02} {made.choice(['AM', 'pm', 'XM'])}",
                    f"{m}/{d}/{y} {h}:{n}",
                ]
            )
        )
    return found


@pytest.mark.parametrize("formats", [FORMATS, FORMATS[:1], FORMATS[1:2], ("d:M:yyyy", "H:mm"), ("MMM d yyyy", "d/M/yyyy")])
def test_a_class_is_read_by_the_formats_that_read_its_texts(spark, formats):
    found = [*texts(), *[f"{d}:{m}:2024" for d in (1, 31, 59) for m in (1, 12, 30)], "Jan 5 2024", "Feb 31 2024"]
    df = spark.createDataFrame([(t,) for t in found], "t string").withColumn("c", date_class(F.col("t"), formats))
    for f in formats:
        same = parse_timestamp(F.col("t"), f).isNull() == parse_timestamp(F.col("c"), f).isNull()
        assert rows(df.where(~same)) == []
        failures = {r["format"]: (r["rows"], r["failures"]) for r in cleaning.format_failures(df, "t", formats).collect()}
        assert failures[f] == (len(found), df.where(parse_timestamp(F.col("t"), f).isNull()).count())


def test_times_have_few_classes(spark):
    df = spark.range(200_000).select(F.date_format(F.timestamp_seconds(F.col("id") * 7), "yyyy-MM-dd HH:mm:ss").alias("t"))
    assert df.select(date_class(F.col("t"), ["yyyy-MM-dd HH:mm:ss"])).distinct().count() <= 17 * 24


def test_formats_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "t string")
    assert rows(cleaning.format_failures(empty, "t", ["d/M/yyyy"])) == [("d/M/yyyy", 0, 0, None)]
    assert cleaning.parse_dates(empty, ["t"], ["d/M/yyyy"]).count() == 0


def test_column_report(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, `b c` string")
    assert rows(cleaning.column_report(df, ["b c", "z", "a"]), "position") == [
        ("b c", 0, "string", True, 1),
        ("z", 1, None, False, 0),
        ("a", 2, "int", True, 2),
    ]

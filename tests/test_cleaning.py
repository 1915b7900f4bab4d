from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import cleaning as c


def test_columns(spark):
    df = spark.createDataFrame([(" x ", 1)], "` a ` string, `b` int")
    named = c.strip_column_names(df)
    assert named.columns == ["a", "b"]
    assert c.strip_values(named).first() == ("x", 1)
    assert c.keep_existing(named, ["b", "z", "a"]).columns == ["b", "a"]
    assert c.missing_columns(named, ["b", "z"]) == ["z"]
    assert c.rename(named, {"a": "A", "q": "Q"}).columns == ["A", "b"]
    assert c.map_schema(named, {"id": "b", "name": F.trim("a")}).first() == (1, "x")
    assert c.tag(named, big=F.col("b") > 0).first()["big"] is True


def test_missing_and_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (None, "a")], "k int, v string")
    assert c.drop_duplicates(df).count() == 3
    assert rows(c.drop_missing(df)) == [(1, "a")]
    assert c.drop_missing(df, ["k"]).count() == 3
    assert rows(c.fill_missing(df, {"v": "z"}))[0] == (1, "a")
    assert c.duplicate_rows(df).first() == (4, 3, 1)
    assert c.duplicate_rows(df, ["k"]).first() == (4, 2, 2)
    assert c.drop_duplicates(c.drop_duplicates(df)).count() == 3


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), 1.0)], "a double, b double")
    assert c.nan_to_null(df).first() == (None, 1.0)


def test_keep_first_follows_the_given_order(spark):
    df = spark.createDataFrame([(1, 1, "b"), (1, 1, "a"), (1, 2, "c"), (2, 1, "d"), (None, 1, "f"), (None, 1, "e")], "k int, p int, v string")
    want = [(1, 1, "a"), (1, 2, "c"), (2, 1, "d"), (None, 1, "e")]
    for table in (df, df.repartition(5)):
        assert sorted(rows(c.keep_first(table, ["k", "p"], ["v"])), key=repr) == sorted(want, key=repr)


def test_keep_first_cuts_hot_keys_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = c.keep_first(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("row_number(), 1, Partial")
    assert plan.index("Exchange") < partial  # printed top-down: the partial limit lies below the exchange


def test_filters(spark):
    df = spark.createDataFrame([(0.0, 1.0), (5.0, None), (5.0, 2.0), (10.0, 1.0)], "a double, b double")
    assert rows(c.keep_positive(df, "a", "b")) == [(10.0, 1.0), (5.0, 2.0)]
    assert c.keep_within(df, {"a": (0, 10)}).count() == 2


def test_date_format_choice(spark):
    data = [("13/1/2014", "1/13/2014"), ("2/1/2014", "2/1/2014"), ("28/2/2014", "2/28/2014"), ("bad", None)]
    df = spark.createDataFrame(data * 5 + [("1/1/2014", "1/1/2014")] * 40, "day_first string, month_first string")
    parsed = c.parse_dates(df, ["day_first", "month_first"], ["d/M/yyyy", "M/d/yyyy"])
    first = parsed.filter(F.col("day_first") == datetime.datetime(2014, 1, 13)).count()
    assert first == 5
    assert parsed.filter(F.col("month_first") == datetime.datetime(2014, 2, 28)).count() == 5
    # The raw text counts: 5 bad of 60 is under the limit for the right format, not for the wrong one.
    failures = {r["format"]: r["failures"] for r in c.format_failures(df, "day_first", ["d/M/yyyy", "M/d/yyyy"]).collect()}
    assert failures == {"d/M/yyyy": 5, "M/d/yyyy": 15}


def test_date_format_falls_back_to_fewest_failures(spark):
    df = spark.createDataFrame([("1/2/2014",), ("13/2/2014",), ("x",), ("y",)], "t string")
    parsed = c.parse_dates(df, ["t"], ["M/d/yyyy", "d/M/yyyy"])
    assert parsed.filter("t is not null").count() == 2


def test_checks(spark):
    df = spark.createDataFrame([("a", 1), ("b", 13), (None, 0), ("a", None)], "s string, m int")
    assert rows(c.unexpected_values(df, "s", ["a"])) == [("s", "b", 1), ("s", None, 1)]
    assert c.same_domain(df, "s", ["a", "b"]).first()["matches"] is False
    assert c.same_domain(df.filter("s is not null"), "s", ["a", "b"]).first()["matches"] is True
    assert c.same_domain(df.filter("s = 'a'"), "s", ["a", "b"]).first()["matches"] is False
    assert rows(c.out_of_range(df, {"m": (1, 12)})) == [("m", 2)]
    failures = c.conversion_failures(df, {"m": F.col("m")}).first()
    assert (failures["rows"], failures["failures"]) == (4, 1)


def test_tails(spark):
    df = spark.range(1, 101).select(F.col("id").cast("double").alias("v"))
    for method in ("inline", "radix"):
        low, high, below, above, extreme = c.tail_counts(df, "v", method=method).first()
        assert (round(low, 4), round(high, 4), below, above, extreme) == (1.99, 99.01, 1, 1, 2)


def test_step_summary_counts_in_order(spark):
    df = spark.createDataFrame([(None, 1), (0, 1), (5, 0), (5, None), (5, 5)], "a int, b int")
    steps = [("no a", F.col("a").isNotNull()), ("a", F.col("a") > 0), ("b", F.col("b") > 0)]
    assert rows(c.step_summary(df, steps), "step") == [(0, "loaded", 5), (1, "no a", 1), (2, "a", 1), (3, "b", 2), (4, "kept", 1)]

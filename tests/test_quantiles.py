from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import statistics
from tidemark.operators.quantiles import estimated_bytes, quantiles, with_order_key

FRACTIONS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]


def both(df, value, fractions, by=(), **options):
    out = []
    for method in ("inline", "radix"):
        table = quantiles(df, value, fractions, by=by, method=method, **options)
        out.append(sorted(tuple(r) for r in table.collect()))
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False).map(lambda v: round(v, 2)), min_size=1, max_size=40))
def test_any_values_agree_with_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = quantiles(df, "v", FRACTIONS, method="radix").first()
    assert list(row) == pytest.approx(list(np.quantile(values, FRACTIONS)), abs=1e-6)


def test_groups_with_ties_nulls_and_single_rows(spark):
    data = [(1, 1.0), (1, 2.0), (1, 4.0), (1, 8.0), (2, 5.0), (3, 1.0), (3, 1.0), (3, 9.0), (4, None), (None, 3.0)]
    df = spark.createDataFrame(data, "g int, v double")
    inline, radix = both(df, "v", FRACTIONS, by=["g"])
    assert inline == radix
    assert [r[0] for r in radix] == [1, 2, 3]


@pytest.mark.parametrize("bounded", [True, False])
def test_skewed_groups_and_heavy_ties(spark, bounded):
    # One group holds most rows and one value most of that group; the rest is spread out.
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 7).alias("g"),
        F.when(F.col("id") % 2 == 0, 5.0).otherwise((F.col("id") * 7919 % 10_007).cast("double")).alias("v"),
    )
    inline, radix = both(df, "v", FRACTIONS, by=["g"], bounded_groups=bounded)
    assert inline == radix


def test_hot_group_over_many_tasks(spark):
    df = spark.range(0, 400_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("g"),
        (F.xxhash64("id") % 1_000_003).cast("double").alias("v"),
    )
    for bounded in (True, False):
        inline, radix = both(df, "v", [0.5, 0.99], by=["g"], bounded_groups=bounded)
        assert inline == radix


def test_values_of_many_sizes(spark):
    df = spark.range(50_000).select(F.exp(F.rand(7) * 20).alias("v"))
    values = [r["v"] for r in df.collect()]
    row = quantiles(df, "v", FRACTIONS, method="radix").first()
    assert list(row) == pytest.approx(list(np.quantile(values, FRACTIONS)), rel=1e-12)


def test_keys_are_the_bits_of_the_values(spark):
    values = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, float("inf"),
              float("-inf"), 1.0, np.nextafter(1.0, 0), np.nextafter(1.0, 2), 8.0, np.nextafter(8.0, 0), -3.7, 0.1]
    values += [float(v) for v in np.random.default_rng(3).integers(0, 2**63, 2000, dtype="u8").view("f8") if np.isfinite(v)]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    for v, k in with_order_key(df, "v", "k").collect():
        bits = int(np.array(abs(v)).view("i8"))
        assert k == (-bits if v < 0 else bits)
    assert with_order_key(spark.createDataFrame([(float("nan"),)], "v double"), "v", "k").first()["k"] == 2**63 - 1


def test_neighbouring_doubles_and_one_value(spark):
    base = [1.0 + k * 2.0**-52 for k in range(500)]
    df = spark.createDataFrame([(v,) for v in base + [-v for v in base]], "v double").repartition(5)
    row = quantiles(df, "v", [0.1, 0.25, 0.75], method="radix").first()
    assert list(row) == list(quantiles(df, "v", [0.1, 0.25, 0.75], method="inline").first())
    same = spark.range(1000).select(F.lit(-7.5).alias("v"))
    assert set(quantiles(same, "v", FRACTIONS, method="radix").first()) == {-7.5}


def test_empty_input(spark):
    df = spark.createDataFrame([], "v double")
    assert quantiles(df, "v", [0.5], method="inline").first()[0] is None
    assert quantiles(df, "v", [0.5], method="radix").first()[0] is None


def test_repartitioning_changes_nothing(spark):
    df = spark.range(5_000).select((F.col("id") * 37 % 1_000).cast("double").alias("v"))
    want = quantiles(df, "v", FRACTIONS, method="radix").first()
    assert quantiles(df.repartition(13), "v", FRACTIONS, method="radix").first() == want


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        quantiles(spark.range(1).select(F.lit(1.0).alias("v")), "v", [0.5], method="guess")


def test_size_estimate_grows(spark):
    assert estimated_bytes(spark.range(10)) < estimated_bytes(spark.range(10_000))


def test_describe_both_ways(spark):
    df = spark.createDataFrame([(1, 2.0, None), (2, None, None), (3, 8.0, None), (4, 1.0, None)], "a int, b double, c double")
    inline = {r["column"]: tuple(r) for r in statistics.describe(df, method="inline").collect()}
    radix = {r["column"]: tuple(r) for r in statistics.describe(df, method="radix").collect()}
    assert inline == radix
    assert inline["a"][1:] == (4, 2.5, pytest.approx(np.std([1, 2, 3, 4], ddof=1)), 1.0, 1.75, 2.5, 3.25, 4.0)
    assert inline["c"][1:] == (0, None, None, None, None, None, None, None)


def test_box_plot_by_hand(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for method in ("inline", "radix"):
        box = statistics.box_plot(df, "v", method=method).first()
        assert (box["q1"], box["median"], box["q3"]) == (2.25, 3.5, 4.75)
        assert (box["whisker_low"], box["whisker_high"], box["fliers"]) == (1.0, 5.0, 1)


def test_histogram_against_numpy(spark):
    values = [0.0, 0.5, 1.0, 2.0, 9.9, 10.0, 10.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    counts, edges = np.histogram(values, bins=5)
    got = statistics.histogram(df, "v", 5).orderBy("bin").collect()
    assert [r["rows"] for r in got] == list(counts)
    assert [r["lower"] for r in got] == pytest.approx(list(edges[:-1]))
    flat = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert [r["rows"] for r in statistics.histogram(flat, "v", 4).orderBy("bin").collect()] == list(np.histogram([3.0, 3.0], 4)[0])


def test_shape_types_preview_and_shares(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, v int")
    assert tuple(statistics.shape(df).first()) == (3, 2)
    assert [(r["column"], r["type"]) for r in statistics.column_types(df).orderBy("position").collect()] == [("k", "string"), ("v", "int")]
    assert [r["v"] for r in statistics.preview(df, 2, ["v"]).collect()] == [1, 2]
    assert [tuple(r) for r in statistics.value_shares(df, "k").collect()] == [("a", 2, 100.0)]
    assert {r["column"]: r["distinct_values"] for r in statistics.distinct_counts(df, ["k", "v"]).collect()} == {"k": 1, "v": 3}
    assert {r["column"]: (r["nulls"], round(r["complete_pct"], 2)) for r in statistics.completeness(df).collect()} == {"k": (1, 66.67), "v": (0, 100.0)}


def test_session_sizes_follow_the_input():
    from tidemark.session import sized

    small = sized(10**6, cores=8)
    large = sized(100 * 10**12, cores=8000)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert int(large["spark.sql.shuffle.partitions"]) == 200_000
    assert int(sized(10**12, 100)["spark.sql.shuffle.partitions"]) == -(-(10**12) // (256 * 1024 * 1024))

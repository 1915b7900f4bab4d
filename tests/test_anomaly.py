from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import anomaly as a


@pytest.fixture(scope="module")
def amounts():
    rng = np.random.default_rng(3)
    return np.round(rng.lognormal(3, 1, 400), 2)


@pytest.fixture(scope="module")
def table(spark, amounts):
    rng = np.random.default_rng(4)
    n = len(amounts)
    data = [
        (i, float(v), int(h), float(x), float(y), float(z), int(c))
        for i, (v, h, x, y, z, c) in enumerate(
            zip(amounts, rng.integers(0, 24, n), rng.normal(size=n), rng.normal(size=n), rng.normal(size=n), rng.random(n) < 0.1)
        )
    ]
    df = spark.createDataFrame(data, "id int, Amount double, Hour int, V1 double, V4 double, V14 double, Class int")
    return df.withColumn("Amount_log", F.log1p("Amount"))


def column(df, name):
    return np.array([r[name] for r in df.orderBy("id").collect()])


def test_scaling_and_zscore(table, amounts):
    logs = np.log1p(amounts)
    z = (logs - logs.mean()) / logs.std()
    scaled = a.standard_scale(table, {"s": "Amount_log"})
    assert column(scaled, "s") == pytest.approx(z)
    assert (column(a.flag_zscore(table, "Amount_log", 2.0), "zscore_flag") == (abs(z) > 2.0)).all()
    # The z-score of a standardised column is that of the column.
    assert (column(a.flag_zscore(scaled, "s", 2.0), "zscore_flag") == (abs(z) > 2.0)).all()


def test_constant_column(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    assert rows(a.flag_zscore(df, "v")) == [(5.0, False), (5.0, False)]
    assert rows(a.standard_scale(df, {"s": "v"})) == [(5.0, 0.0), (5.0, 0.0)]
    assert rows(a.risk_score(df, [a.RangeShare("v", 40), a.MagnitudeShare("v", 10)])) == [(5.0, 10.0), (5.0, 10.0)]


@pytest.mark.parametrize("method", ["inline", "radix"])
def test_percentile_flag(table, amounts, method):
    flagged = column(a.flag_percentile(table, top_pct=95, method=method), "iqr_flag")
    assert (flagged == (amounts > np.percentile(amounts, 95))).all()


def test_missing_amounts_count_as_zero(spark):
    df = spark.createDataFrame([(None,), (1.0,), (2.0,), (50.0,)], "v double")
    flagged = rows(a.flag_percentile(df, "v", 75))
    assert flagged == sorted([(None, False), (1.0, False), (2.0, False), (50.0, True)], key=repr)
    assert dict(rows(a.flag_zscore(df, "v", 1.5))) == {None: False, 1.0: False, 2.0: False, 50.0: True}


@pytest.mark.parametrize("method", ["inline", "radix"])
def test_fences(table, amounts, method):
    q1, q3 = np.quantile(amounts, [0.25, 0.75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    outside = (amounts < low) | (amounts > high)
    s = a.fence_summary(table, "Amount", method=method).first()
    assert (s["lower"], s["upper"]) == pytest.approx((low, high))
    assert (s["rows"], s["outliers"]) == (len(amounts), outside.sum())
    assert sorted(r["id"] for r in a.fence_outliers(table, "Amount", method=method).collect()) == list(np.flatnonzero(outside))
    by = a.fence_summary_by(table, "Amount", "Hour", method=method).collect()
    assert sum(r["outliers"] for r in by) == outside.sum()


def test_sigma(table, amounts):
    beyond = abs(amounts - amounts.mean()) > 3 * amounts.std(ddof=1)
    assert (column(table.withColumn("s", a.sigma_outliers(table, "Amount")), "s") == beyond).all()


def expected_score(t):
    logs, hours = column(t, "Amount_log"), column(t, "Hour")
    score = (logs - logs.min()) / (logs.max() - logs.min()) * 40 + ((hours <= 4) | (hours >= 22)) * 20
    for name, points in (("V1", 15), ("V4", 15), ("V14", 10)):
        v = abs(column(t, name))
        score = score + v / v.max() * points
    return score.clip(0, 100)


def test_risk_score(table):
    scored = a.risk_score(table)
    got = column(scored, "risk_score")
    assert got == pytest.approx(expected_score(table))
    assert ((got >= 0) & (got <= 100)).all()
    assert column(a.risk_score(table.repartition(7)), "risk_score") == pytest.approx(got)


def test_absent_columns_and_missing_values_add_nothing(spark, table):
    without = a.risk_score(table.drop("V1", "V4", "V14", "Hour"))
    assert column(without, "risk_score").max() == pytest.approx(40)
    df = spark.createDataFrame([(None, None), (1.0, 23)], "Amount_log double, Hour int")
    assert rows(a.risk_score(df)) == sorted([(None, None, 0.0), (1.0, 23, 60.0)], key=repr)


def test_stored_statistics_score_new_rows_alike(table):
    stored = a.score_statistics(table).first().asDict()
    part = table.filter("id < 50")
    assert column(a.risk_score(part, statistics=stored), "risk_score") == pytest.approx(expected_score(table)[:50])


def test_activity_score(spark):
    df = spark.createDataFrame(
        [(1, 0.0, 1, "POS", 12), (2, 100.0, 11, "international", 23)], "id int, amount double, frequency_per_day int, type string, hour int"
    )
    assert list(column(a.risk_score(df, a.ACTIVITY_COMPONENTS), "risk_score")) == [0.0, 100.0]


def test_levels_flags_and_metrics(spark):
    data = [
        (40.0, False, False, 0),
        (70.0, False, False, 1),
        (80.0, False, False, 0),
        (10.0, True, False, 1),
        (20.0, None, True, 0),
        (30.0, False, None, 1),
    ]
    df = spark.createDataFrame(data, "risk_score double, zscore_flag boolean, iqr_flag boolean, Class int")
    out = a.combine_flags(a.risk_level(df))
    assert [r["flagged"] for r in out.orderBy("risk_score").collect()] == [True, True, False, False, True, True]
    assert a.risk_summary(out).first().asDict() == {"total": 6, "flagged": 4, "high": 1, "medium": 1, "low": 4, "flagged_pct": 66.67}
    assert a.detection_metrics(out).first().asDict() == {
        "true_positives": 2,
        "false_positives": 2,
        "false_negatives": 1,
        "precision": 0.5,
        "recall": pytest.approx(2 / 3),
    }
    assert rows(a.flag_counts(out)) == [("Flagged", 4), ("Normal", 2)]
    assert rows(a.flag_counts(out.filter("flagged"))) == [("Flagged", 4), ("Normal", 0)]
    assert a.detection_metrics(out.limit(0)).first()["precision"] == 0.0
    assert tuple(a.class_balance(out).first()) == (6, 3, 50.0, 3, 50.0)

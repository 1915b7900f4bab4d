from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from tests import goldens
from tests.conftest import rows
from tidemark.operators import kpi, trends


def lines(text):
    return [line.split(";") for line in text.strip().splitlines()]


def number(text):
    return float(text) if text else None


def close(got, want):
    return (got is None and want is None) or got == pytest.approx(want, rel=1e-9)


@pytest.fixture(scope="module")
def months(spark):
    data = [(datetime.datetime.strptime(m, "%b-%Y").date(), m, float(s), 1) for m, s, _, _ in lines(goldens.MONTHLY)]
    return spark.createDataFrame(data, "month date, `Month-Year` string, Sales double, Quantity int").repartition(3)


def test_centred_mean_in_label_order(months):
    got = {r["Month-Year"]: r["rolling_avg_3m"] for r in trends.revenue_trend(months, "label").collect()}
    for label, _, mean, _ in lines(goldens.MONTHLY):
        assert close(got[label], number(mean)), label


def test_growth_in_label_order(months):
    got = {r["Month-Year"]: r["Sales_Growth_%"] for r in trends.growth_table(months, "label").collect()}
    for label, _, _, growth in lines(goldens.MONTHLY):
        assert close(got[label], number(growth)), label


def test_anomalies_in_label_order(months):
    got = {r["Month-Year"]: r["deviation_pct"] for r in trends.sales_anomalies(months, order="label").collect()}
    want = {label: float(d) for label, d in lines(goldens.ANOMALIES)}
    assert got == pytest.approx(want)
    assert len(got) == 27
    assert trends.sales_anomalies(months).count() == 16  # in time order


def test_unknown_order():
    with pytest.raises(ValueError):
        trends.series_order("random")


def test_trailing_report(spark):
    want = lines(goldens.TREND_REPORT)
    df = spark.createDataFrame([(r[0], float(r[1]), int(r[2])) for r in want], "date string, revenue double, units_sold int")
    got = trends.trend_report(df).orderBy("date").collect()
    for row, expected in zip(got, want):
        assert [row["date"], row["rev_anomaly"]] == [expected[0], expected[7] == "True"]
        for name, text in zip(("rev_mom_pct", "units_mom_pct", "rev_roll3", "units_roll3"), expected[3:7]):
            assert close(row[name], number(text)), (name, row["date"])
    assert sum(r["rev_anomaly"] for r in got) == 12


def test_margin_ranking_order(spark):
    want = [(n, float(p), float(s), float(m)) for n, p, s, m in lines(goldens.SUBCATEGORIES)]
    df = spark.createDataFrame([(n, p, s) for n, p, s, _ in want], "`Sub-Category` string, Profit double, Sales double")
    assert [tuple(r) for r in trends.margin_ranking(df).collect()] == want


def test_top_and_bottom_products(spark):
    want = [(n, float(p), float(s), int(q), float(m), r) for n, p, s, q, m, r in lines(goldens.PRODUCTS)]
    df = spark.createDataFrame([r[:4] for r in want], "`Product Name` string, Profit double, Sales double, Quantity int")
    got = [tuple(r) for r in trends.top_bottom(trends.product_margins(df.repartition(4))).collect()]
    assert got == want


def test_top_bottom_breaks_ties_by_name(spark):
    df = spark.createDataFrame([(n, 1.0, 2.0, 1) for n in "dbcae"], "`Product Name` string, Profit double, Sales double, Quantity int")
    got = [(r["Product Name"], r["ranking"]) for r in trends.top_bottom(trends.product_margins(df), k=2).collect()]
    assert got == [("a", "Top 2"), ("b", "Top 2"), ("a", "Bottom 2"), ("b", "Bottom 2")]


def test_profit_margin_per_month(spark):
    want = [(m, float(p), float(s), float(pct)) for m, p, s, pct in lines(goldens.MARGINS)]
    df = spark.createDataFrame([r[:3] for r in want], "`Month-Year` string, Profit double, Sales double")
    assert sorted(tuple(r) for r in kpi.margin(df).collect()) == want


@pytest.fixture(scope="module")
def orders(spark):
    data = [
        ("2016-01-15", "East", "Furniture", 100.0, 2, 10.0),
        ("2016-01-20", "West", "Technology", 50.0, 1, -5.0),
        ("2016-03-02", "East", "Technology", 150.0, 3, 30.0),
        ("2016-03-05", "East", "Furniture", 0.0, 1, 3.0),
        ("2017-01-09", "West", None, 300.0, 4, 60.0),
        (None, "West", "Furniture", 7.0, 1, 1.0),
    ]
    df = spark.createDataFrame(data, "d string, Region string, Category string, Sales double, Quantity int, Profit double")
    return df.withColumn("Order Date", F.col("d").cast("timestamp_ntz")).drop("d")


def test_months_with_and_without_gaps(orders):
    got = rows(trends.monthly_totals(orders).select("Month-Year", "Sales", "Quantity", "month"), "month")
    assert [r[:3] for r in got] == [("Jan-2016", 150.0, 3), ("Mar-2016", 150.0, 4), ("Jan-2017", 300.0, 4)]
    filled = trends.monthly_totals(orders, fill_gaps=True)
    assert filled.count() == 13
    assert filled.filter("Sales is null").count() == 10
    assert trends.revenue_trend(filled).filter("rolling_avg_3m is not null").count() == 0


def test_growth_after_zero_is_null(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 5.0), (3, 10.0)], "t int, v double")
    assert [r["g"] for r in trends.growth_pct(df, "v", "t", "g").orderBy("t").collect()] == [None, None, 100.0]


def test_pivot_season_and_regions(orders):
    # A column for every category with rows; the fixed list has one for those without as well.
    pivot = {r["Region"]: r.asDict() for r in trends.revenue_pivot(orders).collect()}
    assert pivot["East"] == {"Region": "East", "Furniture": 100.0, "Technology": 150.0}
    assert pivot["West"] == {"Region": "West", "Furniture": 7.0, "Technology": 50.0}
    fixed = {r["Region"]: tuple(r)[1:] for r in trends.revenue_pivot(orders, values=trends.CATEGORIES).collect()}
    assert fixed == {"East": (100.0, None, 150.0, None), "West": (7.0, None, 50.0, None)}
    season = {r["Month"]: (r["Sales"], r["Month_Name"]) for r in trends.seasonal_mean(orders).collect()}
    assert season == {1: (150.0, "Jan"), 3: (75.0, "Mar")}
    assert dict(rows(trends.group_revenue(orders, "Region"))) == {"East": 250.0, "West": 357.0}
    assert rows(trends.recent_revenue(orders, ["Region"], months=12)) == [("East", 150.0), ("West", 300.0)]
    assert rows(trends.recent_revenue(orders, ["Region"], months=10)) == [("West", 300.0)]


def test_region_rank(orders):
    ranked = {(r["month"].isoformat(), r["Region"]): r["rank"] for r in trends.region_rank(orders).collect()}
    assert ranked == {("2016-01-01", "East"): 1, ("2016-01-01", "West"): 2, ("2016-03-01", "East"): 1, ("2017-01-01", "West"): 1}


def test_seasonal_verdicts(spark):
    data = [(datetime.date(y, m, 1), s) for y in (2016, 2017) for m, s in ((1, 50.0), (2, 100.0), (3, 150.0 if y == 2016 else 90.0), (12, 200.0))]
    df = spark.createDataFrame(data, "month date, Sales double")
    got = {r["calendar_month"]: r["verdict"] for r in trends.seasonal_index(df).collect()}
    assert got == {1: "under", 2: "under", 3: "mixed", 12: "over"}


def test_low_stock_uses_the_newest_level(spark):
    data = [("p1", "N", "2024-01-01", 1, 5), ("p1", "N", "2024-02-01", 9, 5), ("p2", "N", "2024-02-01", 5, 5), ("p2", "S", "2024-02-01", 4, 5)]
    df = spark.createDataFrame(data, "product_id string, region string, date string, stock_level int, reorder_point int")
    assert rows(trends.low_stock(df)) == [("p2", "S", "2024-02-01", 4, 5)]
    assert tuple(trends.low_stock_records(df).first()) == (4, 2)


@pytest.fixture(scope="module")
def metrics(spark):
    data = []
    for department, name, target, values in lines(goldens.METRICS):
        for i, value in enumerate(values.split(), start=1):
            data.append((f"2024-{i:02d}", department, name, float(value), float(target)))
    return spark.createDataFrame(data, "month string, department string, kpi_id string, actual_value double, target_value double")


@pytest.mark.parametrize("threshold, alerts", [(10, 91), (15, 68), (20, 46)])
def test_target_alerts(metrics, threshold, alerts):
    assert kpi.target_alerts(metrics, threshold).count() == alerts


def test_metric_views(metrics):
    chosen = kpi.select_metrics(metrics, ["Sales"], "2024-03", "2024-04")
    assert chosen.count() == 8
    cards = kpi.latest_vs_target(metrics)
    assert cards.count() == 12 and {r["month"] for r in cards.collect()} == {"2024-12"}
    line = [r["month"] for r in kpi.trend_line(metrics, "revenue").collect()]
    assert line == sorted(line) and len(line) == 12
    plain = kpi.on_target(metrics).filter("kpi_id = 'error_rate_pct'").filter("on_target").count()
    turned = kpi.on_target(metrics, ["error_rate_pct"]).filter("kpi_id = 'error_rate_pct'").filter("on_target").count()
    assert plain + turned == 12
    assert sum(r["reached"] + r["missed"] for r in kpi.target_status(kpi.on_target(metrics), by=["department"]).collect()) == 144


def test_zero_target_has_no_deviation(spark):
    df = spark.createDataFrame([(1.0, 0.0)], "actual_value double, target_value double")
    assert kpi.target_deviation(df).first()["deviation_pct"] is None


def test_kpis_by_hand(spark):
    data = [("Jan-2017", "A", 1, 10.0, 1, 0, 2), ("Jan-2017", "A", 0, 20.0, 2, 1, -1), ("Jan-2017", None, 1, 30.0, 3, 1, 5), ("Feb-2017", "B", 0, 7.0, 1, 0, 0), (None, "B", 1, 1.0, 1, 1, 1)]
    df = spark.createDataFrame(data, "`Month-Year` string, `Department Name` string, on_time int, Sales double, Quantity int, Late_delivery_risk int, delay_days int").withColumn("Profit", F.col("Sales") / 10)
    assert rows(kpi.on_time(df)) == [("Feb-2017", "B", 0, 1, 0.0), ("Jan-2017", "A", 1, 2, 50.0)]
    for method in ("inline", "radix"):
        assert rows(kpi.average_sales(df, method=method)) == [("Feb-2017", 7.0, 7.0, None), ("Jan-2017", 20.0, 20.0, 10.0)]
    assert rows(kpi.revenue(df)) == [("Feb-2017", 7.0, 1), ("Jan-2017", 60.0, 6)]
    assert rows(kpi.late_risk(df)) == [("Feb-2017", 0.0), ("Jan-2017", 66.67)]
    assert rows(kpi.delay(df)) == [("Feb-2017", 0.0, 0, 0), ("Jan-2017", 2.0, -1, 5)]
    assert rows(kpi.on_time_vs_late(df)) == [("Feb-2017", 0, 1), ("Jan-2017", 2, 1)]
    board = {r["Month-Year"]: r for r in kpi.board(df).collect()}
    assert board["Jan-2017"]["total_revenue"] == 60.0 and board["Jan-2017"]["late"] == 1 and board["Jan-2017"]["profit_margin_pct"] == 10.0


def test_series_of_several_keys_have_their_own_gaps(spark):
    data = [("a", "2020-01-05", 4.0, 1), ("a", "2020-03-09", 6.0, 2), ("a", "2020-04-01", 8.0, 3), ("b", "2019-11-30", 5.0, 1), (None, "2020-02-01", 1.0, 1), (None, "2020-04-01", 2.0, 1)]
    df = spark.createDataFrame(data, "k string, d string, Sales double, Quantity int").withColumn("Order Date", F.col("d").cast("timestamp_ntz"))
    months = trends.monthly_totals(df, by=["k"], fill_gaps=True)
    got = rows(months.select("k", "Month-Year", "Sales", "Quantity"))
    want = [("a", "Jan-2020", 4.0, 1), ("a", "Feb-2020", None, None), ("a", "Mar-2020", 6.0, 2), ("a", "Apr-2020", 8.0, 3), ("b", "Nov-2019", 5.0, 1)]
    want += [(None, "Feb-2020", 1.0, 1), (None, "Mar-2020", None, None), (None, "Apr-2020", 2.0, 1)]
    assert got == sorted(want, key=repr)
    plain = trends.monthly_totals(df, by=["k"])
    growth = {(r["k"], r["Month-Year"]): r["Sales_Growth_%"] for r in trends.growth_table(plain, by=["k"], fill_gaps=True).collect()}
    assert growth["a", "Mar-2020"] is None and round(growth["a", "Apr-2020"], 3) == 33.333 and len(growth) == 8
    assert rows(trends.revenue_trend(plain, by=["k"], fill_gaps=True)) == rows(trends.revenue_trend(months, by=["k"]))
    report = trends.trend_report(df.withColumn("date", F.col("d").cast("date")), revenue="Sales", units="Quantity", by=["k"], fill_gaps=True)
    assert report.count() == 8
    assert trends.monthly_totals(df.limit(0), by=["k"], fill_gaps=True).count() == 0


def test_matrix_of_more_values_than_columns(spark):
    df = spark.range(20_000).select((F.col("id") % 3).alias("Region"), F.concat(F.lit("p"), "id").alias("Category"), F.lit(2.0).alias("Sales"))
    few = trends.revenue_matrix(df.filter("Category in ('p0', 'p1', 'p3')"))
    assert few.columns == ["Region", "p0", "p1", "p3"] and rows(few) == sorted([(0, 2.0, None, 2.0), (1, None, 2.0, None)], key=repr)
    many = {r["Region"]: r["revenue"] for r in trends.revenue_matrix(df).collect()}
    assert sum(len(m) for m in many.values()) == 20_000 and many[1]["p4"] == 2.0 and "p4" not in many[0]

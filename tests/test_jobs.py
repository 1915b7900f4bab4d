"""The five jobs from raw files to result tables."""

from __future__ import annotations

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import trends
from tidemark.plans import fraud, store, supply, taxi
from tidemark.sources import read_delimited, schemas, write_delimited, write_lines, write_table
from tidemark.sources.checkpoints import fresh_path, shared_folder


# -- files -------------------------------------------------------------------------------------------


def test_latin1_file_with_padded_header_and_null_tokens(spark, tmp_path):
    text = ' Name ,Sales,Quantity,Note\n"Caf\xe9, Paris",12.5,3,"say ""hi"""\nNA,bad,,x\n'
    (tmp_path / "in.csv").write_bytes(text.encode("latin-1"))
    df = read_delimited(spark, str(tmp_path / "in.csv"), {"Sales": "double", "Quantity": "int"}, encoding="ISO-8859-1")
    assert df.dtypes == [(" Name ", "string"), ("Sales", "double"), ("Quantity", "int"), ("Note", "string")]
    assert rows(df) == sorted([("Café, Paris", 12.5, 3, 'say "hi"'), (None, None, None, "x")], key=repr)


def test_delimited_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 1.5), ('q"q', None)], "name string, v double")
    write_delimited(df, str(tmp_path / "out"))
    assert rows(read_delimited(spark, str(tmp_path / "out"), {"v": "double"})) == rows(df)


def test_table_sink_counts_and_partitions(spark, tmp_path):
    df = spark.range(10).withColumn("part", F.col("id") % 2)
    assert write_table(df, str(tmp_path / "t"), ["part"]) == 10
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if p.is_dir()) == ["part=0", "part=1"]


def test_lines_sink(spark, tmp_path):
    df = spark.createDataFrame([(1, "two"), (0, "one")], "line_no int, line string")
    write_lines(df, str(tmp_path / "l"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "l")).collect()] == ["one", "two"]


def test_intermediate_tables_use_the_named_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


# -- card transactions ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def cards(spark, tmp_path_factory):
    rng = np.random.default_rng(11)
    n = 300
    time = np.arange(n) * 977.0
    amount = np.round(rng.lognormal(3, 1.2, n), 2)
    v = rng.normal(size=(n, 3))
    label = (rng.random(n) < 0.05).astype(int)
    lines = ["Time,V1,V4,V14,Amount,Class"] + [f"{t},{a:.6f},{b:.6f},{c:.6f},{m},{k}" for t, (a, b, c), m, k in zip(time, v, amount, label)]
    lines += [lines[1], lines[2], "5.0,,1,1,1,0"]
    path = tmp_path_factory.mktemp("cards") / "cards.csv"
    path.write_text("\n".join(lines) + "\n")
    return read_delimited(spark, str(path), schemas.CARD_TRANSACTIONS)


def test_fraud_job(cards):
    assert rows(fraud.cleaning_summary(cards), "step") == [(0, "loaded", 303), (1, "missing values", 1), (2, "duplicates", 2), (3, "kept", 300)]
    clean = fraud.clean(cards)
    assert "Time" not in clean.columns
    means = clean.agg(F.avg("Amount_log_scaled"), F.stddev_pop("Amount_log_scaled"), F.avg("Time_scaled"), F.stddev_pop("Time_scaled")).first()
    assert list(means) == pytest.approx([0, 1, 0, 1], abs=1e-9)
    tables = fraud.results(cards)
    summary = tables["risk_summary"].first()
    assert summary["total"] == 300 == summary["low"] + summary["medium"] + summary["high"]
    export = tables["flagged_transactions"].collect()
    assert len(export) == summary["flagged"] > 0
    assert [r["risk_score"] for r in export] == sorted((r["risk_score"] for r in export), reverse=True)
    assert tables["flagged_transactions"].columns == list(fraud.EXPORT_COLUMNS)
    assert sum(r["rows"] for r in tables["risk_score_histogram"].collect()) == 300
    assert sum(r["rows"] for r in tables["amount_vs_hour"].collect()) == 300
    assert dict(rows(tables["flagged_vs_normal"]))["Flagged"] == summary["flagged"]
    m = tables["detection_metrics"].first()
    assert m["true_positives"] + m["false_positives"] == summary["flagged"]
    assert m["true_positives"] + m["false_negatives"] == tables["class_balance"].first()["positive"]


def test_both_quantile_ways_flag_the_same(cards):
    clean = fraud.clean(cards)
    flagged = [rows(fraud.score(clean, m).filter("flagged").select("Amount", "V1", "iqr_flag")) for m in ("inline", "radix")]
    assert flagged[0] == flagged[1]


# -- supply chain --------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def supply_raw(spark, tmp_path_factory):
    header = ",".join([" order date (DateOrders)", *supply.KEY_COLUMNS[1:], "Extra"])
    lines = [
        header,
        "1/31/2017 22:56,Fan Shop,100.5,2,10.05,Advance shipping,0,2,4,c,m,r,k,x",
        "1/13/2017 1:05,Fan Shop,50,1,,Late delivery,1,6,4,c,m,r,k,x",
        "2/01/2017 0:00,Golf,200,1,-20,Shipping on time,0,4,4,c,m,r,k,x",
        "2/02/2017 0:00,Golf,0,1,5,Shipping on time,0,4,4,c,m,r,k,x",
        "2/03/2017 0:00,Golf,10,0,5,Shipping on time,0,4,4,c,m,r,k,x",
        "2/04/2017 0:00,Apparel \xe9,40,4,4,Shipping canceled,1,5,4,c,m,r,k,x",
    ]
    lines += ["2/05/2017 0:00,Golf,10,1,1,Shipping on time,0,4,4,c,m,r,k,x"] * 14 + ["someday,Golf,10,1,1,,0,4,4,c,m,r,k,x"]
    path = tmp_path_factory.mktemp("supply") / "orders.csv"
    path.write_bytes("\n".join(lines).encode("latin-1"))
    return read_delimited(spark, str(path), schemas.SUPPLY_ORDERS, encoding="ISO-8859-1")


def test_supply_job(supply_raw):
    assert [r[2] for r in rows(supply.cleaning_summary(supply_raw), "step")] == [21, 1, 1, 1, 18]
    tables = supply.results(supply_raw)
    assert rows(tables["kpi_on_time_delivery"]) == sorted(
        [("Feb-2017", "Apparel é", 0, 1, 0.0), ("Feb-2017", "Golf", 15, 15, 100.0), ("Jan-2017", "Fan Shop", 1, 2, 50.0)], key=repr
    )
    assert rows(tables["kpi_revenue"]) == [("Feb-2017", 380.0, 19), ("Jan-2017", 150.5, 3)]
    assert rows(tables["kpi_profit_margin"]) == [("Feb-2017", -2.0, 380.0, -0.53), ("Jan-2017", 10.05, 150.5, 6.68)]
    assert rows(tables["kpi_delay_days"]) == [("Feb-2017", 0.06, 0, 1), ("Jan-2017", 0.0, -2, 2)]
    assert rows(tables["kpi_late_risk"]) == [("Feb-2017", 6.25), ("Jan-2017", 50.0)]
    assert rows(tables["on_time_vs_late"]) == [("Feb-2017", 15, 1), ("Jan-2017", 1, 1)]
    overview = tables["overview"].first()
    assert (overview["orders"], overview["departments"], overview["first_date"]) == (18, 3, datetime.date(2017, 1, 13))


# -- store orders --------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def store_raw(spark):
    def order(i, day, **changes):
        base = {
            "Order ID": f"O{i}",
            "Product ID": f"P{i % 4}",
            "Product Name": f"product {i % 4}",
            "Category": "Furniture",
            "Sub-Category": "Chairs",
            "Region": "East",
            "Order Date": day,
            "Ship Date": day,
            "Sales": 100.0 + i,
            "Quantity": 2,
            "Discount": 0.1,
            "Profit": 10.0,
        }
        return tuple({**base, **changes}.values())

    data = [order(i, f"{1 + i % 12}/{13 + i % 15}/2016") for i in range(60)]  # month first
    data += [
        order(0, "1/13/2016", Sales=999.0),  # same order and product as the first row
        order(70, None),
        order(71, "1/20/2016", Sales=-5.0),
        order(72, "1/20/2016", Quantity=0),
        order(73, "1/20/2016", Discount=1.5, Region="Mars", Category="Toys"),
    ]
    schema = (
        "`Order ID` string, `Product ID` string, `Product Name` string, Category string, `Sub-Category` string, Region string, "
        "`Order Date` string, `Ship Date` string, Sales double, Quantity int, Discount double, Profit double"
    )
    return spark.createDataFrame(data, schema)


def test_store_job(store_raw):
    assert [r[1:] for r in rows(store.cleaning_summary(store_raw), "step")] == [
        ("loaded", 65), ("invalid date", 1), ("sales not positive", 1), ("quantity not positive", 1), ("duplicates", 1), ("kept", 61),
    ]
    tables = store.results(store_raw)
    assert tables["monthly_revenue_trend"].count() == 12
    first = store.clean(store_raw, ["Sales"]).filter("`Order ID` = 'O0'").first()
    assert (first["Sales"], first["Month-Year"], first["Quarter"], first["profit_margin"]) == (100.0, "Jan-2016", "Q1", 10.0)
    assert rows(tables["invalid_discounts"]) == [("Discount", 1)]
    assert rows(tables["unexpected_regions"]) == [("Region", "Mars", 1)]
    assert rows(tables["unexpected_categories"]) == [("Category", "Toys", 1)]
    assert tables["overview"].first()["rows"] == 61
    total = sum(r["Sales"] for r in tables["sales_by_region"].collect())
    assert total == pytest.approx(sum(r["Sales"] for r in tables["monthly_revenue_trend"].collect()))
    assert tables["top_bottom_products"].count() == 8
    pivot = tables["regional_revenue_by_category"]
    assert "Toys" in pivot.columns
    cells = sum(v or 0.0 for r in pivot.collect() for v in tuple(r)[1:])
    assert cells == pytest.approx(total)
    assert {r["Month_Name"] for r in tables["seasonal_analysis"].collect()} >= {"Jan", "Dec"}


def test_inventory_job(spark):
    data = [
        (f"20{23 + m // 12}-{m % 12 + 1:02d}-01", f"E{p}", f"name {p}", "Electronics", region, 10 * (p + 1), 100.0 * (p + 1) + m, m % 30, 15)
        for m in range(24)
        for p in range(3)
        for region in ("North", "South")
    ]
    df = spark.createDataFrame(
        data, "date string, product_id string, product_name string, category string, region string, units_sold int, revenue double, stock_level int, reorder_point int"
    )
    tables = store.inventory_results(df)
    assert tables["trend_report"].count() == 24
    assert tables["low_stock_alert"].count() == 0 and tables["low_stock_records"].first()["low_stock_records"] == 15 * 6
    assert {r["rank"] for r in tables["regional_ranking"].collect()} == {1}
    assert tables["regional_revenue"].count() == 2 and tables["revenue_heatmap"].count() == 24
    assert tables["seasonal_index"].count() == 12


# -- trips ---------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def taxi_raw(spark, tmp_path_factory):
    lines = ["VendorID,tpep_pickup_datetime,tpep_dropoff_datetime,trip_distance,total_amount,payment_type"]
    start = datetime.datetime(2017, 1, 1, 0, 0, 0)
    for i in range(40):
        begin = start + datetime.timedelta(days=9 * i, hours=i % 24)
        end = begin + datetime.timedelta(seconds=90 * i)
        lines.append(f"{1 + i % 2},{begin:%m/%d/%Y %I:%M:%S %p},{end:%m/%d/%Y %I:%M:%S %p},{i % 5},{5 + i},{1 + i % 3}")
    lines.append("1,01/01/2017 08:00:00 AM,01/02/2017 08:00:00 PM,1.5,20,1")
    path = tmp_path_factory.mktemp("taxi") / "trips.csv"
    path.write_text("\n".join(lines))
    return read_delimited(spark, str(path), schemas.TRIPS)


def test_taxi_job(taxi_raw):
    tables = taxi.results(taxi_raw)
    assert tuple(tables["shape"].first()) == (41, 6)
    assert sum(r["trip_count"] for r in tables["hourly_volume"].collect()) == 41
    assert {r["month_name"] for r in tables["monthly_volume"].collect()} >= {"Jan", "Feb", "Dec"}
    assert tables["longest_trips"].first()["trip_duration_min"] == 36 * 60
    assert [r["total_amount"] for r in tables["dearest_trips"].collect()] == [44.0, 43.0, 42.0, 41.0, 40.0]
    durations = np.array([1.5 * i for i in range(40)] + [2160.0])
    q1, q3 = np.quantile(durations, [0.25, 0.75])
    outliers = tables["duration_outliers"].first()
    assert (outliers["lower"], outliers["upper"], outliers["outliers"]) == (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1), 1)
    assert tables["zero_distance"].first()["zero_distance_charged"] == 8
    assert tables["duration_box"].first()["n"] == 32
    medians = dict(rows(tables["medians"]))
    assert medians["trip_duration_min"] == np.median(durations)
    assert sum(r["rows"] for r in tables["payment_shares"].collect()) == 41
    assert {r["day_type"] for r in tables["peak_hours"].collect()} == {"weekday", "weekend"}
    assert {r["column"]: r["nulls"] for r in tables["null_counts"].collect()}["trip_distance"] == 0
    assert sum(r["trips"] for r in tables["amount_by_distance"].collect()) == 41
    assert tables["quarterly_fare"].count() == 4
    assert tables["preview"].count() == 5 and tables["describe"].count() == 4 and tables["column_types"].count() == 6

"""Supply-chain orders: clean, then six monthly KPIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import delay_days, month_label, on_time_flag, percent, safe_ratio
from tidemark.operators import kpi
from tidemark.operators.cleaning import (
    drop_missing,
    fill_missing,
    keep_existing,
    keep_positive,
    missing_columns,
    parse_dates,
    rename,
    step_summary,
    strip_column_names,
)
from tidemark.sources.checkpoints import store

# Column names of the input file.
KEY_COLUMNS = (
    "order date (DateOrders)",
    "Department Name",
    "Sales per customer",
    "Order Item Quantity",
    "Benefit per order",
    "Delivery Status",
    "Late_delivery_risk",
    "Days for shipping (real)",
    "Days for shipment (scheduled)",
    "Category Name",
    "Market",
    "Order Region",
    "Order Country",
)
# Column names of the input file.
NEW_NAMES = {
    "order date (DateOrders)": "Order Date",
    "Sales per customer": "Sales",
    "Order Item Quantity": "Quantity",
    "Benefit per order": "Profit",
    "Days for shipping (real)": "Actual_Days",
    "Days for shipment (scheduled)": "Scheduled_Days",
}
DATE_FORMATS = ("M/d/yyyy H:mm", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")


def typed(raw: DataFrame) -> DataFrame:
    """Key columns under short names, the order date parsed."""
    orders = rename(keep_existing(strip_column_names(raw), KEY_COLUMNS), NEW_NAMES)
    if dict(orders.dtypes)["Order Date"] == "string":
        orders = parse_dates(orders, ["Order Date"], DATE_FORMATS)
    return orders


def derive(orders: DataFrame) -> DataFrame:
    """Calendar parts, punctuality, delay and row margin."""
    out = fill_missing(orders, {"Profit": 0.0}).withColumns(
        {
            "Month": F.month("Order Date"),
            "Year": F.year("Order Date"),
            "Month-Year": month_label(F.col("Order Date")),
            "on_time": on_time_flag(F.col("Delivery Status")),
            "delay_days": delay_days(F.col("Actual_Days"), F.col("Scheduled_Days")),
        }
    )
    return out.withColumn("profit_margin", safe_ratio(F.col("Profit"), F.col("Sales")))


def clean(raw: DataFrame) -> DataFrame:
    orders = drop_missing(typed(raw), ["Order Date"])
    return derive(keep_positive(orders, "Sales", "Quantity"))


def filter_steps() -> list[tuple[str, Column]]:
    return [
        ("invalid date", F.col("Order Date").isNotNull()),
        ("sales not positive", F.col("Sales") > 0),
        ("quantity not positive", F.col("Quantity") > 0),
    ]


def cleaning_summary(raw: DataFrame) -> DataFrame:
    return step_summary(typed(raw), filter_steps())


def missing_key_columns(raw: DataFrame) -> DataFrame:
    """One row for each key column that the file lacks, misspelt ones included."""
    lacking = missing_columns(strip_column_names(raw), KEY_COLUMNS)
    return raw.sparkSession.createDataFrame([(c,) for c in lacking], "column string")


def overview(orders: DataFrame) -> DataFrame:
    """One row: cleaned orders, date range, departments, on-time share."""
    return orders.agg(
        F.count(F.lit(1)).alias("orders"),
        F.min("Order Date").cast("date").alias("first_date"),
        F.max("Order Date").cast("date").alias("last_date"),
        F.count_distinct("Department Name").alias("departments"),
        percent(F.coalesce(F.sum("on_time"), F.lit(0)), F.count(F.lit(1))).alias("on_time_pct"),
    )


def results(raw: DataFrame) -> dict[str, DataFrame]:
    """All result tables of the job by name."""
    # Read by every table below, and parsed from text: written once.
    parsed = store(typed(raw), "supply-parsed")
    orders = store(derive(keep_positive(drop_missing(parsed, ["Order Date"]), "Sales", "Quantity")), "supply-orders")
    return {
        "missing_columns": missing_key_columns(raw),
        "cleaning_summary": step_summary(parsed, filter_steps()),
        "overview": overview(orders),
        "kpi_on_time_delivery": kpi.on_time(orders),
        "kpi_avg_sales": kpi.average_sales(orders),
        "kpi_revenue": kpi.revenue(orders),
        "kpi_late_risk": kpi.late_risk(orders),
        "kpi_delay_days": kpi.delay(orders),
        "kpi_profit_margin": kpi.margin(orders),
        "on_time_vs_late": kpi.on_time_vs_late(orders),
    }

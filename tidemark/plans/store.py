"""Store orders: clean, then trend, growth, anomaly, pivot, season and ranking tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import POSITION, month_label, quarter_label, safe_ratio
from tidemark.operators import trends
from tidemark.operators.cleaning import (
    drop_missing,
    duplicate_rows,
    keep_first,
    keep_positive,
    out_of_range,
    parse_dates,
    step_summary,
    strip_column_names,
    tail_counts,
    unexpected_values,
)
from tidemark.sources.checkpoints import store as written
from tidemark.sources.schemas import STORE_DATE_FORMATS

KEYS = ("Order ID", "Product ID")


def typed(raw: DataFrame) -> DataFrame:
    """Stripped column names, both dates parsed."""
    orders = strip_column_names(raw)
    text = [c for c in ("Order Date", "Ship Date") if dict(orders.dtypes).get(c) == "string"]
    return parse_dates(orders, text, STORE_DATE_FORMATS) if text else orders


def derive(orders: DataFrame) -> DataFrame:
    """Calendar parts and row margin."""
    return orders.withColumns(
        {
            "Month": F.month("Order Date"),
            "Year": F.year("Order Date"),
            "Month-Year": month_label(F.col("Order Date")),
            "Quarter": quarter_label(F.col("Order Date")),
            "profit_margin": safe_ratio(F.col("Profit"), F.col("Sales")),
        }
    )


def clean(raw: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """Valid orders, one row per order and product: the first one in ``order_by``.

    Without ``order_by`` the first one in the file decides, if the rows carry their position, else the remaining columns.
    """
    orders = typed(raw)
    rest = [POSITION] if POSITION in orders.columns else [c for c in orders.columns if c not in KEYS]
    orders = keep_positive(drop_missing(orders, ["Order Date"]), "Sales", "Quantity")
    return derive(keep_first(orders, KEYS, [F.col(f"`{c}`") for c in order_by or rest]).drop(POSITION))


def filter_steps() -> list[tuple[str, Column]]:
    return [
        ("invalid date", F.col("Order Date").isNotNull()),
        ("sales not positive", F.col("Sales") > 0),
        ("quantity not positive", F.col("Quantity") > 0),
    ]


def cleaning_summary(raw: DataFrame) -> DataFrame:
    """Rows per filter step, then surplus rows per order and product, then rows kept."""
    orders = typed(raw)
    steps = step_summary(orders, filter_steps())
    valid = keep_positive(drop_missing(orders, ["Order Date"]), "Sales", "Quantity")
    surplus = duplicate_rows(valid, KEYS)
    tail = surplus.select(
        F.inline(
            F.array(
                F.struct(F.lit(4).alias("step"), F.lit("duplicates").alias("name"), F.col("removed").alias("rows")),
                F.struct(F.lit(5).alias("step"), F.lit("kept").alias("name"), F.col("distinct_rows").alias("rows")),
            )
        )
    )
    return steps.filter(F.col("name") != "kept").unionByName(tail)


def overview(orders: DataFrame) -> DataFrame:
    """One row: rows, date range, distinct categories, sub-categories and regions, mean row margin."""
    return orders.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("Order Date").cast("date").alias("first_date"),
        F.max("Order Date").cast("date").alias("last_date"),
        F.count_distinct("Category").alias("categories"),
        F.count_distinct("Sub-Category").alias("sub_categories"),
        F.count_distinct("Region").alias("regions"),
        F.avg("profit_margin").alias("overall_margin"),
    )


def results(raw: DataFrame, order_by: Sequence[str] | None = None, order: str = "chronological") -> dict[str, DataFrame]:
    """All result tables of the job by name."""
    # Read by every table below, and de-duplicated at the cost of a shuffle of all columns: written once.
    orders = written(clean(raw, order_by), "store-orders")
    months = trends.monthly_totals(orders)
    return {
        "cleaning_summary": cleaning_summary(raw),
        "overview": overview(orders),
        "invalid_discounts": out_of_range(orders, {"Discount": (0, 1)}),
        "profit_tails": tail_counts(orders, "Profit"),
        "unexpected_regions": unexpected_values(orders, "Region", trends.REGIONS),
        "unexpected_categories": unexpected_values(orders, "Category", trends.CATEGORIES),
        "monthly_revenue_trend": trends.revenue_trend(months, order),
        "mom_growth_rates": trends.growth_table(months, order),
        "sales_anomalies": trends.sales_anomalies(months, order=order),
        "regional_revenue_by_category": trends.revenue_pivot(orders),
        "seasonal_analysis": trends.seasonal_mean(orders),
        "subcategory_profitability": trends.margin_ranking(orders),
        "top_bottom_products": trends.top_bottom(trends.product_margins(orders)),
        "profit_margin_by_category": trends.mean_margin(orders),
        "sales_by_region": trends.group_revenue(orders, "Region"),
    }


def inventory_results(sales: DataFrame) -> dict[str, DataFrame]:
    """Result tables of a monthly sales and inventory table (date, product, category, region, units, stock)."""
    dated = sales.withColumn("date", F.col("date").cast("date"))
    series = dated.groupBy("date").agg(
        F.sum("revenue").alias("revenue"), F.sum("units_sold").cast("bigint").alias("units_sold")
    )
    months = trends.monthly_totals(dated, "date", "revenue", "units_sold")
    return {
        "trend_report": trends.trend_report(series),
        "regional_ranking": trends.region_rank(dated, "date", "region", "revenue"),
        "seasonal_index": trends.seasonal_index(months),
        "regional_revenue": trends.recent_revenue(dated, ("region", "category"), "date", 6, "revenue"),
        "revenue_heatmap": trends.group_revenue(
            dated.withColumn("month", F.date_format("date", "yyyy-MM")), "month", "category", sales="revenue"
        ),
        "low_stock_alert": trends.low_stock(dated),
        "low_stock_records": trends.low_stock_records(dated),
    }

"""Monthly series, rankings, pivots and stock alerts.

Windows here run over tables that are already aggregated to one row per period (and a few keys), never
over row-level data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import count_where, month_label, month_name, month_start, percent, total
from tidemark.operators.kpi import latest
from tidemark.sources.checkpoints import store

# The categories and regions of the store data set.
CATEGORIES = ("Furniture", "Office Supplies", "Technology")
REGIONS = ("East", "West", "Central", "South")


def _known(df: DataFrame, *keys: str) -> DataFrame:
    for k in keys:
        df = df.filter(F.col(f"`{k}`").isNotNull())
    return df


# -- monthly series ----------------------------------------------------------------------------------


def monthly_totals(
    df: DataFrame,
    date: str = "Order Date",
    sales: str = "Sales",
    quantity: str = "Quantity",
    scale: int | None = None,
    fill_gaps: bool = False,
    by: Sequence[str] = (),
) -> DataFrame:
    """Sales and quantity per calendar month, and per ``by`` if given: month (date), Month-Year (label), Sales, Quantity."""
    months = (
        df.filter(F.col(f"`{date}`").isNotNull())
        .groupBy(*[F.col(f"`{c}`") for c in by], month_start(F.col(f"`{date}`")).alias("month"))
        .agg(
            total(F.col(f"`{sales}`"), scale).alias("Sales"),
            F.coalesce(F.sum(F.col(f"`{quantity}`")), F.lit(0)).cast("bigint").alias("Quantity"),
        )
    )
    if fill_gaps:
        months = with_missing_months(months, "month", by)
    return months.withColumn("Month-Year", month_label(F.col("month"))).select(*[f"`{c}`" for c in by], "month", "Month-Year", "Sales", "Quantity")


def with_missing_months(months: DataFrame, month: str = "month", by: Sequence[str] = ()) -> DataFrame:
    """Add rows (NULL measures) for months without data between the first and the last one, of each ``by`` on its own.

    ``months`` has one row per month (and key). Each row brings the empty months up to the next one with it, so the
    series needs no join, and a NULL key is a key like others.
    """
    keys = [F.col(f"`{c}`") for c in by]
    after = F.lead(F.col(f"`{month}`")).over(Window.partitionBy(*keys).orderBy(F.col(f"`{month}`")))
    until = F.coalesce(F.add_months(after, -1), F.col(f"`{month}`"))
    spine = months.withColumn("_months", F.sequence(F.col(f"`{month}`"), until, F.expr("interval 1 month")))
    each = spine.select("*", F.posexplode("_months").alias("_at", "_month"))
    filled = [
        F.col("_month").alias(c) if c == month else F.col(f"`{c}`") if c in by else F.when(F.col("_at") == 0, F.col(f"`{c}`")).alias(c)
        for c in months.columns
    ]
    return each.select(*filled)


def series_order(order: str = "chronological") -> str:
    """Column that orders a monthly series: in time, or by the text of the month label."""
    columns = {"chronological": "month", "label": "Month-Year"}
    if order not in columns:
        raise ValueError(f"order must be one of {sorted(columns)}")
    return columns[order]


def rolling_mean(
    df: DataFrame,
    value: str,
    order_by: str | Sequence[str],
    out: str,
    by: Sequence[str] = (),
    width: int = 3,
    centred: bool = True,
    min_periods: int | None = None,
) -> DataFrame:
    """Mean over ``width`` rows; NULL where fewer than ``min_periods`` (default: all) values are present."""
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    back = (width - 1) // 2 if centred else width - 1
    ahead = width - 1 - back
    frame = Window.partitionBy(*by).orderBy(*[F.col(f"`{k}`") for k in keys]).rowsBetween(-back, ahead)
    needed = width if min_periods is None else min_periods
    v = F.col(f"`{value}`")
    return df.withColumn(out, F.when(F.count(v).over(frame) >= needed, F.avg(v).over(frame)))


def growth_pct(
    df: DataFrame, value: str, order_by: str | Sequence[str], out: str, by: Sequence[str] = ()
) -> DataFrame:
    """Change against the previous row in percent; NULL for the first row and after a zero."""
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    before = F.lag(F.col(f"`{value}`")).over(Window.partitionBy(*by).orderBy(*[F.col(f"`{k}`") for k in keys]))
    return df.withColumn(out, F.try_divide((F.col(f"`{value}`") - before).cast("double"), before.cast("double")) * 100)


def _series(months: DataFrame, by: Sequence[str], fill_gaps: bool) -> DataFrame:
    """A monthly table as it is, or with its missing months and their labels."""
    if not fill_gaps:
        return months
    return with_missing_months(months, "month", by).withColumn("Month-Year", month_label(F.col("month")))


def revenue_trend(months: DataFrame, order: str = "chronological", by: Sequence[str] = (), fill_gaps: bool = False) -> DataFrame:
    """Monthly sales with the centred three-month mean; with ``fill_gaps`` over calendar months instead of rows."""
    months = _series(months, by, fill_gaps)
    return rolling_mean(months, "Sales", series_order(order), "rolling_avg_3m", by=by)


def growth_table(months: DataFrame, order: str = "chronological", by: Sequence[str] = (), fill_gaps: bool = False) -> DataFrame:
    """Growth of sales and quantity side by side, from one table with both sums; with ``fill_gaps`` a month after one
    without data has no growth."""
    key = series_order(order)
    months = _series(months, by, fill_gaps)
    out = growth_pct(months, "Sales", key, "Sales_Growth_%", by)
    out = growth_pct(out, "Quantity", key, "Quantity_Growth_%", by)
    return out.select(*by, "month", "Month-Year", "Sales_Growth_%", "Quantity_Growth_%")


def sales_anomalies(
    months: DataFrame, threshold: float = 15.0, order: str = "chronological", by: Sequence[str] = ()
) -> DataFrame:
    """Months whose sales differ from the centred mean by more than ``threshold`` percent."""
    out = growth_pct(revenue_trend(months, order, by), "Sales", series_order(order), "mom_growth", by)
    gap = F.abs(F.try_divide(F.col("Sales") - F.col("rolling_avg_3m"), F.col("rolling_avg_3m"))) * 100
    return (
        out.withColumn("deviation_pct", gap)
        .filter(F.col("deviation_pct") > threshold)
        .select(*by, "month", "Month-Year", "Sales", "rolling_avg_3m", "mom_growth", "deviation_pct")
    )


def trend_report(
    df: DataFrame,
    date: str = "date",
    revenue: str = "revenue",
    units: str = "units_sold",
    threshold: float = 15.0,
    by: Sequence[str] = (),
    fill_gaps: bool = False,
) -> DataFrame:
    """Growth and trailing three-row means (from the first row on) of a dated series, with anomaly mark.

    With ``fill_gaps`` the dates are months, and those missing between the first and the last are added.
    """
    if fill_gaps:
        df = with_missing_months(df.withColumn(date, F.trunc(F.col(f"`{date}`").cast("date"), "month")), date, by)
    out = growth_pct(df, revenue, date, "rev_mom_pct", by)
    out = growth_pct(out, units, date, "units_mom_pct", by)
    for value, name in ((revenue, "rev_roll3"), (units, "units_roll3")):
        out = rolling_mean(out, value, date, name, by, centred=False, min_periods=1)
    gap = F.abs(F.try_divide(F.col(revenue) - F.col("rev_roll3"), F.col("rev_roll3"))) * 100
    return out.withColumn("rev_anomaly", F.coalesce(gap > threshold, F.lit(False))).select(
        *by, date, revenue, units, "rev_mom_pct", "units_mom_pct", "rev_roll3", "units_roll3", "rev_anomaly"
    )


# -- seasonality -------------------------------------------------------------------------------------


def seasonal_mean(df: DataFrame, date: str = "Order Date", sales: str = "Sales") -> DataFrame:
    """Mean sale per calendar month, with the month's short name."""
    return (
        df.filter(F.col(f"`{date}`").isNotNull())
        .groupBy(F.month(F.col(f"`{date}`")).alias("Month"))
        .agg(F.avg(F.col(f"`{sales}`")).alias("Sales"))
        .withColumn("Month_Name", month_name(F.col("Month")))
    )


def seasonal_index(months: DataFrame) -> DataFrame:
    """Which calendar months lie above (or below) the mean month of their year in every year.

    The index of a month is its revenue over the mean monthly revenue of that year.
    """
    with_year = months.withColumns({"year": F.year("month"), "calendar_month": F.month("month")})
    indexed = with_year.withColumn(
        "index", F.try_divide(F.col("Sales"), F.avg("Sales").over(Window.partitionBy("year")))
    )
    return (
        indexed.groupBy("calendar_month")
        .agg(
            F.count("index").alias("years"),
            F.avg("index").alias("mean_index"),
            count_where(F.col("index") > 1).alias("years_over"),
            count_where(F.col("index") < 1).alias("years_under"),
        )
        .withColumn(
            "verdict",
            F.when(F.col("years_over") == F.col("years"), "over")
            .when(F.col("years_under") == F.col("years"), "under")
            .otherwise("mixed"),
        )
    )


# -- groups ------------------------------------------------------------------------------------------


def revenue_pivot(
    df: DataFrame,
    rows: str | Column = "Region",
    columns: str = "Category",
    values: Sequence[str] | None = None,
    sales: str = "Sales",
    scale: int | None = None,
) -> DataFrame:
    """Revenue matrix with a column for every value present.

    The rows are summed per cell first; the small table of cells is written once, and its values become the
    columns. With ``values`` the columns are fixed and the revenue of all other values goes to ``other``.
    """
    key = F.col(f"`{rows}`") if isinstance(rows, str) else rows
    known = df.filter(key.isNotNull() & F.col(f"`{columns}`").isNotNull())
    column = F.col(f"`{columns}`").cast("string")
    if values is not None:
        column = F.when(column.isin(*values), column).otherwise("other")
    cells = known.groupBy(key, column.alias("_column")).agg(total_or_null(F.col(sales), scale).alias("_total"))
    if values is None:
        cells = store(cells, "pivot-cells")
    return cells.groupBy(cells.columns[0]).pivot("_column", [*values, "other"] if values is not None else None).agg(F.first("_total"))


def revenue_matrix(
    df: DataFrame, rows: str = "Region", columns: str = "Category", sales: str = "Sales", scale: int | None = None, widest: int = 5_000
) -> DataFrame:
    """Revenue matrix for any number of values: a column each up to ``widest`` of them, else one map column ``revenue``
    (value -> revenue, by value) with the same content.

    Only the number of different values, and up to ``widest`` of them, reach the driver; a map holds the values of one row.
    """
    known = _known(df, rows, columns).withColumn("_column", F.col(f"`{columns}`").cast("string"))
    cells = store(known.groupBy(F.col(f"`{rows}`"), "_column").agg(total_or_null(F.col(f"`{sales}`"), scale).alias("_total")), "matrix-cells")
    values = [r["_column"] for r in cells.select("_column").distinct().limit(widest + 1).collect()]
    if len(values) <= widest:
        return cells.groupBy(F.col(f"`{rows}`")).pivot("_column", sorted(values)).agg(F.first("_total"))
    entries = F.array_sort(F.collect_list(F.struct("_column", "_total")))
    return cells.groupBy(F.col(f"`{rows}`")).agg(F.map_from_entries(entries).alias("revenue"))


def total_or_null(c: Column, scale: int | None = None) -> Column:
    """Sum that stays NULL for a cell without rows."""
    return F.when(F.count(c) > 0, total(c, scale))


def group_revenue(df: DataFrame, *keys: str, sales: str = "Sales", scale: int | None = None) -> DataFrame:
    return _known(df, *keys).groupBy(*keys).agg(total(F.col(sales), scale).alias("Sales"))


def recent_revenue(
    df: DataFrame,
    keys: Sequence[str] = ("Region", "Category"),
    date: str = "Order Date",
    months: int = 6,
    sales: str = "Sales",
    scale: int | None = None,
) -> DataFrame:
    """Revenue per group in the last ``months`` calendar months of the data (the newest one included)."""
    newest = df.agg(F.max(F.col(f"`{date}`")).cast("date").alias("d")).scalar()
    since = F.add_months(F.trunc(newest, "month"), -(months - 1))
    recent = df.filter(F.col(f"`{date}`").cast("date") >= since)
    return group_revenue(recent, *keys, sales=sales, scale=scale)


def margin_ranking(
    df: DataFrame, group: str = "Sub-Category", profit: str = "Profit", sales: str = "Sales", scale: int | None = None
) -> DataFrame:
    """Profit, sales and margin per group, best margin first."""
    return (
        _known(df, group)
        .groupBy(F.col(f"`{group}`"))
        .agg(total(F.col(profit), scale).alias("Profit"), total(F.col(sales), scale).alias("Sales"))
        .withColumn("profit_margin_pct", percent(F.col("Profit"), F.col("Sales")))
        .orderBy(F.desc("profit_margin_pct"), F.col(f"`{group}`"))
    )


def product_margins(
    df: DataFrame,
    product: str = "Product Name",
    profit: str = "Profit",
    sales: str = "Sales",
    quantity: str = "Quantity",
    scale: int | None = None,
) -> DataFrame:
    """Profit, sales, quantity and rounded margin per product."""
    return (
        _known(df, product)
        .groupBy(F.col(f"`{product}`"))
        .agg(
            total(F.col(profit), scale).alias("Profit"),
            total(F.col(sales), scale).alias("Sales"),
            F.coalesce(F.sum(quantity), F.lit(0)).cast("bigint").alias("Quantity"),
        )
        .withColumn("profit_margin_pct", percent(F.col("Profit"), F.col("Sales")))
    )


def top_bottom(
    margins: DataFrame, product: str = "Product Name", measure: str = "profit_margin_pct", k: int = 10
) -> DataFrame:
    """The k best and k worst products by rounded margin; ties in product order."""
    ranked = margins.filter(F.col(measure).isNotNull())
    name = F.col(f"`{product}`")
    best = ranked.orderBy(F.desc(measure), name).limit(k).withColumn("ranking", F.lit(f"Top {k}"))
    worst = ranked.orderBy(F.asc(measure), name).limit(k).withColumn("ranking", F.lit(f"Bottom {k}"))
    return best.unionByName(worst)


def mean_margin(df: DataFrame, group: str = "Category", margin: str = "profit_margin") -> DataFrame:
    """Mean of the row margins per group."""
    return _known(df, group).groupBy(group).agg(F.avg(margin).alias("avg_margin"))


def region_rank(
    df: DataFrame, date: str = "Order Date", region: str = "Region", sales: str = "Sales", scale: int | None = None
) -> DataFrame:
    """Revenue rank of each region within its month (equal revenue, equal rank)."""
    monthly = (
        _known(df, date, region)
        .groupBy(month_start(F.col(f"`{date}`")).alias("month"), F.col(region))
        .agg(total(F.col(sales), scale).alias("Sales"))
    )
    return monthly.withColumn("rank", F.rank().over(Window.partitionBy("month").orderBy(F.desc("Sales"))))


# -- stock -------------------------------------------------------------------------------------------


def low_stock(
    df: DataFrame,
    keys: Sequence[str] = ("product_id", "region"),
    date: str = "date",
    stock: str = "stock_level",
    reorder: str = "reorder_point",
) -> DataFrame:
    """Products whose newest stock level lies below their reorder point."""
    return latest(df, keys, date, [stock, reorder]).filter(F.col(stock) < F.col(reorder))


def low_stock_records(df: DataFrame, stock: str = "stock_level", reorder: str = "reorder_point") -> DataFrame:
    """One row: records and records below the reorder point."""
    return df.agg(
        F.count(F.lit(1)).alias("records"), count_where(F.col(stock) < F.col(reorder)).alias("low_stock_records")
    )

"""Operational KPIs per period, and alerts of KPI values against targets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import count_where, percent, total
from tidemark.operators.quantiles import is_small, quantiles

PERIOD = "Month-Year"


def _known(df: DataFrame, *keys: str) -> DataFrame:
    """Rows without a group key belong to no group."""
    for k in keys:
        df = df.filter(F.col(f"`{k}`").isNotNull())
    return df


def on_time(df: DataFrame, period: str = PERIOD, unit: str = "Department Name", flag: str = "on_time") -> DataFrame:
    """On-time share per period and organisational unit."""
    return (
        _known(df, period, unit)
        .groupBy(period, unit)
        .agg(F.coalesce(F.sum(flag), F.lit(0)).cast("bigint").alias("on_time_count"), F.count(flag).alias("total_orders"))
        .withColumn("on_time_pct", percent(F.col("on_time_count"), F.col("total_orders")))
    )


def average_sales(
    df: DataFrame, period: str = PERIOD, sales: str = "Sales", method: str = "auto", calendar: bool = True
) -> DataFrame:
    """Mean, median and sample SD of the order value per period.

    ``calendar`` states that the periods are calendar months or the like, whose number is bounded.
    """
    groups = _known(df, period).groupBy(period)
    moments = [F.avg(sales).alias("avg"), F.stddev_samp(sales).alias("std")]
    if method == "auto":
        method = "inline" if is_small(df.select(period, sales)) else "radix"
    if method == "inline":
        table = groups.agg(*moments, F.percentile(sales, F.lit(0.5)).alias("median"))
    else:
        medians = quantiles(df, sales, [0.5], by=[period], names=["median"], method=method, bounded_groups=calendar)
        table = groups.agg(*moments).join(medians, period, "left")
    # A median of cents often ends in half a cent: rounding in two steps keeps the noise of its
    # interpolation from deciding the direction.
    return table.select(
        period,
        F.round("avg", 2).alias("avg_sales"),
        F.round(F.round("median", 6), 2).alias("median_sales"),
        F.round("std", 2).alias("std_sales"),
    )


def revenue(
    df: DataFrame, period: str = PERIOD, sales: str = "Sales", quantity: str = "Quantity", scale: int | None = None
) -> DataFrame:
    """Revenue and quantity sums per period."""
    return (
        _known(df, period)
        .groupBy(period)
        .agg(total(F.col(sales), scale).alias("total_revenue"), F.coalesce(F.sum(quantity), F.lit(0)).alias("total_quantity"))
    )


def late_risk(df: DataFrame, period: str = PERIOD, flag: str = "Late_delivery_risk") -> DataFrame:
    """Share of orders at risk of late delivery per period."""
    return _known(df, period).groupBy(period).agg(F.round(F.avg(flag) * 100, 2).alias("late_risk_pct"))


def delay(df: DataFrame, period: str = PERIOD, days: str = "delay_days") -> DataFrame:
    """Mean, smallest and largest delay per period."""
    return (
        _known(df, period)
        .groupBy(period)
        .agg(F.round(F.avg(days), 2).alias("avg_delay"), F.min(days).alias("min_delay"), F.max(days).alias("max_delay"))
    )


def margin(
    df: DataFrame, period: str = PERIOD, profit: str = "Profit", sales: str = "Sales", scale: int | None = None
) -> DataFrame:
    """Profit margin per period as a ratio of sums."""
    return (
        _known(df, period)
        .groupBy(period)
        .agg(total(F.col(profit), scale).alias("total_profit"), total(F.col(sales), scale).alias("total_sales"))
        .withColumn("profit_margin_pct", percent(F.col("total_profit"), F.col("total_sales")))
    )


def on_time_vs_late(df: DataFrame, period: str = PERIOD, flag: str = "on_time") -> DataFrame:
    """Punctual and other orders per period (the two series of a stacked chart)."""
    return (
        _known(df, period)
        .groupBy(period)
        .agg(F.coalesce(F.sum(flag), F.lit(0)).cast("bigint").alias("on_time"), F.count(F.lit(1)).alias("_n"))
        .select(period, "on_time", (F.col("_n") - F.col("on_time")).alias("late"))
    )


def board(df: DataFrame, period: str = PERIOD, scale: int | None = None) -> DataFrame:
    """All monthly KPIs except the median side by side, from one scan and one shuffle."""
    return (
        _known(df, period)
        .groupBy(period)
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.coalesce(F.sum("on_time"), F.lit(0)).cast("bigint").alias("on_time"),
            F.round(F.avg("Sales"), 2).alias("avg_sales"),
            F.round(F.stddev_samp("Sales"), 2).alias("std_sales"),
            total(F.col("Sales"), scale).alias("total_revenue"),
            F.coalesce(F.sum("Quantity"), F.lit(0)).alias("total_quantity"),
            F.round(F.avg("Late_delivery_risk") * 100, 2).alias("late_risk_pct"),
            F.round(F.avg("delay_days"), 2).alias("avg_delay"),
            F.min("delay_days").alias("min_delay"),
            F.max("delay_days").alias("max_delay"),
            total(F.col("Profit"), scale).alias("total_profit"),
        )
        .withColumns(
            {
                "late": F.col("orders") - F.col("on_time"),
                "profit_margin_pct": percent(F.col("total_profit"), F.col("total_revenue")),
            }
        )
    )


# -- targets -----------------------------------------------------------------------------------------


def select_metrics(
    df: DataFrame,
    departments: Sequence[str] | None = None,
    first_month: str | None = None,
    last_month: str | None = None,
    month: str = "month",
    department: str = "department",
) -> DataFrame:
    """Restrict metric rows to departments and a closed month range."""
    if departments is not None:
        df = df.filter(F.col(department).isin(*departments))
    if first_month is not None:
        df = df.filter(F.col(month) >= first_month)
    if last_month is not None:
        df = df.filter(F.col(month) <= last_month)
    return df


def target_deviation(df: DataFrame, actual: str = "actual_value", target: str = "target_value") -> DataFrame:
    """Add ``deviation_pct`` = |actual - target| / |target| * 100 (NULL for a zero target)."""
    gap = F.abs(F.col(actual) - F.col(target))
    return df.withColumn("deviation_pct", F.try_divide(gap, F.abs(F.col(target))) * 100)


def target_alerts(df: DataFrame, threshold: float = 15.0, actual: str = "actual_value", target: str = "target_value") -> DataFrame:
    """Metric rows that deviate from their target by more than ``threshold`` percent."""
    return target_deviation(df, actual, target).filter(F.col("deviation_pct") > threshold)


def on_target(
    df: DataFrame,
    lower_is_better: Sequence[str] = (),
    kpi: str = "kpi_id",
    actual: str = "actual_value",
    target: str = "target_value",
) -> DataFrame:
    """Add ``on_target``; for the KPIs in ``lower_is_better`` the target is an upper bound."""
    reached = F.col(actual) >= F.col(target)
    if lower_is_better:
        reached = F.when(F.col(kpi).isin(*lower_is_better), F.col(actual) <= F.col(target)).otherwise(reached)
    return df.withColumn("on_target", reached)


def latest(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str] | None = None) -> DataFrame:
    """The row with the greatest ``order`` value per key (an aggregate, so hot keys combine map-side).

    Ties are broken by the remaining columns, so the result does not depend on row order.
    """
    values = list(values or [c for c in df.columns if c not in keys and c != order])
    newest = F.max(F.struct(F.col(f"`{order}`"), *[F.col(f"`{c}`") for c in values])).alias("_r")
    keyed = df.filter(F.col(f"`{order}`").isNotNull()).groupBy(*keys).agg(newest)
    return keyed.select(*keys, *[F.col("_r")[c].alias(c) for c in [order, *values]])


def latest_vs_target(
    df: DataFrame, keys: Sequence[str] = ("department", "kpi_id"), month: str = "month",
    actual: str = "actual_value", target: str = "target_value",
) -> DataFrame:
    """Metric cards: newest month per KPI with actual, target and their difference."""
    newest = latest(df, keys, month, [actual, target])
    return target_deviation(newest.withColumn("delta", F.col(actual) - F.col(target)), actual, target)


def trend_line(df: DataFrame, kpi_id: str, month: str = "month", kpi: str = "kpi_id") -> DataFrame:
    """One KPI over time, in month order."""
    return df.filter(F.col(kpi) == kpi_id).orderBy(month)


def target_status(df: DataFrame, flag: str = "on_target", by: Sequence[str] = ()) -> DataFrame:
    """Metric rows on and below target."""
    return df.groupBy(*by).agg(
        count_where(F.col(flag)).alias("reached"), count_where(~F.col(flag)).alias("missed")
    )

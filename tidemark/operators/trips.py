"""Trip-style records: derived columns, volumes, demand and quality shares."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import count_where, duration_minutes, month_name, percent
from tidemark.operators.cleaning import keep_within
from tidemark.operators.quantiles import is_small, quantiles

# The plausible open ranges of a trip.
PLAUSIBLE = {"trip_duration_min": (0, 180), "trip_distance": (0, 100), "total_amount": (0, 300)}


def with_trip_features(
    df: DataFrame, pickup: str = "tpep_pickup_datetime", dropoff: str = "tpep_dropoff_datetime"
) -> DataFrame:
    """Duration in minutes, calendar parts of the pick-up, and quality marks; keeps every row."""
    out = df.withColumns(
        {
            "trip_duration_min": duration_minutes(F.col(pickup), F.col(dropoff)),
            "pickup_month": F.month(pickup),
            "pickup_quarter": F.quarter(pickup),
            "pickup_hour": F.hour(pickup),
            "zero_distance": F.coalesce(F.col("trip_distance") == 0, F.lit(False)),
        }
    )
    return out.withColumn("invalid_time", F.coalesce(F.col("trip_duration_min") <= 0, F.lit(False)))


def plausible(df: DataFrame, limits: Mapping[str, tuple[float, float]] = PLAUSIBLE) -> DataFrame:
    return keep_within(df, limits)


def volume_by(df: DataFrame, part: str = "pickup_hour") -> DataFrame:
    """Trips per calendar part; months also get their short name."""
    out = df.filter(F.col(part).isNotNull()).groupBy(part).agg(F.count(F.lit(1)).alias("trip_count"))
    return out.withColumn("month_name", month_name(F.col(part))) if part == "pickup_month" else out


def fare_by_quarter(df: DataFrame, amount: str = "total_amount") -> DataFrame:
    """Mean amount per quarter of the pick-up."""
    return (
        df.filter(F.col("pickup_quarter").isNotNull())
        .groupBy(F.col("pickup_quarter").alias("Quarter"))
        .agg(F.avg(amount).alias("Avg_Total_Amount"))
    )


def demand(df: DataFrame, pickup: str = "tpep_pickup_datetime") -> DataFrame:
    """Trips per day type (weekday or weekend) and hour."""
    day_type = F.when(F.weekday(F.col(pickup)) >= 5, "weekend").otherwise("weekday")
    return (
        df.filter(F.col(pickup).isNotNull())
        .groupBy(day_type.alias("day_type"), F.hour(pickup).alias("hour"))
        .agg(F.count(F.lit(1)).alias("trips"))
    )


def peak_hours(demand_table: DataFrame) -> DataFrame:
    """Busiest hour per day type; among equals the earliest."""
    return demand_table.groupBy("day_type").agg(
        F.max_by("hour", F.struct(F.col("trips"), -F.col("hour"))).alias("peak_hour"),
        F.max("trips").alias("trips"),
    )


def zero_distance_share(df: DataFrame, distance: str = "trip_distance", amount: str = "total_amount") -> DataFrame:
    """One row: trips without distance that were charged, and their share."""
    return df.agg(
        F.count(F.lit(1)).alias("trips"),
        count_where((F.col(distance) == 0) & (F.col(amount) != 0)).alias("zero_distance_charged"),
    ).withColumn("pct", percent(F.col("zero_distance_charged"), F.col("trips")))


def medians(df: DataFrame, columns: tuple[str, ...] = ("trip_duration_min", "trip_distance", "total_amount"), method: str = "auto") -> DataFrame:
    """Median per column as rows (column, median)."""
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    if method == "auto":
        method = "inline" if is_small(values) else "radix"
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("v")) for c in columns]
    long = values.select(F.inline(F.array(*pairs)))
    return quantiles(long, "v", [0.5], by=["column"], names=["median"], method=method, bounded_groups=True)


def quality_by(df: DataFrame, key: str, **checks: Column) -> DataFrame:
    """Per value of ``key``: rows and, for each named condition, the share of rows meeting it in percent."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            *[percent(count_where(c), F.count(F.lit(1))).alias(f"{n}_pct") for n, c in checks.items()],
        )
    )


def mean_by(df: DataFrame, value: str, *keys: str, digits: int = 2) -> DataFrame:
    """Mean of a measure per group, e.g. tip by payment type and hour."""
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    return df.groupBy(*keys).agg(F.count(value).alias("rows"), F.round(F.avg(value), digits).alias(f"avg_{value}"))


def largest(df: DataFrame, measure: str, columns: tuple[str, ...], k: int = 5, tie_break: tuple[str, ...] = ()) -> DataFrame:
    """The k rows with the greatest ``measure``, projected to ``columns``."""
    return (
        df.filter(F.col(measure).isNotNull()).orderBy(F.desc(measure), *[F.col(c) for c in tie_break]).limit(k).select(*columns)
    )


def amount_by_distance(df: DataFrame, distance_step: float = 1.0, amount_step: float = 5.0) -> DataFrame:
    """Chart table: trips per distance and amount bucket, with the zero-distance mark."""
    bucket = lambda c, step: (F.floor(F.col(c) / step) * step)
    return (
        df.filter(F.col("trip_distance").isNotNull() & F.col("total_amount").isNotNull())
        .groupBy(
            "zero_distance",
            bucket("trip_distance", distance_step).alias("distance_from"),
            bucket("total_amount", amount_step).alias("amount_from"),
        )
        .agg(F.count(F.lit(1)).alias("trips"))
    )

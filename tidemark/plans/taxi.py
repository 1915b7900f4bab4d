"""Taxi trips: profile, durations, volumes, outliers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import anomaly, statistics, trips
from tidemark.operators.cleaning import parse_dates
from tidemark.sources.checkpoints import store
from tidemark.sources.schemas import TRIP_TIME_FORMATS

PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"


def typed(raw: DataFrame) -> DataFrame:
    text = [c for c in (PICKUP, DROPOFF) if dict(raw.dtypes)[c] == "string"]
    return parse_dates(raw, text, TRIP_TIME_FORMATS) if text else raw


def results(raw: DataFrame) -> dict[str, DataFrame]:
    """All result tables of the job by name. Volumes and outliers use all trips, box plot and fares plausible ones."""
    # Read by every table below, and parsed from text: written once.
    all_trips = store(trips.with_trip_features(typed(raw)), "trips")
    good = trips.plausible(all_trips)
    demand = trips.demand(all_trips)
    tables = {
        "shape": statistics.shape(raw),
        "column_types": statistics.column_types(raw),
        "preview": statistics.preview(raw),
        "null_counts": statistics.completeness(raw),
        "describe": statistics.describe(raw),
        "duration_box": statistics.box_plot(good, "trip_duration_min"),
        "monthly_volume": trips.volume_by(all_trips, "pickup_month"),
        "quarterly_fare": trips.fare_by_quarter(good),
        "hourly_volume": trips.volume_by(all_trips, "pickup_hour"),
        "demand": demand,
        "peak_hours": trips.peak_hours(demand),
        "duration_outliers": anomaly.fence_summary(all_trips, "trip_duration_min"),
        "longest_trips": trips.largest(
            all_trips, "trip_duration_min", (PICKUP, "trip_duration_min", "trip_distance", "total_amount"), tie_break=(PICKUP,)
        ),
        "dearest_trips": trips.largest(
            all_trips, "total_amount", (PICKUP, "trip_distance", "total_amount", "payment_type"), tie_break=(PICKUP,)
        ),
        "payment_shares": statistics.value_shares(all_trips, "payment_type"),
        "zero_distance": trips.zero_distance_share(all_trips),
        "medians": trips.medians(all_trips),
        "amount_by_distance": trips.amount_by_distance(all_trips),
    }
    return tables | follow_ups(all_trips)


def follow_ups(all_trips: DataFrame) -> dict[str, DataFrame]:
    """Tables by pick-up zone, vendor and payment type, of those columns the file has."""
    has = set(all_trips.columns)
    tables = {}
    if "PULocationID" in has:
        tables["outliers_by_zone"] = anomaly.fence_summary_by(all_trips, "trip_duration_min", "PULocationID")
    if "VendorID" in has:
        tables["quality_by_vendor"] = trips.quality_by(
            all_trips, "VendorID", zero_distance=F.col("zero_distance"), invalid_time=F.col("invalid_time")
        )
    if {"tip_amount", "payment_type"} <= has:
        tables["tip_by_payment_and_hour"] = trips.mean_by(all_trips, "tip_amount", "payment_type", "pickup_hour")
    return tables

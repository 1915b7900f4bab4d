"""Trip queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import anomaly, statistics, trips
from tidemark.workload import tables as t
from tidemark.workload.base import Query, rounded


def all_trips(spark, folder):
    return trips.with_trip_features(t.trips(spark, folder))


def good_trips(spark, folder):
    return trips.plausible(all_trips(spark, folder))


def trip_features(spark, folder):
    return rounded(
        all_trips(spark, folder).select(
            "event_id", "trip_duration_min", "pickup_month", "pickup_quarter", "pickup_hour", "zero_distance", "invalid_time"
        )
    )


def plausible_trips(spark, folder):
    return rounded(good_trips(spark, folder).select("event_id", "trip_duration_min", "trip_distance", "total_amount"))


def duration_box(spark, folder):
    return rounded(statistics.box_plot(good_trips(spark, folder), "trip_duration_min"))


def volume_by_month(spark, folder):
    return trips.volume_by(all_trips(spark, folder), "pickup_month")


def volume_by_hour(spark, folder):
    return trips.volume_by(all_trips(spark, folder), "pickup_hour")


def fare_by_quarter(spark, folder):
    return rounded(trips.fare_by_quarter(good_trips(spark, folder)))


def duration_outliers(spark, folder):
    return rounded(anomaly.fence_summary(all_trips(spark, folder), "trip_duration_min"))


def longest_trips(spark, folder):
    columns = ("event_id", "trip_duration_min", "trip_distance", "total_amount")
    return rounded(trips.largest(all_trips(spark, folder), "trip_duration_min", columns, tie_break=("event_id",)))


def dearest_trips(spark, folder):
    columns = ("event_id", "trip_distance", "total_amount", "payment_type")
    return rounded(trips.largest(all_trips(spark, folder), "total_amount", columns, tie_break=("event_id",)))


def payment_share(spark, folder):
    return statistics.value_shares(all_trips(spark, folder), "payment_type")


def zero_distance_share(spark, folder):
    return trips.zero_distance_share(all_trips(spark, folder))


def demand(spark, folder):
    return trips.demand(all_trips(spark, folder))


def peak_hours(spark, folder):
    return trips.peak_hours(trips.demand(all_trips(spark, folder)))


def trip_medians(spark, folder):
    return rounded(trips.medians(all_trips(spark, folder)))


def outliers_by_zone(spark, folder):
    return rounded(anomaly.fence_summary_by(all_trips(spark, folder), "trip_duration_min", "PULocationID"))


def quality_by_payment(spark, folder):
    return trips.quality_by(
        all_trips(spark, folder), "payment_type", zero_distance=F.col("zero_distance"), invalid_time=F.col("invalid_time")
    )


def amount_by_payment_and_hour(spark, folder):
    return trips.mean_by(all_trips(spark, folder), "total_amount", "payment_type", "pickup_hour")


def amount_by_distance(spark, folder):
    return rounded(trips.amount_by_distance(all_trips(spark, folder)))


QUERIES: dict[str, Query] = {
    "trip_features": Query(
        trip_features,
        f"""select event_id, round(duration, 4) as trip_duration_min, month(pickup)::int as pickup_month,
                   quarter(pickup)::int as pickup_quarter, hour(pickup)::int as pickup_hour,
                   distance = 0 as zero_distance, duration <= 0 as invalid_time from ({t.TRIPS})""",
    ),
    "plausible_trips": Query(
        plausible_trips,
        f"""select event_id, round(duration, 4) as trip_duration_min, round(distance, 4) as trip_distance,
                   round(amount, 4) as total_amount from ({t.PLAUSIBLE_TRIPS})""",
    ),
    "duration_box": Query(
        duration_box,
        f"""with v as (select duration as v from ({t.PLAUSIBLE_TRIPS})),
                 q as (select quantile_cont(v, 0.25) as q1, quantile_cont(v, 0.5) as q2, quantile_cont(v, 0.75) as q3 from v),
                 f as (select *, q1 - 1.5 * (q3 - q1) as lower, q3 + 1.5 * (q3 - q1) as upper from q)
            select count(*) as n, round(min(v), 4) as "min", round(max(v), 4) as "max", round(any_value(q1), 4) as q1,
                   round(any_value(q2), 4) as median, round(any_value(q3), 4) as q3,
                   round(least(min(v) filter (v >= lower), any_value(q1)), 4) as whisker_low,
                   round(greatest(max(v) filter (v <= upper), any_value(q3)), 4) as whisker_high,
                   count(*) filter (v < lower or v > upper) as fliers from v, f""",
    ),
    "volume_by_month": Query(
        volume_by_month,
        """select month(ts)::int as pickup_month, count(*) as trip_count, strftime(min(ts), '%b') as month_name from events group by 1""",
    ),
    "volume_by_hour": Query(
        volume_by_hour, "select hour(ts)::int as pickup_hour, count(*) as trip_count from events group by 1"
    ),
    "fare_by_quarter": Query(
        fare_by_quarter,
        f"""select quarter(pickup)::int as "Quarter", round(avg(amount), 4) as "Avg_Total_Amount" from ({t.PLAUSIBLE_TRIPS}) group by 1""",
    ),
    "duration_outliers": Query(
        duration_outliers,
        f"""with q as (select quantile_cont(duration, 0.25) as q1, quantile_cont(duration, 0.75) as q3 from ({t.TRIPS})),
                 f as (select *, q1 - 1.5 * (q3 - q1) as lower, q3 + 1.5 * (q3 - q1) as upper from q)
            select round(any_value(q1), 4) as q1, round(any_value(q3), 4) as q3, round(any_value(lower), 4) as lower,
                   round(any_value(upper), 4) as upper, count(*) as "rows",
                   count(*) filter (duration < lower or duration > upper) as outliers,
                   round(count(*) filter (duration < lower or duration > upper) / count(*)::double * 100, 2) as outlier_pct
            from ({t.TRIPS}), f""",
    ),
    "longest_trips": Query(
        longest_trips,
        f"""select event_id, round(duration, 4) as trip_duration_min, distance as trip_distance, amount as total_amount
            from ({t.TRIPS}) order by duration desc, event_id limit 5""",
    ),
    "dearest_trips": Query(
        dearest_trips,
        f"""select event_id, distance as trip_distance, amount as total_amount, payment_type
            from ({t.TRIPS}) order by amount desc, event_id limit 5""",
    ),
    "payment_share": Query(
        payment_share,
        """select event_type as payment_type, count(*) as "rows",
                  round(count(*) / (select count(*) from events)::double * 100, 2) as pct from events group by 1""",
    ),
    "zero_distance_share": Query(
        zero_distance_share,
        f"""select count(*) as trips, count(*) filter (distance = 0 and amount <> 0) as zero_distance_charged,
                   round(count(*) filter (distance = 0 and amount <> 0) / count(*)::double * 100, 2) as pct from ({t.TRIPS})""",
    ),
    "demand": Query(
        demand,
        """select case when isodow(ts) >= 6 then 'weekend' else 'weekday' end as day_type, hour(ts)::int as hour, count(*) as trips
           from events group by 1, 2""",
    ),
    "peak_hours": Query(
        peak_hours,
        """select day_type, hour as peak_hour, trips
           from (select *, row_number() over (partition by day_type order by trips desc, hour) as rn
                 from (select case when isodow(ts) >= 6 then 'weekend' else 'weekday' end as day_type, hour(ts)::int as hour,
                              count(*) as trips from events group by 1, 2)) where rn = 1""",
    ),
    "trip_medians": Query(
        trip_medians,
        f"""select 'trip_duration_min' as "column", round(quantile_cont(duration, 0.5), 4) as median from ({t.TRIPS})
            union all select 'trip_distance', round(quantile_cont(distance, 0.5), 4) from ({t.TRIPS})
            union all select 'total_amount', round(quantile_cont(amount, 0.5), 4) from ({t.TRIPS})""",
    ),
    "outliers_by_zone": Query(
        outliers_by_zone,
        f"""with q as (select quantile_cont(duration, 0.25) as q1, quantile_cont(duration, 0.75) as q3 from ({t.TRIPS})),
                 f as (select q1 - 1.5 * (q3 - q1) as lower, q3 + 1.5 * (q3 - q1) as upper from q)
            select zone as "PULocationID", count(*) as "rows", count(*) filter (duration < lower or duration > upper) as outliers,
                   round(count(*) filter (duration < lower or duration > upper) / count(*)::double * 100, 2) as outlier_pct
            from ({t.TRIPS}), f group by 1""",
    ),
    "quality_by_payment": Query(
        quality_by_payment,
        f"""select payment_type, count(*) as "rows", round(count(*) filter (distance = 0) / count(*)::double * 100, 2) as zero_distance_pct,
                   round(count(*) filter (duration <= 0) / count(*)::double * 100, 2) as invalid_time_pct from ({t.TRIPS}) group by 1""",
    ),
    "amount_by_payment_and_hour": Query(
        amount_by_payment_and_hour,
        f"""select payment_type, hour(pickup)::int as pickup_hour, count(amount) as "rows", round(avg(amount), 2) as avg_total_amount
            from ({t.TRIPS}) group by 1, 2""",
    ),
    "amount_by_distance": Query(
        amount_by_distance,
        f"""select distance = 0 as zero_distance, floor(distance) as distance_from, floor(amount / 5.0) * 5.0 as amount_from, count(*) as trips
            from ({t.TRIPS}) group by 1, 2, 3""",
    ),
}

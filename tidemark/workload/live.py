"""Streaming queries, run over everything that is there."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.sources.checkpoints import fresh_path
from tidemark.streaming import incremental, live
from tidemark.workload import tables as t
from tidemark.workload.base import SCHEMAS, Query, cents, rounded, sql_cents


def event_stream(spark, folder):
    # The pattern fits a table that is one file and one that is a folder.
    return live.read_stream(spark, f"{folder.rstrip('/')}/events.parquet*", SCHEMAS["events"])


def live_scores(spark, folder):
    history = t.transactions(spark, folder).withColumn("Amount_log", F.log1p("Amount"))
    statistics = live.frozen_statistics(history)
    rows = event_stream(spark, folder).select(
        "event_id",
        F.log1p("value").alias("Amount_log"),
        F.hour("ts").alias("Hour"),
        (F.get_json_object("props", "$.k").cast("double") - 50).alias("V1"),
        (F.minute("ts") - 30).cast("double").alias("V4"),
        (F.second("ts") - 30).cast("double").alias("V14"),
    )
    scored = live.run_available(live.score_stream(rows, statistics), "live-scores")
    return rounded(scored.select("event_id", "risk_score", "risk_level", "flagged"))


def live_kpi_alerts(spark, folder):
    """Daily windows, open ones included, against each type's target: the same rows for any files in any order."""
    events = live.with_event_time(event_stream(spark, folder), "ts")
    windows = live.windowed_totals(events, ["event_type"], "value", "1 day", scale=2)
    targets = t.kpi_metrics(spark, folder).select(F.col("kpi_id").alias("event_type"), "target_value").distinct()
    out = live.run_available(live.live_alerts(windows, targets, ["event_type"], 20.0), "live-alerts", mode="complete")
    return rounded(
        out.select(
            F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "rows", "actual_value", "target_value", "deviation_pct"
        )
    )


def timed_events(spark, folder):
    return event_stream(spark, folder).withColumn("event_time", F.col("ts").cast("timestamp"))


def live_totals(spark, folder):
    """Daily totals per type, merged micro-batch by micro-batch."""
    kept = incremental.Kept(fresh_path(spark, "live-totals"), ("event_type",), "value")
    incremental.run_available(timed_events(spark, folder), incremental.merge_totals(kept), kept.at("checkpoint"))
    found = incremental.totals(spark, kept).drop("window_end").withColumn("mean_value", cents(F.col("mean_value")))
    return rounded(found.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "*").drop("window_start"))


def live_sessions(spark, folder):
    """Sessions of each user: events at most a day apart."""
    kept = incremental.Kept(fresh_path(spark, "live-sessions"), ("user_id",), "value")
    incremental.run_available(timed_events(spark, folder), incremental.merge_sessions(kept, "1 day"), kept.at("checkpoint"))
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return rounded(incremental.sessions(spark, kept, "1 day").select("user_id", text("session_start"), text("session_end"), "rows", "actual_value"))


QUERIES: dict[str, Query] = {
    "live_scores": Query(
        live_scores,
        """with e as (select event_id, ln(1 + value) as a, hour(ts) as h, json_extract_string(props, '$.k')::double - 50 as v1,
                             minute(ts) - 30 as v4, second(ts) - 30 as v14 from events),
                s as (select min(a) as lo, max(a) as hi, max(abs(v1)) as m1, max(abs(v4)) as m4, max(abs(v14)) as m14 from e),
                r as (select event_id, (a - lo) / (hi - lo) * 40 + case when h <= 4 or h >= 22 then 20 else 0 end
                        + abs(v1) / m1 * 15 + abs(v4) / m4::double * 15 + abs(v14) / m14::double * 10 as score from e, s)
           select event_id, round(score, 4) as risk_score, score >= 70 as flagged,
                  case when score <= 40 then 'Low' when score <= 70 then 'Medium' else 'High' end as risk_level from r""",
    ),
    "live_kpi_alerts": Query(
        live_kpi_alerts,
        f"""select "month" as day, kpi_id as event_type, "rows", actual_value, target_value,
                   round(abs(actual_value - target_value) / target_value * 100, 4) as deviation_pct
            from ({t.KPI_METRICS}) k
            join (select strftime(ts, '%Y-%m-%d') as d, event_type as e, count(*) as "rows" from events group by 1, 2) c
              on c.d = k."month" and c.e = k.kpi_id
            where abs(actual_value - target_value) / target_value * 100 > 20""",
    ),
    "live_totals": Query(
        live_totals,
        """select strftime(ts, '%Y-%m-%d') as day, event_type, count(*) as "rows", sum(round(value * 100)::decimal(38,0))::double / 100 as actual_value,
                  {mean} as mean_value, round(min(value), 4) as min_value, round(max(value), 4) as max_value
           from events where ts is not null group by 1, 2""".format(mean=sql_cents("sum(round(value * 100)::decimal(38,0))::double / 100 / count(value)")),
    ),
    "live_sessions": Query(
        live_sessions,
        """with marked as (select *, coalesce(ts > lag(ts) over (partition by user_id order by ts) + interval 1 day, true)::int as b from events where ts is not null),
                islands as (select *, sum(b) over (partition by user_id order by ts rows unbounded preceding) as i from marked)
           select user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') as session_start, strftime(max(ts) + interval 1 day, '%Y-%m-%d %H:%M:%S') as session_end,
                  count(*) as "rows", sum(round(value * 100)::decimal(38,0))::double / 100 as actual_value
           from islands group by user_id, i""",
    ),
}

"""Anomaly flag, risk score and evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import anomaly
from tidemark.operators.statistics import histogram, scalar_quantiles, value_shares
from tidemark.plans import fraud
from tidemark.workload import tables as t
from tidemark.workload.base import Query, read_table, rounded


def scored(spark, folder):
    return fraud.score(fraud.clean(t.transactions(spark, folder)))


def event_amounts(spark, folder):
    return read_table(spark, folder, "events").select(
        "event_id", "event_type", "user_id", F.col("value").alias("Amount"), F.log1p("value").alias("Amount_log")
    )


def zscore_flags(spark, folder):
    flagged = anomaly.flag_zscore(event_amounts(spark, folder), "Amount_log").filter("zscore_flag")
    return rounded(flagged.select("event_id", "Amount"))


def percentile_flags(spark, folder):
    flagged = anomaly.flag_percentile(event_amounts(spark, folder)).filter("iqr_flag")
    return rounded(flagged.select("event_id", "Amount"))


def scaled_columns(spark, folder):
    out = anomaly.standard_scale(event_amounts(spark, folder), {"scaled": "Amount", "log_scaled": "Amount_log"})
    return rounded(out.select("event_id", "scaled", "log_scaled"))


def risk_scores(spark, folder):
    return rounded(scored(spark, folder).select("Amount", "Hour", "V1", "V4", "V14", "risk_score", "risk_level"))


def flagged_transactions(spark, folder):
    return rounded(fraud.flagged_export(scored(spark, folder)))


def risk_summary(spark, folder):
    return anomaly.risk_summary(scored(spark, folder))


def detection_metrics(spark, folder):
    return rounded(anomaly.detection_metrics(scored(spark, folder)))


def class_balance(spark, folder):
    return anomaly.class_balance(fraud.distinct_transactions(t.transactions(spark, folder)))


def flag_counts(spark, folder):
    return anomaly.flag_counts(scored(spark, folder))


def score_histogram(spark, folder):
    return rounded(histogram(scored(spark, folder), "risk_score", 50).select("bin", "lower", "rows"), 3)


def amount_by_hour(spark, folder):
    return rounded(anomaly.amount_by_hour(scored(spark, folder)), 3)


def fraud_cleaning_summary(spark, folder):
    return fraud.cleaning_summary(t.transactions(spark, folder))


def activity_score(spark, folder):
    e = read_table(spark, folder, "events").select(
        "event_id",
        F.col("value").alias("amount"),
        F.hour("ts").alias("hour"),
        F.get_json_object("props", "$.k").cast("int").alias("frequency_per_day"),
        F.when(F.col("event_type") == "error", "international")
        .when(F.col("event_type") == "click", "online")
        .when(F.col("event_type") == "view", "ATM")
        .otherwise("POS")
        .alias("type"),
    )
    out = anomaly.risk_level(anomaly.risk_score(e, anomaly.ACTIVITY_COMPONENTS))
    return rounded(out.select("event_id", "risk_score", "risk_level"))


def fence_outliers(spark, folder):
    rows = anomaly.fence_outliers(event_amounts(spark, folder), "Amount")
    return rounded(rows.select("event_id", "Amount"))


def fence_summary(spark, folder):
    return rounded(anomaly.fence_summary(event_amounts(spark, folder), "Amount"))


def outliers_by_user(spark, folder):
    return rounded(anomaly.fence_summary_by(event_amounts(spark, folder), "Amount", "user_id"))


def sigma_outliers(spark, folder):
    e = event_amounts(spark, folder)
    return rounded(e.filter(anomaly.sigma_outliers(e, "Amount")).select("event_id", "Amount"))


def price_quantiles(spark, folder):
    """The quantile operator on line prices by its exact way for large inputs."""
    li = read_table(spark, folder, "lineitem")
    fractions = [0.01, 0.25, 0.5, 0.75, 0.99]
    q = scalar_quantiles(li, "l_extendedprice", fractions, method="radix")
    out = li.agg(F.count(F.lit(1)).alias("rows")).withColumn("q", q)
    return rounded(out.select("rows", *[F.col("q")[i].alias(f"p{int(f * 100):02d}") for i, f in enumerate(fractions)]))


def event_shares(spark, folder):
    return value_shares(read_table(spark, folder, "events"), "event_type")


EVENT_FENCES = """
  select *, q1 - 1.5 * (q3 - q1) as lower, q3 + 1.5 * (q3 - q1) as upper
  from (select quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3 from events)
"""
EXPORT = """"Amount", "Hour", "V1", "V4", "V14", round(risk_score, 4) as risk_score, risk_level, zscore_flag, iqr_flag, "Class" """

QUERIES: dict[str, Query] = {
    "zscore_flags": Query(
        zscore_flags,
        """select event_id, round(value, 4) as "Amount" from events,
             (select avg(ln(1 + value)) as mu, stddev_pop(ln(1 + value)) as sd from events)
           where abs(ln(1 + value) - mu) > 2.5 * sd""",
    ),
    "percentile_flags": Query(
        percentile_flags,
        """select event_id, round(value, 4) as "Amount" from events
           where value > (select quantile_cont(value, 0.99) from events)""",
    ),
    "scaled_columns": Query(
        scaled_columns,
        """select event_id, round((value - m1) / s1, 4) as scaled, round((ln(1 + value) - m2) / s2, 4) as log_scaled
           from events, (select avg(value) as m1, stddev_pop(value) as s1, avg(ln(1 + value)) as m2,
                                stddev_pop(ln(1 + value)) as s2 from events)""",
    ),
    "risk_scores": Query(
        risk_scores,
        f"""select "Amount", "Hour", "V1", "V4", "V14", round(risk_score, 4) as risk_score, risk_level from ({t.SCORED})""",
    ),
    "flagged_transactions": Query(flagged_transactions, f"select {EXPORT} from ({t.SCORED}) where flagged"),
    "risk_summary": Query(
        risk_summary,
        f"""select count(*) as total, count(*) filter (flagged) as flagged, count(*) filter (risk_level = 'High') as high,
                   count(*) filter (risk_level = 'Medium') as medium, count(*) filter (risk_level = 'Low') as low,
                   round(count(*) filter (flagged) / count(*)::double * 100, 2) as flagged_pct from ({t.SCORED})""",
    ),
    "detection_metrics": Query(
        detection_metrics,
        f"""select tp as true_positives, fp as false_positives, fn as false_negatives,
                   round(case when tp + fp > 0 then tp / (tp + fp)::double else 0 end, 4) as "precision",
                   round(case when tp + fn > 0 then tp / (tp + fn)::double else 0 end, 4) as recall
            from (select count(*) filter (flagged and "Class" = 1) as tp, count(*) filter (flagged and "Class" = 0) as fp,
                         count(*) filter (not flagged and "Class" = 1) as fn from ({t.SCORED}))""",
    ),
    "class_balance": Query(
        class_balance,
        f"""select n as "rows", p as positive, round(p / n::double * 100, 2) as positive_pct, n - p as negative,
                   round((n - p) / n::double * 100, 2) as negative_pct
            from (select count(*) as n, count(*) filter ("Class" = 1) as p from ({t.TRANSACTIONS}))""",
    ),
    "flag_counts": Query(
        flag_counts,
        f"""select 'Normal' as class, count(*) filter (not flagged) as "rows" from ({t.SCORED})
            union all select 'Flagged', count(*) filter (flagged) from ({t.SCORED})""",
    ),
    "score_histogram": Query(
        score_histogram,
        f"""with v as (select risk_score as v from ({t.SCORED})), r as (select min(v) as lo, max(v) as hi from v),
                 c as (select least(49, floor((v - lo) / (hi - lo) * 50))::int as bin, count(*) as n from v, r group by 1)
            select b.i::int as bin, round(lo + b.i * ((hi - lo) / 50), 3) as lower, coalesce(n, 0) as "rows"
            from range(50) b(i) cross join r left join c on c.bin = b.i""",
    ),
    "amount_by_hour": Query(
        amount_by_hour,
        f"""select "Hour" as hour, floor("Amount" / 50) * 50 as amount_from, count(*) as "rows", round(avg(risk_score), 3) as avg_score
            from ({t.SCORED}) group by 1, 2""",
    ),
    "fraud_cleaning_summary": Query(
        fraud_cleaning_summary,
        f"""select * from (values (0, 'loaded', (select count(*) from events)), (1, 'missing values', 0),
               (2, 'duplicates', (select count(*) from events) - (select count(*) from ({t.TRANSACTIONS}))),
               (3, 'kept', (select count(*) from ({t.TRANSACTIONS})))) v(step, name, "rows")""",
    ),
    "activity_score": Query(
        activity_score,
        """with e as (select event_id, value, hour(ts) as h, json_extract_string(props, '$.k')::int as k, event_type from events),
                s as (select min(value) as v0, max(value) as v1, min(k) as k0, max(k) as k1 from e),
                r as (select event_id, (value - v0) / (v1 - v0) * 40 + (k - k0) / (k1 - k0)::double * 25
                        + case event_type when 'error' then 20 when 'click' then 10 when 'view' then 5 else 0 end
                        + case when h <= 4 or h >= 22 then 15 else 0 end as score from e, s)
           select event_id, round(score, 4) as risk_score,
                  case when score <= 40 then 'Low' when score <= 70 then 'Medium' else 'High' end as risk_level from r""",
    ),
    "fence_outliers": Query(
        fence_outliers,
        f"""select event_id, round(value, 4) as "Amount" from events, ({EVENT_FENCES}) where value < lower or value > upper""",
    ),
    "fence_summary": Query(
        fence_summary,
        f"""select round(any_value(q1), 4) as q1, round(any_value(q3), 4) as q3, round(any_value(lower), 4) as lower,
                   round(any_value(upper), 4) as upper, count(*) as "rows",
                   count(*) filter (value < lower or value > upper) as outliers,
                   round(count(*) filter (value < lower or value > upper) / count(*)::double * 100, 2) as outlier_pct
            from events, ({EVENT_FENCES})""",
    ),
    "outliers_by_user": Query(
        outliers_by_user,
        f"""select user_id, count(*) as "rows", count(*) filter (value < lower or value > upper) as outliers,
                   round(count(*) filter (value < lower or value > upper) / count(*)::double * 100, 2) as outlier_pct
            from events, ({EVENT_FENCES}) group by 1""",
    ),
    "sigma_outliers": Query(
        sigma_outliers,
        """select event_id, round(value, 4) as "Amount" from events,
             (select avg(value) as mu, stddev_samp(value) as sd from events) where abs(value - mu) > 3 * sd""",
    ),
    "price_quantiles": Query(
        price_quantiles,
        """select count(*) as "rows", """
        + ", ".join(f"round(quantile_cont(l_extendedprice, 0.{p}), 4) as p{p}" for p in ("01", "25", "50", "75", "99"))
        + " from lineitem",
    ),
    "event_shares": Query(
        event_shares,
        """select event_type, count(*) as "rows", round(count(*) / (select count(*) from events)::double * 100, 2) as pct
           from events group by 1""",
    ),
}

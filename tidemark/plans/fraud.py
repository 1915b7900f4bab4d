"""Card transactions: clean, flag, score, evaluate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import hour_of_elapsed, log_amount, show_count, show_percent
from tidemark.operators import anomaly
from tidemark.operators.statistics import histogram
from tidemark.sources.checkpoints import store
from tidemark.operators.cleaning import drop_duplicates, drop_missing, duplicate_rows, keep_existing, unexpected_values

# The labels, and the header of the export.
LABELS = (0, 1)
EXPORT_COLUMNS = (
    "Amount",
    "Hour",
    "V1",
    "V4",
    "V14",
    "risk_score",
    "risk_level",
    "zscore_flag",
    "iqr_flag",
    "Class",
)


def distinct_transactions(raw: DataFrame) -> DataFrame:
    """Complete transactions, each once."""
    return drop_duplicates(drop_missing(raw))


def clean(raw: DataFrame) -> DataFrame:
    """Complete, distinct transactions with log amount, hour of day and standardised columns.

    The distinct rows are written once: the statistics passes and the scoring pass all read them, and
    de-duplication shuffles the whole table.
    """
    rows = store(distinct_transactions(raw), "transactions")
    rows = rows.withColumns(
        {"Amount_log": log_amount(F.col("Amount")), "Hour": hour_of_elapsed(F.col("Time"))}
    )
    return anomaly.standard_scale(rows, {"Amount_log_scaled": "Amount_log", "Time_scaled": "Time"}).drop("Time")


def cleaning_summary(raw: DataFrame) -> DataFrame:
    """Rows loaded, with NULLs, duplicated, kept (long table)."""
    complete = drop_missing(raw)
    counts = duplicate_rows(complete)
    loaded = raw.agg(F.count(F.lit(1)).alias("n")).scalar()
    rows = [
        F.struct(F.lit(i).alias("step"), F.lit(n).alias("name"), c.cast("bigint").alias("rows"))
        for i, (n, c) in enumerate(
            [
                ("loaded", loaded),
                ("missing values", loaded - F.col("rows")),
                ("duplicates", F.col("removed")),
                ("kept", F.col("distinct_rows")),
            ]
        )
    ]
    return counts.select(F.inline(F.array(*rows)))


def score(transactions: DataFrame, method: str = "auto") -> DataFrame:
    """Cleaned transactions with both flags, the risk score, its level and the combined flag.

    The z-score of a standardised column is that of the column itself, so the flag reads the log amount.
    """
    out = anomaly.flag_zscore(transactions, "Amount_log")
    out = anomaly.flag_percentile(out, "Amount", method=method)
    out = anomaly.risk_score(out)
    return anomaly.combine_flags(anomaly.risk_level(out))


def flagged_export(scored: DataFrame) -> DataFrame:
    """Flagged transactions, highest score first."""
    flagged = keep_existing(scored.filter("flagged"), EXPORT_COLUMNS)
    return flagged.orderBy(F.desc("risk_score"), *[F.col(c) for c in flagged.columns if c != "risk_score"])


def summary_lines(scored: DataFrame) -> DataFrame:
    """Summary of a scored table as text lines (line_no, line)."""
    one = anomaly.risk_summary(scored)
    metrics = anomaly.detection_metrics(scored) if "Class" in scored.columns else None
    parts = [
        ("Total transactions", show_count(F.col("total"))),
        ("Flagged", F.concat(show_count(F.col("flagged")), F.lit(" ("), show_percent(F.col("flagged_pct")), F.lit(")"))),
        ("High risk (above 70)", show_count(F.col("high"))),
        ("Medium risk (above 40)", show_count(F.col("medium"))),
        ("Low risk", show_count(F.col("low"))),
    ]
    if metrics is not None:
        one = one.withColumn("m", metrics.select(F.struct(*metrics.columns)).scalar())
        parts += [
            ("True positives", show_count(F.col("m.true_positives"))),
            ("False positives", show_count(F.col("m.false_positives"))),
            ("False negatives", show_count(F.col("m.false_negatives"))),
            ("Precision", show_percent(F.col("m.precision") * 100)),
            ("Recall", show_percent(F.col("m.recall") * 100)),
        ]
    lines = F.array(*[F.concat(F.lit(f"{name}: "), value) for name, value in parts])
    return one.select(F.posexplode(lines).alias("line_no", "line"))


def results(raw: DataFrame) -> dict[str, DataFrame]:
    """All result tables of the job by name."""
    scored = store(score(clean(raw)), "scored-transactions")
    return {
        "cleaning_summary": cleaning_summary(raw),
        "class_balance": anomaly.class_balance(scored),
        "unexpected_labels": unexpected_values(raw, "Class", LABELS),
        "flagged_transactions": flagged_export(scored),
        "summary": summary_lines(scored),
        "risk_summary": anomaly.risk_summary(scored),
        "detection_metrics": anomaly.detection_metrics(scored),
        "risk_score_histogram": histogram(scored, "risk_score", 50),
        "flagged_vs_normal": anomaly.flag_counts(scored),
        "amount_vs_hour": anomaly.amount_by_hour(scored),
    }

"""Payment activity: a rule score over amount, daily frequency, kind of transaction and hour."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators import anomaly
from tidemark.operators.cleaning import drop_duplicates, drop_missing
from tidemark.operators.statistics import value_shares
from tidemark.sources.checkpoints import store


def score(raw: DataFrame) -> DataFrame:
    """Complete, distinct transactions with score, level and flag."""
    rows = drop_duplicates(drop_missing(raw))
    scored = anomaly.risk_level(anomaly.risk_score(rows, anomaly.ACTIVITY_COMPONENTS))
    return anomaly.combine_flags(scored, flags=())


def results(raw: DataFrame) -> dict[str, DataFrame]:
    """All result tables of the job by name."""
    scored = store(score(raw), "scored-activity")
    tables = {
        "scores": scored,
        "risk_summary": anomaly.risk_summary(scored),
        "levels": value_shares(scored, "risk_level"),
    }
    if "is_fraud" in scored.columns:
        labelled = scored.withColumnRenamed("is_fraud", "Class")
        tables["detection_metrics"] = anomaly.detection_metrics(labelled)
    return tables

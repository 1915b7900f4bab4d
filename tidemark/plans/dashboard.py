"""KPI metric rows (one per month and KPI): filters, cards, alerts, trend lines and the on-target table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.operators import kpi


def results(
    metrics: DataFrame,
    departments: Sequence[str] | None = None,
    first_month: str | None = None,
    last_month: str | None = None,
    threshold: float = 15.0,
    lower_is_better: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """All result tables for a selection of departments and months, by name."""
    chosen = kpi.select_metrics(metrics, departments, first_month, last_month)
    marked = kpi.on_target(chosen, lower_is_better)
    return {
        "cards": kpi.latest_vs_target(chosen),
        "alerts": kpi.target_alerts(chosen, threshold),
        "trend": chosen.orderBy("department", "kpi_id", "month"),
        "on_target": marked,
        "status": kpi.target_status(marked, by=["department"]),
    }

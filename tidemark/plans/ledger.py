"""Financial records: ten rules with severities, rule report, score and grade."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import holds, is_iso_date, iso_date
from tidemark.operators import quality
from tidemark.operators.anomaly import sigma_outliers

# The domains of the record schema.
CURRENCIES = ("INR", "USD", "EUR", "GBP")
STATUSES = ("paid", "pending", "overdue")
REQUIRED = ("vendor_id", "amount", "currency")


def delivered_before(start: str = "date", end: str = "delivery_date") -> Column:
    """Violation: delivery not after the date. Rows whose dates are not both ISO days are not judged."""
    return holds(iso_date(F.col(end)) <= iso_date(F.col(start)))


def rules(
    records: DataFrame,
    vendors: DataFrame,
    vendor_key: str = "vendor_id",
    currencies: Sequence[str] = CURRENCIES,
    statuses: Sequence[str] = STATUSES,
) -> list[quality.Rule]:
    """The standard rule set for a table of financial records."""
    return [
        quality.RowRule("1. No nulls in required fields", "Critical", quality.any_missing(*REQUIRED)),
        quality.UniqueRule("2. No duplicate record_id", "Critical", ("record_id",)),
        quality.RowRule("3. Date format YYYY-MM-DD", "Major", ~is_iso_date(F.col("date"))),
        quality.RowRule("4. delivery_date after date", "Major", delivered_before()),
        quality.RowRule("5. amount > 0", "Critical", quality.not_positive("amount", null_breaks=True)),
        quality.RowRule("6. amount within 3 SD (outlier)", "Minor", sigma_outliers(records, "amount")),
        quality.RowRule(
            f"7. currency in {{{', '.join(currencies)}}}", "Major", quality.not_in("currency", currencies)
        ),
        quality.ReferenceRule("8. vendor_id in reference list", "Critical", "vendor_id", vendors, vendor_key),
        quality.RowRule(
            f"9. payment_status in {{{', '.join(statuses)}}}", "Major", quality.not_in("payment_status", statuses)
        ),
        quality.CompletenessRule("10. All columns ≥ 95% non-null", "Minor", 95.0),
    ]


def report(records: DataFrame, vendors: DataFrame, order_by: Sequence[str] = (), **options) -> DataFrame:
    """Rule report of financial records; ``order_by`` is the row order for the sample records."""
    return quality.run_rules(records, rules(records, vendors, **options), "record_id", order_by)


def results(records: DataFrame, vendors: DataFrame, order_by: Sequence[str] = ()) -> dict[str, DataFrame]:
    """All result tables of the job by name."""
    table = report(records, vendors, order_by)
    return {
        "integrity_report": table.drop("checked"),
        "integrity_score": quality.integrity_score(table),
        "violations_by_rule": table.select("rule", "violations"),
        "rule_status": quality.status_counts(table),
    }

"""Financials: clean money text, then ten checks and an issue report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import count_where, holds, parse_amount, relative_gap
from tidemark.operators.anomaly import sigma_outliers
from tidemark.operators.cleaning import (
    conversion_failures,
    drop_duplicates,
    duplicate_rows,
    parse_dates,
    strip_column_names,
    strip_values,
    unexpected_values,
    out_of_range,
)
from tidemark.operators.statistics import completeness
from tidemark.sources.checkpoints import store
from tidemark.sources.schemas import FINANCIAL_AMOUNTS

DATE_FORMATS = ("M/d/yyyy", "yyyy-MM-dd")
REQUIRED = ("Segment", "Country", "Product", "Units Sold", "Sales", "Profit", "Date")
SEGMENTS = ("Government", "Midmarket", "Channel Partners", "Enterprise", "Small Business")
LIMITS = {"Month Number": (1, 12), "Year": (2010, 2030)}
MIN_COMPLETE = 95.0


def typed(raw: DataFrame) -> DataFrame:
    """Stripped names and values, money text as numbers, the date parsed; duplicates still in."""
    rows = strip_values(strip_column_names(raw))
    text = {n for n, t in rows.dtypes if t == "string"}
    amounts = [c for c in FINANCIAL_AMOUNTS if c in text]
    if amounts:
        rows = rows.withColumns({c: parse_amount(F.col(f"`{c}`")) for c in amounts})
    if "Date" in text:
        rows = parse_dates(rows, ["Date"], DATE_FORMATS)
    return rows


def clean(raw: DataFrame) -> DataFrame:
    return drop_duplicates(typed(raw))


def amount_failures(raw: DataFrame) -> DataFrame:
    """Money texts per column that are no number."""
    rows = strip_values(strip_column_names(raw))
    return conversion_failures(rows, {c: parse_amount(F.col(f"`{c}`")) for c in FINANCIAL_AMOUNTS if c in rows.columns})


def validated(rows: DataFrame) -> DataFrame:
    """Cleaned rows with the recomputed gross sales and its relative gap."""
    out = rows.withColumn("calc_gross", F.col("`Units Sold`") * F.col("`Sale Price`"))
    return out.withColumn("gross_diff_pct", relative_gap(F.col("`Gross Sales`"), F.col("calc_gross")))


def _check(
    number: int, subject: str, violations: Column, message: Column, raises: bool, measure: Column | None = None
) -> Column:
    return F.struct(
        F.lit(number).alias("rule"),
        F.lit(subject).alias("subject"),
        violations.cast("bigint").alias("violations"),
        (measure if measure is not None else F.lit(None)).cast("double").alias("complete_pct"),
        F.lit(raises).alias("raises_issue"),
        message.alias("message"),
    )


def checks(rows: DataFrame, raw: DataFrame | None = None) -> DataFrame:
    """The ten checks with their counts: rule, subject, violations, status, message.

    Status is PASS or FAIL for the checks that raise issues (1, 4, 5, 6, 9, 10) and INFO for the counts
    that are only reported (2, 3, 7, 8). All counts come from one scan. The duplicate check (2) compares
    with the number of rows of ``raw``, the table before de-duplication, and is left out without it.
    """
    table = validated(rows)
    names = table.columns
    # The name of each issue check of a positive amount.
    positive = {4: "Units Sold", 5: "Sale Price", 6: "Sales", 9: "COGS"}
    aggregates = [F.count(F.lit(1)).alias("rows")]
    aggregates += [F.count(F.col(f"`{c}`")).alias(f"filled{i}") for i, c in enumerate(names)]
    aggregates += [count_where(F.col(f"`{c}`") <= 0).alias(f"low{n}") for n, c in positive.items() if c in names]
    aggregates.append(count_where(sigma_outliers(table, "Profit")).alias("sigma"))
    aggregates.append(count_where(F.col("gross_diff_pct") > 0.10).alias("gross"))
    wide = table.agg(*aggregates)
    if raw is not None:
        wide = wide.withColumn("surplus", raw.agg(F.count(F.lit(1)).alias("n")).scalar() - F.col("rows"))

    def nulls(column: str) -> Column:
        return F.col("rows") - F.col(f"filled{names.index(column)}")

    found = []
    for c in REQUIRED:
        if c in names:
            found.append(_check(1, c, nulls(c), F.format_string(f"Rule 1: %,d nulls in {c}", nulls(c)), True))
    if "Date" in names:
        found.append(_check(3, "Date", nulls("Date"), F.format_string("Rule 3: %,d dates not parsed", nulls("Date")), False))
    for n, c in positive.items():
        if c in names:
            bad = F.col(f"low{n}")
            found.append(_check(n, c, bad, F.format_string(f"Rule {n}: %,d rows with {c} <= 0", bad), True))
    found.append(_check(7, "Profit", F.col("sigma"), F.format_string("Rule 7: %,d values beyond 3 sigma", F.col("sigma")), False))
    found.append(
        _check(8, "Gross Sales", F.col("gross"), F.format_string("Rule 8: %,d rows off by more than 10%%", F.col("gross")), False)
    )
    for i, c in enumerate(names):
        pct = F.try_divide(F.col(f"filled{i}").cast("double"), F.col("rows").cast("double")) * 100
        low = holds(pct < MIN_COMPLETE).cast("bigint")
        found.append(_check(10, c, low, F.format_string(f"Rule 10: {c} only %.1f%%%% complete".replace("%%%%", "%%"), pct), True, pct))
    if raw is not None:
        bad = F.col("surplus")
        found.append(_check(2, "row", bad, F.format_string("Rule 2: %,d duplicate rows", bad), False))
    table_checks = wide.select(F.inline(F.array(*found)))
    status = (
        F.when(~F.col("raises_issue"), "INFO").when(F.col("violations") > 0, "FAIL").otherwise("PASS")
    )
    return table_checks.withColumn("status", status)


def issues(check_table: DataFrame) -> DataFrame:
    """Failed checks only: rule, subject, message."""
    return check_table.filter(F.col("status") == "FAIL").select("rule", "subject", "message")


def issue_report(check_table: DataFrame) -> DataFrame:
    """The issue report as text lines (line_no, line)."""
    failed = issues(check_table)
    found = failed.agg(
        F.array_sort(F.collect_list(F.struct("rule", "subject", "message"))).alias("items")
    )  # at most one item per check and column
    bullets = F.transform("items", lambda item: F.concat(F.lit("  • "), item["message"]))
    head = [F.lit("FINANCIAL DATA VALIDATION REPORT"), F.lit("=" * 60), F.lit("")]
    body = F.when(
        F.size("items") > 0,
        F.concat(F.array(F.format_string("ISSUES FOUND: %d", F.size("items"))), bullets),
    ).otherwise(F.array(F.lit("✓ ALL VALIDATION RULES PASSED")))
    return found.select(F.posexplode(F.concat(F.array(*head), body)).alias("line_no", "line"))


def overview(rows: DataFrame) -> DataFrame:
    """One row: rows, date range, segments, countries."""
    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("Date").cast("date").alias("first_date"),
        F.max("Date").cast("date").alias("last_date"),
        F.count_distinct("Segment").alias("segments"),
        F.count_distinct("Country").alias("countries"),
    )


def results(raw: DataFrame, segments: Sequence[str] = SEGMENTS) -> dict[str, DataFrame]:
    """All result tables of the job by name."""
    # The texts are parsed once; the rows are read by every table below, and de-duplicated at the cost of a shuffle of
    # all columns: both are written once.
    parsed = store(typed(raw), "financials-typed")
    rows = store(drop_duplicates(parsed), "financials")
    table = store(checks(rows, raw), "financial-checks")
    limits = {c: r for c, r in LIMITS.items() if c in rows.columns}
    return {
        "validated_financials": validated(rows),
        "amount_failures": amount_failures(raw),
        "duplicates": duplicate_rows(parsed),
        "out_of_range": out_of_range(rows, limits),
        "unexpected_segments": unexpected_values(rows, "Segment", segments),
        "completeness": completeness(rows),
        "overview": overview(rows),
        "checks": table,
        "validation_issues": issue_report(table),
    }

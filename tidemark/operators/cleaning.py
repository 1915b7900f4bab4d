"""Cleaning steps: naming, typing, de-duplication, filters, checks and the summary of what was removed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import POSITION, count_where, date_class, holds, parse_timestamp, strip
from tidemark.operators.statistics import melt, scalar_quantiles


# -- columns ---------------------------------------------------------------------------------------


def strip_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def strip_values(df: DataFrame) -> DataFrame:
    """Strip every string column, in one projection."""
    return df.select(
        *[
            strip(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def keep_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Project to those of the wanted columns that exist, in the wanted order."""
    return df.select(*[F.col(f"`{c}`") for c in wanted if c in df.columns])


def missing_columns(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    return [c for c in wanted if c not in df.columns]


def column_report(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """One row for each wanted column in the wanted order: its type, whether the table has it, rows with a value (one scan)."""
    kinds = dict(df.dtypes)
    wide = df.agg(
        *[F.lit(i).alias(f"position_{i}") for i in range(len(wanted))],
        *[F.lit(kinds.get(c)).cast("string").alias(f"type_{i}") for i, c in enumerate(wanted)],
        *[F.lit(c in kinds).alias(f"present_{i}") for i, c in enumerate(wanted)],
        *[F.count(F.col(f"`{c}`") if c in kinds else F.lit(None)).alias(f"filled_{i}") for i, c in enumerate(wanted)],
    )
    return melt(wide, wanted, ["position", "type", "present", "filled"])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def map_schema(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """Bring a table to a standard schema: target name -> source column name or expression."""
    return df.select(
        *[(F.col(f"`{src}`") if isinstance(src, str) else src).alias(target) for target, src in columns.items()]
    )


def fill_missing(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(v)) for c, v in values.items()})


def tag(df: DataFrame, **flags: Column) -> DataFrame:
    """Add boolean marks without dropping rows."""
    return df.withColumns(flags)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Boundary step for floating-point columns: from here on NULL is the only missing value."""
    marks = {
        f.name: F.when(~F.isnan(F.col(f"`{f.name}`")), F.col(f"`{f.name}`"))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(marks) if marks else df


# -- rows ------------------------------------------------------------------------------------------


def drop_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in any column, or in any column of ``subset``."""
    return df.na.drop("any", subset=list(subset) if subset else None)


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Keep one of each set of equal rows, the first if rows carry their position; NULLs compare as equal."""
    if POSITION not in df.columns:
        return df.dropDuplicates()
    others = [F.col(f"`{c}`") for c in df.columns if c != POSITION]
    found = df.groupBy(*others).agg(F.min(POSITION).alias(POSITION))
    return found.select(*[f"`{c}`" for c in df.columns])


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """Keep the first row per key in the given order (add a tie-break so that the order is total).

    ``POSITION`` orders by the place in the files that were read (see ``sources.read_delimited``), which is total.
    ``row_number() = 1`` lets Spark cut every key to one row per map task before the shuffle, so a key
    holding a large part of the table is reduced where it is read.
    """
    order = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") == 1).drop("_rank")


def keep_positive(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.filter(F.col(f"`{c}`") > 0)
    return df


def keep_within(df: DataFrame, limits: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Keep rows strictly inside every open interval."""
    for c, (low, high) in limits.items():
        df = df.filter((F.col(f"`{c}`") > low) & (F.col(f"`{c}`") < high))
    return df


# -- parsing with counted failures -------------------------------------------------------------------


def _date_classes(df: DataFrame, columns: Sequence[str], formats: Sequence[str]) -> DataFrame:
    """The dictionary of texts: number ``k`` of the column, class of texts, rows; merged within each map task."""
    entries = [
        F.struct(F.lit(k).alias("k"), date_class(F.col(f"`{c}`"), formats).alias("text")) for k, c in enumerate(columns)
    ]
    return df.select(F.inline(F.array(*entries))).groupBy("k", "text").agg(F.count(F.lit(1)).alias("n"))


def _unread(fmt: str) -> Column:
    """Rows of the dictionary's texts that a format cannot read."""
    return F.coalesce(F.sum(F.when(parse_timestamp(F.col("text"), fmt).isNull(), F.col("n"))), F.lit(0))


def format_failures(df: DataFrame, column: str, formats: Sequence[str]) -> DataFrame:
    """Per candidate date format: number and share of texts of ``column`` it cannot parse.

    Every class of texts is tried once, not every row.
    """
    wide = _date_classes(df, [column], formats).agg(
        *[F.coalesce(F.sum("n"), F.lit(0)).alias(f"rows_{i}") for i in range(len(formats))],
        *[_unread(f).alias(f"failures_{i}") for i, f in enumerate(formats)],
    )
    return melt(wide, formats, ["rows", "failures"]).withColumnRenamed("column", "format").withColumn(
        "failure_pct", F.try_divide(F.col("failures").cast("double"), F.col("rows").cast("double")) * 100
    )


def parse_dates(df: DataFrame, columns: Sequence[str], formats: Sequence[str], max_failure: float = 0.10) -> DataFrame:
    """Parse each text column with the first format that fails on less than ``max_failure`` of all rows.

    If none does, the format with the fewest failures is taken. Every format is tried on the raw text, and texts the
    chosen format cannot read become NULL. Formats are tried on the classes of texts of all columns, counted in one
    scan; the choice is one row inside the plan, and each row is parsed once, with the format chosen.
    """
    tried = _date_classes(df, columns, formats).groupBy("k").agg(
        F.sum("n").alias("rows"), F.array(*[_unread(f) for f in formats]).alias("failures")
    )
    passed = F.transform("failures", lambda f: f < F.col("rows") * F.lit(max_failure))
    first_good = F.array_position(passed, True)
    fewest = F.array_position("failures", F.array_min("failures"))
    choice = F.when(first_good > 0, first_good).otherwise(fewest).cast("int")
    # One entry a column.
    chosen = tried.select("k", choice.alias("c")).agg(F.map_from_entries(F.collect_list(F.struct("k", "c")))).scalar()
    parsed = {}
    for k, column in enumerate(columns):
        value = None
        for i, fmt in enumerate(formats, start=1):
            hit, attempt = F.col("_chosen")[k] == i, parse_timestamp(F.col(f"`{column}`"), fmt)
            value = F.when(hit, attempt) if value is None else value.when(hit, attempt)
        parsed[column] = value
    return df.withColumn("_chosen", chosen).withColumns(parsed).drop("_chosen")


def conversion_failures(df: DataFrame, parsers: Mapping[str, Column]) -> DataFrame:
    """Per column: values that its parser leaves NULL (missing ones included), in one scan."""
    names = list(parsers)
    wide = df.agg(
        *[F.count(F.lit(1)).alias(f"rows_{i}") for i in range(len(names))],
        *[F.count_if(parsers[n].isNull()).alias(f"failures_{i}") for i, n in enumerate(names)],
    )
    return melt(wide, names, ["rows", "failures"])


# -- checks ----------------------------------------------------------------------------------------


def unexpected_values(df: DataFrame, column: str, allowed: Sequence[object]) -> DataFrame:
    """Values outside the allow-list with their row counts; NULL is reported like any other value."""
    c = F.col(f"`{column}`")
    return (
        df.filter(~holds(c.isin(*allowed)))
        .groupBy(c.cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(column).alias("column"), "value", "rows")
    )


def same_domain(df: DataFrame, column: str, allowed: Sequence[object]) -> DataFrame:
    """One row: are the distinct values exactly the allowed set?"""
    c = F.col(f"`{column}`")
    found = [count_where(c == v).alias(f"v{i}") for i, v in enumerate(allowed)]
    other = F.count_if(~holds(c.isin(*allowed))).alias("other")
    ok = F.col("other") == 0
    for i in range(len(allowed)):
        ok = ok & (F.col(f"v{i}") > 0)
    return df.agg(*found, other).select(F.lit(column).alias("column"), ok.alias("matches"), F.col("other").alias("unexpected_rows"))


def out_of_range(df: DataFrame, limits: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Per column: rows outside the closed interval (NULL is not counted), in one scan."""
    names = list(limits)
    wide = df.agg(
        *[
            count_where((F.col(f"`{c}`") < limits[c][0]) | (F.col(f"`{c}`") > limits[c][1])).alias(f"violations_{i}")
            for i, c in enumerate(names)
        ]
    )
    return melt(wide, names, ["violations"])


def tail_counts(df: DataFrame, column: str, low: float = 0.01, high: float = 0.99, method: str = "auto") -> DataFrame:
    """One row: the two percentile cut-offs of a column and the rows beyond each."""
    q, c = F.col("_q"), F.col(f"`{column}`")
    return df.withColumn("_q", scalar_quantiles(df, column, [low, high], method=method)).agg(
        F.any_value("_q").alias("_q"),
        count_where(c < q[0]).alias("below"),
        count_where(c > q[1]).alias("above"),
    ).select(q[0].alias("low_cut"), q[1].alias("high_cut"), "below", "above", (F.col("below") + F.col("above")).alias("extreme"))


# -- summary ---------------------------------------------------------------------------------------


def step_summary(df: DataFrame, steps: Sequence[tuple[str, Column]], loaded: str = "loaded") -> DataFrame:
    """Rows loaded, rows removed by each filter in turn, rows left: one scan instead of a count per step.

    ``steps`` are (name, condition a kept row fulfils) in the order in which the filters run.
    """
    alive = F.lit(True)
    aggregates = [F.count(F.lit(1)).alias("rows_0")]
    names = [loaded]
    for name, keep in steps:
        kept = holds(keep)
        aggregates.append(F.count_if(alive & ~kept).alias(f"rows_{len(names)}"))
        names.append(name)
        alive = alive & kept
    aggregates.append(F.count_if(alive).alias(f"rows_{len(names)}"))
    names.append("kept")
    wide = df.agg(*aggregates)
    rows = [
        F.struct(F.lit(i).alias("step"), F.lit(n).alias("name"), F.col(f"rows_{i}").alias("rows"))
        for i, n in enumerate(names)
    ]
    return wide.select(F.inline(F.array(*rows)))


def duplicate_rows(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row: rows, distinct rows (or keys) and surplus rows that de-duplication removes."""
    columns = [F.col(f"`{c}`") for c in (keys or df.columns)]
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct_rows")
    ).withColumn("removed", F.col("rows") - F.col("distinct_rows"))

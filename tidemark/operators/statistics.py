"""Whole-column statistics as scalar subqueries, and profile tables.

A statistic that every row needs (mean, deviation, range, cut-off) is a one-row aggregate used through
``DataFrame.scalar()``: Spark evaluates it once and folds the value into the generated row code, so no
join is planned and the row side is never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.quantiles import is_small, quantiles
from tidemark.sources.checkpoints import store


def scalar_stats(df: DataFrame, **aggregates: Column) -> Column:
    """All aggregates of ``df`` in one struct-valued scalar; read one with ``result["name"]``.

    Every use of the result is planned as a subquery of its own (and only then found to be the same), so
    a result used more than once is better put into a column first, see ``attach_stats``.
    """
    return df.agg(F.struct(*[c.alias(n) for n, c in aggregates.items()]).alias("s")).scalar()


def attach_stats(df: DataFrame, name: str = "_s", source: DataFrame | None = None, **aggregates: Column) -> DataFrame:
    """Add the statistics of ``source`` (default: ``df`` itself) as one struct column; drop it after use."""
    return df.withColumn(name, scalar_stats(df if source is None else source, **aggregates))


def scalar_quantiles(df: DataFrame, value: str, fractions: Sequence[float], **options) -> Column:
    """Quantiles as an array-valued scalar, in the order of ``fractions``."""
    names = [f"q{i}" for i in range(len(fractions))]
    table = quantiles(df, value, fractions, names=names, **options)
    return table.select(F.array(*names).alias("q")).scalar()


def shape(df: DataFrame) -> DataFrame:
    """Row and column count."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)).cast("bigint"))


def column_types(df: DataFrame) -> DataFrame:
    """One row per column with its type: the schema as a table."""
    rows = [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def preview(df: DataFrame, rows: int = 5, order_by: Sequence[str] = ()) -> DataFrame:
    """The first rows, by ``order_by`` where given."""
    return (df.orderBy(*order_by) if order_by else df).limit(rows)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def melt(wide: DataFrame, columns: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Turn one row of ``<measure>_<i>`` values into one row per column."""
    rows = [
        F.struct(F.lit(name).alias("column"), *[F.col(f"{m}_{i}").alias(m) for m in measures])
        for i, name in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*rows)))


def completeness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: rows, NULL count and the share of non-NULL values in percent (one scan)."""
    columns = list(columns or df.columns)
    wide = df.agg(
        *[F.count(F.lit(1)).alias(f"rows_{i}") for i in range(len(columns))],
        *[F.count(F.col(f"`{c}`")).alias(f"filled_{i}") for i, c in enumerate(columns)],
    )
    table = melt(wide, columns, ["rows", "filled"])
    return table.select(
        "column",
        "rows",
        (F.col("rows") - F.col("filled")).alias("nulls"),
        (F.try_divide(F.col("filled").cast("double"), F.col("rows").cast("double")) * 100).alias("complete_pct"),
    )


def summary_values(df: DataFrame, column: str, quantile_fractions: Sequence[float] = (), **options) -> DataFrame:
    """One row: count, sum, mean, min, max, sample SD and any wanted quantiles of a column."""
    c = F.col(column)
    base = df.agg(
        F.count(c).alias("count"),
        F.sum(c).cast("double").alias("sum"),
        F.avg(c).alias("mean"),
        F.min(c).cast("double").alias("min"),
        F.max(c).cast("double").alias("max"),
        F.stddev_samp(c).alias("std"),
    )
    if not quantile_fractions:
        return base
    q = scalar_quantiles(df, column, quantile_fractions, **options)
    names = {f"q{int(round(f * 100)):02d}": F.col("_q")[i] for i, f in enumerate(quantile_fractions)}
    return base.withColumn("_q", q).withColumns(names).drop("_q")


def describe(df: DataFrame, columns: Sequence[str] | None = None, method: str = "auto") -> DataFrame:
    """Profile of numeric columns: count, mean, std, min, quartiles, max (one row per column)."""
    columns = list(columns or numeric_columns(df))
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    if method == "auto":
        method = "inline" if is_small(values) else "radix"
    if method == "inline":
        # Small inputs often come as one file and so one task, too few for several quantile maps. The
        # input size is checked above, so this shuffle is a small one.
        tasks = min(df.sparkSession.sparkContext.defaultParallelism, 32)
        values = values.repartition(tasks, *values.columns)
    aggregates = []
    for i in range(len(columns)):
        c = F.col(f"c{i}")
        aggregates += [
            F.count(c).alias(f"count_{i}"),
            F.avg(c).alias(f"mean_{i}"),
            F.stddev_samp(c).alias(f"std_{i}"),
            F.min(c).alias(f"min_{i}"),
            F.max(c).alias(f"max_{i}"),
        ]
        if method == "inline":
            aggregates.append(F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"q_{i}"))
    measures = ["count", "mean", "std", "min", "max"]
    quartile_names = ["q25", "q50", "q75"]
    order = ["column", "count", "mean", "std", "min", *quartile_names, "max"]
    if method == "inline":
        table = melt(values.agg(*aggregates), columns, [*measures, "q"])
        return table.select(
            *["column", *measures], *[F.col("q")[k].alias(n) for k, n in enumerate(quartile_names)]
        ).select(*order)
    table = melt(values.agg(*aggregates), columns, measures)
    long = values.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("column"), F.col(f"c{i}").alias("v")) for i, n in enumerate(columns)]))
    )
    quartiles = quantiles(
        long, "v", [0.25, 0.5, 0.75], by=["column"], names=quartile_names, method=method, bounded_groups=True
    )
    return table.join(F.broadcast(quartiles), "column", "left").select(*order)


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of distinct non-NULL values per column, each counted from its own pruned projection."""
    parts = [
        df.groupBy(F.col(f"`{c}`").alias("v"))
        .agg(F.lit(1).alias("one"))
        .agg(F.count("v").alias("distinct_values"))
        .select(F.lit(c).alias("column"), "distinct_values")
        for c in columns
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Rows and share in percent per value (class balance, payment mix), NULL values left out."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    everything = counts.agg(F.sum("rows").alias("n")).scalar()
    return counts.withColumn("pct", F.round(F.col("rows") / everything * 100, 2))


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram from minimum to maximum; the last bin is closed, empty bins are kept.

    The values alone are written once: limits and counts both read them, and ``df`` may be a costly plan.
    """
    data = store(df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull()), "histogram-values")
    # A constant column gets one unit of width around its value.
    half = F.when(F.max("v") == F.min("v"), 0.5).otherwise(0.0)
    limits = scalar_stats(data, lo=F.min("v") - half, hi=F.max("v") + half)
    lo, hi = F.col("_r.lo"), F.col("_r.hi")
    index = F.least(F.lit(bins - 1), F.floor((F.col("v") - lo) / (hi - lo) * bins)).cast("int")
    counts = data.withColumn("_r", limits).groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("rows"))
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).withColumn("_r", limits)
    width = (hi - lo) / bins
    return spine.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (lo + F.col("bin") * width).alias("lower"),
        (lo + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
    )


def box_plot(df: DataFrame, column: str, whisker: float = 1.5, method: str = "auto") -> DataFrame:
    """Five numbers of a box plot with fences, whiskers inside the fences and the number of fliers."""
    data = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull())
    q = F.col("_q")
    reach = (q[2] - q[0]) * whisker
    inside = F.col("v").between(q[0] - reach, q[2] + reach)
    inner = data.withColumn("_q", scalar_quantiles(data, "v", [0.25, 0.5, 0.75], method=method)).agg(
        F.any_value("_q").alias("_q"),
        F.count("v").alias("n"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
        F.min(F.when(inside, F.col("v"))).alias("low_value"),
        F.max(F.when(inside, F.col("v"))).alias("high_value"),
        F.count_if(~inside).alias("fliers"),
    )
    return inner.select(
        "n",
        "min",
        q[0].alias("q1"),
        q[1].alias("median"),
        q[2].alias("q3"),
        "max",
        F.least("low_value", q[0]).alias("whisker_low"),
        F.greatest("high_value", q[2]).alias("whisker_high"),
        "fliers",
    )

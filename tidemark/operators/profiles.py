"""Profiles that can be put together.

A part of a table (a month, a file, a micro-batch) leaves one small row for each column: counts, moments, limits and a
HyperLogLog sketch of its values. Rows of any number of parts merge into the profile of all of them without reading
the table again, and a part that is profiled anew replaces its row only. All figures are those of the whole table but
``distinct_estimate``, whose relative standard error is ``ERROR``; ``statistics.distinct_counts`` counts exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.statistics import melt

# Registers of a sketch as a power of two: 4 KiB for each part and column.
LG_K = 12
# Relative standard error of merged sketches.
ERROR = 1.04 / 2 ** (LG_K / 2)
MEASURES = {
    "rows": "bigint",
    "filled": "bigint",
    "mean": "double",
    "squares": "double",
    "least": "double",
    "greatest": "double",
    "sketch": "binary",
}


def _hashed(c: Column, kind: T.DataType) -> Column:
    """64 bits of a value; both zeros are one value, NULL stays NULL."""
    value = c + F.lit(0).cast(kind) if isinstance(kind, (T.DoubleType, T.FloatType)) else c
    return F.when(c.isNotNull(), F.xxhash64(value))


def partial_profiles(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row for each part (values of ``by``) and column: ``MEASURES``, in one scan and one aggregate.

    Mean, ``squares`` (sum of squared deviations from the mean) and limits are NULL for columns that are no numbers
    and where no value is. Without ``by`` the whole table is one part, an empty table too.
    """
    aggregates = []
    for i, name in enumerate(columns):
        kind = df.schema[name].dataType
        c = F.col(f"`{name}`")
        number = c.cast("double") if isinstance(kind, T.NumericType) else F.lit(None).cast("double")
        aggregates += [
            F.count(F.lit(1)).alias(f"rows_{i}"),
            F.count(c).alias(f"filled_{i}"),
            F.avg(number).alias(f"mean_{i}"),
            (F.var_pop(number) * F.count(number)).alias(f"squares_{i}"),
            F.min(number).alias(f"least_{i}"),
            F.max(number).alias(f"greatest_{i}"),
            F.hll_sketch_agg(_hashed(c, kind), F.lit(LG_K)).alias(f"sketch_{i}"),
        ]
    wide = df.groupBy(*[F.col(f"`{b}`") for b in by]).agg(*aggregates)
    if not by:
        return melt(wide, columns, list(MEASURES))
    rows = [
        F.struct(F.lit(name).alias("column"), *[F.col(f"{m}_{i}").alias(m) for m in MEASURES])
        for i, name in enumerate(columns)
    ]
    return wide.select(*[F.col(f"`{b}`") for b in by], F.inline(F.array(*rows)))


def merge_profiles(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Profiles of the parts together: one row for each column and value of ``by``, in the form of a part again.

    The deviations of each part are moved to the common mean, so nothing cancels where means are large.
    """
    keys = [*by, "column"]
    joint = parts.groupBy(*keys).agg(
        F.try_divide(F.sum(F.col("mean") * F.col("filled")), F.sum(F.when(F.col("mean").isNotNull(), F.col("filled")))).alias("_mean")
    )
    same = [F.col(f"p.{k}").eqNullSafe(F.col(f"j.{k}")) for k in keys]
    condition = same[0]
    for further in same[1:]:
        condition = condition & further
    both = parts.alias("p").join(joint.alias("j"), condition).select("p.*", "j._mean")
    moved = F.col("squares") + F.col("filled") * (F.col("mean") - F.col("_mean")) ** 2
    merged = both.groupBy(*keys).agg(
        F.sum("rows").alias("rows"),
        F.sum("filled").alias("filled"),
        F.any_value("_mean").alias("mean"),
        F.sum(moved).alias("squares"),
        F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
        F.hll_union_agg("sketch").alias("sketch"),
    )
    return merged.select(*keys, *MEASURES)


def read_profiles(profiles: DataFrame) -> DataFrame:
    """Profiles in figures: rows, NULLs, share of values, estimate of distinct values, mean, sample SD, limits."""
    kept = [c for c in profiles.columns if c not in MEASURES]
    filled = F.col("filled").cast("double")
    return profiles.select(
        *[f"`{c}`" for c in kept],
        "rows",
        (F.col("rows") - F.col("filled")).alias("nulls"),
        (F.try_divide(filled, F.col("rows").cast("double")) * 100).alias("complete_pct"),
        F.hll_sketch_estimate("sketch").alias("distinct_estimate"),
        "mean",
        F.when(F.col("filled") > 1, F.sqrt(F.col("squares") / (filled - 1))).alias("std"),
        F.col("least").alias("min"),
        F.col("greatest").alias("max"),
    )


def keep_profiles(parts: DataFrame, folder: str, by: Sequence[str]) -> None:
    """Write parts below ``folder``, a Parquet partition for each value of ``by``.

    Parts that are there already are replaced, others stay: profiling a month again changes nothing but that month.
    """
    writer = parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by)
    writer.parquet(folder)


def kept_profiles(spark: SparkSession, folder: str, by: str) -> DataFrame:
    """All parts below a folder; ``by`` are its key columns as DDL, such as ``"month string"``."""
    measures = ", ".join(f"{m} {kind}" for m, kind in MEASURES.items())
    return spark.read.schema(f"column string, {measures}, {by}").parquet(folder)

"""Exact, linearly interpolated quantiles that do not need a group to fit into one task.

Spark's ``percentile`` keeps a value -> count map of a whole group in one task. That is the fastest way
for small inputs and is used for them. Beyond ``INLINE_BYTES`` the wanted ranks are selected by radix:

1. every value gets a 64-bit key that keeps the order of the values;
2. a round counts the rows of each value of the next ``BITS`` bits, with map-side combining, adds the counts
   up in order and keeps the few buckets that hold a wanted rank;
3. four such rounds fix all bits, so that a bucket is one value.

However rows are skewed, a round leaves at most 65,536 counts for each bucket kept, two buckets for each
quantile of a group. Nothing is approximate, so a repeated task finds the same, and nothing runs before the
result is asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

INLINE_BYTES = 16 * 1024 * 1024
SALTS = 64
BITS = 16


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a DataFrame, or None where the session does not give one."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # e.g. a Connect session has no JVM handle: take the way that always scales
        return None


def is_small(df: DataFrame, limit: int = INLINE_BYTES) -> bool:
    size = estimated_bytes(df)
    return size is not None and size <= limit


def quantiles(
    df: DataFrame,
    value: str,
    fractions: Sequence[float],
    by: Sequence[str] = (),
    names: Sequence[str] | None = None,
    method: str = "auto",
    accuracy: int = 10_000,
    bounded_groups: bool = False,
) -> DataFrame:
    """One row per group with the wanted quantiles of ``value`` (NULLs skipped) as double columns.

    ``method``: ``auto`` (by input size), ``inline``, ``radix`` (both exact) or ``sketch``
    (approximate, to one part in ``accuracy``). NaN counts as the largest value. Groups with a NULL in their key are
    left out; an empty table gives one row of NULLs, or no row with ``by``.
    ``bounded_groups`` states that the number of groups has a fixed bound (calendar months, columns of a
    table), which allows the small per-group tables to be broadcast.
    """
    by = list(by)
    names = list(names or [f"q{int(round(f * 100)):02d}" for f in fractions])
    data = df.select(*by, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    for key in by:
        data = data.filter(F.col(key).isNotNull())
    if method == "auto":
        method = "inline" if is_small(data) else "radix"
    if method in ("inline", "sketch"):
        wanted = F.array(*[F.lit(float(f)) for f in fractions])
        q = F.percentile("_v", wanted) if method == "inline" else F.percentile_approx("_v", wanted, accuracy)
        out = data.groupBy(*by).agg(q.alias("_q"))
        return out.select(*by, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    if method != "radix":
        raise ValueError(f"unknown method {method!r}")
    return _selected(data, [float(f) for f in fractions], by, names, bounded_groups)


def with_order_key(df: DataFrame, value: str, name: str) -> DataFrame:
    """Add a BIGINT for each double that is ordered as the doubles are, different for different ones.

    Exponent and fraction are taken apart by scaling with powers of two, which is exact; the logarithm, which is not,
    only proposes the exponent. Both zeros have the key 0, NaN and NULL the largest one. Each step is a column, so that
    it is computed once a row; a key that cannot be NULL keeps joins from filtering by the whole expression below.
    """
    v, size, near, power = F.col(value), F.col("_size"), F.col("_near"), F.col("_power")
    least, most = F.lit(-1022.0), F.lit(1023.0)
    high, low = (power > size) & (near > least), power * 2 <= size
    # Below the smallest normal number the leading bit is missing and the exponent counts as 0.
    fraction = F.floor(size / F.col("_unit") * F.lit(float(2**52)))
    normal = (F.col("_exponent") + 1022).cast("bigint") * F.lit(2**52) + fraction
    infinite = F.lit(2047 * 2**52)
    magnitude = F.when(size == 0, F.lit(0)).when(size == F.lit(float("inf")), infinite).otherwise(normal)
    return (
        df.withColumn("_size", F.abs(v))
        .withColumn("_near", F.greatest(least, F.least(most, F.floor(F.log2(size)).cast("double"))))
        .withColumn("_power", F.pow(F.lit(2.0), near))
        .withColumn("_unit", F.when(high, power / 2).when(low, power * 2).otherwise(power))
        .withColumn("_exponent", F.when(high, near - 1).when(low, near + 1).otherwise(near))
        .withColumn("_size", F.when(F.isnan(v), 0.0).otherwise(size))
        .withColumn(name, F.when(v < 0, -magnitude).when(~F.isnan(v), magnitude))
        .withColumn(name, F.coalesce(F.col(name), F.lit(2**63 - 1)))
        .drop("_size", "_near", "_power", "_unit", "_exponent")
    )


def _selected(data: DataFrame, fractions: list[float], by: list[str], names: list[str], bounded_groups: bool) -> DataFrame:
    ordered = sorted(set(fractions))
    small = (not by) or bounded_groups
    rows = data.withColumn("_v", F.col("_v") + F.lit(0.0)).withColumn("_w", F.lit(1).cast("bigint"))
    if not small:
        # Any number of groups: equal values are merged first, then the distinct values of a group are
        # spread over SALTS join keys (a function of the value, so a repeated task spreads them alike).
        rows = rows.groupBy(*by, "_v").agg(F.sum("_w").alias("_w"))
        rows = rows.withColumn("_salt", F.pmod(F.xxhash64("_v"), F.lit(SALTS)).cast("int"))
    rows = with_order_key(rows, "_v", "_k")

    ranks = [(F.floor((F.col("_n") - 1) * F.lit(f)), F.ceil((F.col("_n") - 1) * F.lit(f))) for f in ordered]

    def reaches(rank: Column) -> Column:
        return (rank >= F.col("_start")) & (rank < F.col("_start") + F.col("_c"))

    wanted = F.lit(False)
    for low, high in ranks:
        wanted = wanted | reaches(low) | reaches(high)

    kept = None
    for shift in range(64 - BITS, -1, -BITS):
        bucket = F.shiftright("_k", shift).alias("_bucket")
        if kept is None:
            counted = rows.groupBy(*by, bucket).agg(F.sum("_w").alias("_c"), F.min("_v").alias("_v"))
            whole, before = Window.partitionBy(*by), F.lit(0)
            counted = counted.withColumn("_n", F.sum("_c").over(whole)).withColumn("_above", F.lit(0))
        else:
            above = kept.select(*by, F.col("_bucket").alias("_above"), F.col("_start").alias("_before"), "_n")
            marked = rows.withColumn("_above", F.shiftright("_k", shift + BITS))
            if small:
                inside = marked.join(F.broadcast(above), [*by, "_above"])
            else:
                salted = above.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
                inside = marked.join(salted, [*by, "_above", "_salt"])
            counted = inside.groupBy(*by, "_n", "_above", "_before", bucket).agg(F.sum("_w").alias("_c"), F.min("_v").alias("_v"))
            before = F.col("_before")
        in_order = Window.partitionBy(*by, "_above").orderBy("_bucket")
        kept = counted.withColumn("_start", before + F.sum("_c").over(in_order) - F.col("_c")).filter(wanted)

    def at(rank: Column) -> Column:
        return F.max(F.when(reaches(rank), F.col("_v")))

    picked = kept.groupBy(*by).agg(
        F.max("_n").alias("_n"),
        *[at(low).alias(f"_lo{i}") for i, (low, _) in enumerate(ranks)],
        *[at(high).alias(f"_hi{i}") for i, (_, high) in enumerate(ranks)],
    )
    out = []
    for name, fraction in zip(names, fractions):
        i = ordered.index(fraction)
        place = (F.col("_n") - 1) * F.lit(fraction)
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        between = (F.ceil(place) - place) * low + (place - F.floor(place)) * high
        out.append(F.when(low == high, low).otherwise(between).alias(name))
    return picked.select(*by, *out)

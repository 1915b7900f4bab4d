"""Anomaly flags, risk scores and their evaluation against labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import bin_label, clip, count_where, holds, percent
from tidemark.operators.quantiles import quantiles
from tidemark.operators.statistics import attach_stats, scalar_quantiles, scalar_stats

RISK_EDGES = (0, 40, 70, 100)
RISK_LABELS = ("Low", "Medium", "High")
FLAG_SCORE = 70


# -- scaling and simple flags ------------------------------------------------------------------------


def standard_scale(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Standardise columns (new name -> source) with the population SD; a constant column gives 0."""
    aggregates = {}
    for i, source in enumerate(columns.values()):
        aggregates[f"mean{i}"] = F.avg(source)
        aggregates[f"sd{i}"] = F.stddev_pop(source)
    s = F.col("_s")
    return attach_stats(df, "_s", **aggregates).withColumns(
        {
            name: (F.col(source) - s[f"mean{i}"]) / F.when(s[f"sd{i}"] == 0, 1.0).otherwise(s[f"sd{i}"])
            for i, (name, source) in enumerate(columns.items())
        }
    ).drop("_s")


def flag_zscore(
    df: DataFrame, column: str = "Amount_log_scaled", threshold: float = 2.5, out: str = "zscore_flag"
) -> DataFrame:
    """Flag values more than ``threshold`` population SDs from the mean; missing counts as 0."""
    x, s = F.coalesce(F.col(column), F.lit(0.0)), F.col("_s")
    # |x - mean| > t * sd instead of a division; with sd = 0 nothing is flagged.
    beyond = holds((s["sd"] > 0) & (F.abs(x - s["mean"]) > s["sd"] * threshold))
    return attach_stats(df, "_s", mean=F.avg(x), sd=F.stddev_pop(x)).withColumn(out, beyond).drop("_s")


def flag_percentile(
    df: DataFrame, column: str = "Amount", top_pct: float = 99, out: str = "iqr_flag", method: str = "auto"
) -> DataFrame:
    """Flag values above the ``top_pct`` percentile, in which missing values count as 0."""
    filled = df.select(F.coalesce(F.col(column), F.lit(0.0)).alias("v"))
    cut = scalar_quantiles(filled, "v", [top_pct / 100], method=method)[0]
    return df.withColumn(out, holds(F.col(column) > cut))


FENCES = ("q1", "q3", "lower", "upper")


def with_fences(df: DataFrame, column: str, k: float = 1.5, method: str = "auto") -> DataFrame:
    """Add a struct column ``fences``: quartiles and the bounds k interquartile ranges outside them."""
    spread = (F.col("q3") - F.col("q1")) * k
    table = quantiles(df, column, [0.25, 0.75], names=["q1", "q3"], method=method).select(
        F.struct("q1", "q3", (F.col("q1") - spread).alias("lower"), (F.col("q3") + spread).alias("upper")).alias("f")
    )
    return df.withColumn("fences", table.scalar())


def beyond_fences(column: str) -> Column:
    return (F.col(column) < F.col("fences.lower")) | (F.col(column) > F.col("fences.upper"))


def fence_outliers(df: DataFrame, column: str, k: float = 1.5, method: str = "auto") -> DataFrame:
    """The rows beyond the fences."""
    return with_fences(df, column, k, method).filter(beyond_fences(column)).drop("fences")


def fence_summary(df: DataFrame, column: str, k: float = 1.5, method: str = "auto") -> DataFrame:
    """One row: quartiles, fences, number and share of outliers."""
    counts = with_fences(df, column, k, method).agg(
        F.any_value("fences").alias("fences"),
        F.count(F.lit(1)).alias("rows"),
        count_where(beyond_fences(column)).alias("outliers"),
    )
    return counts.select(
        *[F.col(f"fences.{n}").alias(n) for n in FENCES],
        "rows",
        "outliers",
        percent(F.col("outliers"), F.col("rows")).alias("outlier_pct"),
    )


def fence_summary_by(
    df: DataFrame, column: str, key: str, k: float = 1.5, method: str = "auto"
) -> DataFrame:
    """Share of whole-table fence outliers per value of ``key`` (e.g. per pick-up zone)."""
    return (
        with_fences(df, column, k, method)
        .filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("rows"), count_where(beyond_fences(column)).alias("outliers"))
        .withColumn("outlier_pct", percent(F.col("outliers"), F.col("rows")))
    )


def sigma_outliers(df: DataFrame, column: str, k: float = 3.0) -> Column:
    """Condition: value more than k sample SDs from the mean of ``df``; NULL is no outlier."""
    s = scalar_stats(df, mean=F.avg(column), sd=F.stddev_samp(column))
    return holds(F.abs(F.col(column) - s["mean"]) > s["sd"] * k)


# -- risk score --------------------------------------------------------------------------------------


@dataclass(frozen=True)
class RangeShare:
    """Position of a value between minimum and maximum, times ``points``."""

    column: str
    points: float
    default: float = 0.0

    def stats(self) -> dict[str, Column]:
        x = F.coalesce(F.col(self.column), F.lit(self.default))
        return {"min": F.min(x), "max": F.max(x)}

    def score(self, s: Mapping[str, Column]) -> Column:
        x = F.coalesce(F.col(self.column), F.lit(self.default))
        spread = s["max"] - s["min"]
        return F.when(spread > 0, (x - s["min"]) / spread * self.points).otherwise(0.0)


@dataclass(frozen=True)
class MagnitudeShare:
    """Absolute value relative to the largest absolute value, times ``points``."""

    column: str
    points: float
    default: float = 0.0

    def stats(self) -> dict[str, Column]:
        return {"top": F.max(F.abs(F.coalesce(F.col(self.column), F.lit(self.default))))}

    def score(self, s: Mapping[str, Column]) -> Column:
        x = F.abs(F.coalesce(F.col(self.column), F.lit(self.default)))
        return F.when(s["top"] > 0, x / s["top"] * self.points).otherwise(0.0)


@dataclass(frozen=True)
class NightHours:
    """``points`` for hours up to ``until`` or from ``since`` on; a missing hour counts as noon."""

    column: str
    points: float
    until: int = 4
    since: int = 22
    default: int = 12

    def stats(self) -> dict[str, Column]:
        return {}

    def score(self, s: Mapping[str, Column]) -> Column:
        hour = F.coalesce(F.col(self.column), F.lit(self.default))
        return F.when((hour <= self.until) | (hour >= self.since), float(self.points)).otherwise(0.0)


@dataclass(frozen=True)
class CategoryPoints:
    """Fixed points per category value, 0 for any other."""

    column: str
    points: Mapping[str, float]

    def stats(self) -> dict[str, Column]:
        return {}

    def score(self, s: Mapping[str, Column]) -> Column:
        chain = F.when(F.lit(False), 0.0)
        for value, points in self.points.items():
            chain = chain.when(F.col(self.column) == value, float(points))
        return chain.otherwise(0.0)


Component = RangeShare | MagnitudeShare | NightHours | CategoryPoints

# The weights of the card-transaction score.
CARD_COMPONENTS: tuple[Component, ...] = (
    RangeShare("Amount_log", 40),
    NightHours("Hour", 20),
    MagnitudeShare("V1", 15),
    MagnitudeShare("V4", 15),
    MagnitudeShare("V14", 10),
)

# The score over amount, daily frequency, transaction type and hour; its weights are this package's choice.
ACTIVITY_COMPONENTS: tuple[Component, ...] = (
    RangeShare("amount", 40),
    RangeShare("frequency_per_day", 25),
    CategoryPoints("type", {"international": 20, "online": 10, "ATM": 5}),
    NightHours("hour", 15),
)


def _present(df: DataFrame, components: Sequence[Component]) -> list[Component]:
    return [c for c in components if c.column in df.columns]


def score_statistics(df: DataFrame, components: Sequence[Component] = CARD_COMPONENTS) -> DataFrame:
    """The one-row table of column statistics a score needs: store it to score later rows the same way."""
    named = [
        value.cast("double").alias(f"{c.column}_{stat}")
        for c in _present(df, components)
        for stat, value in c.stats().items()
    ]
    return df.agg(*named) if named else df.agg(F.lit(0.0).alias("none"))


def risk_score(
    df: DataFrame,
    components: Sequence[Component] = CARD_COMPONENTS,
    out: str = "risk_score",
    statistics: Mapping[str, float] | None = None,
) -> DataFrame:
    """Add a 0-100 score: the sum of its components, each over whole-column statistics.

    Components whose column is absent or constant add nothing. The statistics come from ``df`` itself
    unless given (a stored row of ``score_statistics``), which is how a stream is scored.
    """
    present = _present(df, components)
    if statistics is None:
        table = score_statistics(df, present)
        df = df.withColumn("_s", table.select(F.struct(*table.columns)).scalar())
        lookup = {name: F.col("_s")[name] for name in table.columns}
    else:
        lookup = {n: F.lit(v) for n, v in statistics.items()}
    score = F.lit(0.0)
    for c in present:
        score = score + c.score({stat: lookup[f"{c.column}_{stat}"] for stat in c.stats()})
    return df.withColumn(out, clip(score, 0.0, 100.0)).drop("_s")


def risk_level(df: DataFrame, score: str = "risk_score", out: str = "risk_level") -> DataFrame:
    return df.withColumn(out, bin_label(F.col(score), RISK_EDGES, RISK_LABELS))


def combine_flags(
    df: DataFrame,
    flags: Sequence[str] = ("zscore_flag", "iqr_flag"),
    score: str = "risk_score",
    at_least: float = FLAG_SCORE,
    out: str = "flagged",
) -> DataFrame:
    """A row is flagged if any flag is set or its score reaches ``at_least``."""
    any_flag = holds(F.col(score) >= at_least)
    for f in flags:
        any_flag = any_flag | holds(F.col(f))
    return df.withColumn(out, any_flag)


# -- evaluation --------------------------------------------------------------------------------------


def flag_counts(df: DataFrame, flag: str = "flagged") -> DataFrame:
    """Rows normal and flagged; a class without rows shows 0."""
    wide = df.agg(count_where(~holds(F.col(flag))).alias("normal"), count_where(F.col(flag)).alias("flagged"))
    return wide.select(
        F.inline(
            F.array(
                F.struct(F.lit("Normal").alias("class"), F.col("normal").alias("rows")),
                F.struct(F.lit("Flagged").alias("class"), F.col("flagged").alias("rows")),
            )
        )
    )


def risk_summary(df: DataFrame, level: str = "risk_level", flag: str = "flagged") -> DataFrame:
    """One row: total, flagged with share, rows per risk level."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        count_where(F.col(flag)).alias("flagged"),
        *[count_where(F.col(level) == n).alias(n.lower()) for n in reversed(RISK_LABELS)],
    ).withColumn("flagged_pct", percent(F.col("flagged"), F.col("total")))


def detection_metrics(df: DataFrame, flag: str = "flagged", label: str = "Class") -> DataFrame:
    """One row: true and false positives, false negatives, precision and recall (0 where undefined)."""
    hit, real = holds(F.col(flag)), F.col(label)
    counts = df.agg(
        count_where(hit & (real == 1)).alias("true_positives"),
        count_where(hit & (real == 0)).alias("false_positives"),
        count_where(~hit & (real == 1)).alias("false_negatives"),
    )
    tp, fp, fn = (F.col(c) for c in counts.columns)
    return counts.withColumns(
        {
            "precision": F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0),
            "recall": F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0),
        }
    )


def class_balance(df: DataFrame, label: str = "Class") -> DataFrame:
    """One row: positive and negative class with shares in percent."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), count_where(F.col(label) == 1).alias("positive")
    ).select(
        "rows",
        "positive",
        percent(F.col("positive"), F.col("rows")).alias("positive_pct"),
        (F.col("rows") - F.col("positive")).alias("negative"),
        percent(F.col("rows") - F.col("positive"), F.col("rows")).alias("negative_pct"),
    )


def amount_by_hour(
    df: DataFrame, amount: str = "Amount", hour: str = "Hour", score: str = "risk_score", width: float = 50.0
) -> DataFrame:
    """Chart table: rows and mean score per hour and amount bucket (a scatter plot that stays small)."""
    return (
        df.filter(F.col(amount).isNotNull() & F.col(hour).isNotNull())
        .groupBy(F.col(hour).cast("int").alias("hour"), (F.floor(F.col(amount) / width) * width).alias("amount_from"))
        .agg(F.count(F.lit(1)).alias("rows"), F.avg(score).alias("avg_score"))
    )

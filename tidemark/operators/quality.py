"""Data-quality rules as data, evaluated over a whole table in two scans.

The first scan turns every row into pairs of a rule and a key: the keys of uniqueness and reference rules, the row
rules that it breaks, its empty columns. One aggregate with map-side combining counts the pairs of all rules, so a key
holding a large part of the table is one row of each map task. What breaks a rule is written; the second scan looks up
its first records, among the rows up to a limit that one row in ``LIMIT_SHARE`` gave before.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import POSITION, holds
from tidemark.sources.checkpoints import store

SEVERITY_WEIGHTS = {"Critical": 3, "Major": 2, "Minor": 1}
GRADES = ((90, "A"), (75, "B"), (60, "C"))
SAMPLE = 10
# One row in so many is looked at for where the samples end.
LIMIT_SHARE = 64


@dataclass(frozen=True)
class RowRule:
    """Broken by every row for which ``violation`` is true."""

    name: str
    severity: str
    violation: Column


@dataclass(frozen=True)
class UniqueRule:
    """Broken by every row whose key occurs more than once (all of its rows, not only the later ones)."""

    name: str
    severity: str
    keys: tuple[str, ...]


@dataclass(frozen=True)
class ReferenceRule:
    """Broken by every row whose key is missing from a reference table (a NULL key is missing, too)."""

    name: str
    severity: str
    key: str
    reference: DataFrame
    reference_key: str


@dataclass(frozen=True)
class CompletenessRule:
    """Broken by every column with less than ``min_pct`` percent of non-NULL values."""

    name: str
    severity: str
    min_pct: float = 95.0
    columns: tuple[str, ...] = field(default=())


Rule = RowRule | UniqueRule | ReferenceRule | CompletenessRule


def any_missing(*columns: str) -> Column:
    """Violation: any of the required columns is NULL."""
    out = F.lit(False)
    for c in columns:
        out = out | F.col(f"`{c}`").isNull()
    return out


def not_positive(column: str, null_breaks: bool = False) -> Column:
    """Violation: value of zero or less; a NULL breaks the rule only if asked for."""
    c = F.col(f"`{column}`")
    return F.coalesce(c <= 0, F.lit(null_breaks))


def not_in(column: str, allowed: Sequence[object]) -> Column:
    """Violation: value outside a fixed list, NULL included."""
    return ~holds(F.col(f"`{column}`").isin(*allowed))


# -- evaluation --------------------------------------------------------------------------------------


# The pair of every row, which counts the table.
ALL = -1


def _key_text(c: Column, kind: T.DataType) -> Column:
    """A text that is equal for equal values of a type, and for these only."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (c + F.lit(0.0)).cast("string")  # one zero
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("string")  # an hour may come twice in local time
    if isinstance(kind, T.BinaryType):
        return F.hex(c)
    if isinstance(kind, (T.ArrayType, T.StructType)):
        return F.to_json(c, {"ignoreNullFields": "false"})
    return c.cast("string")


def _key(df: DataFrame, rule: UniqueRule | ReferenceRule) -> Column:
    """The key of a row under a rule as one text; NULL where a key of one column is NULL."""
    if isinstance(rule, ReferenceRule):
        kind = _common_type(df, rule)
        return _key_text(F.col(f"`{rule.key}`").cast(kind), kind)
    kinds = dict(zip(df.columns, (f.dataType for f in df.schema.fields)))
    texts = [_key_text(F.col(f"`{k}`"), kinds[k]) for k in rule.keys]
    return texts[0] if len(texts) == 1 else F.to_json(F.array(*texts))


def _common_type(df: DataFrame, rule: ReferenceRule) -> T.DataType:
    """The type in which keys and reference keys are compared."""
    both = df.select(F.col(f"`{rule.key}`")).union(rule.reference.select(F.col(f"`{rule.reference_key}`")))
    return both.schema.fields[0].dataType


def _pair(position: int, key: Column | None = None) -> Column:
    text = F.lit(None) if key is None else key
    return F.struct(F.lit(position).alias("position"), text.cast("string").alias("key"))


def _checked_columns(df: DataFrame, rule: CompletenessRule) -> list[str]:
    return list(rule.columns or [c for c in df.columns if c != POSITION])


def _keyed(rules: Sequence[Rule]) -> list[tuple[int, UniqueRule | ReferenceRule]]:
    return [(i, r) for i, r in enumerate(rules) if isinstance(r, (UniqueRule, ReferenceRule))]


def _row_pairs(rules: Sequence[Rule]) -> list[Column]:
    return [F.when(holds(r.violation), _pair(i)) for i, r in enumerate(rules) if isinstance(r, RowRule)]


def _broken(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(position, key, n): rows for each rule and key that break it, empty values of each column; with a row for ``ALL``.

    Stored, because counts and samples both read it.
    """
    pairs = [_pair(ALL), *_row_pairs(rules)]
    for i, rule in enumerate(rules):
        if isinstance(rule, CompletenessRule):
            pairs += [F.when(F.col(f"`{c}`").isNull(), _pair(i, F.lit(str(k)))) for k, c in enumerate(_checked_columns(df, rule))]
    pairs += [_pair(i, _key(df, rule)) for i, rule in _keyed(rules)]
    counted = df.select(F.inline(F.array(*pairs))).filter("position is not null").select(
        "position", "key", F.lit(1).cast("bigint").alias("n"), F.lit(0).alias("known")
    )
    for i, rule in _keyed(rules):
        if isinstance(rule, ReferenceRule):
            kind = _common_type(df, rule)
            known = rule.reference.select(F.col(f"`{rule.reference_key}`").cast(kind).alias("k")).filter("k is not null")
            counted = counted.union(
                known.select(F.lit(i), _key_text(F.col("k"), kind), F.lit(0).cast("bigint"), F.lit(1))
            )
    keys = counted.groupBy("position", "key").agg(F.sum("n").alias("n"), F.max("known").alias("known"))
    unique = [i for i, r in _keyed(rules) if isinstance(r, UniqueRule)]
    found = (F.col("n") > 0) & (F.col("known") == 0) & ((F.col("n") > 1) | ~F.col("position").isin(unique))
    return store(keys.filter(found).select("position", "key", "n"), "broken-rules")


def _counts(df: DataFrame, rules: Sequence[Rule], broken: DataFrame) -> DataFrame:
    """(position, violations, checked) per rule."""
    # One row per rule, and one per column of a completeness rule, is all that is left here.
    everything = broken.filter(F.col("position") == ALL).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).scalar()
    catalogue, complete = [], F.lit(None).cast("double")
    for i, rule in enumerate(rules):
        columns = len(_checked_columns(df, rule)) if isinstance(rule, CompletenessRule) else None
        catalogue.append(F.struct(F.lit(i).alias("position"), F.lit(columns).cast("bigint").alias("columns")))
        if columns is not None:
            complete = F.when(F.col("position") == i, F.lit(float(rule.min_pct))).otherwise(complete)
    least, rows = F.col("least"), F.col("rows")
    filled = F.try_divide((rows - F.col("n")).cast("double"), rows.cast("double")) * 100
    per_rule = (
        broken.withColumn("least", complete)
        .withColumn("rows", everything)
        .groupBy("position")
        .agg(F.sum(F.when(least.isNull(), F.col("n")).otherwise(holds(filled < least).cast("bigint"))).alias("violations"))
    )
    listed = df.sparkSession.range(1).select(F.inline(F.array(*catalogue)))
    return listed.join(F.broadcast(per_rule), "position", "left").select(
        "position",
        F.coalesce("violations", F.lit(0).cast("bigint")).alias("violations"),
        F.coalesce("columns", everything).alias("checked"),
    )


def _rows_of_pairs(df: DataFrame, rules: Sequence[Rule], record: str, order_by: Sequence[str]) -> DataFrame:
    """(position, key, record, places): the row rules that each row breaks and its keys, with what orders the samples.

    A row rule takes the record for its key, so that no partition of a join gets all rows that break it.
    """
    place = [F.col(f"`{c}`").alias(f"place{n}") for n, c in enumerate([*order_by, record])]
    identity = F.col(f"`{record}`").cast("string")
    pairs = [F.when(holds(r.violation), _pair(i, identity)) for i, r in enumerate(rules) if isinstance(r, RowRule)]
    pairs += [_pair(i, _key(df, rule)) for i, rule in _keyed(rules)]
    return df.select(F.inline(F.array(*pairs)), identity.alias("record"), *place).filter("position is not null")


def _places(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c.startswith("place")]


def _flagged(rows: DataFrame, keys: DataFrame, flag: str) -> DataFrame:
    """Rows with a true ``flag`` where their pair is one of the keys, else NULL."""
    keys = keys.select(F.col("position").alias("at"), F.col("key").alias("of"), F.lit(True).alias(flag))
    same = (F.col("position") == F.col("at")) & F.col("key").eqNullSafe(F.col("of"))
    return rows.join(keys, same, "left").drop("at", "of")


def _numbered(rows: DataFrame) -> DataFrame:
    return rows.withColumn("sample_no", F.row_number().over(Window.partitionBy("position").orderBy(*_places(rows))))


def _limits(df: DataFrame, rules: Sequence[Rule], record: str, order_by: Sequence[str], keys: DataFrame) -> DataFrame:
    """(position, limit): a place that none of the first ``SAMPLE`` violating rows of a rule comes after.

    Of one row in ``LIMIT_SHARE``, by a hash, it is the place of number ``SAMPLE``: that many violating rows stand there or
    before. It only bounds where the whole table is searched; rules with fewer violating rows among these have no limit.
    """
    chosen = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in [*order_by, record]]), F.lit(LIMIT_SHARE)) == 0
    rows = _flagged(_rows_of_pairs(df.filter(chosen), rules, record, order_by), keys, "breaks")
    rows = rows.filter(F.col("breaks") | ~F.col("position").isin([i for i, _ in _keyed(rules)]))
    return _numbered(rows).filter(F.col("sample_no") == SAMPLE).select("position", F.struct(*_places(rows)).alias("limit"))


def _samples(
    df: DataFrame, rules: Sequence[Rule], record: str, order_by: Sequence[str], broken: DataFrame
) -> DataFrame:
    """(position, record, sample_no) of the first ``SAMPLE`` violating rows per rule, in row order.

    Rows after the limit of a rule are left out before anything is sorted or shuffled. A rule without limit has few
    violating rows, so few keys break it: these are stored by themselves, for a join whose way follows their size.
    """
    keyed = [i for i, _ in _keyed(rules)]
    if not keyed and not _row_pairs(rules):
        return df.sparkSession.createDataFrame([], "position int, record string, sample_no int")
    keys = broken.filter(F.col("position").isin(keyed)).select("position", "key")
    rows = _rows_of_pairs(df, rules, record, order_by)
    limits = _limits(df, rules, record, order_by, keys)
    # Places that are numbered while reading may differ between scans; they limit nothing.
    limits = store(limits if _repeatable(df) else limits.limit(0), "sample-limits")
    rows = rows.join(F.broadcast(limits), "position", "left")
    rows = rows.filter(F.col("limit").isNull() | (F.struct(*_places(rows)) <= F.col("limit")))
    if keyed:
        rare = store(keys.join(F.broadcast(limits), "position", "left_anti"), "rare-keys")
        by_row = ~F.col("position").isin(keyed)
        rows = _flagged(rows, rare, "rare").filter(by_row | F.col("limit").isNotNull() | F.col("rare"))
        rows = _flagged(rows, keys.join(F.broadcast(limits), "position", "left_semi"), "frequent")
        rows = rows.filter(by_row | F.col("rare") | F.col("frequent"))
    return _numbered(rows).filter(F.col("sample_no") <= SAMPLE).select("position", "record", "sample_no")


def _repeatable(df: DataFrame) -> bool:
    """Whether every scan gives a row the same values, as far as Spark knows."""
    return df._jdf.queryExecution().analyzed().deterministic()


def run_rules(df: DataFrame, rules: Sequence[Rule], record: str, order_by: Sequence[str] = ()) -> DataFrame:
    """The rule report: rule, severity, status, violations, checked, sample_ids.

    ``sample_ids`` lists the first ten violating records in ``order_by`` order (default: the order of the file if
    the rows carry their position, else record order), followed by an ellipsis when there are more. A NULL key is a key
    like others under a uniqueness rule and unknown under a reference rule. The first scan and the limits run at once.
    """
    names = [F.struct(F.lit(i).alias("position"), F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity")) for i, r in enumerate(rules)]
    catalogue = df.sparkSession.range(1).select(F.inline(F.array(*names)))
    ids = F.transform(F.array_sort(F.collect_list(F.struct("sample_no", "record"))), lambda s: s["record"])
    order = order_by or [POSITION if POSITION in df.columns else record]
    broken = _broken(df, rules)
    samples = _samples(df, rules, record, order, broken).groupBy("position").agg(
        F.array_join(ids, ", ", "").alias("sample_ids")
    )
    # Both sides hold one row per rule.
    return (
        catalogue.join(F.broadcast(_counts(df, rules, broken)), "position", "left")
        .join(F.broadcast(samples), "position", "left")
        .select(
            "rule",
            "severity",
            F.when(F.col("violations") > 0, "FAIL").otherwise("PASS").alias("status"),
            "violations",
            "checked",
            F.concat(
                F.coalesce("sample_ids", F.lit("")), F.when((F.col("violations") > SAMPLE) & F.col("sample_ids").isNotNull(), " …").otherwise("")
            ).alias("sample_ids"),
        )
    )


def mark_rows(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    """Validated rows: every row with the names of the row rules it breaks."""
    broken = F.array_compact(F.array(*[F.when(holds(r.violation), F.lit(r.name)) for r in rules]))
    return df.withColumn("broken_rules", broken)


def violating_rows(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    """Rows that break at least one row rule."""
    return mark_rows(df, rules).filter(F.size("broken_rules") > 0)


def integrity_score(report: DataFrame) -> DataFrame:
    """One row: score 0-100 and grade.

    The score is the mean share of clean units over the rules, weighted by severity (3/2/1); the grade is
    A from 90, B from 75, C from 60, else D.
    """
    weight = F.lit(0)
    for severity, w in SEVERITY_WEIGHTS.items():
        weight = F.when(F.col("severity") == severity, F.lit(w)).otherwise(weight)
    clean = 1 - F.coalesce(F.try_divide(F.col("violations").cast("double"), F.col("checked").cast("double")), F.lit(0.0))
    scored = report.agg((F.sum(weight * clean) / F.sum(weight) * 100).alias("score"))
    grade = F.lit("D")
    for least, name in reversed(GRADES):
        grade = F.when(F.col("score") >= least, name).otherwise(grade)
    return scored.withColumn("grade", grade)


def status_counts(report: DataFrame) -> DataFrame:
    """Rules passed and failed."""
    return report.agg(
        F.count_if(F.col("status") == "PASS").alias("passed"), F.count_if(F.col("status") == "FAIL").alias("failed")
    )


def severity_counts(report: DataFrame) -> DataFrame:
    """Rules and violations per severity."""
    return report.groupBy("severity").agg(
        F.count(F.lit(1)).alias("rules"),
        F.count_if(F.col("status") == "FAIL").alias("failed"),
        F.sum("violations").alias("violations"),
    )

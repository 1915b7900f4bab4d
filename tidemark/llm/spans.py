"""Regular-expression matches with their places, by column functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KIND = "array<struct<start:int,end:int,value:string>>"


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed a single time."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def part(values: Column, at: Column, last: Column) -> Column:
    """The values from ``at`` to ``last``, one at least, backwards if ``last`` lies before; ``slice`` would copy all values."""
    return F.transform(F.sequence(at, last), lambda i: F.get(values, i))


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as (start, end, value); code points, the end exclusive.

    The pieces between the matches and the matches themselves alternate, so their lengths add up to places.
    """
    both = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values"))

    def placed(x: Column) -> Column:
        steps = F.transform(x["values"], lambda v, i: F.struct(F.length(F.get(x["gaps"], i)).alias("gap"), F.length(v).alias("n")))
        none = F.array().cast("array<int>")
        starts = F.aggregate(
            steps,
            F.struct(F.lit(0).alias("at"), none.alias("starts")),
            lambda acc, s: F.struct((acc["at"] + s["gap"] + s["n"]).alias("at"), F.concat(acc["starts"], F.array(acc["at"] + s["gap"])).alias("starts")),
            lambda acc: acc["starts"],
        )
        return F.zip_with(
            starts, x["values"], lambda s, v: F.struct(s.alias("start"), (s + F.length(v)).alias("end"), v.alias("value"))
        ).cast(KIND)

    return bound(both, placed)


def found(text: Column, pattern: str, hint: Column, keep=None) -> Column:
    """Matches of texts for which ``hint`` holds (a cheap test that every text with a match passes), filtered."""
    every = matches(text, pattern)
    return F.when(hint, F.filter(every, keep) if keep else every).otherwise(F.array().cast(KIND))


def joined(kinds: dict[str, Column]) -> Column:
    """``kind:start:end`` of all spans by start, then in the order of the kinds, joined by commas."""

    def named(kind: str, i: int, spans: Column) -> Column:
        def one(s: Column) -> Column:
            text = F.format_string(f"{kind}:%d:%d", s["start"], s["end"])
            return F.struct(s["start"].alias("start"), F.lit(i).alias("kind"), text.alias("text"))

        return F.transform(spans, one)

    parts = [named(kind, i, spans) for i, (kind, spans) in enumerate(kinds.items())]
    return F.array_join(F.transform(F.array_sort(F.concat(*parts)), lambda s: s["text"]), ",")


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")

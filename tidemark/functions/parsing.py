"""Text to typed values. Bad input becomes NULL, never an error."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The column in which rows carry their place in the files they were read from.
POSITION = "row_position"

# The texts that the usual CSV readers take as "missing".
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Java's double parser also takes "1d", "NaN" or hex; only plain decimal notation counts here.
_DECIMAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


# The white-space characters (Unicode category Zs, line and paragraph separators, controls).
WHITE_SPACE = (
    "\t\n\u000b\f\r\u001c\u001d\u001e\u001f \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Remove every kind of Unicode white space at both ends (``trim`` alone only knows the space)."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def blank_to_null(c: Column) -> Column:
    return F.when(~c.isin(*NULL_TOKENS), c)


def parse_number(c: Column, to: str = "double") -> Column:
    """A number of type ``to``; a whole number may be written ``"3.0"``, another fraction is no integer."""
    if to in ("tinyint", "smallint", "int", "bigint"):
        exact = c.try_cast("decimal(38,10)")
        whole = F.when(exact == F.floor(exact), exact).try_cast(to)
        return F.when(c.rlike(_DECIMAL), F.coalesce(c.try_cast(to), whole))
    return F.when(c.rlike(_DECIMAL), c.try_cast(to))


def parse_amount(c: Column) -> Column:
    """Currency text such as ``"$1,234.50 "``; text that is no number after clean-up is NULL."""
    for sign in "$, ":
        c = F.replace(c, F.lit(sign))
    return parse_number(c)


# What a text must look like to be worth parsing, per field of a date pattern.
_FIELDS = {
    "yyyy": r"\d{4}",
    "M": r"(0?[1-9]|1[0-2])",
    "MM": r"(0[1-9]|1[0-2])",
    "d": r"(0?[1-9]|[12]\d|3[01])",
    "dd": r"(0[1-9]|[12]\d|3[01])",
    "H": r"([01]?\d|2[0-3])",
    "HH": r"([01]\d|2[0-3])",
    "h": r"(0?[1-9]|1[0-2])",
    "hh": r"(0[1-9]|1[0-2])",
    "m": r"[0-5]?\d",
    "mm": r"[0-5]\d",
    "s": r"[0-5]?\d",
    "ss": r"[0-5]\d",
    "a": r"[AaPp][Mm]",
}


def date_shape(fmt: str) -> str | None:
    """Regular expression of the texts a date pattern can read, or None for patterns with other fields."""
    parts = re.findall(r"([A-Za-z])(\1*)|([^A-Za-z]+)", fmt)
    shape = ""
    for letter, rest, literal in parts:
        if literal:
            shape += re.escape(literal)
        elif letter + rest in _FIELDS:
            shape += _FIELDS[letter + rest]
        else:
            return None
    return f"^{shape}$"


def date_class(c: Column, formats: Sequence[str]) -> Column:
    """One text for many: each of the formats reads it if and only if it reads ``c``. NULL is read by none.

    Texts of no format's shape become NULL; minutes and seconds, which are valid whatever the rest says, become zero
    where a colon stands before them. So a table has few classes, however many rows, if its texts are days or times.
    Formats with fields of unknown shape keep every text as it is.
    """
    shapes = [date_shape(f) for f in formats]
    if None in shapes:
        return c
    behind_colon = {m for f in formats for m in re.findall(":(.)", f)}
    small = F.regexp_replace(c, ":[0-5][0-9](?![0-9])", ":00") if behind_colon and behind_colon <= {"m", "s"} else c
    return F.when(c.rlike("|".join(shapes)), small)


def _parsed(c: Column, fmt: str) -> Column:
    """Timestamp or NULL. Texts of the wrong shape skip the parser, whose failures are exceptions and slow."""
    shape = date_shape(fmt)
    parsed = F.try_to_timestamp(c, F.lit(fmt))
    return F.when(c.rlike(shape), parsed) if shape else parsed


def parse_timestamp(c: Column, fmt: str) -> Column:
    return _parsed(c, fmt).cast("timestamp_ntz")


def parse_date(c: Column, fmt: str) -> Column:
    return _parsed(c, fmt).cast("date")


def iso_date(c: Column) -> Column:
    """The day of a text written exactly as yyyy-MM-dd, else NULL."""
    return F.when(c.rlike(date_shape("yyyy-MM-dd")), c.try_cast("date"))


def is_iso_date(c: Column) -> Column:
    """True only for an existing day written exactly as yyyy-MM-dd; NULL input gives false."""
    return iso_date(c).isNotNull()

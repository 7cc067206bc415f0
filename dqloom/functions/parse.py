"""Numbers, dates and flags from dirty text, without errors: what can't be read is null."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import ustrip

#: What counts as a number once a comma is a point. The cast alone would take 1d and NaN.
NUMBER = r"(?i)^[+-]?(?:(?:\d+(?:\.\d*)?|\.\d+)(?:e[+-]?\d+)?|inf(?:inity)?)$"
DATE_WORDS = ["nan", "none", "null", "na", ""]
#: In this order; a slashed date is month first, and day first where that can't be.
DATE_FORMATS = (
    "yyyy-MM-dd HH:mm:ss[.SSSSSS]", "yyyy-MM-dd HH:mm", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]", "yyyy-MM-dd", "yyyy/MM/dd", "yyyyMMdd", "M/d/yyyy", "d/M/yyyy",
    "M/d/yyyy HH:mm:ss", "d/M/yyyy HH:mm:ss", "M-d-yyyy", "d-M-yyyy", "MMM d yyyy", "d MMM yyyy", "yyyy",
)


def to_number(df: DataFrame, name: str) -> Column:
    """Column name of df as a double; numeric columns pass through (NaN as null)."""
    c = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, T.NumericType):
        return F.nanvl(c.cast("double"), F.lit(None).cast("double"))
    return number_from_text(c)


def number_from_text(c: Column) -> Column:
    text = F.replace(ustrip(c.cast("string")), F.lit(","), F.lit("."))
    value = F.when(text.rlike(NUMBER), text)
    infinite = F.when(F.lower(F.regexp_replace(text, r"^[+-]", "")).isin("inf", "infinity"), F.when(text.startswith("-"), float("-inf")).otherwise(float("inf")))
    return F.coalesce(F.when(infinite.isNull(), value.try_cast("double")), infinite)


def to_time(df: DataFrame, name: str) -> Column:
    """Column name of df as a timestamp; dates and timestamps pass through."""
    c = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp")
    return time_from_text(c)


def time_from_text(c: Column) -> Column:
    text = ustrip(c.cast("string"))
    text = F.when(~F.lower(text).isin(DATE_WORDS), text)
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in DATE_FORMATS])


def to_day(df: DataFrame, name: str) -> Column:
    return F.to_date(to_time(df, name))


def says(c: Column, word: str) -> Column:
    """Whether a value is this word, whatever its case and outer white space; null is not."""
    return F.coalesce(F.upper(ustrip(c.cast("string"))) == word.upper(), F.lit(False))


def is_token(c: Column, tokens: list[str]) -> Column:
    """Whether a value, null counting as empty, is one of the upper-case tokens."""
    return F.upper(ustrip(F.coalesce(c.cast("string"), F.lit("")))).isin(tokens)


def tagged(c: Column, tag: str = "OUTLIER") -> Column:
    """Whether c is the tag; null is not."""
    return F.coalesce(c == tag, F.lit(False))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole, whole at least 1, rounded half to even."""
    return F.bround(100.0 * part / F.greatest(whole, F.lit(1)), digits)


def number_text(c: Column) -> Column:
    """A double as Python writes it, for texts: 100000000.0 rather than 1.0E8."""
    plain = F.regexp_replace(F.format_string("%.6f", c), r"(\.\d+?)0+$", "$1")
    return F.when(c.isNull(), F.lit("nan")).when((F.abs(c) < 1e16) & (F.bround(c, 6) == c), plain).otherwise(F.lower(c.cast("string")))


def names_where(pairs: list[tuple[str, Column]]) -> Column:
    """The names whose condition holds, in order, joined by a comma."""
    return F.concat_ws(", ", *[F.when(cond, F.lit(name)) for name, cond in pairs])


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))

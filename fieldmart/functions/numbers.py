"""Parsing and arithmetic that returns null instead of failing (ANSI mode is on)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldmart.functions.text import squeeze, strip, trim_spaces

# Texts the weather bulletins use for "no value".
MISSING_MARKERS = ["", "n/a", "na", "--", "-", "nil", "nd", "nan", "none"]

# Anything but the characters of a decimal number: Spark's own cast also takes Java
# spellings such as '1d', '0x1p3' or 'Infinity'.
NOT_DECIMAL = r"[^0-9.eE+-]"


def to_number(value: Column) -> Column:
    """Text to double, null when it is no number."""
    return parsed_number(strip(value.cast("string")))


def parsed_number(text: Column) -> Column:
    """An already trimmed text to double."""
    return F.when(~text.rlike(NOT_DECIMAL), text.try_cast("double"))


def to_whole(value: Column) -> Column:
    """Text to a nullable long; '28.0' is 28, '28.5' is null."""
    return whole_number(to_number(value))


def whole_number(number: Column) -> Column:
    return F.when(number == F.floor(number), number.try_cast("long"))


def to_day(value: Column) -> Column:
    """Text or timestamp to a date, null when unparseable."""
    return value.try_cast("date")


def bulletin_number(value: Column) -> Column:
    """Bulletin figure to double: missing markers are null, '%' and ',' are dropped."""
    text = trim_spaces(value.cast("string"))
    bare = trim_spaces(F.replace(F.regexp_replace(text, "%+$", ""), F.lit(","), F.lit("")))
    missing = F.lower(text).isin(MISSING_MARKERS)
    return F.when(~missing & ~bare.rlike(NOT_DECIMAL), bare.try_cast("double"))


def crop_year_start(year: Column) -> Column:
    """'1997-1998' -> 1997; null without four leading digits."""
    digits = F.regexp_extract(squeeze(year.cast("string")), r"^(\d{4,})", 1)
    return digits.try_cast("int")


def pct_change(latest: Column, baseline: Column) -> Column:
    """Percent change against a baseline, null for a null or zero baseline."""
    return F.try_divide(latest - baseline, baseline) * 100.0


def mean_of(total: Column, n: Column) -> Column:
    return F.try_divide(total, n)

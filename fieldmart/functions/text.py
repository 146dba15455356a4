"""Text cleaning, match keys and display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Currency text of the published reports.
RUPEE = "₹"
LAKH = 100_000.0
CRORE = 10_000_000.0


# Every character Unicode counts as white space, and the four separators U+001C-U+001F.
SPACES = ("\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
          "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def trim_spaces(text: Column) -> Column:
    """Trim every Unicode space, not only U+0020 as plain `trim` does."""
    return F.trim(text, F.lit(SPACES))


def finish_trim(trimmed: Column) -> Column:
    """Complete a plain `trim`: only texts with other than visible ASCII at an end need more.

    Two byte comparisons tell, so the slow character-set trim sees few rows.
    """
    done = trimmed.between("!", "\x7f") & F.substring(trimmed, -1, 1).between("!", "~")
    return F.when(done, trimmed).otherwise(trim_spaces(trimmed))


def strip(text: Column) -> Column:
    """`trim_spaces` for plain columns, several times faster on ordinary texts.

    The input is repeated in the expression, so composed expressions use `trim_spaces`.
    """
    return finish_trim(F.trim(text))


def squeeze(text: Column) -> Column:
    """Trim and collapse runs of whitespace to one space."""
    return F.regexp_replace(trim_spaces(text), r"(?U)\s+", " ")


def match_key(text: Column) -> Column:
    """Case- and whitespace-insensitive key for exact name matching."""
    return F.lower(squeeze(F.coalesce(text, F.lit(""))))


def location_key(text: Column) -> Column:
    """Upper-case key without any whitespace: 'Kanpur Nagar' -> 'KANPURNAGAR'."""
    return F.upper(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", ""))


def one_line(text: Column) -> Column:
    """Line breaks become one space; null becomes ''."""
    return F.coalesce(trim_spaces(F.regexp_replace(text, r"[\r\n]+", " ")), F.lit(""))


def first_filled(*texts: Column) -> Column:
    """The first non-empty text; the last one as it is when all are empty."""
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in texts[:-1]], texts[-1])


def indian_number(value: Column, decimals: int = 0) -> Column:
    """Indian digit grouping, half-up rounding: 1234567 -> '12,34,567'."""
    amount = value.cast(f"decimal(38,{decimals})")
    plain = F.abs(amount).cast("string")
    whole = F.substring_index(plain, ".", 1)
    grouped = F.regexp_replace(whole, r"(\d)(?=(\d\d)+\d$)", "$1,")
    if decimals:
        grouped = F.concat(grouped, F.lit("."), F.substring_index(plain, ".", -1))
    return F.concat(F.when(amount < 0, "-").otherwise(""), grouped)


def rupees(value: Column, decimals: int = 0) -> Column:
    return F.concat(F.lit(RUPEE), indian_number(value, decimals))


def rupees_per_quintal(value: Column, decimals: int = 0) -> Column:
    return F.concat(rupees(value, decimals), F.lit(" / quintal"))


def rupees_compact(value: Column, decimals: int = 1) -> Column:
    """Rupees with lakh (1e5) and crore (1e7) as units of account."""
    size = F.abs(value)
    return (
        F.when(size >= CRORE, F.concat(rupees(value / CRORE, decimals), F.lit(" crore")))
        .when(size >= LAKH, F.concat(rupees(value / LAKH, decimals), F.lit(" lakh")))
        .otherwise(rupees(value))
    )


def place_label(district: Column, state: Column) -> Column:
    return F.concat(district, F.lit(" ("), state, F.lit(")"))


def hierarchy_label(region: Column, state: Column, mandi: Column) -> Column:
    """'Nashik (Maharashtra) -- APMC Nashik'; empty levels are left out."""
    place = F.when(F.coalesce(state, F.lit("")) != "", place_label(region, state)).otherwise(region)
    market = F.when(F.coalesce(mandi, F.lit("")) != "", F.concat(F.lit("APMC "), mandi))
    return F.concat_ws(" -- ", place, market)


def period_label(start: Column, end: Column) -> Column:
    first, last = start.cast("date").cast("string"), end.cast("date").cast("string")
    return F.when(first == last, first).otherwise(F.concat(first, F.lit(" → "), last))

"""Text clean-up and matching."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Title fragments that mark a line as sold by weight.
VARIABLE_WEIGHT_KEYWORDS = (
    "per lb",
    "per pound",
    "per kg",
    "/lb",
    "/kg",
    "variable",
    "by weight",
    "custom weight",
    "temp",
)

# The characters that count as white space.
WHITE_SPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def trim_ws(c: Column) -> Column:
    """Strip every kind of white space from both ends; plain trim() strips spaces only."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_filled(*columns: Column, default: str | None = None) -> Column:
    """First column that is neither null nor empty."""
    filled = [blank_to_null(c) for c in columns]
    return F.coalesce(*filled, F.lit(default)) if default is not None else F.coalesce(*filled)


def normal_email(c: Column) -> Column:
    """Trimmed lower-case address, or null when nothing is left."""
    return blank_to_null(F.lower(trim_ws(c)))


def full_name(first: Column, last: Column) -> Column:
    joined = F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit("")))
    return first_filled(trim_ws(joined), default="Unknown")


def contains_any(c: Column, fragments: Sequence[str]) -> Column:
    """True when the lower-cased text holds one of the fragments; null text is false."""
    lowered = F.lower(c)
    hit = reduce(lambda a, b: a | b, [lowered.contains(f) for f in fragments], F.lit(False))
    return F.coalesce(hit, F.lit(False))


def is_variable_weight(
    title: Column, keywords: Sequence[str] = VARIABLE_WEIGHT_KEYWORDS
) -> Column:
    return contains_any(title, keywords)

"""Money and counts. Arithmetic is decimal; tables hold doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.text import trim_ws

# 18 digits fit a long, so sums and products stay in Spark's compact decimal form.
MONEY = T.DecimalType(18, 4)

# Letters the JVM takes as part of a number (1d, NaN, Infinity, 0x1p3); only e is one here.
_JVM_LETTERS = "dDfFiInNpPxXyY"


def money(c: Column) -> Column:
    """Strict: text that is no number fails the job."""
    return c.cast(MONEY)


def money_or_zero(c: Column) -> Column:
    return F.coalesce(money(c), F.lit(0).cast(MONEY))


def count_or_zero(c: Column) -> Column:
    return F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint"))


def tolerant_double(c: Column) -> Column:
    """Number with optional thousands commas; blank or malformed text is null."""
    # translate() maps the letters to a sign no number holds and deletes the commas; most texts hold
    # nothing but digits, where looking for commas is enough
    plain = F.translate(c, _JVM_LETTERS + ",", "#" * len(_JVM_LETTERS))
    digits = F.when(c.rlike(r"\A[0-9.,]++\z"), F.replace(c, F.lit(","), F.lit("")))
    return digits.otherwise(trim_ws(plain)).try_cast("double")


def to_double(c: Column, places: int = 2) -> Column:
    """Round half up, then leave the decimal world."""
    return F.round(c, places).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, 0 when the denominator is 0 or missing."""
    return F.coalesce(
        F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0)
    )

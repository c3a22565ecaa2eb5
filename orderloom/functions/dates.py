"""Dates, instants and months."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.functions.text import trim_ws

# Date layouts of the accounting reports, each with its ISO order.
REPORT_DATE_LAYOUTS = {
    r"\A(\d{1,2})/(\d{1,2})/(\d{4})\z": "$3-$1-$2",
    r"\A(\d{1,2})/(\d{1,2})/(\d{2})\z": "20$3-$1-$2",
}
_ISO_DATE = r"\A(\d{4}-\d{1,2}-\d{1,2})\z"
_SLASHED = r"\A\d{1,2}/\d{1,2}/\d{4}\z"

ISO_INSTANT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def report_date(c: Column) -> Column:
    """Date in any of the report layouts, null when none fits. Two-digit years are 20xx.

    Layouts are rewritten to ISO and cast: a pattern parser would throw, and catch, an
    exception for every text that does not fit.
    """
    iso = trim_ws(c)
    for layout, order in REPORT_DATE_LAYOUTS.items():
        iso = F.regexp_replace(iso, layout, order)
    rewritten = F.regexp_extract(iso, _ISO_DATE, 1)
    # the two common layouts, by plain text search
    month_day, year = F.substring_index(c, "/", 2), F.substring_index(c, "/", -1)
    month, day = F.substring_index(month_day, "/", 1), F.substring_index(month_day, "/", -1)
    slashed = F.concat_ws("-", year, month, day)
    text = F.when(c.rlike(_SLASHED), slashed).when(c.rlike(_ISO_DATE), c).otherwise(rewritten)
    return text.try_cast("date")


def instant(c: Column) -> Column:
    """ISO-8601 text to timestamp; malformed text fails the job."""
    return F.to_timestamp(c)


def iso_text(c: Column) -> Column:
    return F.date_format(c, ISO_INSTANT)


def month_of(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")

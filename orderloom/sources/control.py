"""Control row: the watermark of the last successful run, and the read window after it."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.schemas import PIPELINE_CONTROL

WATERMARK_KEY = "nightly_watermark"
OVERLAP = timedelta(hours=1)
FIRST_RUN_DAYS = 30

_ISO = "%Y-%m-%dT%H:%M:%SZ"


def read_watermark(control: DataFrame, key: str = WATERMARK_KEY) -> str | None:
    """ISO text of the stored watermark, None before the first run. Fetches one value."""
    stored = (
        control.where(F.col("control_key") == key)
        .limit(1)
        .select(F.date_format("last_successful_watermark", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .first()
    )
    return stored[0] if stored else None


def cutoff(
    since: str | None = None, days_back: int | None = FIRST_RUN_DAYS, now: datetime | None = None
) -> str | None:
    """Start of the read window: `since`, else the last `days_back` days, else no limit."""
    if since is not None:
        return since
    if days_back is None:
        return None
    return ((now or datetime.now(timezone.utc)) - timedelta(days=days_back)).strftime(_ISO)


def next_cutoff(watermark: str | None, now: datetime | None = None) -> str:
    """One hour before the watermark, or 30 days back on the first run.

    Rows of the overlap are read twice; the keyed load makes that harmless.
    """
    if watermark is None:
        return cutoff(days_back=FIRST_RUN_DAYS, now=now)
    return (datetime.strptime(watermark, _ISO) - OVERLAP).strftime(_ISO)


def control_row(
    spark: SparkSession,
    watermark: str,
    order_count: int,
    key: str = WATERMARK_KEY,
    now: Column | None = None,
) -> DataFrame:
    """The row to load into pipeline_control after a run whose loads all succeeded."""
    row = spark.createDataFrame([(key, watermark, order_count)], "k string, w string, n bigint")
    return row.select(
        F.col("k").alias("control_key"),
        F.to_timestamp("w").alias("last_successful_watermark"),
        (F.current_timestamp() if now is None else now).alias("last_run_at"),
        F.col("n").alias("last_run_order_count"),
    ).select(*PIPELINE_CONTROL.names)

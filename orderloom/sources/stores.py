"""Store reference data: rows the caller gives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from orderloom.schemas import DIM_STORES


def dim_stores(spark: SparkSession, stores: Sequence[tuple]) -> DataFrame:
    """One row per store: id, name, entity, channel, instance."""
    return spark.createDataFrame(list(stores), DIM_STORES)

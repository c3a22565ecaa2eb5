"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in the given order, ties broken by the remaining columns.

    Spark prunes to one row per key before the shuffle (WindowGroupLimit), so a key that
    holds a large share of the rows does not pile up in one task.
    """
    rest = [F.col(c) for c in sorted(df.columns) if c not in keys and _sortable(df, c)]
    window = Window.partitionBy(*keys).orderBy(*([*order, *rest] or keys))
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], version: str | None) -> DataFrame:
    """Latest row of each key; without a version column any stable choice."""
    order = [F.col(version).desc_nulls_last()] if version else []
    return one_per_key(df, keys, order)


def fresh_key(key: Column) -> Column:
    """The same text under a partitioning of its own, for a join after one_per_key().

    Spark splits hot keys of a join only if both inputs come straight from a shuffle. A
    deduplicated input that is still partitioned by the key is not shuffled again and would
    leave the hot keys of the other side in one task.
    """
    return F.concat(key, F.lit(""))


def _sortable(df: DataFrame, column: str) -> bool:
    return "map<" not in df.schema[column].dataType.simpleString()

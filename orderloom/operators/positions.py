"""Order-dependent operators over files: fill-forward and dense numbering.

A file may hold a large share of all rows, so no window spans a whole file. Rows carry a
chunk (for text files the input split, which Spark bounds by maxPartitionBytes). Windows
run inside chunks; one small row per chunk carries the state on to the next chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fill_forward(
    df: DataFrame,
    value: Column,
    alias: str,
    group: Sequence[str],
    chunk: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """Adds `alias`: the latest non-null `value` at or before each row of its group."""
    df = df.withColumn("_value", value)
    position = F.struct(*order)
    last_seen = df.groupBy(*group, *chunk).agg(
        F.max_by("_value", F.when(F.col("_value").isNotNull(), position)).alias("_last")
    )
    earlier = (
        Window.partitionBy(*group)
        .orderBy(*chunk)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = last_seen.select(
        *group, *chunk, F.last("_last", ignorenulls=True).over(earlier).alias("_carried")
    )
    inside = (
        Window.partitionBy(*group, *chunk)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        df.join(carried, [*group, *chunk])
        .withColumn(
            alias,
            F.coalesce(F.last("_value", ignorenulls=True).over(inside), F.col("_carried")),
        )
        .drop("_value", "_carried")
    )


def dense_sequence(
    df: DataFrame, alias: str, group: Sequence[str], chunk: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Adds `alias`: 0-based position of each row in its group, or overall if `group` is empty.

    Running totals are taken in two levels, over the chunks of a file (all columns of `chunk`
    but the last) and over the files of a group, so no window sees all chunks: without a group
    the upper one has one row per file.
    """
    file, last = list(chunk[:-1]), chunk[-1]
    sizes = df.groupBy(*group, *chunk).agg(F.count(F.lit(1)).alias("_size"))

    def before(size: str, within: Sequence[str], order: Sequence[str]) -> Column:
        earlier = Window.partitionBy(*within).orderBy(*order)
        earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(size).over(earlier), F.lit(0))

    in_file = before("_size", [*group, *file], [last])
    if file:
        files = sizes.groupBy(*group, *file).agg(F.sum("_size").alias("_file_size"))
        starts = files.select(*group, *file, before("_file_size", group, file).alias("_start"))
        chunks = sizes.select(*group, *chunk, in_file.alias("_in_file")).join(starts, [*group, *file])
        offset = F.col("_start") + F.col("_in_file")
    else:
        chunks, offset = sizes, in_file
    names = [*group, *chunk]
    offsets = chunks.select(*names, offset.alias("_offset"))
    inside = Window.partitionBy(*group, *chunk).orderBy(*order)
    return (
        df.join(offsets, names)
        .withColumn(alias, F.col("_offset") + F.row_number().over(inside) - 1)
        .drop("_offset")
    )

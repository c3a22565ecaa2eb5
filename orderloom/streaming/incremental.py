"""Micro-batches of landed files merged into a keyed table.

The checkpoint holds the progress, so no control row is needed. Every table notes the last batch
of a stream in the step that makes the batch visible, so a batch that runs again after a crash is
applied once to each table. No event-time state is kept: the version column absorbs late rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from orderloom.schemas import BULK_RECORD, page_schema
from orderloom.sinks.warehouse import Warehouse
from orderloom.sources.pages import READ_MODE, unnest

#: Spark's name for the id of the streaming query that runs a job.
QUERY_ID = "sql.streaming.queryId"


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str = "json",
    files_per_batch: int | None = None,
) -> DataFrame:
    """New files below `path`; `files_per_batch` bounds the size of one batch."""
    reader = spark.readStream.schema(schema).format(file_format)
    if file_format == "json":
        reader = reader.option("mode", READ_MODE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def stream_pages(spark: SparkSession, path: str, entity: str, **options) -> DataFrame:
    return unnest(stream_files(spark, path, page_schema(entity), **options), entity)


def stream_bulk(spark: SparkSession, path: str, **options) -> DataFrame:
    return stream_files(spark, path, BULK_RECORD, **options)


def upsert_stream(
    stream: DataFrame,
    warehouse: Warehouse,
    loads: dict[str, Callable[[DataFrame], DataFrame]],
    checkpoint: str,
) -> StreamingQuery:
    """Start loading every batch into the tables of `loads`, then stop at the end of input.

    `loads` maps a table to the transform that makes its rows from a raw batch. A batch that
    is run again after a failure goes only to the tables it had not reached.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        # the id stays with the checkpoint, also over restarts
        stream_id = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID) or checkpoint
        for table, transform in loads.items():
            warehouse.upsert(table, transform(batch), batch=(stream_id, batch_id))

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

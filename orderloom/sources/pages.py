"""Landed API pages: one JSON document per page, unnested to one entity per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.dates import instant
from orderloom.schemas import page_schema

READ_MODE = "FAILFAST"


def unnest(pages: DataFrame, entity: str) -> DataFrame:
    """data.<entity>.edges[].node, one row per node."""
    edges = pages.select(F.explode(F.col(f"data.{entity}.edges")).alias("edge"))
    return edges.select("edge.node.*")


def read_pages(
    spark: SparkSession,
    path: str | list[str],
    entity: str,
    multi_line: bool = False,
    landed_after: str | None = None,
) -> DataFrame:
    """Raw entities of all landed pages below `path`.

    Files hold one page per line, which keeps large files splittable; `multi_line` reads
    files that hold one indented document each. `landed_after` (ISO, UTC) leaves older files
    unopened.
    """
    reader = spark.read.schema(page_schema(entity)).option("mode", READ_MODE)
    if landed_after is not None:
        reader = reader.option("modifiedAfter", landed_after.rstrip("Z")).option("timeZone", "UTC")
    return unnest(reader.option("multiLine", multi_line).json(path), entity)


def parse_pages(texts: DataFrame, column: str, entity: str) -> DataFrame:
    """Same for pages held as text in a column."""
    page = F.from_json(F.col(column), page_schema(entity), {"mode": READ_MODE})
    return unnest(texts.select(page.alias("page")).select("page.*"), entity)


def updated_since(
    raw: DataFrame, cutoff: str | None, column: str = "updatedAt"
) -> DataFrame:
    """Rows updated at or after the cutoff; no cutoff keeps everything.

    The cutoff is cast to the type of the column, so on columnar input the filter reaches
    the scan.
    """
    if cutoff is None:
        return raw
    dtype = raw.schema[column].dataType
    if dtype == T.StringType():
        return raw.where(instant(F.col(column)) >= F.lit(cutoff).cast("timestamp"))
    return raw.where(F.col(column) >= F.lit(cutoff).cast(dtype))

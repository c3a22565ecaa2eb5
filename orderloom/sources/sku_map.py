"""Mapping base: product name or raw SKU to canonical SKU, and the MASTER records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.text import first_filled, trim_ws
from orderloom.operators.dedup import one_per_key
from orderloom.schemas import (
    MASTER_PAGE,
    SKU_CODE_FIELDS,
    SKU_MAP,
    SKU_MAP_PAGE,
    SKU_NAME_FIELDS,
)
from orderloom.sources.pages import READ_MODE


def sku_map(pages: DataFrame, *page_order: str) -> DataFrame:
    """(name, canonical_sku), one row per name; the last record in page order wins."""
    rows = pages.select(*page_order, F.posexplode("records").alias("pos", "record"))

    def either(names: tuple[str, ...]):
        return first_filled(*[F.col("record.fields").getField(n) for n in names])

    pairs = rows.select(
        *page_order,
        "pos",
        either(SKU_NAME_FIELDS).alias("name"),
        either(SKU_CODE_FIELDS).alias("canonical_sku"),
    ).where("name IS NOT NULL AND canonical_sku IS NOT NULL")
    trimmed = pairs.withColumns(
        {"name": trim_ws(F.col("name")), "canonical_sku": trim_ws(F.col("canonical_sku"))}
    )
    order = [F.col(c).desc() for c in (*page_order, "pos")]
    return one_per_key(trimmed, ["name"], order).select("name", "canonical_sku")


def read_sku_map(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Landed mapping pages, one JSON document per line, in file and line order."""
    pages = (
        spark.read.schema(SKU_MAP_PAGE)
        .option("mode", READ_MODE)
        .json(path)
        .select(
            "records",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq"),
        )
    )
    return sku_map(pages, "file", "block", "seq")


def parse_sku_map(texts: DataFrame, column: str, *page_order: str) -> DataFrame:
    """Same for pages held as text in a column."""
    page = F.from_json(F.col(column), SKU_MAP_PAGE, {"mode": READ_MODE})
    return sku_map(texts.select(*page_order, page["records"].alias("records")), *page_order)


def empty_sku_map(spark: SparkSession) -> DataFrame:
    """The mapping base is optional; without it products fall back to their own SKU."""
    return spark.createDataFrame([], SKU_MAP)


def read_master(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """MASTER product records: id and all fields as a map."""
    pages = spark.read.schema(MASTER_PAGE).option("mode", READ_MODE).json(path)
    return pages.select(F.explode("records").alias("record")).select("record.*")

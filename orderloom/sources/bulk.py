"""Bulk export: JSON lines mixing orders (parents) and line items (children)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.schemas import BULK_RECORD
from orderloom.sources.pages import READ_MODE

PARENT_COLUMNS = (
    "id",
    "name",
    "createdAt",
    "updatedAt",
    "displayFinancialStatus",
    "displayFulfillmentStatus",
    "totalPriceSet",
    "subtotalPriceSet",
    "totalDiscountsSet",
    "totalRefundedSet",
    "customer",
)
CHILD_KEY = r'[{,\s]"__parentId"\s*:\s*"'
CHILD_COLUMNS = ("__parentId", "id", "title", "quantity", "variant")


def read_bulk(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every record of the export; blank lines are skipped, a malformed line fails the job."""
    return spark.read.schema(BULK_RECORD).option("mode", READ_MODE).json(path)


def parse_bulk(texts: DataFrame, column: str) -> DataFrame:
    """Same for records held as text in a column."""
    record = F.from_json(F.col(column), BULK_RECORD, {"mode": READ_MODE})
    # inline() is no projection, so a later filter on a field does not parse the text a second time
    return texts.where(F.trim(column) != "").select(F.inline(F.array(record)))


def parse_sides(texts: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(parents, children) of records held as text, without parsing a record for both sides.

    The text tells most records apart: an unescaped key with a text value makes a child (nested
    objects of the export have no such key), a text without that name makes a parent. Only texts
    in between, such as a null parent id, a title that names the key or an escaped letter, are
    parsed for both and told apart by what they hold.
    """
    text = F.col(column)
    # plain text search first: most parents do not get as far as the pattern
    is_child = text.contains("__parentId") & text.rlike(CHILD_KEY)
    may_be_child = text.contains("__parentId") | text.contains("\\u00")
    return (
        parents(parse_bulk(texts.where(~is_child), column)),
        children(parse_bulk(texts.where(may_be_child), column)),
    )


def read_sides(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(parents, children) of an export, see parse_sides()."""
    return parse_sides(spark.read.text(path), "value")


def parents(records: DataFrame) -> DataFrame:
    return records.where(F.col("__parentId").isNull()).select(*PARENT_COLUMNS)


def children(records: DataFrame) -> DataFrame:
    return records.where(F.col("__parentId").isNotNull()).select(*CHILD_COLUMNS)

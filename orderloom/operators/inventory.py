"""Inventory levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Quantity names the inventory feed delivers.
QUANTITY_NAMES = ("available", "on_hand")


def _quantity(name: str) -> Column:
    named = F.filter("level.quantities", lambda q: q["name"] == name)
    return F.try_element_at(named, F.lit(1))["quantity"]


def inventory_levels(raw: DataFrame) -> DataFrame:
    """One row per item and location with its quantities side by side.

    The quantities of a level arrive in one array, so the pivot needs no shuffle.
    """
    levels = raw.select(
        F.col("id").alias("item_id"),
        "sku",
        "tracked",
        F.explode("inventoryLevels.edges.node").alias("level"),
    )
    return levels.select(
        "item_id",
        "sku",
        "tracked",
        F.col("level.id").alias("level_id"),
        F.col("level.location.id").alias("location_id"),
        F.col("level.location.name").alias("location_name"),
        *[_quantity(name).alias(name) for name in QUANTITY_NAMES],
    )


def sample_item(raw: DataFrame) -> DataFrame:
    """One item with levels if there is one, else any; stable by id."""
    return raw.orderBy(F.size("inventoryLevels.edges") <= 0, "id").limit(1)

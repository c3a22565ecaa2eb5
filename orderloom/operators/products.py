"""Products and variants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.dates import instant
from orderloom.functions.numbers import count_or_zero, money_or_zero
from orderloom.functions.text import first_filled, trim_ws
from orderloom.operators.dedup import fresh_key
from orderloom.operators.orders import STORE


def dim_products(raw: DataFrame, sku_map: DataFrame, store: str = STORE) -> DataFrame:
    """One row per variant with its canonical SKU.

    The SKU is looked up by product title, then by the variant's SKU, else the variant's own
    SKU stays; null marks an unmapped variant. `sku_map` holds one row per name, so lookups
    never multiply rows; Spark broadcasts it when its size allows.
    """
    variants = raw.select("*", F.explode("variants.edges").alias("edge")).drop("variants")
    by_title = sku_map.select(
        fresh_key(F.col("name")).alias("_title"), F.col("canonical_sku").alias("_sku_by_title")
    )
    by_sku = sku_map.select(
        fresh_key(F.col("name")).alias("_raw_sku"), F.col("canonical_sku").alias("_sku_by_sku")
    )
    looked_up = (
        variants.withColumns(
            {"_title": trim_ws(F.col("title")), "_raw_sku": trim_ws(F.col("edge.node.sku"))}
        )
        .join(by_title, "_title", "left")
        .join(by_sku, "_raw_sku", "left")
    )
    weight = "edge.node.inventoryItem.measurement.weight"
    return looked_up.select(
        F.col("id").alias("shopify_product_id"),
        F.col("edge.node.id").alias("shopify_variant_id"),
        F.col("title").alias("raw_name"),
        first_filled(
            F.col("_sku_by_title"), F.col("_sku_by_sku"), F.col("edge.node.sku")
        ).alias("canonical_sku"),
        F.col("edge.node.title").alias("variant_title"),
        money_or_zero(F.col("edge.node.price")).cast("double").alias("price"),
        count_or_zero(F.col("edge.node.inventoryQuantity")).alias("inventory_quantity"),
        F.col(f"{weight}.value").alias("weight_value"),
        F.col(f"{weight}.unit").alias("weight_unit"),
        F.col("productType").alias("product_type"),
        "vendor",
        "status",
        instant(F.col("createdAt")).alias("created_at"),
        instant(F.col("updatedAt")).alias("updated_at"),
        F.lit(store).alias("store"),
    )


def mapped(products: DataFrame) -> DataFrame:
    return products.where(F.col("canonical_sku").isNotNull())


def unmapped(products: DataFrame) -> DataFrame:
    return products.where(F.col("canonical_sku").isNull())

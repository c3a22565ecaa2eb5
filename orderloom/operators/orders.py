"""Orders and order lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from orderloom.functions.dates import instant
from orderloom.functions.numbers import MONEY, money, money_or_zero, to_double
from orderloom.functions.text import (
    VARIABLE_WEIGHT_KEYWORDS,
    first_filled,
    is_variable_weight,
    normal_email,
)
from orderloom.operators.dedup import fresh_key, latest_per_key

STORE = "main_store"
ONLINE = "online"

# Orders of 0 are drafts and shipping labels; anything up to 1 is no real sale either.
MIN_TOTAL = 1


def order_total() -> Column:
    return money(F.col("totalPriceSet.shopMoney.amount"))


def real_sales(raw: DataFrame, min_total: float = MIN_TOTAL) -> DataFrame:
    return raw.where(order_total() > F.lit(min_total).cast(MONEY))


def filter_counts(min_total: float = MIN_TOTAL) -> list[Column]:
    """Aggregates that tell what real_sales() keeps and drops."""
    total = order_total()
    limit = F.lit(min_total).cast(MONEY)
    return [
        F.count(F.lit(1)).alias("orders_read"),
        F.count_if(total == 0).alias("zero_orders"),
        F.count_if((total != 0) & (total <= limit)).alias("small_orders"),
        F.count_if(total > limit).alias("kept_orders"),
    ]


def filter_audit(raw: DataFrame, min_total: float = MIN_TOTAL) -> DataFrame:
    return raw.agg(*filter_counts(min_total))


def observe_filter(
    raw: DataFrame, observation: Observation, min_total: float = MIN_TOTAL
) -> DataFrame:
    """Collects the filter counts while the rows pass by, without a pass of its own."""
    return raw.observe(observation, *filter_counts(min_total))


def fact_orders(
    raw: DataFrame, store: str = STORE, channel: str = ONLINE, min_total: float = MIN_TOTAL
) -> DataFrame:
    """One row per real sale, plus updated_at, which only the load uses."""
    return real_sales(raw, min_total).select(
        F.col("id").alias("order_id"),
        F.col("name").alias("order_name"),
        instant(F.col("createdAt")).alias("created_at"),
        F.col("displayFinancialStatus").alias("financial_status"),
        F.col("displayFulfillmentStatus").alias("fulfillment_status"),
        order_total().cast("double").alias("total_revenue"),
        money(F.col("subtotalPriceSet.shopMoney.amount")).cast("double").alias("subtotal"),
        F.col("totalPriceSet.shopMoney.currencyCode").alias("currency"),
        F.col("customer.id").alias("customer_id"),
        F.col("customer.email").alias("customer_email"),
        F.lit(store).alias("store"),
        F.lit(channel).alias("channel"),
        money_or_zero(F.col("totalDiscountsSet.shopMoney.amount"))
        .cast("double")
        .alias("discount_amount"),
        money_or_zero(F.col("totalRefundedSet.shopMoney.amount"))
        .cast("double")
        .alias("refund_amount"),
        instant(F.col("updatedAt")).alias("updated_at"),
    )


def fill_email(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Live order queries carry the customer id only; take the address from the customers."""
    known = customers.select(
        F.col("customer_id"), F.col("email").alias("_known_email")
    ).where(F.col("customer_id").isNotNull())
    return (
        orders.join(known, "customer_id", "left")
        .withColumn("customer_email", first_filled(F.col("customer_email"), F.col("_known_email")))
        .select(*orders.columns)
    )


def _line(node: str, store: str) -> list[Column]:
    price = F.coalesce(money(F.col(f"{node}variant.price")), F.lit(0).cast(MONEY))
    quantity = F.col(f"{node}quantity").cast("bigint")
    return [
        F.col(f"{node}id").alias("line_item_id"),
        F.col(f"{node}title").alias("product_title"),
        F.col(f"{node}variant.id").alias("variant_id"),
        F.col(f"{node}variant.sku").alias("sku"),
        quantity.alias("quantity"),
        price.cast("double").alias("unit_price"),
        # unit_price is the list price of the variant, not the price paid
        to_double(quantity * price).alias("line_revenue"),
        F.lit(store).alias("store"),
    ]


def _parent(columns: Sequence[str]) -> list[Column]:
    named = {
        "order_id": F.col("id"),
        "order_created_at": instant(F.col("createdAt")),
        "updated_at": instant(F.col("updatedAt")),
    }
    return [named[c].alias(c) for c in columns]


# Carried next to the line columns: the load lays lines out by the month of their order.
PARENT_COLUMNS = ("order_id", "order_created_at", "updated_at")


def lines_of_nested(
    raw: DataFrame, store: str = STORE, min_total: float = MIN_TOTAL
) -> DataFrame:
    """Line rows of orders that carry their lines nested."""
    nodes = real_sales(raw, min_total).select(
        *_parent(PARENT_COLUMNS), F.explode("lineItems.edges").alias("edge")
    )
    return nodes.select(*PARENT_COLUMNS, *_line("edge.node.", store))


def lines_of_bulk(
    parents: DataFrame,
    children: DataFrame,
    store: str = STORE,
    min_total: float = MIN_TOTAL,
) -> DataFrame:
    """Line rows of a bulk export: children of kept parents; orphans find no partner.

    The nested order is never rebuilt, the line table needs nothing but the parent id. One
    order may hold very many lines: parents are unique, so Spark can split the child side.
    """
    latest = latest_per_key(
        real_sales(parents, min_total).select(*_parent(PARENT_COLUMNS)),
        ["order_id"],
        "updated_at",
    ).withColumn("order_id", fresh_key(F.col("order_id")))
    rows = children.select(F.col("__parentId").alias("order_id"), *_line("", store))
    return rows.join(latest, "order_id").select(
        *PARENT_COLUMNS, *[c for c in rows.columns if c != "order_id"]
    )


def orphan_lines(parents: DataFrame, children: DataFrame) -> DataFrame:
    """Children whose parent is not in the export."""
    return children.join(
        parents.select(F.col("id").alias("__parentId")), "__parentId", "left_anti"
    )


def reconcile_bulk(records: DataFrame) -> DataFrame:
    """One row: records, orders, line items kept and orphans of a bulk export.

    Each order id is folded to one row before parents and children meet, in a single
    aggregation over the export.
    """
    is_child = F.col("__parentId").isNotNull()
    per_order = records.groupBy(F.coalesce("__parentId", "id").alias("order_id")).agg(
        F.count_if(~is_child).alias("parents"), F.count_if(is_child).alias("children")
    )
    def total(c):
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    return per_order.agg(
        total(F.col("parents") + F.col("children")).alias("records"),
        total("parents").alias("orders"),
        total(F.when(F.col("parents") > 0, F.col("children"))).alias("line_items"),
        total(F.when(F.col("parents") == 0, F.col("children"))).alias("orphans"),
    )


def flag_variable_weight(
    lines: DataFrame, keywords: Sequence[str] = VARIABLE_WEIGHT_KEYWORDS
) -> DataFrame:
    return lines.withColumn(
        "is_variable_weight", is_variable_weight(F.col("product_title"), keywords)
    )


def split_variable_weight(
    lines: DataFrame, keywords: Sequence[str] = VARIABLE_WEIGHT_KEYWORDS
) -> tuple[DataFrame, DataFrame]:
    """(standard, variable) views of the flagged lines; their union is the flagged table."""
    flagged = flag_variable_weight(lines, keywords)
    return flagged.where("NOT is_variable_weight"), flagged.where("is_variable_weight")


def identity(kind: str = "customer_email") -> Column:
    """Who placed an order: the normal form of the address, or the customer id."""
    return normal_email(F.col(kind)) if kind == "customer_email" else F.col(kind)

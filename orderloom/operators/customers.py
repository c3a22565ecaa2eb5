"""Customers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.dates import instant
from orderloom.functions.numbers import count_or_zero, money
from orderloom.functions.text import blank_to_null, full_name, normal_email
from orderloom.operators.dedup import one_per_key
from orderloom.operators.orders import STORE


def first_orders(orders: DataFrame) -> DataFrame:
    """(email, first_order_date): earliest order per normalized address."""
    return (
        orders.select(normal_email(F.col("customer_email")).alias("email"), "created_at")
        .where(F.col("email").isNotNull())
        .groupBy("email")
        .agg(F.min("created_at").alias("first_order_date"))
    )


def _order(order_by: Sequence[str | Column] | None) -> list[Column]:
    if order_by is None:
        return [instant(F.col("updatedAt"))]
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def _addressed(raw: DataFrame, order: list[Column]) -> DataFrame:
    per_id = one_per_key(raw, ["id"], order)
    return per_id.withColumn("email", normal_email(F.col("email"))).where(
        F.col("email").isNotNull()
    )


def addresses(raw: DataFrame, order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """(customer_id, email) of every customer with an address, shared addresses included."""
    rows = _addressed(raw, _order(order_by))
    return rows.select(F.col("id").alias("customer_id"), "email")


def dim_customers(
    raw: DataFrame,
    orders: DataFrame | None = None,
    order_by: Sequence[str | Column] | None = None,
    store: str = STORE,
) -> DataFrame:
    """One row per customer with an address.

    The first row in `order_by` order (raw columns, by default the time of update) wins per id,
    then the first per normalized address. Without orders first_order_date is null.
    """
    order = _order(order_by)
    unique = one_per_key(_addressed(raw, order), ["email"], order)
    rows = unique.select(
        F.col("id").alias("customer_id"),
        "email",
        full_name(F.col("firstName"), F.col("lastName")).alias("full_name"),
        blank_to_null(F.col("firstName")).alias("first_name"),
        blank_to_null(F.col("lastName")).alias("last_name"),
        "phone",
        F.col("defaultAddress.city").alias("city"),
        F.col("defaultAddress.province").alias("province"),
        F.col("defaultAddress.country").alias("country"),
        count_or_zero(F.col("numberOfOrders")).alias("number_of_orders"),
        money(F.col("amountSpent.amount")).cast("double").alias("total_spent"),
        F.col("amountSpent.currencyCode").alias("currency"),
        instant(F.col("createdAt")).alias("created_at"),
        instant(F.col("updatedAt")).alias("updated_at"),
        F.lit(store).alias("store"),
    )
    if orders is None:
        return rows.withColumn("first_order_date", F.lit(None).cast("timestamp"))
    return rows.join(first_orders(orders), "email", "left").select(
        *rows.columns, "first_order_date"
    )


def customer_profile(customers: DataFrame) -> DataFrame:
    """One row of counts: all, with orders, with a name, with a country, with a first order."""
    return customers.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col("number_of_orders") > 0).alias("with_orders"),
        F.count_if(F.col("full_name") != "Unknown").alias("with_names"),
        F.count_if(blank_to_null(F.col("country")).isNotNull()).alias("with_location"),
        F.count_if(F.col("first_order_date").isNotNull()).alias("with_first_order"),
    )


def sample_customer(customers: DataFrame) -> DataFrame:
    """One customer with a first order if there is one, else any; stable by id."""
    return customers.orderBy(F.col("first_order_date").isNull(), "customer_id").limit(1)

"""Nightly run: landed pages to facts, dimensions, checks, summary and watermark."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.dates import instant
from orderloom.operators import orders as ord_
from orderloom.operators.customers import addresses, dim_customers
from orderloom.operators.dedup import one_per_key
from orderloom.operators.products import dim_products
from orderloom.operators.quality import qa_report
from orderloom.operators.summary import (
    account_totals,
    channel_figures,
    customer_totals,
    merged_totals,
    product_totals,
    summary_row,
)
from orderloom.plans import b2b
from orderloom.sinks.rollups import refresh
from orderloom.sinks.warehouse import PART, Warehouse
from orderloom.sources import control
from orderloom.sources.pages import read_pages, updated_since
from orderloom.sources.sku_map import empty_sku_map, read_sku_map
from orderloom.sources.stores import dim_stores


@dataclass(frozen=True)
class Landing:
    """Folders the feeds land in; a feed without a folder is skipped."""

    orders: str
    customers: str
    products: str
    sku_map: str | None = None
    reports: str | None = None
    report_names: Sequence[str] = ("*.csv",)


@dataclass(frozen=True)
class Settings:
    store: str = ord_.STORE
    business: str = "The business"
    summary_id: str = "combined"
    min_total: float = ord_.MIN_TOTAL
    stores: Sequence[tuple] = ()


@dataclass(frozen=True)
class NightlyReport:
    cutoff: str
    watermark: str
    orders: int
    quality: list
    read: dict[str, int]


def _raw(warehouse: Warehouse, name: str, rows: DataFrame) -> DataFrame:
    """Columnar copy of a parsed feed, read several times below."""
    path = warehouse.staging_path(f"raw_{name}")
    rows.write.mode("overwrite").parquet(path)
    return warehouse.spark.read.schema(rows.schema).parquet(path)


def monthly_figures(warehouse: Warehouse, who: str = "customer_email") -> DataFrame:
    """channel_summary() of the stored facts; only months loaded since the last call are read."""

    def totals(table: str, name: str, key: str, fold: Callable[..., DataFrame]) -> DataFrame:
        kept, _ = refresh(warehouse, table, name, fold)
        return merged_totals(kept.drop(PART), key)

    return channel_figures(
        totals("fact_orders", f"by_{who}", "who", partial(customer_totals, who=who)),
        totals("fact_order_lines", "by_product", "name", product_totals),
        totals("fact_b2b_invoices", "by_account", "name", account_totals),
    )


def run(
    spark: SparkSession,
    warehouse: Warehouse,
    landing: Landing,
    settings: Settings | None = None,
    now: datetime | None = None,
) -> NightlyReport:
    """Load everything updated since the last run.

    The watermark moves to the moment reading began, after all loads succeeded; a failed
    run leaves it where it was and is simply run again. `read` of the report tells how many orders
    were read, kept and dropped.
    """
    settings = settings or Settings()
    started = now or datetime.now(timezone.utc)
    warehouse.create_all()
    since = control.next_cutoff(
        control.read_watermark(warehouse.read("pipeline_control")), started
    )

    def landed(entity: str, path: str) -> DataFrame:
        # a page that holds something updated since landed since then, too
        return read_pages(spark, path, entity, landed_after=since)

    # landed pages of several fetches overlap and may repeat an entity: the latest version counts
    newest = [instant(F.col("updatedAt")).desc()]
    updated = updated_since(landed("orders", landing.orders), since)
    latest = one_per_key(updated, ["id"], newest)
    seen = Observation("orders_read")  # counted while the copy is written
    raw_orders = _raw(
        warehouse, "orders", ord_.observe_filter(latest, seen, settings.min_total)
    )
    raw_customers = _raw(
        warehouse,
        "customers",
        updated_since(landed("customers", landing.customers), since),
    )
    mapping = read_sku_map(spark, landing.sku_map) if landing.sku_map else empty_sku_map(spark)
    raw_products = _raw(warehouse, "products", read_pages(spark, landing.products, "products"))
    products = dim_products(raw_products, mapping, settings.store)

    # addresses of this batch, and of the customers loaded before, complete the orders
    current = addresses(raw_customers, newest)
    stored = warehouse.read("dim_customers").select("customer_id", "email")
    known = current.unionByName(stored.join(current, "customer_id", "left_anti"))
    orders = ord_.fill_email(
        ord_.fact_orders(raw_orders, settings.store, min_total=settings.min_total), known
    )
    customers = dim_customers(raw_customers, orders, newest, settings.store)
    lines = ord_.flag_variable_weight(
        ord_.lines_of_nested(raw_orders, settings.store, settings.min_total)
    )

    quality = qa_report(orders, lines, products, customers).collect()  # a dozen counts
    warehouse.upsert("fact_orders", orders)
    warehouse.upsert("fact_order_lines", lines)
    warehouse.upsert("dim_products", products)
    warehouse.upsert("dim_customers", customers)
    if settings.stores:
        warehouse.upsert("dim_stores", dim_stores(spark, settings.stores))
    if landing.reports:
        b2b.load(
            spark, warehouse, landing.reports, landing.report_names, store=settings.store
        )

    figures = monthly_figures(warehouse)
    run_at = F.lit(started.strftime("%Y-%m-%dT%H:%M:%SZ")).cast("timestamp")
    warehouse.upsert(
        "pipeline_summary",
        summary_row(
            figures, settings.summary_id, settings.business, settings.store, now=run_at
        ),
    )
    count = next(row["n"] for row in quality if row["check"] == "total_orders")
    watermark = started.strftime("%Y-%m-%dT%H:%M:%SZ")
    warehouse.upsert("pipeline_control", control.control_row(spark, watermark, count))
    for name, raw in (
        ("orders", raw_orders),
        ("customers", raw_customers),
        ("products", raw_products),
    ):
        _raw(warehouse, name, spark.createDataFrame([], raw.schema))
    return NightlyReport(since, watermark, count, quality, seen.get)

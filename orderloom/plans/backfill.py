"""Historical backfill from a bulk export."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from orderloom.operators import orders as ord_
from orderloom.operators.profiles import key_audit
from orderloom.sinks.warehouse import Warehouse
from orderloom.sources import bulk


@dataclass(frozen=True)
class BackfillReport:
    """Counts of the export, and rows per table before and after the load."""

    records: int
    orders: int
    line_items: int
    orphans: int
    before: dict[str, int]
    after: dict[str, int]
    net_new: dict[str, int]
    unique: dict[str, bool]


def run(
    spark: SparkSession,
    warehouse: Warehouse,
    path: str,
    store: str = ord_.STORE,
    min_total: float = ord_.MIN_TOTAL,
) -> BackfillReport:
    """Load a bulk export into both order tables and check that every key occurs once.

    The export is parsed once into a columnar copy next to the tables; the passes below
    read only the columns they need from it.
    """
    copy = warehouse.staging_path("bulk_export")
    bulk.read_bulk(spark, path).write.mode("overwrite").parquet(copy)
    records = spark.read.parquet(copy)
    parents, children = bulk.parents(records), bulk.children(records)
    lines = ord_.flag_variable_weight(ord_.lines_of_bulk(parents, children, store, min_total))
    loads = {
        "fact_orders": ord_.fact_orders(parents, store, min_total=min_total),
        "fact_order_lines": lines,
    }
    counts = ord_.reconcile_bulk(records).first()

    def audit(table: str):
        keys = warehouse.tables[table].keys
        return key_audit(warehouse.read(table), *keys).first()

    for table in loads:
        warehouse.create(table)
    before = {table: audit(table)["total"] for table in loads}
    for table, rows in loads.items():
        warehouse.upsert(table, rows)
    checked = {table: audit(table) for table in loads}
    after = {table: row["total"] for table, row in checked.items()}
    return BackfillReport(
        **counts.asDict(),
        before=before,
        after=after,
        net_new={table: after[table] - before[table] for table in loads},
        unique={table: row["passed"] for table, row in checked.items()},
    )

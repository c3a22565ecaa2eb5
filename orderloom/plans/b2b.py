"""B2B reports to invoices and invoice lines."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from orderloom.operators import invoices as inv
from orderloom.operators.orders import STORE
from orderloom.sinks.warehouse import Warehouse
from orderloom.sources.report import read_reports


@dataclass(frozen=True)
class B2BTables:
    invoices: DataFrame
    lines: DataFrame
    rejects: DataFrame


def transform(records: DataFrame, line_ids: str = "file", store: str = STORE) -> B2BTables:
    return B2BTables(
        inv.invoices(records, store),
        inv.invoice_lines(records, line_ids, store),
        inv.rejects(records),
    )


def load(
    spark: SparkSession,
    warehouse: Warehouse,
    folder: str,
    names: Sequence[str] = ("*.csv",),
    line_ids: str = "file",
    store: str = STORE,
) -> B2BTables:
    """Read the named reports of a folder and load both invoice tables.

    The records are written once next to the tables: both loads and the rejects read them.
    """
    copy = warehouse.staging_path("b2b_records")
    parsed = inv.report_lines(read_reports(spark, folder, names))
    parsed.write.mode("overwrite").parquet(copy)
    records = spark.read.schema(parsed.schema).parquet(copy)
    tables = transform(records, line_ids, store)
    warehouse.upsert("fact_b2b_invoices", tables.invoices)
    warehouse.upsert("fact_b2b_invoice_lines", tables.lines)
    return tables

"""Data-quality checks over the transformed tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.text import blank_to_null

# Wording of the warnings, %d is the number of rows concerned.
WARNINGS = {
    "orders_missing_customer": "%d orders have no customer linked (guest checkouts)",
    "lines_missing_sku": "%d order lines have no SKU — using product name as identifier",
    "products_unmapped": "%d products have no canonical SKU — using product name as identifier",
    "products_draft": "%d products are still in DRAFT status",
    "customers_unknown_name": "%d customers have no name",
    "customers_no_location": "%d customers have no location",
}


def _blank(column: str) -> Column:
    return blank_to_null(F.col(column)).isNull()


def _counts(df: DataFrame, checks: dict[str, tuple[str, Column]]) -> DataFrame:
    """All checks of one table in one pass, as rows (check, level, n)."""
    totals = df.agg(*[total.alias(name) for name, (_, total) in checks.items()])
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("check"), F.lit(level).alias("level"), F.col(name).alias("n")
            )
            for name, (level, _) in checks.items()
        ]
    )
    return totals.select(F.inline(rows))


def qa_report(
    orders: DataFrame, lines: DataFrame, products: DataFrame, customers: DataFrame
) -> DataFrame:
    """Rows (check, level, n): row counts as info, findings as warnings.

    `products` holds mapped and unmapped variants together.
    """
    everything = F.count(F.lit(1))
    unmapped = F.col("canonical_sku").isNull()
    return reduce(
        DataFrame.unionByName,
        [
            _counts(
                orders,
                {
                    "total_orders": ("info", everything),
                    "orders_missing_customer": ("warning", F.count_if(_blank("customer_id"))),
                },
            ),
            _counts(
                lines,
                {
                    "total_order_lines": ("info", everything),
                    "lines_missing_sku": (
                        "warning",
                        F.count_if(_blank("sku") | (F.col("sku") == "0")),
                    ),
                },
            ),
            _counts(
                products,
                {
                    "total_products_mapped": ("info", F.count_if(~unmapped)),
                    "total_products_unmapped": ("info", F.count_if(unmapped)),
                    "products_unmapped": ("warning", F.count_if(unmapped)),
                    "products_draft": (
                        "warning",
                        F.count_if(~unmapped & (F.col("status") == "DRAFT")),
                    ),
                },
            ),
            _counts(
                customers,
                {
                    "total_customers": ("info", everything),
                    "customers_unknown_name": (
                        "warning",
                        F.count_if(F.col("full_name") == "Unknown"),
                    ),
                    "customers_no_location": ("warning", F.count_if(_blank("country"))),
                },
            ),
        ],
    )


def warnings(report: DataFrame) -> DataFrame:
    """Only the findings, each with its message."""
    message = reduce(
        lambda chosen, item: chosen.when(
            F.col("check") == item[0], F.format_string(item[1], F.col("n"))
        ),
        WARNINGS.items(),
        F.when(F.lit(False), F.lit(None).cast("string")),
    )
    return report.where("level = 'warning' AND n > 0").withColumn("message", message)


def verdict(report: DataFrame) -> DataFrame:
    """One row: passed unless a check of level `issue` found rows; warnings never block."""
    found = F.col("n") > 0
    return report.agg(
        F.count_if(found & (F.col("level") == "issue")).alias("issues"),
        F.count_if(found & (F.col("level") == "warning")).alias("warnings"),
    ).withColumn("passed", F.col("issues") == 0)

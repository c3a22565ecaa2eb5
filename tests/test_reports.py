import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from orderloom.functions.dates import iso_text, report_date
from orderloom.functions.numbers import tolerant_double
from orderloom.functions.text import full_name, trim_ws
from orderloom.operators import quality, summary
from orderloom.schemas import (
    DIM_CUSTOMERS,
    DIM_PRODUCTS,
    FACT_B2B_INVOICES,
    FACT_ORDER_LINES,
    FACT_ORDERS,
    PIPELINE_SUMMARY,
)

STAMP = dt.datetime(2026, 3, 1)


def table(spark, schema, *items):
    return spark.createDataFrame(
        [tuple(item.get(f.name) for f in schema) for item in items], schema
    )


def orders(spark, *items):
    base = dict(
        order_id="o", total_revenue=10.0, subtotal=9.0, discount_amount=1.0, refund_amount=0.5
    )
    return table(spark, FACT_ORDERS, *[{**base, **i} for i in items])


def lines(spark, *items):
    base = dict(order_id="o", line_item_id="l", quantity=1, line_revenue=1.0, sku="S")
    return table(spark, FACT_ORDER_LINES, *[{**base, **i} for i in items])


def invoices(spark, *items):
    base = dict(invoice_id="i", total_amount=1.0, total_quantity=2.0, customer_name="C")
    return table(spark, FACT_B2B_INVOICES, *[{**base, **i} for i in items])


def test_empty_summary(spark):
    figures = summary.channel_summary(orders(spark), lines(spark), invoices(spark)).first()
    found = figures.asDict()
    assert found.pop("top_online_product") == found.pop("top_b2b_customer") == "N/A"
    assert set(found.values()) == {0}
    text = summary.summary_row(
        summary.channel_summary(orders(spark), lines(spark), invoices(spark))
    ).first()["summary_text"]
    assert text.startswith(
        "The business generated $0.00 in total revenue across 0 transactions in both channels. "
        "B2B restaurant sales contributed $0.00 (0%)"
    )
    assert text.endswith("0 new and 0 returning customers placed online orders this period.")


def test_summary(spark):
    o = orders(
        spark,
        {"customer_email": "a@x.com"},
        {"customer_email": " A@X.com"},
        {"customer_email": "b@x.com", "total_revenue": 1500.0},
        {"customer_email": None},
    )
    l = lines(
        spark,
        {"product_title": "Walnut tray", "line_revenue": 5.0, "quantity": 3},
        {"product_title": None, "line_revenue": 7.5},
    )
    i = invoices(spark, {"customer_name": "Grill", "total_amount": 510.0}, {"total_amount": 0.0})
    df = summary.channel_summary(o, l, i)
    f = df.first()
    assert (f["new_customers"], f["returning_customers"], f["unique_online_customers"]) == (1, 1, 2)
    assert (f["total_revenue"], f["total_transactions"]) == (2040.0, 6)
    assert (f["online_gross_sales"], f["online_discounts"], f["online_refunds"]) == (40.0, 4.0, 2.0)
    assert (f["online_aov"], f["online_units"]) == (382.5, 4)
    assert (f["b2b_pct"], f["online_pct"], f["b2b_customers"]) == (25.0, 75.0, 2)
    assert (f["top_online_product"], f["top_online_product_revenue"]) == ("Unknown", 7.5)
    assert (f["top_b2b_customer"], f["b2b_avg_invoice"], f["b2b_weight"]) == ("Grill", 255.0, 4.0)
    frequency = summary.customer_frequency(o).first().asDict()
    assert frequency == {
        "new_customers": 1,
        "returning_customers": 1,
        "unique_online_customers": 2,
    }
    row = summary.summary_row(df, "march", "Shop", now=F.lit(STAMP)).first()
    assert row.asDict().keys() == {f.name for f in PIPELINE_SUMMARY}
    assert "Shop generated $2,040.00 in total revenue across 6 transactions" in row["summary_text"]
    assert "contributed $1,530.00 (75.0%) across 4 orders from 2 customers" in row["summary_text"]
    assert row["summary_text"].endswith(
        "Top B2B customer is Grill at $510.00. Top online product is Unknown at $7.50."
    )


def test_ties_go_to_the_first_seen(spark):
    l = lines(
        spark,
        {"product_title": "Zed", "line_revenue": 5.0, "line_item_id": "1"},
        {"product_title": "Abe", "line_revenue": 5.0, "line_item_id": "2"},
    )
    for shuffled in (l, l.repartition(2), l.orderBy("product_title")):
        assert summary.top_product(shuffled, "line_item_id").first()["top_name"] == "Zed"
        assert summary.top_product(shuffled).first()["top_name"] == "Abe"
        f = summary.channel_summary(
            orders(spark), shuffled, invoices(spark), line_seen="line_item_id"
        ).first()
        assert f["top_online_product"] == "Zed"


def test_quality(spark):
    products = table(
        spark,
        DIM_PRODUCTS,
        {"shopify_product_id": "1", "canonical_sku": "S", "status": "DRAFT"},
        {"shopify_product_id": "2", "canonical_sku": None, "status": "DRAFT"},
        {"shopify_product_id": "3", "canonical_sku": "S", "status": "ACTIVE"},
    )
    customers = table(
        spark,
        DIM_CUSTOMERS,
        {"customer_id": "1", "full_name": "Unknown", "country": ""},
        {"customer_id": "2", "full_name": "Ann", "country": "US"},
    )
    report = quality.qa_report(
        orders(spark, {"customer_id": ""}, {"customer_id": "c"}),
        lines(spark, {"sku": "0"}, {"sku": None}, {"sku": "S"}),
        products,
        customers,
    )
    counts = {r["check"]: r["n"] for r in report.collect()}
    assert counts == {
        "total_orders": 2,
        "orders_missing_customer": 1,
        "total_order_lines": 3,
        "lines_missing_sku": 2,
        "total_products_mapped": 2,
        "total_products_unmapped": 1,
        "products_unmapped": 1,
        "products_draft": 1,
        "total_customers": 2,
        "customers_unknown_name": 1,
        "customers_no_location": 1,
    }
    assert quality.verdict(report).first().asDict() == {
        "issues": 0,
        "warnings": 6,
        "passed": True,
    }
    messages = {r["check"]: r["message"] for r in quality.warnings(report).collect()}
    assert messages["customers_no_location"] == "1 customers have no location"


def test_quality_of_nothing(spark):
    empty = quality.qa_report(
        orders(spark), lines(spark), table(spark, DIM_PRODUCTS), table(spark, DIM_CUSTOMERS)
    )
    assert {r["n"] for r in empty.collect()} == {0}
    assert quality.warnings(empty).count() == 0 and quality.verdict(empty).first()["passed"]


def test_scalars(spark):
    numbers = ["1,000.5", " -2 ", "1e3", ".5", "", None, "abc", "1d", "NaN", "Infinity", "0x1p3", "5."]
    df = spark.createDataFrame([(n,) for n in numbers], "x string")
    found = [r[0] for r in df.select(tolerant_double(F.col("x"))).collect()]
    assert found == [1000.5, -2.0, 1000.0, 0.5, *[None] * 7, 5.0]
    dates = ["04/01/2026", "4/2/26", "2026-4-3", "13/45/2026", "2026", "2026-04", "", None, "4/2/1975"]
    df = spark.createDataFrame([(d,) for d in dates], "x string")
    found = [str(r[0]) for r in df.select(report_date(F.col("x"))).collect()]
    assert found == ["2026-04-01", "2026-04-02", "2026-04-03", *["None"] * 5, "1975-04-02"]
    df = spark.createDataFrame([(" \tA b \r\n", None)], "a string, b string")
    row = df.select(
        trim_ws(F.col("a")), full_name(F.col("a"), F.col("b")), iso_text(F.lit(STAMP))
    ).first()
    assert tuple(row) == ("A b", "A b", "2026-03-01T00:00:00Z")
    assert rows(df)

"""Combined summary of the online and the B2B channel, as figures and as sentences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.numbers import MONEY, money_or_zero, ratio, to_double
from orderloom.functions.text import first_filled
from orderloom.operators.orders import STORE, identity
from orderloom.operators.profiles import best_of, revenue_by, top_one
from orderloom.schemas import PIPELINE_SUMMARY, conform

# The sentences of the summary; {x} takes a figure of that name.
SENTENCES = (
    "{business} generated ${total_revenue} in total revenue across {total_transactions} "
    "transactions in both channels.",
    "B2B restaurant sales contributed ${b2b_revenue} ({b2b_pct}%) across {b2b_invoices} "
    "invoices from {b2b_customers} restaurant accounts, averaging ${b2b_avg_invoice} per invoice.",
    "Online sales contributed ${online_revenue} ({online_pct}%) across {online_orders} orders "
    "from {unique_online_customers} customers, averaging ${online_aov} per order.",
    "{new_customers} new and {returning_customers} returning customers placed online orders "
    "this period.",
)
TOP_B2B_SENTENCE = "Top B2B customer is {top_b2b_customer} at ${top_b2b_revenue}."
TOP_ONLINE_SENTENCE = "Top online product is {top_online_product} at ${top_online_product_revenue}."

_MONEY_FIGURES = (
    "total_revenue",
    "b2b_revenue",
    "b2b_avg_invoice",
    "online_revenue",
    "online_aov",
    "top_b2b_revenue",
    "top_online_product_revenue",
)
_PERCENT_FIGURES = ("b2b_pct", "online_pct")


def _sum(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def customer_frequency(
    orders: DataFrame, who: str = "customer_email", period: Column | None = None
) -> DataFrame:
    """Customers with exactly one order, with several, and all of them.

    `who` names the column that identifies a customer; orders without one do not count. One
    row over all orders, or one per `period`.
    """
    by = [] if period is None else ["period"]
    named = orders.withColumns(
        {"who": identity(who), **({} if period is None else {"period": period})}
    )
    return (
        named.where(F.col("who").isNotNull())
        .groupBy(*by, "who")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*by)
        .agg(*_frequency("n"))
    )


def _frequency(n: str, known: Column | None = None) -> list[Column]:
    known = F.lit(True) if known is None else known
    return [
        F.count_if(known & (F.col(n) == 1)).alias("new_customers"),
        F.count_if(known & (F.col(n) > 1)).alias("returning_customers"),
        F.count_if(known).alias("unique_online_customers"),
    ]


def customer_totals(orders: DataFrame, *by: str, who: str = "customer_email") -> DataFrame:
    """Number of orders and amounts per customer (`who`, null for none) and `by`."""
    amounts = orders.select(
        *by,
        identity(who).alias("who"),
        money_or_zero(F.col("total_revenue")).alias("net"),
        (money_or_zero(F.col("subtotal")) + money_or_zero(F.col("discount_amount")))
        .cast(MONEY)
        .alias("gross"),
        money_or_zero(F.col("discount_amount")).alias("discounts"),
        money_or_zero(F.col("refund_amount")).alias("refunds"),
    )
    return amounts.groupBy(*by, "who").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(c).alias(c) for c in ("net", "gross", "discounts", "refunds")],
    )


def _ranked_totals(
    df: DataFrame, by: tuple[str, ...], name: Column, first_seen: str | None, amount: str, quantity: str
) -> DataFrame:
    seen = [F.min(first_seen).alias("first_seen")] if first_seen else []
    return df.groupBy(*by, name.alias("name")).agg(
        F.sum(money_or_zero(F.col(amount))).alias("revenue"),
        F.sum(money_or_zero(F.col(quantity))).alias("quantity"),
        F.count(F.lit(1)).alias("n"),
        *seen,
    )


def product_totals(lines: DataFrame, *by: str, first_seen: str | None = None) -> DataFrame:
    """Revenue, quantity and number of lines per product (`name`) and `by`."""
    return _ranked_totals(lines, by, product_name(), first_seen, "line_revenue", "quantity")


def account_totals(invoices: DataFrame, *by: str, first_seen: str | None = None) -> DataFrame:
    """Revenue, quantity and number of invoices per B2B customer (`name`) and `by`."""
    name = F.col("customer_name")
    return _ranked_totals(invoices, by, name, first_seen, "total_amount", "total_quantity")


def merged_totals(parts: DataFrame, key: str) -> DataFrame:
    """Totals per key from totals per key and whatever else; the earliest place of each counts."""
    folds = {c: F.min if c == "first_seen" else F.sum for c in parts.columns if c != key}
    return parts.groupBy(key).agg(*[fold(c).alias(c) for c, fold in folds.items()])


def product_name() -> Column:
    return first_filled(F.col("product_title"), default="Unknown")


def top_product(lines: DataFrame, first_seen: str | None = None) -> DataFrame:
    """One row: best product by line revenue; lines without a title count as Unknown."""
    return top_one(revenue_by(lines, product_name(), "line_revenue", first_seen))


def channel_summary(
    orders: DataFrame,
    lines: DataFrame,
    invoices: DataFrame,
    who: str = "customer_email",
    line_seen: str | None = None,
    invoice_seen: str | None = None,
) -> DataFrame:
    """One row of figures over both channels.

    Each input is read once and folded to one row; the rows are then laid over each other.
    `line_seen` and `invoice_seen` order products and customers of equal revenue.
    """
    return channel_figures(
        customer_totals(orders, who=who),
        product_totals(lines, first_seen=line_seen),
        account_totals(invoices, first_seen=invoice_seen),
    )


def channel_figures(
    per_customer: DataFrame, per_product: DataFrame, per_account: DataFrame
) -> DataFrame:
    """The figures of channel_summary() from totals per customer, product and B2B customer."""
    online = per_customer.agg(
        _sum("n").cast("bigint").alias("online_orders"),
        _sum("net").alias("online_net"),
        _sum("gross").alias("online_gross"),
        _sum("discounts").alias("online_discount_sum"),
        _sum("refunds").alias("online_refund_sum"),
        *_frequency("n", F.col("who").isNotNull()),
    )
    products = per_product.agg(
        _sum("quantity").cast("bigint").alias("online_units"),
        best_of(per_product).alias("best_product"),
    )
    accounts = per_account.agg(
        _sum("n").cast("bigint").alias("b2b_invoices"),
        _sum("revenue").alias("b2b_sum"),
        _sum("quantity").alias("b2b_quantity"),
        F.count(F.lit(1)).alias("b2b_customers"),
        best_of(per_account).alias("best_account"),
    )
    parts = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [online, products, accounts]
    )
    one = parts.agg(*[F.max(c).alias(c) for c in parts.columns])
    total = F.col("online_net") + F.col("b2b_sum")
    b2b_pct = F.round(ratio(F.col("b2b_sum"), total) * 100, 1)
    figures = {
        "total_revenue": to_double(total),
        "total_transactions": F.col("online_orders") + F.col("b2b_invoices"),
        "online_revenue": to_double(F.col("online_net")),
        "online_gross_sales": to_double(F.col("online_gross")),
        "online_discounts": to_double(F.col("online_discount_sum")),
        "online_refunds": to_double(F.col("online_refund_sum")),
        "online_orders": F.col("online_orders"),
        "online_units": F.col("online_units"),
        "online_aov": F.round(ratio(F.col("online_net"), F.col("online_orders")), 2),
        "online_pct": F.when(total != 0, F.round(100 - b2b_pct, 1)).otherwise(0.0),
        "new_customers": F.col("new_customers"),
        "returning_customers": F.col("returning_customers"),
        "unique_online_customers": F.col("unique_online_customers"),
        "top_online_product": F.coalesce("best_product.name", F.lit("N/A")),
        "top_online_product_revenue": F.coalesce(
            to_double(F.col("best_product.revenue")), F.lit(0.0)
        ),
        "b2b_revenue": to_double(F.col("b2b_sum")),
        "b2b_invoices": F.col("b2b_invoices"),
        "b2b_weight": to_double(F.col("b2b_quantity")),
        "b2b_customers": F.col("b2b_customers"),
        "b2b_avg_invoice": F.round(ratio(F.col("b2b_sum"), F.col("b2b_invoices")), 2),
        "b2b_pct": b2b_pct,
        "top_b2b_customer": F.coalesce("best_account.name", F.lit("N/A")),
        "top_b2b_revenue": F.coalesce(to_double(F.col("best_account.revenue")), F.lit(0.0)),
    }
    return one.select(*[c.alias(name) for name, c in figures.items()])


def _shown(name: str) -> Column:
    """A figure as text: money with separators, percent with one digit or a bare 0."""
    if name in _MONEY_FIGURES:
        return F.format_number(F.col(name), 2)
    if name in _PERCENT_FIGURES:
        return F.when(F.col("total_revenue") == 0, "0").otherwise(F.format_number(F.col(name), 1))
    return F.col(name).cast("string")


def _sentence(template: str, business: str) -> Column:
    parts = []
    for piece in template.split("{"):
        name, brace, rest = piece.partition("}")
        if not brace:
            parts.append(F.lit(piece))
        else:
            parts.append(F.lit(business) if name == "business" else _shown(name))
            parts.append(F.lit(rest))
    return F.concat(*parts)


def summary_text(business: str = "The business") -> Column:
    """The sentences over channel_summary(); those about a missing top entry are left out."""
    return F.concat_ws(
        " ",
        *[_sentence(s, business) for s in SENTENCES],
        F.when(F.col("top_b2b_customer") != "N/A", _sentence(TOP_B2B_SENTENCE, business)),
        F.when(F.col("top_online_product") != "N/A", _sentence(TOP_ONLINE_SENTENCE, business)),
    )


def summary_row(
    figures: DataFrame,
    summary_id: str = "combined",
    business: str = "The business",
    store: str = STORE,
    now: Column | None = None,
) -> DataFrame:
    """The row of the summary table; give each period its own `summary_id` to keep history."""
    rows = figures.withColumns(
        {
            "summary_id": F.lit(summary_id),
            "store": F.lit(store),
            "generated_at": F.current_timestamp() if now is None else now,
            "summary_text": summary_text(business),
        }
    )
    return conform(rows, PIPELINE_SUMMARY)

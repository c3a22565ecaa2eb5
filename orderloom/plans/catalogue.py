"""Named queries: every operator over the star-schema tables, read whole."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.dates import instant, month_of
from orderloom.operators import customers as cust
from orderloom.operators import invoices as inv
from orderloom.operators import orders as ord_
from orderloom.operators import products as prod
from orderloom.operators import profiles, quality, summary
from orderloom.operators.inventory import inventory_levels
from orderloom.plans import nightly
from orderloom.plans import retail_tables as rt
from orderloom.plans.retail_tables import table
from orderloom.schemas import (
    DIM_CUSTOMERS,
    DIM_PRODUCTS,
    FACT_B2B_INVOICE_LINES,
    FACT_ORDER_LINES,
    FACT_ORDERS,
    TABLES,
    TableSpec,
    conform,
    earlier_of,
)
from orderloom.session import scratch_folder, prepare
from orderloom.sinks.merge import merge_state, staged_rows
from orderloom.sinks.warehouse import Warehouse
from orderloom.sources import bulk, control
from orderloom.sources.pages import parse_pages, read_pages, updated_since
from orderloom.sources.report import parse_grid, read_report, read_reports
from orderloom.sources.sku_map import parse_sku_map
from orderloom.sources.stores import dim_stores
from orderloom.streaming.incremental import stream_files, upsert_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# A sales threshold that bites on these tables, for the queries about that filter.
LARGE_TOTAL = 100000
STORES = [("shop-1", "First shop", "North", "online", "shop-1.example.org")]
BUSINESS = "The business"
RUN_AT = "2024-02-01T00:00:00Z"


def query(function: Query) -> Query:
    """Register under the function's name; instants leave as zone-free UTC timestamps."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = function(prepare(spark), folder)
        zoned = [f.name for f in df.schema if f.dataType == T.TimestampType()]
        return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})

    QUERIES[function.__name__] = run
    return function


# ---- orders ----


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return ord_.fact_orders(rt.raw_orders(spark, folder))


def _lines(
    spark: SparkSession, folder: str, min_total: float = ord_.MIN_TOTAL
) -> DataFrame:
    rows = ord_.lines_of_bulk(
        rt.raw_orders(spark, folder), rt.raw_lines(spark, folder), min_total=min_total
    )
    return ord_.flag_variable_weight(rows)


@query
def fact_orders(spark, folder):
    large = ord_.fact_orders(rt.raw_orders(spark, folder), min_total=LARGE_TOTAL)
    return conform(large, FACT_ORDERS)


@query
def fact_order_lines(spark, folder):
    return conform(_lines(spark, folder, LARGE_TOTAL), FACT_ORDER_LINES)


@query
def order_filter_audit(spark, folder):
    return ord_.filter_audit(rt.raw_orders(spark, folder), LARGE_TOTAL)


@query
def orders_with_email(spark, folder):
    return ord_.fill_email(
        _orders(spark, folder), cust.addresses(rt.raw_customers(spark, folder))
    ).select("order_id", "customer_id", "customer_email")


@query
def variable_weight_lines(spark, folder):
    variable = _lines(spark, folder).where("is_variable_weight")
    return variable.select("line_item_id", "product_title", "quantity", "is_variable_weight")


@query
def variable_weight_shares(spark, folder):
    return (
        _lines(spark, folder)
        .groupBy("is_variable_weight")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum("quantity").alias("units"),
        )
    )


# ---- page and bulk sources ----


@query
def page_unnest_orders(spark, folder):
    nodes = parse_pages(rt.order_pages(spark, folder), "value", "orders")
    return nodes.select(
        "id",
        "name",
        "createdAt",
        F.col("totalPriceSet.shopMoney.amount").alias("amount"),
        F.col("customer.id").alias("customer_id"),
        F.size("lineItems.edges").cast("bigint").alias("line_edges"),
    )


def _landed(texts: DataFrame, name: str, **options: str) -> str:
    """Folder of text files with the rows, as a feed would leave them."""
    path = scratch_folder(texts.sparkSession, name)
    texts.select("value").write.text(path, **options)
    return path


@query
def landed_order_pages(spark, folder):
    """The order pages from files, read by the reader of landed pages."""
    # packed, as their names come again and again; each task writes a file of its own
    path = _landed(rt.order_pages(spark, folder), "orders", compression="gzip")
    nodes = read_pages(spark, path, "orders", landed_after=control.cutoff())
    return nodes.select("id", "name", F.size("lineItems.edges").cast("bigint").alias("line_edges"))


@query
def landed_bulk_lines(spark, folder):
    """The bulk export from files, read by the reader of exports."""
    heads, lines = bulk.read_sides(spark, _landed(rt.export_text(spark, folder), "export"))
    lines = ord_.lines_of_bulk(heads, lines)
    return lines.select("order_id", "line_item_id", "product_title", "sku", "line_revenue")


@query
def nested_order_lines(spark, folder):
    nodes = parse_pages(rt.order_pages(spark, folder), "value", "orders")
    lines = ord_.lines_of_nested(nodes)
    return conform(ord_.flag_variable_weight(lines), FACT_ORDER_LINES)


@query
def bulk_reassemble_lines(spark, folder):
    lines = ord_.lines_of_bulk(*bulk.parse_sides(rt.export_text(spark, folder), "value"))
    return lines.select("order_id", "line_item_id", "product_title", "sku", "line_revenue")


@query
def bulk_orphans(spark, folder):
    sides = bulk.parse_sides(rt.export_text(spark, folder), "value")
    return ord_.orphan_lines(*sides).select(
        F.col("__parentId").alias("order_id"), F.col("id").alias("line_item_id"), "quantity"
    )


@query
def bulk_reconcile(spark, folder):
    return ord_.reconcile_bulk(bulk.parse_bulk(rt.export_text(spark, folder), "value"))


# ---- customers ----


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    page = F.floor(F.col("id").cast("bigint") / 10)
    pages = rt.page_text(rt.raw_customers(spark, folder), "customers", page)
    nodes = parse_pages(pages, "value", "customers")
    newest = [instant(F.col("updatedAt")).desc()]
    return cust.dim_customers(nodes, _orders(spark, folder), order_by=newest)


@query
def dim_customers(spark, folder):
    return conform(_customers(spark, folder), DIM_CUSTOMERS)


@query
def customer_profile(spark, folder):
    return cust.customer_profile(_customers(spark, folder))


@query
def sample_customer(spark, folder):
    return cust.sample_customer(_customers(spark, folder)).select(
        "customer_id", "email", "first_order_date"
    )


@query
def customer_first_orders(spark, folder):
    return cust.first_orders(_orders(spark, folder))


@query
def customer_frequency(spark, folder):
    return summary.customer_frequency(_orders(spark, folder), "customer_id")


@query
def customer_frequency_by_month(spark, folder):
    """Within a month some customers are new; over the full history nearly all return."""
    return summary.customer_frequency(
        _orders(spark, folder), "customer_id", month_of(F.col("created_at"))
    )


# ---- products, stores, inventory ----


def _products(spark: SparkSession, folder: str) -> DataFrame:
    page = F.floor(F.substring("id", 2, 20).cast("bigint") / 25)
    pages = rt.page_text(rt.raw_products(spark, folder), "products", page)
    mapping = parse_sku_map(rt.sku_map_pages(spark, folder), "value", "page")
    return prod.dim_products(parse_pages(pages, "value", "products"), mapping)


@query
def sku_map(spark, folder):
    return parse_sku_map(rt.sku_map_pages(spark, folder), "value", "page")


@query
def dim_products(spark, folder):
    return conform(_products(spark, folder), DIM_PRODUCTS)


@query
def unmapped_products(spark, folder):
    return prod.unmapped(_products(spark, folder)).select(
        "shopify_product_id", "shopify_variant_id", "raw_name"
    )


@query
def dim_stores_upsert(spark, folder):
    """Stores merged into a registry of supplier outlets, one of which they replace."""
    registry = (
        table(spark, folder, "supplier")
        .join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.when(F.col("s_suppkey") == 0, "shop-1")
            .otherwise(F.col("s_name"))
            .alias("store_id"),
            F.col("s_name").alias("store_name"),
            F.col("n_name").alias("entity"),
            F.lit("pos").alias("channel"),
            F.lit("TBD").alias("shopify_instance"),
        )
    )
    stores = staged_rows(dim_stores(spark, STORES), ["store_id"])
    return merge_state(registry, stores, ["store_id"])


@query
def inventory_by_location(spark, folder):
    page = F.floor(F.substring("id", 2, 20).cast("bigint") / 10)
    pages = rt.page_text(rt.raw_inventory(spark, folder), "inventoryItems", page)
    return inventory_levels(parse_pages(pages, "value", "inventoryItems"))


# ---- B2B ----


@query
def report_grid_lines(spark, folder):
    grid = parse_grid(rt.report_text(spark, folder), "value")
    return inv.report_lines(grid).drop(*inv.POSITION, "date_text")


def _report_name(year) -> str:
    return f"sales {year}+lb.csv"


# Report lines that a folder of reports holds about; it is written by one task.
REPORT_LINES = 1_500_000


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    """A setting that holds for a while."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _landed_reports(spark: SparkSession, folder: str, most: int = REPORT_LINES) -> str:
    """Folders of report files, each with one file a year for some of the products; every memo is
    broken over two lines. The number of folders grows with the lines, the files do not."""
    path = scratch_folder(spark, "reports")
    folders = 1 + table(spark, folder, "lineitem").count() // most
    number = F.pmod(F.xxhash64("l_partkey"), F.lit(folders))
    # every folder is made by one task, which needs no other shuffle than that of the sales
    text = rt.report_text(spark, folder, number, tasks=8 * folders)
    lines = text.select(
        F.split_part("file", F.lit("_"), F.lit(3)).alias("folder"),
        F.split_part("file", F.lit("_"), F.lit(2)).alias("year"),
        "block",
        "seq",
        F.replace("value", F.lit('"said '), F.lit('"said\n')).alias("value"),
    )
    ordered = lines.sortWithinPartitions("folder", "year", "block", "seq")
    with _setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
        ordered.select("folder", "year", "value").write.partitionBy("folder", "year").text(path)
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/folder=*/year=*/part-*")):
        of_year = status.getPath().getParent()
        name = _report_name(of_year.getName().removeprefix("year="))
        fs.rename(status.getPath(), spark._jvm.org.apache.hadoop.fs.Path(of_year.getParent(), name))
    return path


@query
def landed_report_lines(spark, folder):
    """Reports from files named in a list; a name without a file is skipped."""
    names = [_report_name(year) for year in range(1990, 2030)]
    grid = read_reports(spark, _landed_reports(spark, folder), names)
    return inv.report_lines(grid).drop(*inv.POSITION, "date_text")


@query
def landed_report_one(spark, folder):
    """The reports of one name."""
    path = _landed_reports(spark, folder)
    lines = inv.report_lines(read_report(spark, f"{path}/folder=*/{_report_name(2000)}"))
    return lines.drop(*inv.POSITION, "date_text")


@query
def b2b_invoices(spark, folder):
    return inv.invoices(rt.b2b_records(spark, folder))


@query
def b2b_invoice_lines(spark, folder):
    return conform(inv.invoice_lines(rt.b2b_records(spark, folder)), FACT_B2B_INVOICE_LINES)


@query
def b2b_positional_line_ids(spark, folder):
    lines = inv.invoice_lines(rt.b2b_records(spark, folder), line_ids="overall")
    return lines.select("line_id", "invoice_id", "line_amount", "source")


@query
def b2b_rejects(spark, folder):
    return inv.rejects(rt.b2b_records(spark, folder)).select(
        "reason", "invoice_num", "customer_name", "date_text", "line_amount", "source_file"
    )


@query
def report_profile(spark, folder):
    return profiles.report_profile(rt.b2b_records(spark, folder))


@query
def b2b_profile(spark, folder):
    rows = profiles.b2b_profile(inv.invoices(rt.b2b_records(spark, folder)))
    return rows.withColumn("months", F.array_join("months", ","))


@query
def top_b2b_customers(spark, folder):
    return profiles.top_by_revenue(
        inv.invoices(rt.b2b_records(spark, folder)), "customer_name", "total_amount"
    )


@query
def report_top_customers(spark, folder):
    return profiles.top_by_revenue(
        rt.b2b_records(spark, folder), "customer_name", "line_amount", first_seen="seq"
    )


# ---- summary and checks ----


@query
def top_product(spark, folder):
    return summary.top_product(_lines(spark, folder))


@query
def product_revenue(spark, folder):
    return profiles.revenue_by(
        _lines(spark, folder), summary.product_name(), "line_revenue"
    ).select(
        F.col("name").alias("product_title"), F.round("revenue", 2).cast("double").alias("revenue")
    )


@query
def channel_summary(spark, folder):
    return summary.channel_summary(
        _orders(spark, folder),
        _lines(spark, folder),
        inv.invoices(rt.b2b_records(spark, folder)),
        who="customer_id",
    )


def _dated(rows: DataFrame, table: str, day: str) -> DataFrame:
    """The columns of a table and the date that tells the month of a row, be it stored or not."""
    schema = TABLES[table].schema
    if day not in schema.names:
        schema = T.StructType([*schema, rows.schema[day]])
    return conform(rows, schema)


def _made(rows: DataFrame, name: str) -> DataFrame:
    """The rows from files, for jobs that read them several times."""
    path = scratch_folder(rows.sparkSession, f"made-{name}")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


@query
def channel_summary_by_month(spark, folder):
    """The figures from totals kept per month: a second load touches the months from 1997 on."""
    warehouse = Warehouse(spark, scratch_folder(spark, "facts"))
    # the given lines repeat their ids, and a table keeps one line of each
    numbered = F.concat_ws("-", "line_item_id", F.monotonically_increasing_id())
    facts = {
        "fact_orders": (_orders(spark, folder), "created_at"),
        "fact_order_lines": (_lines(spark, folder).withColumn("line_item_id", numbered), "order_created_at"),
        "fact_b2b_invoices": (inv.invoices(rt.b2b_records(spark, folder)), "date"),
    }
    # made once for both loads, which also gives a line the same number in both
    facts = {name: (_made(_dated(rows, name, day), name), day) for name, (rows, day) in facts.items()}
    late = {name: F.coalesce(F.col(day) >= "1997-01-01", F.lit(False)) for name, (_, day) in facts.items()}
    for name, (rows, _) in facts.items():
        part = F.pmod(F.xxhash64(*TABLES[name].keys), F.lit(2)) == 0
        warehouse.upsert(name, rows.where(~late[name] | part))
    nightly.monthly_figures(warehouse, who="customer_id")
    for name, (rows, _) in facts.items():
        warehouse.upsert(name, rows.where(late[name]))
    return nightly.monthly_figures(warehouse, who="customer_id")


@query
def summary_text(spark, folder):
    run_at = F.lit(RUN_AT).cast("timestamp")
    row = summary.summary_row(channel_summary(spark, folder), business=BUSINESS, now=run_at)
    return row.select("summary_id", "store", "generated_at", "summary_text")


@query
def qa_report(spark, folder):
    return quality.qa_report(
        _orders(spark, folder),
        _lines(spark, folder),
        _products(spark, folder),
        _customers(spark, folder),
    )


@query
def qa_warnings(spark, folder):
    return quality.warnings(qa_report(spark, folder))


@query
def qa_verdict(spark, folder):
    return quality.verdict(qa_report(spark, folder))


# ---- keyed loads ----

LINE_KEYS = ["l_orderkey", "l_linenumber"]


def _line_batches(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Stored and arriving lines; both sides repeat keys and they overlap by half a year."""
    lines = table(spark, folder, "lineitem")
    shipped = F.col("l_shipdate")
    stored = lines.where(shipped < F.lit("1998-07-01").cast("timestamp_ntz"))
    arriving = lines.where(shipped >= F.lit("1998-01-01").cast("timestamp_ntz"))
    return (
        staged_rows(stored, LINE_KEYS, "l_shipdate"),
        staged_rows(arriving, LINE_KEYS, "l_shipdate"),
    )


@query
def latest_lines(spark, folder):
    return staged_rows(table(spark, folder, "lineitem"), LINE_KEYS, "l_shipdate")


@query
def upsert_lines(spark, folder):
    stored, arriving = _line_batches(spark, folder)
    return merge_state(stored, arriving, LINE_KEYS)


@query
def upsert_idempotent(spark, folder):
    stored, arriving = _line_batches(spark, folder)
    once = merge_state(stored, arriving, LINE_KEYS)
    return merge_state(once, arriving, LINE_KEYS)


@query
def upsert_partial_columns(spark, folder):
    """Only the status arrives: stored orders keep the rest, pending ones are inserted."""
    stored = table(spark, folder, "orders").where("o_orderstatus <> 'P'")
    arriving = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.max("l_linestatus").alias("o_orderstatus"))
    )
    return merge_state(stored, arriving, ["o_orderkey"])


@query
def upsert_first_order_rule(spark, folder):
    """Late rows do not overwrite newer ones, and the earliest date is kept from either side."""
    day = F.col("o_orderdate")

    def history(statuses: list[str]) -> DataFrame:
        return (
            table(spark, folder, "orders")
            .where(F.col("o_orderstatus").isin(statuses))
            .groupBy("o_custkey")
            .agg(
                F.min(day).alias("first_order_date"),
                F.max(day).alias("updated_at"),
                F.count(F.lit(1)).alias("orders_seen"),
            )
        )

    return merge_state(
        history(["F", "P"]),
        history(["O"]),
        ["o_custkey"],
        version="updated_at",
        rules={"first_order_date": earlier_of},
    )


@query
def upsert_stored_table(spark, folder):
    """Two written loads; the second moves pending orders to a later month."""
    orders = table(spark, folder, "orders")
    spec = TableSpec(orders.schema, ("o_orderkey",), month_of="o_orderdate")
    warehouse = Warehouse(spark, scratch_folder(spark, "orders"), {"orders": spec})
    warehouse.upsert("orders", orders)
    moved = orders.where("o_orderstatus = 'P'").withColumns(
        {
            "o_orderdate": F.col("o_orderdate") + F.expr("INTERVAL 40 DAY"),
            "o_orderstatus": F.lit("F"),
        }
    )
    warehouse.upsert("orders", moved)
    return warehouse.read("orders")


@query
def load_audit(spark, folder):
    stored, arriving = _line_batches(spark, folder)
    return profiles.load_audit(stored, merge_state(stored, arriving, LINE_KEYS), *LINE_KEYS)


@query
def key_audit(spark, folder):
    return profiles.key_audit(table(spark, folder, "lineitem"), *LINE_KEYS)


@query
def key_sketch_audit(spark, folder):
    """Months of the order lines: a load touched those from 1997 on, which alone are counted
    exactly; the sketches of all are merged for the whole."""
    lines = table(spark, folder, "lineitem").withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    sketches = profiles.key_sketches(lines, ["month"], LINE_KEYS)
    exact = profiles.key_audits(lines.where("month >= '1997-01'"), ["month"], LINE_KEYS)
    found = profiles.sketch_audit(sketches, exact, ["month"])
    # the estimate for the whole is held against an exact count of its own here
    distinct = profiles.key_audit(lines, *LINE_KEYS).select("distinct_keys").scalar()
    whole = F.when(F.col("month").isNull(), profiles.agrees(distinct))
    within = F.coalesce("within_error", whole).alias("within_error")
    return found.select("month", "rows", "distinct_keys", "passed", within)


# ---- incremental ----


def _control(spark: SparkSession, folder: str, until: str | None = None) -> DataFrame:
    """Control rows, one per kind of event."""
    events = table(spark, folder, "events")
    if until:
        events = events.where(F.col("ts") < F.lit(until).cast("timestamp_ntz"))
    return events.groupBy(F.col("event_type").alias("control_key")).agg(
        F.date_trunc("second", F.max("ts")).cast("timestamp_ntz").alias(
            "last_successful_watermark"
        ),
        F.lit(RUN_AT).cast("timestamp").cast("timestamp_ntz").alias("last_run_at"),
        F.count(F.lit(1)).alias("last_run_order_count"),
    )


@query
def incremental_window(spark, folder):
    """Events since one hour before the watermark of the clicks."""
    watermark = control.read_watermark(_control(spark, folder), "click")
    window = updated_since(table(spark, folder, "events"), control.next_cutoff(watermark), "ts")
    return window.orderBy("ts", "event_id")


@query
def watermark_commit(spark, folder):
    """Control rows of mid-month in a table, moved on by those of the whole month, and the row
    that a nightly run commits."""
    warehouse = Warehouse(spark, scratch_folder(spark, "control"))
    warehouse.upsert("pipeline_control", _control(spark, folder, until="2024-01-16"))
    warehouse.upsert("pipeline_control", _control(spark, folder))
    done = table(spark, folder, "events").agg(
        F.date_format(F.max("ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.count(F.lit(1))
    )
    watermark, count = done.first()
    run_at = F.lit(RUN_AT).cast("timestamp")
    warehouse.upsert("pipeline_control", control.control_row(spark, watermark, count, now=run_at))
    return warehouse.read("pipeline_control")


# Events of one landed file about.
LANDED_EVENTS = 500_000


@query
def stream_upsert(spark, folder):
    """Events streamed into a keyed table in four batches: the latest event per user remains.

    The latest quarter lands first, so all that follows is late, and a batch is replayed at the end.
    A batch is a quarter, of as many files as its events ask for.
    """
    events = table(spark, folder, "events")
    scratch = scratch_folder(spark, "events")
    quarter = F.ntile(4).over(Window.orderBy(F.desc("day")))
    days = events.groupBy(F.to_date("ts").alias("day")).count().select("day", "count", quarter.alias("landing"))
    most = days.groupBy("landing").agg(F.sum("count").alias("n")).agg(F.max("n")).first()[0] or 0
    files = 1 + most // LANDED_EVENTS
    dealt = events.join(days.drop("count"), F.to_date("ts").eqNullSafe(F.col("day"))).drop("day")
    for n in range(1, 5):
        landing = dealt.where(F.col("landing") == n).drop("landing")
        landing.repartition(files).write.mode("append").parquet(f"{scratch}/landed")
    spec = TableSpec(events.schema, ("user_id",), buckets=8, version="ts")
    warehouse = Warehouse(spark, f"{scratch}/tables", {"latest": spec})
    stream = stream_files(spark, f"{scratch}/landed", events.schema, "parquet", files_per_batch=files)
    run = upsert_stream(
        stream, warehouse, {"latest": lambda batch: batch}, f"{scratch}/progress"
    )
    run.awaitTermination()
    ((stream_id, last),) = warehouse.snapshot("latest").applied.items()
    # a batch that has been applied is left out, whatever it brings
    later = events.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 YEAR"))
    if warehouse.upsert("latest", later, batch=(stream_id, last)):
        raise AssertionError(f"batch {last} was applied twice")
    return warehouse.read("latest")

"""Raw feeds derived row by row from the star-schema tables the queries run on.

Each feed has the shape the sources deliver: nested entities, page and export text, report
lines. Every table is read whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.functions.dates import ISO_INSTANT, report_date
from orderloom.functions.numbers import tolerant_double


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _dec(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def _text(c: Column) -> Column:
    return c.cast("string")


def _iso(c: Column) -> Column:
    return F.date_format(c, ISO_INSTANT)


def _amount(c: Column) -> Column:
    return F.struct(F.struct(_text(_dec(c)).alias("amount")).alias("shopMoney"))


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Order nodes without lines, as the bulk export delivers parents."""
    o = table(spark, folder, "orders")
    total = _dec(F.col("o_totalprice"))
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    price = F.struct(_text(total).alias("amount"), F.lit("USD").alias("currencyCode"))
    email = F.when(
        status == "F", F.concat(F.lit(" Customer"), "o_custkey", F.lit("@Example.com "))
    )
    return o.select(
        _text(F.col("o_orderkey")).alias("id"),
        F.concat(F.lit("#"), "o_orderkey").alias("name"),
        _iso(F.col("o_orderdate")).alias("createdAt"),
        _iso(F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("updatedAt"),
        F.when(status == "F", "PAID")
        .when(status == "O", "PENDING")
        .otherwise("PARTIALLY_PAID")
        .alias("displayFinancialStatus"),
        F.when(priority != "1-URGENT", "FULFILLED").alias("displayFulfillmentStatus"),
        F.struct(price.alias("shopMoney")).alias("totalPriceSet"),
        _amount(total * F.lit(0.9).cast("decimal(2,1)")).alias("subtotalPriceSet"),
        F.when(status != "O", _amount(total * F.lit(0.05).cast("decimal(3,2)"))).alias(
            "totalDiscountsSet"
        ),
        F.when(priority == "5-LOW", _amount(total * F.lit(0.01).cast("decimal(3,2)"))).alias(
            "totalRefundedSet"
        ),
        F.when(
            priority != "4-NOT SPECIFIED",
            F.struct(_text(F.col("o_custkey")).alias("id"), email.alias("email")),
        ).alias("customer"),
    )


def raw_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line nodes with the id of their order, as the bulk export delivers children."""
    size, key = F.col("p_size"), F.col("p_partkey")
    suffix = (
        F.when(size % 7 == 0, " per lb").when(size % 11 == 0, " Custom Weight").otherwise("")
    )
    sku = (
        F.when(key % 10 == 0, F.lit(None).cast("string"))
        .when(key % 10 == 1, "0")
        .otherwise(F.concat(F.lit("SKU-"), key))
    )
    variant = F.struct(
        F.concat(F.lit("v"), key).alias("id"),
        sku.alias("sku"),
        _text(_dec(F.col("p_retailprice"))).alias("price"),
    )
    # what is the same for all lines of a product is made before the join
    part = table(spark, folder, "part").select(
        key.alias("l_partkey"),
        F.when(size != 50, F.concat("p_name", suffix)).alias("title"),
        F.when(size % 13 != 0, variant).alias("variant"),
    )
    return table(spark, folder, "lineitem").join(part, "l_partkey").select(
        _text(F.col("l_orderkey")).alias("__parentId"),
        F.concat_ws("-", _text(F.col("l_orderkey")), _text(F.col("l_linenumber"))).alias("id"),
        "title",
        F.col("l_quantity").cast("int").alias("quantity"),
        "variant",
    )


def export_text(spark: SparkSession, folder: str) -> DataFrame:
    """Bulk export lines: orders and line items mixed; pending orders are not exported, so
    their lines are orphans."""
    orders = raw_orders(spark, folder).where(F.col("displayFinancialStatus") != "PENDING")
    lines = raw_lines(spark, folder)
    return orders.select(F.to_json(F.struct("*")).alias("value")).unionByName(
        lines.select(F.to_json(F.struct("*")).alias("value"))
    )


def page_text(nodes: DataFrame, entity: str, page: Column) -> DataFrame:
    """Landed page documents: the nodes of one `page` number together, a few dozen at most. A column
    _page of the nodes is no part of them."""
    node = F.struct(F.struct(*[c for c in nodes.columns if c != "_page"]).alias("node"))
    edges = nodes.groupBy(page.alias("_page")).agg(F.collect_list(node).alias("edges"))
    info = F.struct(F.lit(False).alias("hasNextPage"), F.lit("").alias("endCursor"))
    document = F.struct(
        F.struct(F.struct(info.alias("pageInfo"), "edges").alias(entity)).alias("data")
    )
    return edges.select(F.to_json(document).alias("value"))


def order_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Order pages of up to ten orders, with or without lines.

    An order lists the lines of up to four line numbers; one with more comes several times. Orders
    and lines are shuffled once each, by page, and all that follows keeps to it.
    """

    def paged(rows: DataFrame, key: str) -> DataFrame:
        page = F.floor(F.col(key).cast("bigint") / 10)
        return rows.withColumn("_page", page).repartition("_page")

    orders = raw_orders(spark, folder)
    node = F.struct(F.struct("id", "title", "quantity", "variant").alias("node"))
    number = F.split_part("id", F.lit("-"), F.lit(2)).cast("int")
    lines = (
        paged(raw_lines(spark, folder), "__parentId")
        .groupBy("_page", "__parentId", F.floor(number / 4).alias("part"))
        .agg(F.collect_list(node).alias("edges"))
        .select(F.col("_page").alias("_of"), F.col("__parentId").alias("_parent"), "edges")
    )
    # equal ids, but told so that they are no key of the join, which would shuffle by them
    same = F.col("id").between(F.col("_parent"), F.col("_parent"))
    joined = paged(orders, "id").join(lines, (F.col("_page") == F.col("_of")) & same, "left")
    edges = F.coalesce("edges", F.array().cast(lines.schema["edges"].dataType))
    nodes = joined.select(*orders.columns, F.struct(edges.alias("edges")).alias("lineItems"), "_page")
    return page_text(nodes, "orders", F.col("_page"))


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customer nodes; one market segment was fetched twice, the second time with a new city."""
    nation = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    c = table(spark, folder, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    copies = F.when(F.col("c_mktsegment") == "BUILDING", F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    c = c.withColumn("copy", F.explode(copies))
    key, balance, home = F.col("c_custkey"), F.col("c_acctbal"), F.col("c_nationkey")
    shared = F.when(home == 3, key - key % 2).otherwise(key)
    email = (
        F.when(home == 5, F.lit(None).cast("string"))
        .when(home == 7, "   ")
        .otherwise(F.concat(F.lit(" Customer"), shared, F.lit("@Example.COM")))
    )
    created = F.expr("TIMESTAMP_NTZ '1992-01-01 00:00:00'") + F.make_dt_interval((key % 2000).cast("int"))
    return c.select(
        _text(key).alias("id"),
        F.when(balance >= 0, F.split_part("c_name", F.lit("#"), F.lit(1))).alias("firstName"),
        F.when(balance >= 500, F.split_part("c_name", F.lit("#"), F.lit(2))).alias("lastName"),
        email.alias("email"),
        F.lit(None).cast("string").alias("phone"),
        _iso(created).alias("createdAt"),
        _iso(created + F.make_dt_interval(F.col("copy") + 1)).alias("updatedAt"),
        F.when(balance >= 0, _text(key % 5)).alias("numberOfOrders"),
        F.struct(
            _text(_dec(balance)).alias("amount"), F.lit("USD").alias("currencyCode")
        ).alias("amountSpent"),
        F.when(
            home != 11,
            F.struct(
                F.when(F.col("copy") == 1, "Moved")
                .otherwise(F.concat(F.lit("City "), home))
                .alias("city"),
                F.col("r_name").alias("province"),
                F.col("n_name").alias("country"),
            ),
        ).alias("defaultAddress"),
    )


def _part_title() -> Column:
    return F.concat_ws(" ", "p_name", _text(F.col("p_partkey")))


def raw_products(spark: SparkSession, folder: str) -> DataFrame:
    """Product nodes with one to three variants each."""
    key, size = F.col("p_partkey"), F.col("p_size")

    def variant(i: Column) -> Column:
        sku = (
            F.when(key % 10 == 0, F.lit(None).cast("string"))
            .when(key % 10 == 1, "")
            .otherwise(F.concat(F.lit("SKU-"), key, F.lit("-"), i))
        )
        weight = F.struct(
            (size / F.lit(2.0)).alias("value"), F.lit("POUNDS").alias("unit")
        )
        item = F.struct(F.struct(weight.alias("weight")).alias("measurement"))
        return F.struct(
            F.struct(
                F.concat(key, F.lit("-"), i).alias("id"),
                sku.alias("sku"),
                F.concat(F.lit("Size "), i).alias("title"),
                _text(_dec(F.col("p_retailprice")) + i).alias("price"),
                F.when(i != 3, size * i).alias("inventoryQuantity"),
                F.when(size % 5 != 0, item).alias("inventoryItem"),
            ).alias("node")
        )

    variants = F.transform(F.sequence(F.lit(1), size % 3 + 1), variant)
    return table(spark, folder, "part").select(
        F.concat(F.lit("p"), key).alias("id"),
        _part_title().alias("title"),
        F.lower("p_name").alias("handle"),
        F.when(size % 4 == 0, "DRAFT").otherwise("ACTIVE").alias("status"),
        F.col("p_type").alias("productType"),
        F.col("p_brand").alias("vendor"),
        F.lit("2024-01-02T03:04:05Z").alias("createdAt"),
        F.lit("2024-02-03T04:05:06Z").alias("updatedAt"),
        F.struct(variants.alias("edges")).alias("variants"),
    )


def sku_map_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Mapping pages, one per part: by title, by raw SKU, and corrections of earlier records."""
    key = F.col("p_partkey")

    def record(name_field: str, name: Column, code_field: str, code: Column) -> Column:
        fields = F.struct(name.alias(name_field), code.alias(code_field))
        return F.struct(F.to_json(fields).alias("fields"))

    padded = F.concat(F.lit("  "), _part_title(), F.lit(" "))
    by_title = record("Shopify Name", padded, "SKU", F.concat(F.lit("OLD-"), key))
    corrected = record(
        "Shopify Product Name", _part_title(), "Canonical SKU", F.concat(F.lit("CANON-"), key)
    )
    by_sku = record(
        "Shopify Name",
        F.concat(F.lit("SKU-"), key, F.lit("-1")),
        "Canonical SKU",
        F.concat(F.lit("RAW-"), key, F.lit(" ")),
    )
    unusable = record("Shopify Name", _part_title(), "SKU", F.lit(""))
    records = (
        F.when(key % 4 == 0, F.array(by_title, corrected))
        .when(key % 4 == 1, F.array(by_sku))
        .when(key % 4 == 2, F.array(by_title, unusable))
        .otherwise(F.array(unusable))
    )
    # fields are rendered one by one, as records differ in the names they use
    joined = F.concat_ws(
        ",",
        F.transform(records, lambda r: F.concat(F.lit('{"fields":'), r["fields"], F.lit("}"))),
    )
    return table(spark, folder, "part").select(
        key.alias("page"), F.concat(F.lit('{"records":['), joined, F.lit("]}")).alias("value")
    )


def raw_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Item nodes with the quantities at up to a few locations; a part may have several nodes."""
    sold = table(spark, folder, "lineitem").groupBy("l_partkey", "l_suppkey").agg(
        F.sum(F.col("l_quantity").cast("int")).cast("int").alias("on_hand"),
        F.sum(F.when(F.col("l_returnflag") == "N", F.col("l_quantity").cast("int")))
        .cast("int")
        .alias("available"),
    )
    part, place = F.col("l_partkey"), F.col("l_suppkey")

    def quantity(name: str) -> Column:
        return F.struct(F.lit(name).alias("name"), F.col(name).alias("quantity"))

    level = F.struct(
        F.concat(part, F.lit("@"), place).alias("id"),
        F.filter(
            F.array(quantity("on_hand"), quantity("available")),
            lambda q: q["quantity"].isNotNull(),
        ).alias("quantities"),
        F.struct(
            _text(place).alias("id"), F.concat(F.lit("Location "), place).alias("name")
        ).alias("location"),
    )
    items = sold.groupBy(part, (place % 16).alias("some")).agg(
        F.collect_list(F.struct(level.alias("node"))).alias("edges")
    )
    return items.select(
        F.concat(F.lit("i"), part).alias("id"),
        F.concat(F.lit("SKU-"), part).alias("sku"),
        (part % 2 == 0).alias("tracked"),
        F.lit("2024-01-02T03:04:05Z").alias("createdAt"),
        F.lit("2024-02-03T04:05:06Z").alias("updatedAt"),
        F.struct("edges").alias("inventoryLevels"),
    )


def _date_text() -> Column:
    """The three layouts the reports use, two-digit years only where they mean 20xx."""
    iso, number = _text(F.col("l_shipdate").cast("date")), F.col("l_linenumber")
    return (
        F.when(number % 3 == 1, iso)
        .when(
            (number % 3 == 2) & (F.year("l_shipdate") >= 2000),
            F.regexp_replace(iso, r"20(\d\d)-0?(\d+)-0?(\d+)", "$2/$3/$1"),
        )
        .otherwise(F.regexp_replace(iso, r"(\d+)-(\d+)-(\d+)", "$2/$3/$1"))
    )


def _grouped(c: Column) -> Column:
    """Amount with a thousands comma."""
    text, last = _text(_dec(c)), F.lit(6)  # the last three digits, the point and two more
    head = F.left(text, F.length(text) - last)
    return F.when(F.abs(c) < 999, text).otherwise(
        F.concat(head, F.when(head.rlike(r"\d$"), ",").otherwise(""), F.right(text, last))
    )


def _sales(spark: SparkSession, folder: str, products: Column | None = None, tasks: int = 1) -> DataFrame:
    """Sold lines with their texts as a report shows them, in table order.

    Texts are made below the joins, so filters on them run in the scan stage. With `products`, a number
    for l_partkey that is kept as `number`, lines are shuffled once, by it and without texts, and every
    number is in one of so many tasks.
    """
    texts = {
        "year": F.year("l_shipdate"),
        "date_text": _date_text(),
        "quantity_text": _text(F.col("l_quantity") * 100),
        "amount_text": _grouped(F.col("l_extendedprice")),
    }
    price = _grouped(F.col("p_retailprice"))
    raw = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"]
    position = [
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.row_index").alias("seq"),
    ]
    lines, part = table(spark, folder, "lineitem"), table(spark, folder, "part")
    supplier = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    of_part = [F.col("p_partkey").alias("l_partkey"), "p_name", "p_size"]
    if products is None:
        lines = lines.select(*position, *raw, *[c.alias(name) for name, c in texts.items()])
        part = part.select(*of_part, price.alias("price_text"))
        return lines.join(part, "l_partkey").join(supplier, "l_suppkey")
    lines = lines.select(position[-1], *raw, "l_shipdate", "l_extendedprice")
    part = part.select(*of_part, "p_retailprice")
    # both sides keep to the shuffle by number where the planner takes a part of the key (see _landed_reports)
    lines, part = (df.withColumn("number", products).repartition(tasks, "number") for df in (lines, part))
    rows = lines.join(part, ["number", "l_partkey"]).join(supplier, "l_suppkey")
    return rows.withColumns(texts | {"price_text": price})


def b2b_records(spark: SparkSession, folder: str) -> DataFrame:
    """Report records in table order, with gaps and malformed cells of all kinds."""
    quantity, flag = F.col("l_quantity"), F.col("l_returnflag")
    texts = _sales(spark, folder).select(
        "file",
        "block",
        "seq",
        F.when((flag == "R") & (quantity == 1), "  ")
        .otherwise(F.concat(F.lit(" "), "l_orderkey", F.lit(" ")))
        .alias("invoice_num"),
        F.when((flag == "R") & (quantity == 2), "").otherwise(F.col("s_name")).alias(
            "customer_name"
        ),
        F.when((flag == "A") & (quantity == 1), "")
        .when((flag == "A") & (quantity == 2), "n/a")
        .otherwise(F.col("date_text"))
        .alias("date_text"),
        F.when(F.col("p_size") % 9 == 0, "").otherwise(F.col("p_name")).alias(
            "product_description"
        ),
        F.when(F.col("p_size") % 2 == 0, "").otherwise(F.concat(F.lit("memo "), "p_name")).alias(
            "memo"
        ),
        "quantity_text",
        F.when(F.col("p_size") % 2 == 1, "lb").otherwise("").alias("unit_of_measure"),
        "price_text",
        F.when(F.col("l_linenumber") == 7, "pending")
        .otherwise(F.col("amount_text"))
        .alias("amount_text"),
        F.concat(F.lit("sales_"), "year", F.lit(".csv")).alias("source_file"),
    )
    return texts.select(
        "file",
        "block",
        "seq",
        "invoice_num",
        report_date(F.col("date_text")).alias("date"),
        "date_text",
        "customer_name",
        "product_description",
        "memo",
        tolerant_double(F.col("quantity_text")).alias("quantity"),
        "unit_of_measure",
        tolerant_double(F.col("price_text")).alias("unit_price"),
        tolerant_double(F.col("amount_text")).alias("line_amount"),
        "source_file",
    )


def _csv(**cells: Column | str) -> Column:
    """A report line: column A and B empty, the group cell in C, then every second column."""
    blank = F.lit("")
    names = ("type", "date", "num", "memo", "name", "qty", "uom", "price", "amount", "balance")
    row = [blank, blank, cells.get("group", blank), blank]
    for name in names:
        row += [cells.get(name, blank), blank]

    def quoted(c: Column) -> Column:
        escaped = F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.when(c.contains('"') | c.contains(","), escaped).otherwise(c)

    return F.concat_ws(",", *[quoted(F.lit(c) if isinstance(c, str) else c) for c in row])


# Where a report is large, a product's transactions are spread over this many chunks, so no chunk
# holds a hot product. A report of fewer lines is one chunk, as a small file is one input split.
_SPREAD = 16
_STEP = 32
CHUNK_LINES = 100_000
# products of a report, unless the caller numbers them
_PRODUCTS = 100


def _large_reports(spark: SparkSession, folder: str, name: Column, most: int) -> list[str]:
    """Names of the reports of more than `most` lines; there is at most one for every `most` lines."""
    lines = table(spark, folder, "lineitem").select("l_partkey", F.year("l_shipdate").alias("year"))
    sizes = lines.groupBy(name.alias("file")).count()
    return [row["file"] for row in sizes.where(F.col("count") > most).select("file").collect()]


def report_text(
    spark: SparkSession,
    folder: str,
    products: Column | None = None,
    most: int = CHUNK_LINES,
    tasks: int = 1,
) -> DataFrame:
    """Report lines (file, block, seq, value): one report per year and group of products, which are
    hundreds unless `products` tells a number for l_partkey.

    Reports of hundreds of products with up to `most` lines are one block; in others every product
    has blocks of its own. The lines are shuffled once, by block; with `products` their sales are, by
    that number into so many tasks, each of which makes the whole text of its reports.
    """
    part = F.col("l_partkey")
    number = F.floor(part / _PRODUCTS) if products is None else F.col("number")
    name = F.concat_ws("_", F.lit("sales"), _text(F.col("year")), _text(number))
    whole = F.lit(False)
    if products is None:
        whole = ~F.col("file").isin(_large_reports(spark, folder, name, most))

    def place(block: Column | int, seq: Column | int, in_whole: Column | int) -> list[Column]:
        block, seq, in_whole = (c if isinstance(c, Column) else F.lit(c) for c in (block, seq, in_whole))
        # the default is never taken: it tells Spark that no block is null
        return [
            F.coalesce(F.when(whole, F.lit(0)).otherwise(block), F.lit(0)).cast("bigint").alias("block"),
            F.when(whole, in_whole).otherwise(seq).cast("bigint").alias("seq"),
        ]

    # the products of a whole report one after the other, each with room for all of its lines
    first = F.shiftleft(F.pmod(part, F.lit(_PRODUCTS)), 52)
    last = F.lit((1 << 52) - 1)
    sales = _sales(spark, folder, products, tasks).withColumn("file", name)
    spread = F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "l_suppkey"), F.lit(_SPREAD))
    kind = (
        F.when(F.col("l_linenumber") == 7, "Estimate")
        .when(F.col("l_returnflag") == "R", "Credit Memo")
        .when(F.col("l_returnflag") == "A", "Sales Receipt")
        .otherwise("Invoice")
    )
    transaction = F.struct(
        *place(part * _STEP + 1 + spread, F.col("seq"), first + 1 + F.col("seq")),
        _csv(
            type=kind,
            date=F.col("date_text"),
            num=_text(F.col("l_orderkey")),
            memo=F.concat(F.lit('said "'), "p_name", F.lit('", twice')),
            name=F.col("s_name"),
            qty=F.col("quantity_text"),
            uom="lb",
            price=F.col("price_text"),
            amount=F.col("amount_text"),
        ).alias("value"),
    )
    product = F.concat_ws(" ", "p_name", _text(part))
    headings = F.array(
        F.struct(*place(part * _STEP, 0, first), _csv(group=product).alias("value")),
        F.struct(
            *place(part * _STEP + _STEP - 1, 0, first + last),
            _csv(group=F.concat(F.lit("Total "), product)).alias("value"),
        ),
    )
    titles = ("type", "date", "num", "memo", "name", "qty", "uom", "price", "amount", "balance")
    words = (
        "Type", "Date", "Num", "Memo", "Name", "Qty", "U/M", "Sales Price", "Amount", "Balance"
    )
    frame = [
        (-1, 0, F.lit("Sales by Item Detail")),
        (-1, 1, F.lit("")),
        (-1, 2, _csv(**dict(zip(titles, words)))),
        (-1, 3, F.lit("Inventory,,,,")),
        (2**60, 0, _csv(type="Total Inventory", amount="1.00")),
        (2**60, 1, _csv(type="Grand Total", amount="1.00")),
    ]
    frames = F.array(
        *[
            F.struct(*place(b, s, s - len(frame) if b < 0 else 2**60 + s), v.alias("value"))
            for b, s, v in frame
        ]
    )
    if products is None:
        groups = sales.select("file", "l_partkey", "p_name").distinct()
        lines = [
            sales.select("file", transaction.alias("row")),
            groups.select("file", F.explode(headings).alias("row")),
            groups.select("file").distinct().select("file", F.explode(frames).alias("row")),
        ]
        lines = reduce(DataFrame.unionByName, [rows.select("file", "row.*") for rows in lines])
        lines = lines.repartition("file", "block")
    else:
        # the first sale of a product in a report brings its headings, the first of all the frame
        of_file = Window.partitionBy("number", "file").orderBy("l_partkey", "p_name")
        of_product = Window.partitionBy("number", "file", "l_partkey", "p_name").orderBy("l_partkey")
        firsts = {"_file": F.row_number().over(of_file), "_product": F.row_number().over(of_product)}
        none = F.array().cast("array<struct<block:bigint,seq:bigint,value:string>>")
        rows = F.concat(
            F.array(transaction),
            F.when(F.col("_product") == 1, headings).otherwise(none),
            F.when(F.col("_file") == 1, frames).otherwise(none),
        )
        lines = sales.withColumns(firsts).select("file", F.explode(rows).alias("row")).select("file", "row.*")
    return lines.withColumn("source_file", F.concat("file", F.lit(".csv")))

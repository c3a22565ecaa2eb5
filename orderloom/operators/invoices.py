"""B2B invoices: from the report grid to lines, invoices and rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.dates import month_of, report_date
from orderloom.functions.numbers import money_or_zero, to_double, tolerant_double
from orderloom.functions.text import WHITE_SPACE, blank_to_null, first_filled, trim_ws
from orderloom.operators.orders import STORE
from orderloom.operators.positions import dense_sequence
from orderloom.sources.report import checked_cells, raw_cell, raw_cells

# Report headings and the types that are real transactions (case-sensitive).
HEADINGS = {
    "type": "Type",
    "date": "Date",
    "num": "Num",
    "memo": "Memo",
    "name": "Name",
    "qty": "Qty",
    "uom": "U/M",
    "price": "Sales Price",
    "amount": "Amount",
}
HEADER_MARKS = ("Type", "Date", "Amount")
TRANSACTION_TYPES = ("Invoice", "Credit Memo", "Sales Receipt", "Cash Sale")

# Column of the group header, which names the product of the rows below it.
PRODUCT_POSITION = 2

POSITION = ("file", "block", "seq")


def _text(cell: Column) -> Column:
    return F.coalesce(trim_ws(cell), F.lit(""))


def chunk_states(grid: DataFrame, product_position: int = PRODUCT_POSITION) -> DataFrame:
    """One row per chunk (file, block): the header of its file, header_at and at (the column each
    heading has), and the product that rows before its first group header belong to.

    One pass folds every chunk. Which column holds the type is not known before the header is
    found, so group headers are folded apart by which of their cells are blank.
    """
    # plain text search first: hardly any line gets as far as being cut into cells
    is_header = F.lit(True)
    for mark in HEADER_MARKS:
        is_header = is_header & F.col("line").contains(mark)
    no_group = F.col("line").rlike(
        rf'\A(?:[^,"]*+,){{{product_position}}}[{WHITE_SPACE}]*+(?:,|\z|(?i:total))'
    )
    grid = grid.withColumn("cells", F.when(is_header | ~no_group, F.col("cells")))
    for mark in HEADER_MARKS:
        is_header = is_header & F.array_contains("cells", mark)
    group_cell = _text(F.try_element_at("cells", F.lit(product_position + 1)))
    may_head = F.lower(group_cell).rlike(r"\A(?!total)[\s\S]")
    blanks = F.transform("cells", lambda c: F.when(trim_ws(c) == "", "1").otherwise("0"))
    folded = (
        grid.select(
            "file",
            "block",
            "seq",
            F.when(is_header, F.col("cells")).alias("header"),
            F.when(may_head, group_cell).alias("product"),
            F.when(may_head, F.array_join(blanks, "")).alias("blanks"),
        )
        .groupBy("file", "block", "blanks")
        .agg(
            F.min(F.when(F.col("header").isNotNull(), F.struct("seq", "header"))).alias("h"),
            F.max(F.when(F.col("product").isNotNull(), F.struct("seq", "product"))).alias("p"),
        )
    )
    file = Window.partitionBy("file")
    header = F.min(F.when(F.col("h").isNotNull(), F.struct("block", "h.seq", "h.header"))).over(file)
    headed = folded.withColumn("top", header).where(F.col("top").isNotNull())
    backwards = F.reverse(F.transform("top.header", trim_ws))

    def column_of(heading: str) -> Column:
        # searched from the end: the last column wins when a heading occurs twice
        found = F.array_position(backwards, heading)
        return F.when(found > 0, (F.size("top.header") - found).cast("int"))

    named = headed.select(
        "file",
        "block",
        "blanks",
        "p",
        F.struct("top.block", "top.seq").alias("header_at"),
        F.struct(*[column_of(h).alias(k) for k, h in HEADINGS.items()]).alias("at"),
    )
    # a group header has no type: its cell there is blank, or the row ends before it
    flag = F.substring(F.col("blanks"), F.col("at.type") + 1, F.lit(1))
    is_group = (F.struct("block", "p.seq") > F.col("header_at")) & (
        F.col("at.type").isNull() | (flag != "0")
    )
    chunks = named.groupBy("file", "block").agg(
        F.max(F.when(is_group, F.col("p"))).alias("last"),
        F.first("header_at").alias("header_at"),
        F.first("at").alias("at"),
    )
    earlier = (
        Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = F.last("last.product", ignorenulls=True).over(earlier)
    return chunks.select("file", "block", "header_at", "at", carried.alias("carried"))


def report_lines(grid: DataFrame, product_position: int = PRODUCT_POSITION) -> DataFrame:
    """Transaction rows of the reports, each with the product of the group it stands in.

    The text is read twice: once to fold its chunks, once for the rows. Rows are shuffled once,
    by chunk, to find the group header above each.
    """
    # on the line rather than the cells, which would be cut twice
    filled = grid.where(F.translate("line", ", \t\r", "") != "")
    states = chunk_states(filled, product_position)
    # ten cells are needed, so only these are freed of their quotes
    cut = filled.withColumn("raw", raw_cells(F.col("line")))
    cut = cut.withColumn("raw", checked_cells(F.col("raw")))
    body = cut.join(states, ["file", "block"]).where(
        F.struct("block", "seq") > F.col("header_at")
    )
    named = body.select(
        *POSITION,
        "source_file",
        "carried",
        _text(raw_cell(F.col("raw"), F.lit(product_position))).alias("group_cell"),
        *[_text(raw_cell(F.col("raw"), F.col(f"at.{k}"))).alias(k) for k in HEADINGS],
    )
    # Subtotals and grand totals are neither: their type is no transaction, their group cell
    # starts with "total". Few references to a cell keep the pushed-down filter small.
    is_transaction = F.col("type").isin(*TRANSACTION_TYPES)
    is_group = (F.col("type") == "") & F.lower("group_cell").rlike(r"\A(?!total)[\s\S]")
    inside = (
        Window.partitionBy("file", "block")
        .orderBy("seq")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    above = F.last(F.when(is_group, F.col("group_cell")), ignorenulls=True).over(inside)
    with_product = (
        named.where(is_group | is_transaction)
        .withColumn("product", F.coalesce(above, "carried", F.lit("")))
        .where(is_transaction)
    )
    return with_product.select(
        *POSITION,
        F.col("num").alias("invoice_num"),
        report_date(F.col("date")).alias("date"),
        F.col("date").alias("date_text"),
        F.col("name").alias("customer_name"),
        F.col("product").alias("product_description"),
        "memo",
        tolerant_double(F.col("qty")).alias("quantity"),
        F.col("uom").alias("unit_of_measure"),
        tolerant_double(F.col("price")).alias("unit_price"),
        tolerant_double(F.col("amount")).alias("line_amount"),
        "source_file",
    )


def classify(records: DataFrame) -> DataFrame:
    """Adds `reason`: the first rule a record breaks, null for a valid record."""

    def missing(column: str) -> Column:
        return F.coalesce(trim_ws(F.col(column)), F.lit("")) == ""

    return records.withColumn(
        "reason",
        F.when(missing("invoice_num"), "missing invoice_num")
        .when(missing("customer_name"), "missing customer_name")
        .when(missing("date_text"), "missing date")
        .when(F.col("date").isNull(), "unparsable date"),
    )


def rejects(records: DataFrame) -> DataFrame:
    return classify(records).where(F.col("reason").isNotNull())


def accepted(records: DataFrame) -> DataFrame:
    return classify(records).where(F.col("reason").isNull()).drop("reason")


def invoice_lines(records: DataFrame, line_ids: str = "file", store: str = STORE) -> DataFrame:
    """One row per accepted record.

    `line_ids="file"` numbers the lines of all files of one name on, as the id carries the name:
    equal names in several folders get no id twice, and other names leave ids as they are.
    `"overall"` numbers them across all files in reading order.
    """
    numbered = dense_sequence(
        accepted(records),
        "_line",
        group={"file": ["source_file"], "overall": []}[line_ids],
        chunk=["file", "block"],
        order=["seq"],
    )
    file_part = [F.col("source_file")] if line_ids == "file" else []
    id_parts = [trim_ws(F.col("invoice_num")), *file_part, F.col("_line").cast("string")]
    memo = F.coalesce(trim_ws(F.col("memo")), F.lit(""))
    return numbered.select(
        F.concat_ws("_", *id_parts).alias("line_id"),
        *_invoice_columns(),
        first_filled(
            trim_ws(F.col("product_description")), memo, default="Unknown"
        ).alias("product_description"),
        memo.alias("memo"),
        "quantity",
        blank_to_null(trim_ws(F.col("unit_of_measure"))).alias("unit_of_measure"),
        "unit_price",
        F.coalesce("line_amount", F.lit(0.0)).alias("line_amount"),
        F.lit(store).alias("store"),
        F.col("source_file").alias("source"),
        *POSITION,
    )


def _invoice_columns() -> list[Column]:
    return [
        trim_ws(F.col("invoice_num")).alias("invoice_id"),
        F.col("date"),
        month_of(F.col("date")).alias("month"),
        trim_ws(F.col("customer_name")).alias("customer_name"),
    ]


def invoices(records: DataFrame, store: str = STORE) -> DataFrame:
    """One row per invoice; date, customer and source are those of its first line.

    Amounts are summed exactly as decimals and rounded once.
    """
    rows = accepted(records).select(
        *_invoice_columns(), "line_amount", "quantity", "source_file", *POSITION
    )
    first = F.min_by(F.struct("date", "customer_name", "source_file"), F.struct(*POSITION))
    rolled = rows.groupBy("invoice_id").agg(
        first.alias("first"),
        F.sum(money_or_zero(F.col("line_amount"))).alias("amount"),
        F.sum(money_or_zero(F.col("quantity"))).alias("units"),
        F.count(F.lit(1)).alias("line_item_count"),
    )
    return rolled.select(
        "invoice_id",
        F.col("first.date").alias("date"),
        month_of(F.col("first.date")).alias("month"),
        F.col("first.customer_name").alias("customer_name"),
        to_double(F.col("amount")).alias("total_amount"),
        to_double(F.col("units")).alias("total_quantity"),
        "line_item_count",
        F.lit(store).alias("store"),
        F.col("first.source_file").alias("source"),
    )

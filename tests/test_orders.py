from builders import line, order
from conftest import rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from orderloom.operators import orders as o
from orderloom.schemas import BULK_RECORD, LINE_NODE, ORDER_NODE, struct, STRING
from orderloom.sources.bulk import CHILD_KEY, children, parents, read_bulk, read_sides


def raw(spark, *nodes):
    return spark.createDataFrame(list(nodes), ORDER_NODE)


def test_order_columns(spark):
    row = o.fact_orders(raw(spark, order())).first()
    assert row["order_id"] == "o1" and row["order_name"] == "#o1"
    assert (row["total_revenue"], row["subtotal"]) == (64.2, 58.1)
    assert (row["discount_amount"], row["refund_amount"]) == (3.4, 2.7)
    assert (row["customer_id"], row["customer_email"]) == ("c1", "mira@quill.test")
    assert (row["store"], row["channel"], row["currency"]) == ("main_store", "online", "USD")
    assert str(row["created_at"]) == "2026-03-01 10:00:00"


def test_missing_money_and_customer(spark):
    node = order(totalDiscountsSet=None, totalRefundedSet=None, customer=None)
    row = o.fact_orders(raw(spark, node)).first()
    assert (row["discount_amount"], row["refund_amount"]) == (0.0, 0.0)
    assert row["customer_id"] is None and row["customer_email"] is None


def test_only_totals_above_one_are_sales(spark):
    totals = ["0.00", "0.35", "1.00", "-8.00", "1.02", "64.20"]
    df = raw(spark, *[order(f"o{t}", t) for t in totals])
    assert [r["order_id"] for r in rows(o.fact_orders(df))] == ["o1.02", "o64.20"]
    audit = o.filter_audit(df).first().asDict()
    assert audit == {
        "orders_read": 6,
        "zero_orders": 1,
        "small_orders": 3,
        "kept_orders": 2,
    }
    seen = Observation("filter")
    o.fact_orders(o.observe_filter(df, seen)).count()
    assert seen.get == audit


def test_nested_lines(spark):
    nodes = [
        order(
            "o1",
            lines=[
                line("l1", quantity=4, price="17.25"),
                line("l2", quantity=7, price="1.287"),
                line("l3", variant=None),
            ],
        ),
        order("o2", "0.00", lines=[line("l9")]),
        order("o3"),
    ]
    found = rows(o.lines_of_nested(raw(spark, *nodes)), "line_item_id")
    assert [r["line_item_id"] for r in found] == ["l1", "l2", "l3"]
    assert [r["line_revenue"] for r in found] == [69.0, 9.01, 0.0]
    assert found[2]["sku"] is None and found[2]["unit_price"] == 0.0


def test_half_cents_round_up(spark):
    node = order(lines=[line("a", quantity=1, price="2.675"), line("b", quantity=1, price="0.125")])
    found = rows(o.lines_of_nested(raw(spark, node)), "line_item_id")
    assert [r["line_revenue"] for r in found] == [2.68, 0.13]


BULK = """{"id":"o1","name":"#1","createdAt":"2026-03-01T10:00:00Z","totalPriceSet":{"shopMoney":{"amount":"64.20","currencyCode":"USD"}},"subtotalPriceSet":{"shopMoney":{"amount":"58.10"}},"customer":{"id":"c1"}}

{"id":"l1","title":"Walnut tray","quantity":2,"variant":{"id":"v","sku":"S","price":"17.25"},"__parentId":"o1"}
{"id":"l0","title":"Early child","quantity":1,"variant":null,"__parentId":"o2"}
{"id":"o2","name":"#2","createdAt":"2026-03-02T10:00:00Z","totalPriceSet":{"shopMoney":{"amount":"5.00","currencyCode":"USD"}},"subtotalPriceSet":{"shopMoney":{"amount":"5.00"}}}
{"id":"o3","name":"#3","createdAt":"2026-03-02T10:00:00Z","totalPriceSet":{"shopMoney":{"amount":"7.00","currencyCode":"USD"}},"subtotalPriceSet":{"shopMoney":{"amount":"5.00"}}}

{"id":"l2","title":"Oak spoon","quantity":1,"variant":null,"__parentId":"o1"}
{"id":"lx","title":"Orphan","quantity":1,"variant":null,"__parentId":"gone"}
"""


def test_bulk_export(spark, tmp_path):
    (tmp_path / "bulk.jsonl").write_text(BULK)
    records = read_bulk(spark, str(tmp_path))
    heads, kids = parents(records), children(records)
    lines = rows(o.lines_of_bulk(heads, kids), "line_item_id")
    assert [(r["line_item_id"], r["order_id"]) for r in lines] == [
        ("l0", "o2"),
        ("l1", "o1"),
        ("l2", "o1"),
    ]
    assert [r["id"] for r in o.orphan_lines(heads, kids).collect()] == ["lx"]
    assert o.reconcile_bulk(records).first().asDict() == {
        "records": 7,
        "orders": 3,
        "line_items": 3,
        "orphans": 1,
    }
    assert o.fact_orders(heads).count() == 3


UNSURE = r"""
{"id":"o4","name":"says \"__parentId\": \"o1\"","createdAt":"2026-03-02T10:00:00Z","__parentId":null}
{"id":"o5","name":"__parentId","createdAt":"2026-03-02T10:00:00Z"}
{"id":"l4","title":"Escaped key","quantity":1,"\u005f_parentId":"o4"}
{ "__parentId" : "o5", "id":"l5","title":"Spaces","quantity":1}
{"id":"o6","name":"caf\u00e9","createdAt":"2026-03-02T10:00:00Z"}
"""


def test_sides_of_an_export(spark, tmp_path):
    (tmp_path / "bulk.jsonl").write_text(BULK + UNSURE)
    records = read_bulk(spark, str(tmp_path))
    heads, kids = read_sides(spark, str(tmp_path))
    assert rows(heads, "id") == rows(parents(records), "id")
    assert rows(kids, "id") == rows(children(records), "id")
    assert [r["id"] for r in rows(heads, "id")] == ["o1", "o2", "o3", "o4", "o5", "o6"]
    # all but the child with an escaped key are told by their text, so parsed once
    texts = spark.read.text(str(tmp_path)).where(F.trim("value") != "")
    sure = texts.where(F.col("value").rlike(CHILD_KEY)).count()
    assert sure == kids.count() - 1


def test_bad_bulk_line_fails(spark, tmp_path):
    (tmp_path / "bulk.jsonl").write_text('{"id": "o1"\n')
    try:
        read_bulk(spark, str(tmp_path)).collect()
    except Exception as e:
        assert "MALFORMED" in str(e) or "Malformed" in str(e)
    else:
        raise AssertionError("malformed line went unnoticed")


def test_repeated_parent_does_not_repeat_lines(spark):
    heads = spark.createDataFrame([order("o1"), order("o1", updatedAt="2026-03-05T00:00:00Z")], ORDER_NODE)
    kid_schema = struct(__parentId=STRING, **{f.name: f.dataType for f in LINE_NODE})
    kids = spark.createDataFrame([{"__parentId": "o1", **line("l1")}], kid_schema)
    assert o.lines_of_bulk(heads, kids).count() == 1
    assert "__parentId" in BULK_RECORD.names


def test_variable_weight(spark):
    titles = ["Rice per lb", "Custom Weight", "Oak spoon", None, "TEMP item", "Contemporary art"]
    df = spark.createDataFrame([(t,) for t in titles], "product_title string")
    flags = [r["is_variable_weight"] for r in o.flag_variable_weight(df).collect()]
    assert flags == [True, True, False, False, True, True]
    standard, variable = o.split_variable_weight(df)
    assert (standard.count(), variable.count()) == (2, 4)


def test_fill_email(spark):
    orders = spark.createDataFrame(
        [("o1", "c1", None), ("o2", "c1", "own@x.com"), ("o3", None, None), ("o4", "c9", None)],
        "order_id string, customer_id string, customer_email string",
    )
    known = spark.createDataFrame([("c1", "a@x.com")], "customer_id string, email string")
    found = {r["order_id"]: r["customer_email"] for r in o.fill_email(orders, known).collect()}
    assert found == {"o1": "a@x.com", "o2": "own@x.com", "o3": None, "o4": None}

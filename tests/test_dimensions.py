import json

from builders import customer, order, page, product, variant
from conftest import rows
from pyspark.sql import functions as F

from orderloom.operators import customers as c
from orderloom.operators import inventory as i
from orderloom.operators import orders as o
from orderloom.operators import products as p
from orderloom.schemas import CUSTOMER_NODE, INVENTORY_NODE, ORDER_NODE, PRODUCT_NODE
from orderloom.sources.pages import parse_pages, read_pages, updated_since
from orderloom.sources.sku_map import empty_sku_map, read_master, read_sku_map
from orderloom.sources.stores import dim_stores


def people(spark, *nodes):
    return spark.createDataFrame(list(nodes), CUSTOMER_NODE)


def test_email_and_names(spark):
    df = people(
        spark,
        customer("c1", "  MIRA@Quill.TEST  "),
        customer("c2", "x@x.com", firstName=None, lastName=None),
        customer("c3", None),
        customer("c4", "\t \n"),
        customer("c5", "y@x.com", numberOfOrders=None, defaultAddress=None, lastName=""),
    )
    found = rows(c.dim_customers(df), "customer_id")
    assert [r["email"] for r in found] == ["mira@quill.test", "x@x.com", "y@x.com"]
    assert [r["full_name"] for r in found] == ["Mira Sol", "Unknown", "Mira"]
    assert (found[1]["first_name"], found[1]["last_name"]) == (None, None)
    assert (found[2]["number_of_orders"], found[2]["city"]) == (0, None)
    assert found[0]["total_spent"] == 10.5


def test_first_row_wins_per_id_and_email(spark):
    df = people(
        spark,
        customer("c1", "a@x.com", phone="1"),
        customer("c1", "a@x.com", phone="2", updatedAt="2026-02-02T00:00:00Z"),
        customer("c2", "A@X.com", phone="3", updatedAt="2026-02-03T00:00:00Z"),
    )
    for shuffled in (df, df.repartition(3), df.orderBy("phone", ascending=False)):
        found = c.dim_customers(shuffled).collect()
        assert [(r["customer_id"], r["phone"]) for r in found] == [("c1", "1")]
    latest = c.dim_customers(df, order_by=[F.col("updatedAt").desc()]).collect()
    assert [(r["customer_id"], r["phone"]) for r in latest] == [("c2", "3")]


def test_earliest_order(spark):
    orders = spark.createDataFrame(
        [
            order("o1", createdAt="2026-03-01T00:00:00Z", customer={"id": "c1", "email": "A@x.com"}),
            order("o2", createdAt="2026-01-01T00:00:00Z", customer={"id": "c1", "email": "a@x.com"}),
        ],
        ORDER_NODE,
    )
    df = people(spark, customer("c1", "a@x.com"), customer("c2", "b@x.com"))
    found = rows(c.dim_customers(df, o.fact_orders(orders)), "customer_id")
    assert [str(r["first_order_date"]) for r in found] == ["2026-01-01 00:00:00", "None"]
    profile = c.customer_profile(c.dim_customers(df, o.fact_orders(orders))).first().asDict()
    assert profile == {
        "customers": 2,
        "with_orders": 2,
        "with_names": 2,
        "with_location": 2,
        "with_first_order": 1,
    }
    sample = c.sample_customer(c.dim_customers(df, o.fact_orders(orders))).collect()
    assert [r["customer_id"] for r in sample] == ["c1"]


def goods(spark, *nodes):
    return spark.createDataFrame(list(nodes), PRODUCT_NODE)


def mapping(spark, **pairs):
    return spark.createDataFrame(list(pairs.items()) or [], "name string, canonical_sku string")


def test_sku_ladder(spark):
    by_title = mapping(spark, **{"Walnut tray": "KEY-1"})
    by_sku = spark.createDataFrame([("WT-7", "KEY-2")], "name string, canonical_sku string")
    none = empty_sku_map(spark)

    def sku(node, m):
        return p.dim_products(goods(spark, node), m).first()["canonical_sku"]

    assert sku(product(), none) == "WT-7"
    assert sku(product(), by_title) == "KEY-1"
    assert sku(product(), by_sku) == "KEY-2"
    assert sku(product(title="  Walnut tray "), by_title) == "KEY-1"
    assert sku(product(variants=[variant(sku="")]), none) is None
    assert sku(product(variants=[variant(sku=None)]), none) is None


def test_variants_and_weight(spark):
    node = product(variants=[variant("v1", inventoryItem=None, price=None), variant("v2", sku="")])
    df = p.dim_products(goods(spark, node), empty_sku_map(spark))
    found = rows(df, "shopify_variant_id")
    assert [r["shopify_variant_id"] for r in found] == ["v1", "v2"]
    assert found[0]["weight_value"] is None and found[0]["price"] == 0.0
    assert found[1]["weight_value"] == 0.75
    assert (p.mapped(df).count(), p.unmapped(df).count()) == (1, 1)


def test_pages(spark, tmp_path):
    first = page("customers", [customer("c1"), customer("c2")])
    second = page("customers", [customer("c3")])
    (tmp_path / "a.json").write_text(json.dumps(first) + "\n" + json.dumps(second) + "\n")
    raw = read_pages(spark, str(tmp_path), "customers")
    assert sorted(r["id"] for r in raw.collect()) == ["c1", "c2", "c3"]
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "b.json").write_text(json.dumps(first, indent=2))
    whole = read_pages(spark, str(tmp_path / "one"), "customers", multi_line=True)
    assert whole.count() == 2
    texts = spark.createDataFrame([(json.dumps(second),)], "value string")
    assert parse_pages(texts, "value", "customers").first()["id"] == "c3"


def test_read_window(spark):
    df = people(
        spark,
        customer("old", updatedAt="2026-01-31T23:59:59Z"),
        customer("edge", updatedAt="2026-02-01T00:00:00Z"),
    )
    kept = updated_since(df, "2026-02-01T00:00:00Z").collect()
    assert [r["id"] for r in kept] == ["edge"]
    assert updated_since(df, None).count() == 2


def test_sku_map_pages(spark, tmp_path):
    records = [
        {"fields": {"Shopify Name": " Walnut tray ", "SKU": "OLD"}},
        {"fields": {"Shopify Product Name": "Walnut tray", "Canonical SKU": " NEW "}},
        {"fields": {"Shopify Name": "No code"}},
        {"fields": {"Shopify Name": "", "SKU": "No name"}},
    ]
    (tmp_path / "map.json").write_text(json.dumps({"records": records}) + "\n")
    found = read_sku_map(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in found] == [("Walnut tray", "NEW")]
    master = read_master(spark, str(tmp_path)).collect()
    assert len(master) == 4 and master[0]["fields"]["SKU"] == "OLD"


def test_inventory(spark):
    level = {
        "id": "lv1",
        "quantities": [{"name": "on_hand", "quantity": 7}, {"name": "available", "quantity": 5}],
        "location": {"id": "w1", "name": "Barn"},
    }
    other = {"id": "lv2", "quantities": [], "location": {"id": "w2", "name": "Shop"}}
    nodes = [
        {"id": "i0", "sku": "S0", "tracked": False, "inventoryLevels": {"edges": []}},
        {
            "id": "i1",
            "sku": "S1",
            "tracked": True,
            "inventoryLevels": {"edges": [{"node": level}, {"node": other}]},
        },
    ]
    raw = spark.createDataFrame(nodes, INVENTORY_NODE)
    found = rows(i.inventory_levels(raw), "level_id")
    assert [(r["location_id"], r["available"], r["on_hand"]) for r in found] == [
        ("w1", 5, 7),
        ("w2", None, None),
    ]
    assert i.sample_item(raw).first()["id"] == "i1"


def test_stores(spark):
    assert dim_stores(spark, [("s", "S", "E", "pos", "x")]).first()["store_id"] == "s"

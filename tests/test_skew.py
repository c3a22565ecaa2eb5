"""A third of all rows on one key: results stay whole and no task gets them all."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from orderloom.operators import orders as o
from orderloom.operators.dedup import latest_per_key
from orderloom.operators.positions import dense_sequence, fill_forward
from orderloom.schemas import ORDER_NODE
from builders import order

ROWS = 30000


@pytest.fixture
def no_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_order(spark, no_broadcast):
    heads = spark.createDataFrame([order(f"o{n}") for n in range(50)], ORDER_NODE)
    kids = spark.range(ROWS, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "o7").otherwise(F.concat(F.lit("o"), F.col("id") % 60)).alias(
            "__parentId"
        ),
        F.concat(F.lit("l"), "id").alias("id"),
        F.lit("Walnut tray").alias("title"),
        F.lit(1).alias("quantity"),
        F.struct(F.lit("v").alias("id"), F.lit("S").alias("sku"), F.lit("2").alias("price")).alias(
            "variant"
        ),
    )
    lines = o.lines_of_bulk(heads, kids)
    expected = sum(1 for i in range(ROWS) if i % 3 == 0 or i % 60 < 50)
    assert len(lines.collect()) == expected
    assert "skew=true" in lines._jdf.queryExecution().executedPlan().toString()
    assert o.orphan_lines(heads, kids).count() == ROWS - expected


def test_hot_key_dedup(spark):
    df = spark.range(ROWS, numPartitions=8).selectExpr(
        "IF(id % 3 = 0, -1, id % 100) AS k", "id AS v"
    )
    found = {r["k"]: r["v"] for r in latest_per_key(df, ["k"], "v").collect()}
    expected = {}
    for i in range(ROWS):
        expected[-1 if i % 3 == 0 else i % 100] = i
    assert found == expected


def test_one_file_in_many_chunks(spark):
    df = spark.range(ROWS).selectExpr(
        "'f' AS file", "id div 500 AS block", "id AS seq", "IF(id % 1777 = 5, concat('p', id), NULL) AS h"
    )
    filled = fill_forward(
        df.repartition(8), F.col("h"), "product", group=["file"], chunk=["block"], order=["seq"]
    )
    numbered = dense_sequence(
        filled.where("seq % 7 <> 0"), "n", group=[], chunk=["file", "block"], order=["seq"]
    )
    current, n = None, 0
    expected = []
    for i in range(ROWS):
        current = f"p{i}" if i % 1777 == 5 else current
        if i % 7:
            expected.append((i, current, n))
            n += 1
    found = sorted((r["seq"], r["product"], r["n"]) for r in numbered.collect())
    assert found == expected
    assert rows(numbered.limit(1))


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_title_and_guest_orders(spark, no_broadcast):
    from orderloom.operators.dedup import one_per_key
    from orderloom.operators.products import dim_products
    from orderloom.schemas import PRODUCT_NODE

    variants = F.struct(
        F.array(
            F.struct(
                F.struct(
                    *[
                        (
                            F.concat(F.lit("s"), "id")
                            if f.name == "sku"
                            else F.lit(None)
                        ).cast(f.dataType).alias(f.name)
                        for f in PRODUCT_NODE["variants"].dataType["edges"].dataType.elementType["node"].dataType
                    ]
                ).alias("node")
            )
        ).alias("edges")
    )
    title = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 90))
    raw = spark.range(ROWS, numPartitions=8).select(
        F.concat(F.lit("p"), "id").alias("id"),
        title.alias("title"),
        *[F.lit(None).cast("string").alias(f.name) for f in PRODUCT_NODE if f.name not in ("id", "title", "variants")],
        variants.alias("variants"),
    )
    pairs = spark.range(100).selectExpr(
        "IF(id = 0, 'hot', concat('t', id)) AS name", "concat('C', id) AS canonical_sku"
    )
    mapping = one_per_key(pairs, ["name"], [F.col("canonical_sku")])
    products = dim_products(raw, mapping)
    assert "skew=true" in final_plan(products)
    found = {r["canonical_sku"]: r["count"] for r in products.groupBy("canonical_sku").count().collect()}
    assert found["C0"] == ROWS // 3 and sum(found.values()) == ROWS

    orders = spark.range(ROWS, numPartitions=8).selectExpr(
        "concat('o', id) AS order_id",
        "IF(id % 3 = 0, NULL, concat('c', id % 90)) AS customer_id",
        "string(NULL) AS customer_email",
        "repeat('x', 40) AS note",
    )
    customers = spark.range(90).selectExpr("concat('c', id) AS customer_id", "concat(id, '@x') AS email")
    filled = o.fill_email(orders, customers)
    assert "skew=true" in final_plan(filled)
    assert filled.where("customer_email IS NULL").count() == ROWS // 3
    assert filled.count() == ROWS

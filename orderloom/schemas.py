"""Raw input schemas and the catalogue of target tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRING = T.StringType()
LONG = T.LongType()
INT = T.IntegerType()
DOUBLE = T.DoubleType()
BOOL = T.BooleanType()
STAMP = T.TimestampType()
DATE = T.DateType()
DEC = T.DecimalType(18, 4)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


def connection(node: T.DataType) -> T.StructType:
    """Repeated child rows as the commerce API wraps them: edges[].node."""
    return struct(edges=T.ArrayType(struct(node=node)))


# ---- raw entities ---------------------------------------------------------

_AMOUNT = struct(shopMoney=struct(amount=STRING))
_PRICE = struct(shopMoney=struct(amount=STRING, currencyCode=STRING))
_VARIANT_REF = struct(id=STRING, sku=STRING, price=STRING)

LINE_NODE = struct(id=STRING, title=STRING, quantity=INT, variant=_VARIANT_REF)

_ORDER_FIELDS = dict(
    id=STRING,
    name=STRING,
    createdAt=STRING,
    updatedAt=STRING,
    displayFinancialStatus=STRING,
    displayFulfillmentStatus=STRING,
    totalPriceSet=_PRICE,
    subtotalPriceSet=_AMOUNT,
    totalDiscountsSet=_AMOUNT,
    totalRefundedSet=_AMOUNT,
    customer=struct(id=STRING, email=STRING),
)

ORDER_NODE = struct(**_ORDER_FIELDS, lineItems=connection(LINE_NODE))

# One export file mixes parents and children, so the schema is the superset of both.
BULK_RECORD = struct(
    **_ORDER_FIELDS, title=STRING, quantity=INT, variant=_VARIANT_REF, __parentId=STRING
)

CUSTOMER_NODE = struct(
    id=STRING,
    firstName=STRING,
    lastName=STRING,
    email=STRING,
    phone=STRING,
    createdAt=STRING,
    updatedAt=STRING,
    numberOfOrders=STRING,
    amountSpent=struct(amount=STRING, currencyCode=STRING),
    defaultAddress=struct(city=STRING, province=STRING, country=STRING),
)

VARIANT_NODE = struct(
    id=STRING,
    sku=STRING,
    title=STRING,
    price=STRING,
    inventoryQuantity=INT,
    inventoryItem=struct(measurement=struct(weight=struct(value=DOUBLE, unit=STRING))),
)

PRODUCT_NODE = struct(
    id=STRING,
    title=STRING,
    handle=STRING,
    status=STRING,
    productType=STRING,
    vendor=STRING,
    createdAt=STRING,
    updatedAt=STRING,
    variants=connection(VARIANT_NODE),
)

LEVEL_NODE = struct(
    id=STRING,
    quantities=T.ArrayType(struct(name=STRING, quantity=INT)),
    location=struct(id=STRING, name=STRING),
)

INVENTORY_NODE = struct(
    id=STRING,
    sku=STRING,
    tracked=BOOL,
    createdAt=STRING,
    updatedAt=STRING,
    inventoryLevels=connection(LEVEL_NODE),
)

ENTITIES = {
    "orders": ORDER_NODE,
    "customers": CUSTOMER_NODE,
    "products": PRODUCT_NODE,
    "inventoryItems": INVENTORY_NODE,
}


def page_schema(entity: str) -> T.StructType:
    """Envelope of one landed page: data.<entity>.{pageInfo, edges}."""
    body = T.StructType(
        [
            T.StructField("pageInfo", struct(hasNextPage=BOOL, endCursor=STRING)),
            T.StructField("edges", T.ArrayType(struct(node=ENTITIES[entity]))),
        ]
    )
    return T.StructType([T.StructField("data", T.StructType([T.StructField(entity, body)]))])


# The mapping base exists in two generations, so a name and a SKU have two field names each.
SKU_NAME_FIELDS = ("Shopify Name", "Shopify Product Name")
SKU_CODE_FIELDS = ("Canonical SKU", "SKU")

SKU_MAP_PAGE = T.StructType(
    [
        T.StructField(
            "records",
            T.ArrayType(
                struct(
                    fields=T.StructType(
                        [T.StructField(n, STRING) for n in SKU_NAME_FIELDS + SKU_CODE_FIELDS]
                    )
                )
            ),
        )
    ]
)

MASTER_PAGE = struct(
    records=T.ArrayType(struct(id=STRING, fields=T.MapType(STRING, STRING)))
)

SKU_MAP = struct(name=STRING, canonical_sku=STRING)

# ---- target tables --------------------------------------------------------


def _table(required: str, **columns: T.DataType) -> T.StructType:
    needed = required.split()
    return T.StructType([T.StructField(n, t, n not in needed) for n, t in columns.items()])


FACT_ORDERS = _table(
    "order_id",
    order_id=STRING,
    order_name=STRING,
    created_at=STAMP,
    financial_status=STRING,
    fulfillment_status=STRING,
    total_revenue=DOUBLE,
    subtotal=DOUBLE,
    currency=STRING,
    customer_id=STRING,
    customer_email=STRING,
    store=STRING,
    channel=STRING,
    discount_amount=DOUBLE,
    refund_amount=DOUBLE,
)

FACT_ORDER_LINES = _table(
    "order_id line_item_id",
    order_id=STRING,
    line_item_id=STRING,
    product_title=STRING,
    variant_id=STRING,
    sku=STRING,
    quantity=LONG,
    unit_price=DOUBLE,
    line_revenue=DOUBLE,
    is_variable_weight=BOOL,
    store=STRING,
)

DIM_PRODUCTS = _table(
    "shopify_product_id",
    shopify_product_id=STRING,
    shopify_variant_id=STRING,
    raw_name=STRING,
    canonical_sku=STRING,
    variant_title=STRING,
    price=DOUBLE,
    inventory_quantity=LONG,
    weight_value=DOUBLE,
    weight_unit=STRING,
    product_type=STRING,
    vendor=STRING,
    status=STRING,
    created_at=STAMP,
    updated_at=STAMP,
    store=STRING,
)

DIM_CUSTOMERS = _table(
    "customer_id",
    customer_id=STRING,
    email=STRING,
    full_name=STRING,
    first_name=STRING,
    last_name=STRING,
    phone=STRING,
    city=STRING,
    province=STRING,
    country=STRING,
    number_of_orders=LONG,
    total_spent=DOUBLE,
    currency=STRING,
    created_at=STAMP,
    updated_at=STAMP,
    store=STRING,
    first_order_date=STAMP,
)

DIM_STORES = _table(
    "store_id",
    store_id=STRING,
    store_name=STRING,
    entity=STRING,
    channel=STRING,
    shopify_instance=STRING,
)

FACT_B2B_INVOICES = _table(
    "invoice_id",
    invoice_id=STRING,
    date=DATE,
    month=STRING,
    customer_name=STRING,
    total_amount=DOUBLE,
    total_quantity=DOUBLE,
    line_item_count=LONG,
    store=STRING,
    source=STRING,
)

FACT_B2B_INVOICE_LINES = _table(
    "line_id",
    line_id=STRING,
    invoice_id=STRING,
    date=DATE,
    month=STRING,
    customer_name=STRING,
    product_description=STRING,
    memo=STRING,
    quantity=DOUBLE,
    unit_of_measure=STRING,
    unit_price=DOUBLE,
    line_amount=DOUBLE,
    store=STRING,
    source=STRING,
)

PIPELINE_SUMMARY = _table(
    "summary_id",
    summary_id=STRING,
    store=STRING,
    generated_at=STAMP,
    summary_text=STRING,
    total_revenue=DOUBLE,
    total_transactions=LONG,
    online_revenue=DOUBLE,
    online_gross_sales=DOUBLE,
    online_discounts=DOUBLE,
    online_refunds=DOUBLE,
    online_orders=LONG,
    online_units=LONG,
    online_aov=DOUBLE,
    online_pct=DOUBLE,
    new_customers=LONG,
    returning_customers=LONG,
    unique_online_customers=LONG,
    top_online_product=STRING,
    top_online_product_revenue=DOUBLE,
    b2b_revenue=DOUBLE,
    b2b_invoices=LONG,
    b2b_weight=DOUBLE,
    b2b_customers=LONG,
    b2b_avg_invoice=DOUBLE,
    b2b_pct=DOUBLE,
    top_b2b_customer=STRING,
    top_b2b_revenue=DOUBLE,
)

PIPELINE_CONTROL = _table(
    "control_key",
    control_key=STRING,
    last_successful_watermark=STAMP,
    last_run_at=STAMP,
    last_run_order_count=LONG,
)


def earlier_of(stored: Column, staged: Column) -> Column:
    """Merge rule: least() skips nulls, so a known date survives an unknown one."""
    return F.least(stored, staged)


@dataclass(frozen=True)
class TableSpec:
    """How one target table is keyed, deduplicated, merged and laid out.

    `buckets` lays the table out by key hash: a row never moves, but any batch larger than
    the bucket count touches them all. `month_of` lays it out by the month of a date column,
    so a batch of recent rows rewrites recent months only.
    `month_fixed` says that the date of a key never changes, so a key is in the month it arrives
    for and upserts need not search the table for it.
    `version` is a staged column; a staged row older than the stored one is ignored.
    """

    schema: T.StructType
    keys: tuple[str, ...]
    buckets: int = 16
    month_of: str | None = None
    month_fixed: bool = False
    version: str | None = None
    rules: dict[str, Callable[[Column, Column], Column]] = field(default_factory=dict)


TABLES = {
    "fact_orders": TableSpec(
        FACT_ORDERS, ("order_id",), month_of="created_at", month_fixed=True, version="updated_at"
    ),
    "fact_order_lines": TableSpec(
        FACT_ORDER_LINES,
        ("line_item_id",),
        month_of="order_created_at",
        month_fixed=True,
        version="updated_at",
    ),
    "dim_products": TableSpec(
        DIM_PRODUCTS, ("shopify_product_id", "shopify_variant_id"), version="updated_at"
    ),
    "dim_customers": TableSpec(
        DIM_CUSTOMERS,
        ("customer_id",),
        version="updated_at",
        rules={"first_order_date": earlier_of},
    ),
    "dim_stores": TableSpec(DIM_STORES, ("store_id",), buckets=1),
    "fact_b2b_invoices": TableSpec(FACT_B2B_INVOICES, ("invoice_id",), month_of="date"),
    "fact_b2b_invoice_lines": TableSpec(FACT_B2B_INVOICE_LINES, ("line_id",), month_of="date"),
    "pipeline_summary": TableSpec(PIPELINE_SUMMARY, ("summary_id",), buckets=1),
    "pipeline_control": TableSpec(PIPELINE_CONTROL, ("control_key",), buckets=1),
}


def schema_of(table: str) -> T.StructType:
    """Declared schema; a staging table has the schema of its base table."""
    return TABLES[table.removesuffix("_staging")].schema


def conform(df, schema: T.StructType):
    """Cast and order the columns of `schema` that `df` has."""
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema if f.name in df.columns]
    )

"""SQL each catalogue query is checked against, over the same tables.

Written from the meaning of the queries; shared parts are common table expressions.
"""

from __future__ import annotations

# spelled out again rather than imported: a wrong value in the library must show
KEYWORDS = (
    "per lb", "per pound", "per kg", "/lb", "/kg", "variable", "by weight", "custom weight", "temp"
)
RUN_AT = "2024-02-01 00:00:00"
LARGE = "total_revenue > 100000"


def dec(c: str) -> str:
    return f"CAST({c} AS DECIMAL(18,2))"


def dbl(c: str) -> str:
    return f"CAST({c} AS DOUBLE)"


def latest(condition: str) -> str:
    return f"""(
        SELECT * FROM lineitem WHERE {condition}
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_shipdate DESC, l_discount, l_extendedprice, l_linestatus, l_partkey,
            l_quantity, l_returnflag, l_suppkey, l_tax) = 1)"""


TOTAL = dec("o_totalprice")
STORED = "l_shipdate < TIMESTAMP '1998-07-01'"
ARRIVING = "l_shipdate >= TIMESTAMP '1998-01-01'"

CTES = {
    "fo": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, '#' || o_orderkey AS order_name,
          o_orderdate AS created_at,
          CASE o_orderstatus WHEN 'F' THEN 'PAID' WHEN 'O' THEN 'PENDING'
            ELSE 'PARTIALLY_PAID' END AS financial_status,
          CASE WHEN o_orderpriority <> '1-URGENT' THEN 'FULFILLED' END AS fulfillment_status,
          {dbl(TOTAL)} AS total_revenue,
          {dbl(dec(f'{TOTAL} * 0.9'))} AS subtotal,
          'USD' AS currency,
          CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
            THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
          CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' AND o_orderstatus = 'F'
            THEN ' Customer' || o_custkey || '@Example.com ' END AS customer_email,
          'main_store' AS store, 'online' AS channel,
          CASE WHEN o_orderstatus <> 'O' THEN {dbl(dec(f'{TOTAL} * 0.05'))} ELSE 0.0 END
            AS discount_amount,
          CASE WHEN o_orderpriority = '5-LOW' THEN {dbl(dec(f'{TOTAL} * 0.01'))} ELSE 0.0 END
            AS refund_amount,
          o_orderstatus
        FROM orders WHERE {TOTAL} > 1""",
    "ln": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
          l_orderkey || '-' || l_linenumber AS line_item_id,
          CASE WHEN p_size <> 50 THEN p_name || CASE WHEN p_size % 7 = 0 THEN ' per lb'
            WHEN p_size % 11 = 0 THEN ' Custom Weight' ELSE '' END END AS product_title,
          CASE WHEN p_size % 13 <> 0 THEN 'v' || p_partkey END AS variant_id,
          CASE WHEN p_size % 13 = 0 OR p_partkey % 10 = 0 THEN NULL
            WHEN p_partkey % 10 = 1 THEN '0' ELSE 'SKU-' || p_partkey END AS sku,
          CAST(l_quantity AS BIGINT) AS quantity,
          CASE WHEN p_size % 13 <> 0 THEN {dec('p_retailprice')} ELSE 0 END AS price
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "fl": f"""
        SELECT order_id, line_item_id, product_title, variant_id, sku, quantity,
          {dbl('price')} AS unit_price, {dbl('quantity * price')} AS line_revenue,
          COALESCE({' OR '.join(f"contains(lower(product_title), '{k}')"
                                for k in KEYWORDS)}, FALSE)
            AS is_variable_weight,
          'main_store' AS store
        FROM ln SEMI JOIN fo USING (order_id)""",
    "rc": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
          CASE WHEN c_nationkey = 5 OR c_nationkey = 7 THEN NULL
            ELSE 'customer' || CASE WHEN c_nationkey = 3 THEN c_custkey - c_custkey % 2
              ELSE c_custkey END || '@example.com' END AS email,
          CASE WHEN c_acctbal >= 500 THEN replace(c_name, '#', ' ')
            WHEN c_acctbal >= 0 THEN split_part(c_name, '#', 1) ELSE 'Unknown' END AS full_name,
          CASE WHEN c_acctbal >= 0 THEN split_part(c_name, '#', 1) END AS first_name,
          CASE WHEN c_acctbal >= 500 THEN split_part(c_name, '#', 2) END AS last_name,
          CAST(NULL AS VARCHAR) AS phone,
          CASE WHEN c_nationkey <> 11 THEN CASE WHEN c_mktsegment = 'BUILDING' THEN 'Moved'
            ELSE 'City ' || c_nationkey END END AS city,
          CASE WHEN c_nationkey <> 11 THEN r_name END AS province,
          CASE WHEN c_nationkey <> 11 THEN n_name END AS country,
          CASE WHEN c_acctbal >= 0 THEN c_custkey % 5 ELSE 0 END AS number_of_orders,
          {dbl(dec('c_acctbal'))} AS total_spent, 'USD' AS currency,
          TIMESTAMP '1992-01-01' + to_days(CAST(c_custkey % 2000 AS INTEGER)) AS created_at,
          TIMESTAMP '1992-01-02' + to_days(CAST(c_custkey % 2000 AS INTEGER)
            + CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END) AS updated_at,
          CAST({dec('c_acctbal')} AS VARCHAR) AS spent_text,
          'main_store' AS store
        FROM customer JOIN nation ON c_nationkey = n_nationkey
          JOIN region ON n_regionkey = r_regionkey""",
    "uc": """
        SELECT * FROM rc WHERE email IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY email ORDER BY updated_at DESC, spent_text, created_at,
          customer_id) = 1""",
    "first_orders": """
        SELECT lower(trim(customer_email)) AS email, min(created_at) AS first_order_date
        FROM fo WHERE customer_email IS NOT NULL GROUP BY 1""",
    "dc": """
        SELECT uc.*, first_order_date FROM uc LEFT JOIN first_orders USING (email)""",
    "dp": f"""
        SELECT 'p' || p_partkey AS shopify_product_id, p_partkey || '-' || i AS shopify_variant_id,
          p_name || ' ' || p_partkey AS raw_name,
          CASE WHEN p_partkey % 4 = 0 THEN 'CANON-' || p_partkey
            WHEN p_partkey % 4 = 2 THEN 'OLD-' || p_partkey
            WHEN p_partkey % 10 IN (0, 1) THEN NULL
            WHEN p_partkey % 4 = 1 AND i = 1 THEN 'RAW-' || p_partkey
            ELSE 'SKU-' || p_partkey || '-' || i END AS canonical_sku,
          'Size ' || i AS variant_title,
          {dbl(f"{dec('p_retailprice')} + i")} AS price,
          CASE WHEN i <> 3 THEN CAST(p_size * i AS BIGINT) ELSE 0 END AS inventory_quantity,
          CASE WHEN p_size % 5 <> 0 THEN p_size / 2.0 END AS weight_value,
          CASE WHEN p_size % 5 <> 0 THEN 'POUNDS' END AS weight_unit,
          p_type AS product_type, p_brand AS vendor,
          CASE WHEN p_size % 4 = 0 THEN 'DRAFT' ELSE 'ACTIVE' END AS status,
          TIMESTAMP '2024-01-02 03:04:05' AS created_at,
          TIMESTAMP '2024-02-03 04:05:06' AS updated_at, 'main_store' AS store
        FROM (SELECT *, unnest(generate_series(1, p_size % 3 + 1)) AS i FROM part)""",
    "numbered": "SELECT *, row_number() OVER () - 1 AS seq FROM lineitem",
    "b": """
        SELECT seq,
          CASE WHEN l_returnflag = 'R' AND l_quantity = 1 THEN '  '
            ELSE ' ' || l_orderkey || ' ' END AS invoice_num,
          CASE WHEN l_returnflag = 'R' AND l_quantity = 2 THEN '' ELSE s_name END
            AS customer_name,
          CASE WHEN l_returnflag = 'A' AND l_quantity = 1 THEN ''
            WHEN l_returnflag = 'A' AND l_quantity = 2 THEN 'n/a'
            WHEN l_linenumber % 3 = 1 THEN strftime(l_shipdate, '%Y-%m-%d')
            WHEN l_linenumber % 3 = 2 AND year(l_shipdate) >= 2000
              THEN strftime(l_shipdate, '%-m/%-d/%y')
            ELSE strftime(l_shipdate, '%m/%d/%Y') END AS date_text,
          CASE WHEN l_returnflag = 'A' AND l_quantity <= 2 THEN NULL
            ELSE CAST(l_shipdate AS DATE) END AS date,
          CASE WHEN p_size % 9 = 0 THEN '' ELSE p_name END AS product_description,
          CASE WHEN p_size % 2 = 0 THEN '' ELSE 'memo ' || p_name END AS memo,
          l_quantity * 100 AS quantity,
          CASE WHEN p_size % 2 = 1 THEN 'lb' ELSE '' END AS unit_of_measure,
          p_retailprice AS unit_price,
          CASE WHEN l_linenumber <> 7 THEN l_extendedprice END AS line_amount,
          'sales_' || year(l_shipdate) || '.csv' AS source_file
        FROM numbered JOIN part ON l_partkey = p_partkey
          JOIN supplier ON l_suppkey = s_suppkey""",
    "checked": """
        SELECT *, trim(invoice_num) AS invoice_id, strftime(date, '%Y-%m') AS month,
          CASE WHEN trim(invoice_num) = '' THEN 'missing invoice_num'
            WHEN trim(customer_name) = '' THEN 'missing customer_name'
            WHEN trim(date_text) = '' THEN 'missing date'
            WHEN date IS NULL THEN 'unparsable date' END AS reason
        FROM b""",
    "ok": "SELECT * FROM checked WHERE reason IS NULL",
    "iv": f"""
        SELECT invoice_id, arg_min(date, seq) AS date, arg_min(month, seq) AS month,
          arg_min(customer_name, seq) AS customer_name,
          {dbl(f"sum({dec('coalesce(line_amount, 0)')})")} AS total_amount,
          {dbl(f"sum({dec('quantity')})")} AS total_quantity,
          count(*) AS line_item_count, 'main_store' AS store,
          arg_min(source_file, seq) AS source
        FROM ok GROUP BY invoice_id""",
    "il": """
        SELECT *, row_number() OVER (ORDER BY seq) - 1 AS n,
          row_number() OVER (PARTITION BY source_file ORDER BY seq) - 1 AS n_file FROM ok""",
    "stored": f"SELECT * FROM {latest(STORED)}",
    "arriving": f"SELECT * FROM {latest(ARRIVING)}",
    "merged": """
        SELECT * FROM arriving
        UNION ALL SELECT * FROM stored ANTI JOIN arriving USING (l_orderkey, l_linenumber)""",
    "per_customer": f"""
        SELECT customer_id, count(*) AS n, sum({dec('total_revenue')}) AS net,
          sum({dec('subtotal')} + {dec('discount_amount')}) AS gross,
          sum({dec('discount_amount')}) AS discounts, sum({dec('refund_amount')}) AS refunds
        FROM fo GROUP BY customer_id""",
    "per_product": f"""
        SELECT coalesce(product_title, 'Unknown') AS name, sum({dec('line_revenue')}) AS revenue,
          sum(quantity) AS units FROM fl GROUP BY 1""",
    "per_account": f"""
        SELECT customer_name AS name, sum({dec('total_amount')}) AS revenue,
          sum({dec('total_quantity')}) AS units, count(*) AS n FROM iv GROUP BY 1""",
    "online": """
        SELECT sum(n) AS orders, sum(net) AS net, sum(gross) AS gross,
          sum(discounts) AS discounts, sum(refunds) AS refunds,
          count(*) FILTER (customer_id IS NOT NULL AND n = 1) AS new_customers,
          count(*) FILTER (customer_id IS NOT NULL AND n > 1) AS returning_customers,
          count(customer_id) AS customers
        FROM per_customer""",
    "b2b": """
        SELECT sum(n) AS invoices, sum(revenue) AS revenue, sum(units) AS weight,
          count(*) AS customers FROM per_account""",
    "best_product": "SELECT * FROM per_product ORDER BY revenue DESC, name LIMIT 1",
    "best_account": "SELECT * FROM per_account ORDER BY revenue DESC, name LIMIT 1",
    "figures": f"""
        SELECT {dbl('online.net + b2b.revenue')} AS total_revenue,
          CAST(orders + invoices AS BIGINT) AS total_transactions,
          {dbl('net')} AS online_revenue, {dbl('gross')} AS online_gross_sales,
          {dbl('discounts')} AS online_discounts, {dbl('refunds')} AS online_refunds,
          CAST(orders AS BIGINT) AS online_orders,
          CAST((SELECT sum(units) FROM per_product) AS BIGINT) AS online_units,
          round({dbl('net')} / orders, 2) AS online_aov,
          round(100 - round({dbl('b2b.revenue')} / {dbl('net + b2b.revenue')} * 100, 1), 1)
            AS online_pct,
          new_customers, returning_customers, online.customers AS unique_online_customers,
          best_product.name AS top_online_product,
          {dbl('best_product.revenue')} AS top_online_product_revenue,
          {dbl('b2b.revenue')} AS b2b_revenue, CAST(invoices AS BIGINT) AS b2b_invoices,
          {dbl('weight')} AS b2b_weight, b2b.customers AS b2b_customers,
          round({dbl('b2b.revenue')} / invoices, 2) AS b2b_avg_invoice,
          round({dbl('b2b.revenue')} / {dbl('net + b2b.revenue')} * 100, 1) AS b2b_pct,
          best_account.name AS top_b2b_customer,
          {dbl('best_account.revenue')} AS top_b2b_revenue
        FROM online, b2b, best_product, best_account""",
    "qa": """
        SELECT 'total_orders' AS "check", 'info' AS level, count(*) AS n FROM fo
        UNION ALL SELECT 'orders_missing_customer', 'warning',
          count(*) FILTER (customer_id IS NULL) FROM fo
        UNION ALL SELECT 'total_order_lines', 'info', count(*) FROM fl
        UNION ALL SELECT 'lines_missing_sku', 'warning',
          count(*) FILTER (sku IS NULL OR sku IN ('', '0')) FROM fl
        UNION ALL SELECT 'total_products_mapped', 'info', count(canonical_sku) FROM dp
        UNION ALL SELECT 'total_products_unmapped', 'info',
          count(*) FILTER (canonical_sku IS NULL) FROM dp
        UNION ALL SELECT 'products_unmapped', 'warning',
          count(*) FILTER (canonical_sku IS NULL) FROM dp
        UNION ALL SELECT 'products_draft', 'warning',
          count(*) FILTER (canonical_sku IS NOT NULL AND status = 'DRAFT') FROM dp
        UNION ALL SELECT 'total_customers', 'info', count(*) FROM dc
        UNION ALL SELECT 'customers_unknown_name', 'warning',
          count(*) FILTER (full_name = 'Unknown') FROM dc
        UNION ALL SELECT 'customers_no_location', 'warning',
          count(*) FILTER (country IS NULL) FROM dc""",
    "clicks": """
        SELECT date_trunc('second', max(ts)) - INTERVAL 1 HOUR AS since
        FROM events WHERE event_type = 'click'""",
}

NEEDS = {
    "fl": "ln fo",
    "uc": "rc",
    "first_orders": "fo",
    "dc": "uc first_orders",
    "b": "numbered",
    "checked": "b",
    "ok": "checked",
    "iv": "ok",
    "il": "ok",
    "merged": "stored arriving",
    "per_customer": "fo",
    "per_product": "fl",
    "per_account": "iv",
    "online": "per_customer",
    "b2b": "per_account",
    "best_product": "per_product",
    "best_account": "per_account",
    "figures": "online b2b best_product best_account per_product",
    "qa": "fo fl dp dc",
}


def using(names: str, body: str) -> str:
    """`body` after the common table expressions it names and those they need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, "").split():
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    return "WITH " + ", ".join(f"{n} AS ({CTES[n]})" for n in ordered) + " " + body


def money(c: str) -> str:
    return f"format('{{:,.2f}}', {c})"


def pct(c: str) -> str:
    return f"format('{{:.1f}}', {c})"


ORDER_COLUMNS = (
    "order_id, order_name, created_at, financial_status, fulfillment_status, total_revenue, "
    "subtotal, currency, customer_id, customer_email, store, channel, discount_amount, "
    "refund_amount"
)
CUSTOMER_COLUMNS = (
    "customer_id, email, full_name, first_name, last_name, phone, city, province, country, "
    "number_of_orders, total_spent, currency, created_at, updated_at, store, first_order_date"
)
INVOICE_LINE = """invoice_id, date, month, trim(customer_name) AS customer_name,
    coalesce(nullif(product_description, ''), nullif(memo, ''), 'Unknown')
      AS product_description,
    memo, quantity, nullif(unit_of_measure, '') AS unit_of_measure, unit_price,
    coalesce(line_amount, 0.0) AS line_amount, 'main_store' AS store, source_file AS source"""

EXPORTED = "o_orderstatus <> 'O'"

ORACLE_SQL = {
    "fact_orders": using("fo", f"SELECT {ORDER_COLUMNS} FROM fo WHERE {LARGE}"),
    "fact_order_lines": using(
        "fl", f"SELECT * FROM fl SEMI JOIN (SELECT order_id FROM fo WHERE {LARGE}) USING (order_id)"
    ),
    "order_filter_audit": f"""
        SELECT count(*) AS orders_read, count(*) FILTER ({TOTAL} = 0) AS zero_orders,
          count(*) FILTER ({TOTAL} <> 0 AND {TOTAL} <= 100000) AS small_orders,
          count(*) FILTER ({TOTAL} > 100000) AS kept_orders FROM orders""",
    "orders_with_email": using(
        "fo rc",
        """SELECT order_id, fo.customer_id,
          coalesce(customer_email, rc.email) AS customer_email
        FROM fo LEFT JOIN rc USING (customer_id)""",
    ),
    "variable_weight_lines": using(
        "fl",
        """SELECT line_item_id, product_title, quantity, is_variable_weight
        FROM fl WHERE is_variable_weight""",
    ),
    "variable_weight_shares": using(
        "fl",
        """SELECT is_variable_weight, count(*) AS lines, CAST(sum(quantity) AS BIGINT) AS units
        FROM fl GROUP BY 1""",
    ),
    "page_unnest_orders": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS id, '#' || o_orderkey AS name,
          strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS "createdAt",
          CAST({TOTAL} AS VARCHAR) AS amount,
          CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
            THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
          count(l_orderkey) AS line_edges
        FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
        GROUP BY o_orderkey, o_orderdate, o_totalprice, o_orderpriority, o_custkey,
          l_linenumber // 4""",
    "landed_order_pages": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id, '#' || o_orderkey AS name,
          count(l_orderkey) AS line_edges
        FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
        GROUP BY o_orderkey, l_linenumber // 4""",
    "landed_bulk_lines": using(
        "fl",
        f"""SELECT order_id, line_item_id, product_title, sku, line_revenue
        FROM fl SEMI JOIN (SELECT order_id FROM fo WHERE {EXPORTED}) USING (order_id)""",
    ),
    "nested_order_lines": using("fl", "SELECT * FROM fl"),
    "bulk_reassemble_lines": using(
        "fl",
        f"""SELECT order_id, line_item_id, product_title, sku, line_revenue
        FROM fl SEMI JOIN (SELECT order_id FROM fo WHERE {EXPORTED}) USING (order_id)""",
    ),
    "bulk_orphans": using(
        "ln",
        f"""SELECT order_id, line_item_id, CAST(quantity AS INTEGER) AS quantity
        FROM ln ANTI JOIN (SELECT CAST(o_orderkey AS VARCHAR) AS order_id FROM orders
          WHERE {EXPORTED}) USING (order_id)""",
    ),
    "bulk_reconcile": f"""
        WITH parents AS (SELECT o_orderkey AS l_orderkey FROM orders WHERE {EXPORTED}),
          kept AS (SELECT count(*) AS n FROM lineitem SEMI JOIN parents USING (l_orderkey)),
          total AS (SELECT count(*) AS n FROM lineitem),
          heads AS (SELECT count(*) AS n FROM parents)
        SELECT total.n + heads.n AS records, heads.n AS orders, kept.n AS line_items,
          total.n - kept.n AS orphans FROM kept, total, heads""",
    "dim_customers": using("dc", f"SELECT {CUSTOMER_COLUMNS} FROM dc"),
    "customer_profile": using(
        "dc",
        """SELECT count(*) AS customers, count(*) FILTER (number_of_orders > 0) AS with_orders,
          count(*) FILTER (full_name <> 'Unknown') AS with_names,
          count(country) AS with_location, count(first_order_date) AS with_first_order
        FROM dc""",
    ),
    "sample_customer": using(
        "dc",
        """SELECT customer_id, email, first_order_date FROM dc
        ORDER BY first_order_date IS NULL, customer_id LIMIT 1""",
    ),
    "customer_first_orders": using("first_orders", "SELECT * FROM first_orders"),
    "customer_frequency": using(
        "fo",
        """SELECT count(*) FILTER (n = 1) AS new_customers,
          count(*) FILTER (n > 1) AS returning_customers, count(*) AS unique_online_customers
        FROM (SELECT customer_id, count(*) AS n FROM fo
          WHERE customer_id IS NOT NULL GROUP BY 1)""",
    ),
    "customer_frequency_by_month": using(
        "fo",
        """SELECT period, count(*) FILTER (n = 1) AS new_customers,
          count(*) FILTER (n > 1) AS returning_customers, count(*) AS unique_online_customers
        FROM (SELECT strftime(created_at, '%Y-%m') AS period, customer_id, count(*) AS n
          FROM fo WHERE customer_id IS NOT NULL GROUP BY 1, 2) GROUP BY period""",
    ),
    "sku_map": """
        SELECT p_name || ' ' || p_partkey AS name,
          CASE WHEN p_partkey % 4 = 0 THEN 'CANON-' ELSE 'OLD-' END || p_partkey AS canonical_sku
        FROM part WHERE p_partkey % 4 IN (0, 2)
        UNION ALL SELECT 'SKU-' || p_partkey || '-1', 'RAW-' || p_partkey
        FROM part WHERE p_partkey % 4 = 1""",
    "dim_products": using("dp", "SELECT * FROM dp"),
    "unmapped_products": using(
        "dp",
        """SELECT shopify_product_id, shopify_variant_id, raw_name
        FROM dp WHERE canonical_sku IS NULL""",
    ),
    "dim_stores_upsert": """
        SELECT s_name AS store_id, s_name AS store_name, n_name AS entity, 'pos' AS channel,
          'TBD' AS shopify_instance
        FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey <> 0
        UNION ALL SELECT 'shop-1', 'First shop', 'North', 'online', 'shop-1.example.org'""",
    "inventory_by_location": """
        SELECT 'i' || l_partkey AS item_id, 'SKU-' || l_partkey AS sku,
          l_partkey % 2 = 0 AS tracked, l_partkey || '@' || l_suppkey AS level_id,
          CAST(l_suppkey AS VARCHAR) AS location_id, 'Location ' || l_suppkey AS location_name,
          CAST(sum(l_quantity) FILTER (l_returnflag = 'N') AS INTEGER) AS available,
          CAST(sum(l_quantity) AS INTEGER) AS on_hand
        FROM lineitem GROUP BY l_partkey, l_suppkey""",
    "report_grid_lines": """
        SELECT CAST(l_orderkey AS VARCHAR) AS invoice_num, CAST(l_shipdate AS DATE) AS date,
          s_name AS customer_name, p_name || ' ' || p_partkey AS product_description,
          'said "' || p_name || '", twice' AS memo, l_quantity * 100 AS quantity,
          'lb' AS unit_of_measure, p_retailprice AS unit_price, l_extendedprice AS line_amount,
          'sales_' || year(l_shipdate) || '_' || (l_partkey // 100) || '.csv' AS source_file
        FROM lineitem JOIN part ON l_partkey = p_partkey
          JOIN supplier ON l_suppkey = s_suppkey
        WHERE l_linenumber <> 7""",
    "landed_report_lines": """
        SELECT CAST(l_orderkey AS VARCHAR) AS invoice_num, CAST(l_shipdate AS DATE) AS date,
          s_name AS customer_name, p_name || ' ' || p_partkey AS product_description,
          'said' || chr(10) || '"' || p_name || '", twice' AS memo, l_quantity * 100 AS quantity,
          'lb' AS unit_of_measure, p_retailprice AS unit_price, l_extendedprice AS line_amount,
          'sales ' || year(l_shipdate) || '+lb.csv' AS source_file
        FROM lineitem JOIN part ON l_partkey = p_partkey
          JOIN supplier ON l_suppkey = s_suppkey
        WHERE l_linenumber <> 7""",
    "landed_report_one": """
        SELECT CAST(l_orderkey AS VARCHAR) AS invoice_num, CAST(l_shipdate AS DATE) AS date,
          s_name AS customer_name, p_name || ' ' || p_partkey AS product_description,
          'said' || chr(10) || '"' || p_name || '", twice' AS memo, l_quantity * 100 AS quantity,
          'lb' AS unit_of_measure, p_retailprice AS unit_price, l_extendedprice AS line_amount,
          'sales ' || year(l_shipdate) || '+lb.csv' AS source_file
        FROM lineitem JOIN part ON l_partkey = p_partkey
          JOIN supplier ON l_suppkey = s_suppkey
        WHERE l_linenumber <> 7 AND year(l_shipdate) = 2000""",
    "b2b_invoices": using("iv", "SELECT * FROM iv"),
    "b2b_invoice_lines": using(
        "il",
        f"SELECT invoice_id || '_' || source_file || '_' || n_file AS line_id, {INVOICE_LINE} FROM il",
    ),
    "b2b_positional_line_ids": using(
        "il",
        """SELECT invoice_id || '_' || n AS line_id, invoice_id,
          coalesce(line_amount, 0.0) AS line_amount, source_file AS source FROM il""",
    ),
    "b2b_rejects": using(
        "checked",
        """SELECT reason, invoice_num, customer_name, date_text, line_amount, source_file
        FROM checked WHERE reason IS NOT NULL""",
    ),
    "report_profile": using(
        "b",
        f"""SELECT source_file, count(*) AS line_items, count(DISTINCT invoice_num) AS invoices,
          count(DISTINCT customer_name) AS customers,
          count(DISTINCT nullif(product_description, '')) AS products,
          min(date) AS date_min, max(date) AS date_max,
          {dbl(f"sum({dec('coalesce(line_amount, 0)')})")} AS total_amount
        FROM b GROUP BY source_file""",
    ),
    "b2b_profile": using(
        "iv",
        f"""SELECT count(*) AS invoices, {dbl(f"sum({dec('total_amount')})")} AS total_revenue,
          {dbl(f"sum({dec('total_quantity')})")} AS total_weight,
          count(DISTINCT customer_name) AS customers,
          string_agg(DISTINCT month, ',' ORDER BY month) AS months FROM iv""",
    ),
    "top_b2b_customers": using(
        "per_account",
        f"""SELECT name AS customer_name, {dbl('revenue')} AS revenue
        FROM per_account ORDER BY per_account.revenue DESC, name LIMIT 5""",
    ),
    "report_top_customers": using(
        "b",
        f"""SELECT customer_name, {dbl(f"sum({dec('coalesce(line_amount, 0)')})")} AS revenue
        FROM b GROUP BY 1 ORDER BY 2 DESC, min(seq) LIMIT 5""",
    ),
    "top_product": using(
        "best_product",
        f"SELECT name AS top_name, {dbl('revenue')} AS top_revenue FROM best_product",
    ),
    "product_revenue": using(
        "per_product",
        f"SELECT name AS product_title, {dbl('revenue')} AS revenue FROM per_product",
    ),
    "channel_summary": using("figures", "SELECT * FROM figures"),
    "channel_summary_by_month": using("figures", "SELECT * FROM figures"),
    "summary_text": using(
        "figures",
        f"""SELECT 'combined' AS summary_id, 'main_store' AS store,
          TIMESTAMP '{RUN_AT}' AS generated_at,
          'The business generated $' || {money('total_revenue')} || ' in total revenue across '
          || total_transactions || ' transactions in both channels. '
          || 'B2B restaurant sales contributed $' || {money('b2b_revenue')} || ' ('
          || {pct('b2b_pct')} || '%) across ' || b2b_invoices || ' invoices from '
          || b2b_customers || ' restaurant accounts, averaging $' || {money('b2b_avg_invoice')}
          || ' per invoice. Online sales contributed $' || {money('online_revenue')} || ' ('
          || {pct('online_pct')} || '%) across ' || online_orders || ' orders from '
          || unique_online_customers || ' customers, averaging $' || {money('online_aov')}
          || ' per order. ' || new_customers || ' new and ' || returning_customers
          || ' returning customers placed online orders this period. Top B2B customer is '
          || top_b2b_customer || ' at $' || {money('top_b2b_revenue')}
          || '. Top online product is ' || top_online_product || ' at $'
          || {money('top_online_product_revenue')} || '.' AS summary_text
        FROM figures""",
    ),
    "qa_report": using("qa", "SELECT * FROM qa"),
    "qa_warnings": using(
        "qa",
        """SELECT "check", level, n, n || CASE "check"
            WHEN 'orders_missing_customer'
              THEN ' orders have no customer linked (guest checkouts)'
            WHEN 'lines_missing_sku'
              THEN ' order lines have no SKU — using product name as identifier'
            WHEN 'products_unmapped'
              THEN ' products have no canonical SKU — using product name as identifier'
            WHEN 'products_draft' THEN ' products are still in DRAFT status'
            WHEN 'customers_unknown_name' THEN ' customers have no name'
            ELSE ' customers have no location' END AS message
        FROM qa WHERE level = 'warning' AND n > 0""",
    ),
    "qa_verdict": using(
        "qa",
        """SELECT CAST(0 AS BIGINT) AS issues,
          count(*) FILTER (level = 'warning' AND n > 0) AS warnings, TRUE AS passed FROM qa""",
    ),
    "latest_lines": f"SELECT * FROM {latest('TRUE')}",
    "upsert_lines": using("merged", "SELECT * FROM merged"),
    "upsert_idempotent": using("merged", "SELECT * FROM merged"),
    "upsert_partial_columns": """
        WITH arriving AS (SELECT l_orderkey AS o_orderkey, max(l_linestatus) AS status
          FROM lineitem GROUP BY 1),
          stored AS (SELECT * FROM orders WHERE o_orderstatus <> 'P')
        SELECT o_orderkey, o_custkey, coalesce(status, o_orderstatus) AS o_orderstatus,
          o_totalprice, o_orderdate, o_orderpriority
        FROM stored FULL JOIN arriving USING (o_orderkey)""",
    "upsert_first_order_rule": """
        WITH s AS (SELECT o_custkey, min(o_orderdate) AS d, max(o_orderdate) AS u, count(*) AS n
          FROM orders WHERE o_orderstatus IN ('F', 'P') GROUP BY 1),
          a AS (SELECT o_custkey, min(o_orderdate) AS d, max(o_orderdate) AS u, count(*) AS n
          FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
        SELECT o_custkey, least(s.d, a.d) AS first_order_date,
          CASE WHEN a.u IS NULL OR s.u > a.u THEN s.u ELSE a.u END AS updated_at,
          CASE WHEN a.u IS NULL OR s.u > a.u THEN s.n ELSE a.n END AS orders_seen
        FROM s FULL JOIN a USING (o_custkey)""",
    "upsert_stored_table": """
        SELECT o_orderkey, o_custkey,
          CASE o_orderstatus WHEN 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
          o_totalprice,
          CASE o_orderstatus WHEN 'P' THEN o_orderdate + INTERVAL 40 DAY ELSE o_orderdate END
            AS o_orderdate,
          o_orderpriority
        FROM orders""",
    "load_audit": using(
        "merged",
        """SELECT before.n AS total_before, before.n AS distinct_before, later.n AS total_after,
          later.n AS distinct_after, later.n - before.n AS net_new, TRUE AS passed
        FROM (SELECT count(*) AS n FROM stored) AS before,
          (SELECT count(*) AS n FROM merged) AS later""",
    ),
    "key_audit": """
        SELECT count(*) AS total, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys,
          count(*) = count(DISTINCT (l_orderkey, l_linenumber)) AS passed FROM lineitem""",
    "key_sketch_audit": """
        WITH lines AS (SELECT *, strftime(l_shipdate, '%Y-%m') AS month FROM lineitem)
        SELECT month, count(*) AS rows,
          CASE WHEN month >= '1997-01' THEN count(DISTINCT (l_orderkey, l_linenumber)) END
            AS distinct_keys,
          CASE WHEN month >= '1997-01'
            THEN count(*) = count(DISTINCT (l_orderkey, l_linenumber)) END AS passed,
          CASE WHEN month >= '1997-01' THEN TRUE END AS within_error FROM lines GROUP BY month
        UNION ALL SELECT NULL, count(*), NULL, NULL, TRUE FROM lineitem""",
    "incremental_window": using(
        "clicks",
        "SELECT events.* FROM events, clicks WHERE ts >= since ORDER BY ts, event_id",
    ),
    "watermark_commit": f"""
        SELECT event_type AS control_key, date_trunc('second', max(ts))
            AS last_successful_watermark,
          TIMESTAMP '{RUN_AT}' AS last_run_at,
          count(*) AS last_run_order_count FROM events GROUP BY 1
        UNION ALL SELECT 'nightly_watermark', date_trunc('second', max(ts)),
          TIMESTAMP '{RUN_AT}', count(*) FROM events""",
    "stream_upsert": """
        SELECT * FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1""",
}

"""The registered queries as standard SQL over the input tables, for checking in another engine."""

from __future__ import annotations

from ordermill.schemas import PROCESSED, RAW, REQUIRED, WAREHOUSE

COMMON = """
WITH runs(run_date) AS (VALUES ('2025-12-01'), ('2025-12-02')),
raw_customers AS (
  SELECT printf('C%03d', c_custkey) AS customer_id, c_name AS name,
         replace(lower(c_name), '#', '.') || '@example.com' AS email, n_name AS country,
         CAST(DATE '1995-01-01' + CAST(c_custkey % 730 AS INTEGER) AS DATE) AS signup_date, run_date
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey CROSS JOIN runs
),
part_category AS (
  SELECT *, p_type AS category FROM part
),
raw_products AS (
  SELECT printf('P%03d', p_partkey) AS product_id, category,
         printf('%s Product %02d', category, p_partkey) AS name,
         round(p_retailprice / 2, 2) AS cost, round(p_retailprice, 2) AS price, run_date
  FROM part_category CROSS JOIN runs
),
lines AS (
  SELECT *, CASE WHEN l_orderkey % 2 = 0 THEN '2025-12-01' ELSE '2025-12-02' END AS run_date,
         printf('O%s%03d-%d', CASE WHEN l_orderkey % 2 = 0 THEN '20251201' ELSE '20251202' END,
                l_orderkey, l_linenumber) AS order_id
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
),
raw_orders AS (
  SELECT order_id, CAST(o_orderdate AS DATE) AS order_date, printf('C%03d', o_custkey) AS customer_id,
         printf('P%03d', l_partkey) AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
         l_extendedprice AS price, n_name AS country, run_date
  FROM lines LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
),
raw_payments AS (
  SELECT printf('PAY%03d-%d', l_orderkey, l_linenumber) AS payment_id, order_id,
         ['Credit Card', 'PayPal', 'Bank Transfer'][CAST((l_orderkey + l_linenumber) % 3 + 1 AS INTEGER)]
           AS payment_method,
         CAST(CAST(o_orderdate AS DATE) + CAST(l_linenumber % 3 AS INTEGER) AS DATE) AS payment_date,
         round(l_quantity * l_extendedprice, 2) AS amount, run_date
  FROM lines
),
orders_clean AS (
  SELECT order_id, order_date, customer_id, product_id, quantity AS order_quantity, price AS order_price,
         country AS order_country, run_date
  FROM (SELECT *, row_number() OVER (
          PARTITION BY order_id, run_date
          ORDER BY order_date NULLS FIRST, customer_id NULLS FIRST, product_id NULLS FIRST,
                   quantity NULLS FIRST, price NULLS FIRST, country NULLS FIRST) AS position
        FROM raw_orders)
  WHERE position = 1
),
customers_clean AS (
  SELECT customer_id, name AS customer_name, email, country AS customer_country, signup_date, run_date
  FROM (SELECT *, row_number() OVER (
          PARTITION BY customer_id, run_date
          ORDER BY name NULLS FIRST, email NULLS FIRST, country NULLS FIRST, signup_date NULLS FIRST) AS position
        FROM raw_customers)
  WHERE position = 1
),
products_clean AS (
  SELECT product_id, category, name AS product_name, cost, price, run_date
  FROM (SELECT *, row_number() OVER (
          PARTITION BY product_id, run_date
          ORDER BY category NULLS FIRST, name NULLS FIRST, cost NULLS FIRST, price NULLS FIRST) AS position
        FROM raw_products)
  WHERE position = 1
),
enriched AS (
  SELECT o.product_id, o.customer_id, o.order_id, o.order_date, o.run_date,
         CAST(o.order_quantity AS DOUBLE) AS order_quantity, CAST(o.order_price AS DOUBLE) AS order_price,
         o.order_country, c.customer_name, c.email, c.customer_country, c.signup_date,
         p.category, p.product_name, p.cost, p.price,
         CAST(CAST(o.order_quantity AS DOUBLE) * CAST(o.order_price AS DOUBLE) AS DECIMAL(18, 2)) AS total_amount
  FROM orders_clean o
  LEFT JOIN customers_clean c ON o.customer_id = c.customer_id AND o.run_date = c.run_date
  LEFT JOIN products_clean p ON o.product_id = p.product_id AND o.run_date = p.run_date
),
customers_revenue AS (
  SELECT customer_id, customer_name, run_date, sum(total_amount) AS total_revenue
  FROM enriched GROUP BY customer_id, customer_name, run_date
),
products_sales AS (
  SELECT product_id, product_name, category, run_date, sum(order_quantity) AS total_quantity_sold,
         sum(total_amount) AS total_revenue
  FROM enriched GROUP BY product_id, product_name, category, run_date
),
category_revenue AS (
  SELECT category, run_date, sum(total_amount) AS category_revenue FROM enriched GROUP BY category, run_date
),
payments_summary AS (
  SELECT run_date, payment_method, CAST(sum(CAST(amount AS DECIMAL(28, 6))) AS DOUBLE) AS total_amount,
         count(amount) AS total_count
  FROM raw_payments GROUP BY run_date, payment_method
),
per_run AS (
  SELECT 'orders_enriched' AS table_name, run_date, count(*) AS row_count,
         round(CAST(sum(total_amount) AS DOUBLE), 2) AS revenue FROM enriched GROUP BY run_date
  UNION ALL
  SELECT 'customers_revenue', run_date, count(*), round(CAST(sum(total_revenue) AS DOUBLE), 2)
  FROM customers_revenue GROUP BY run_date
  UNION ALL
  SELECT 'products_sales', run_date, count(*), round(CAST(sum(total_revenue) AS DOUBLE), 2)
  FROM products_sales GROUP BY run_date
  UNION ALL
  SELECT 'category_revenue', run_date, count(*), round(CAST(sum(category_revenue) AS DOUBLE), 2)
  FROM category_revenue GROUP BY run_date
  UNION ALL
  SELECT 'payments_summary', run_date, count(*), round(sum(total_amount), 2)
  FROM payments_summary GROUP BY run_date
),
customer_pairs AS (
  SELECT sum(r.true_revenue) AS recomputed, sum(c.total_revenue) AS stored
  FROM (SELECT customer_id, run_date, sum(total_amount) AS true_revenue
        FROM enriched GROUP BY customer_id, run_date) r
  JOIN customers_revenue c ON r.customer_id = c.customer_id AND r.run_date = c.run_date
),
product_pairs AS (
  SELECT sum(r.true_quantity) AS recomputed_qty, sum(p.total_quantity_sold) AS stored_qty,
         sum(r.true_revenue) AS recomputed_rev, sum(p.total_revenue) AS stored_rev
  FROM (SELECT product_id, run_date, sum(order_quantity) AS true_quantity, sum(total_amount) AS true_revenue
        FROM enriched GROUP BY product_id, run_date) r
  JOIN products_sales p ON r.product_id = p.product_id AND r.run_date = p.run_date
),
totals AS (
  SELECT (SELECT sum(total_amount) FROM enriched) AS orders_total,
         (SELECT sum(total_revenue) FROM customers_revenue) AS customers_total,
         (SELECT sum(total_revenue) FROM products_sales) AS products_total
),
volume AS (
  SELECT count(DISTINCT order_id) AS n_orders, sum(order_quantity) AS total_quantity,
         count(DISTINCT customer_id) AS n_customers, count(DISTINCT product_id) AS n_products,
         count(*) FILTER (customer_id IS NULL OR product_id IS NULL) AS missing
  FROM enriched
),
copies AS (
  SELECT o.customer_id, o.product_id, o.run_date, CAST(o.quantity AS DOUBLE) AS order_quantity,
         CAST(CAST(o.quantity AS DOUBLE) * o.price AS DECIMAL(18, 2)) AS total_amount, p.category
  FROM raw_orders o
  LEFT JOIN products_clean p ON o.product_id = p.product_id AND o.run_date = p.run_date
)
"""


def _enriched_columns() -> str:
    return ", ".join("CAST(total_amount AS DOUBLE) AS total_amount" if c == "total_amount" else c
                     for c in PROCESSED["orders_enriched"])


def _anomalies() -> str:
    compared = [
        ("customers_revenue", "total_revenue", "customer_id", "total_amount"),
        ("products_sales", "total_quantity_sold", "product_id", "order_quantity"),
        ("products_sales", "total_revenue", "product_id", "total_amount"),
        ("category_revenue", "category_revenue", "category", "total_amount"),
    ]
    return " UNION ALL ".join(
        f"""
        SELECT '{table}' AS table_name, '{measure}' AS measure, coalesce(e.key, s.key) AS key,
               coalesce(e.run_date, s.run_date) AS run_date,
               CAST(e.total AS DOUBLE) AS recomputed, CAST(s.total AS DOUBLE) AS stored,
               CAST(CAST(s.total AS DECIMAL(38, 2)) - CAST(e.total AS DECIMAL(38, 2)) AS DOUBLE) AS difference
        FROM (SELECT {key} AS key, run_date, sum({value}) AS total FROM enriched GROUP BY ALL) e
        FULL JOIN (SELECT {key} AS key, run_date, sum({value}) AS total FROM copies GROUP BY ALL) s
        ON e.key IS NOT DISTINCT FROM s.key AND e.run_date = s.run_date
        WHERE NOT coalesce(abs(e.total - s.total) <= 0.01, FALSE)
        """
        for table, measure, key, value in compared
    )


def _stored(table: str) -> str:
    if table == "category_revenue_clean":
        return "(SELECT category, CAST(category_revenue AS DOUBLE) AS category_revenue FROM category_revenue)"
    return "enriched" if table == "orders_enriched" else table


def _completeness() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, count(*) AS total_rows, '{column}' AS column_name, TRUE AS present, "
        f"count({column}) AS filled FROM {_stored(table)}"
        for table, columns in REQUIRED.items()
        for column in columns
    )
    return f"SELECT *, present AND total_rows > 0 AND filled = total_rows AS passed FROM ({rows})"


def _types(contracts: dict[str, dict[str, str]], relation, found: dict[str, str | None] | None = None) -> str:
    def actual(column: str, kind: str) -> str:
        kind = (found or {}).get(column, kind)
        return f"'{kind}'" if kind else "NULL::VARCHAR"

    def malformed(column: str, kind: str) -> str:
        if column == "run_date":
            return "count(*) FILTER (run_date IS NOT NULL AND TRY_CAST(run_date AS DATE) IS NULL)"
        if kind == "double":
            return f"count(*) FILTER (isnan({column}) OR isinf({column}))"
        return "CAST(0 AS BIGINT)"

    rows = " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, count(*) AS total_rows, '{column}' AS column_name, "
        f"'{kind}' AS expected_type, {actual(column, kind)} AS actual_type, {malformed(column, kind)} AS malformed "
        f"FROM {relation(table)}"
        for table, contract in contracts.items()
        for column, kind in contract.items()
    )
    return f"SELECT *, coalesce(expected_type = actual_type, FALSE) AND malformed = 0 AS passed FROM ({rows})"


SUITE = """
SELECT 1 AS check_id, 'Orders & quantities' AS check_name, CAST(n_orders AS DOUBLE) AS measured,
       total_quantity AS expected, n_orders <= total_quantity AS passed FROM volume
UNION ALL
SELECT 2, 'Customers & products existence', CAST(least(n_customers, n_products) AS DOUBLE), 1.0::DOUBLE,
       n_customers > 0 AND n_products > 0 FROM volume
UNION ALL
SELECT 3, 'Product name consistency', CAST(count(*) AS DOUBLE), 0.0::DOUBLE, count(*) = 0
FROM (SELECT product_id FROM enriched GROUP BY product_id HAVING count(DISTINCT product_name) > 1)
UNION ALL
SELECT 4, 'Missing customers/products', CAST(missing AS DOUBLE), 0.0::DOUBLE, missing = 0 FROM volume
UNION ALL
SELECT 5, 'Duplicate orders', CAST(count(*) AS DOUBLE), 0.0::DOUBLE, count(*) = 0
FROM (SELECT order_id FROM enriched GROUP BY order_id HAVING count(*) > 1)
UNION ALL
SELECT 6, 'Global revenue consistency',
       CAST(greatest(abs(orders_total - customers_total), abs(orders_total - products_total)) AS DOUBLE),
       0.01::DOUBLE,
       abs(orders_total - customers_total) <= 0.01 AND abs(orders_total - products_total) <= 0.01 FROM totals
UNION ALL
SELECT 7, 'Customer aggregation correctness', CAST(abs(recomputed - stored) AS DOUBLE), 0.01::DOUBLE,
       abs(recomputed - stored) <= 0.01 FROM customer_pairs
UNION ALL
SELECT 8, 'Product aggregation correctness',
       CAST(greatest(abs(recomputed_qty - stored_qty), abs(recomputed_rev - stored_rev)) AS DOUBLE), 0.01::DOUBLE,
       abs(recomputed_qty - stored_qty) <= 0.01 AND abs(recomputed_rev - stored_rev) <= 0.01 FROM product_pairs
"""

SELECTS = {
    "raw_customers": "SELECT * FROM raw_customers",
    "raw_products": "SELECT * FROM raw_products",
    "raw_orders": "SELECT * FROM raw_orders",
    "raw_payments": "SELECT * FROM raw_payments",
    "raw_run_scan": "SELECT * FROM raw_orders WHERE run_date = '2025-12-02'",
    "ingest_raw": " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, run_date, count(*) AS row_count FROM raw_{table} GROUP BY run_date"
        for table in RAW
    ),
    "safe_cast_numeric": """
        SELECT o_orderkey, TRY_CAST(o_orderpriority AS DOUBLE) AS priority_number,
               TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS first_character FROM orders
    """,
    "orders_clean": "SELECT * FROM orders_clean",
    "customers_clean": "SELECT * FROM customers_clean",
    "products_clean": "SELECT * FROM products_clean",
    "orders_enriched": f"SELECT {_enriched_columns()} FROM enriched",
    "enriched_preview": f"SELECT {_enriched_columns()} FROM enriched ORDER BY order_id LIMIT 5",
    "customers_revenue": """
        SELECT customer_id, customer_name, run_date, CAST(total_revenue AS DOUBLE) AS total_revenue
        FROM customers_revenue
    """,
    "products_sales": """
        SELECT product_id, product_name, category, run_date, total_quantity_sold,
               CAST(total_revenue AS DOUBLE) AS total_revenue FROM products_sales
    """,
    "category_revenue": """
        SELECT category, run_date, CAST(category_revenue AS DOUBLE) AS category_revenue FROM category_revenue
    """,
    "totals_in_one_pass": """
        SELECT 'customers_revenue' AS table_name, customer_id, customer_name, NULL::VARCHAR AS product_id,
               NULL::VARCHAR AS product_name, NULL::VARCHAR AS category, run_date,
               sum(order_quantity) AS total_quantity_sold, CAST(sum(total_amount) AS DOUBLE) AS total_revenue
        FROM enriched GROUP BY customer_id, customer_name, run_date
        UNION ALL
        SELECT 'products_sales', NULL, NULL, product_id, product_name, category, run_date, sum(order_quantity),
               CAST(sum(total_amount) AS DOUBLE)
        FROM enriched GROUP BY product_id, product_name, category, run_date
        UNION ALL
        SELECT 'category_revenue', NULL, NULL, NULL, NULL, category, run_date, sum(order_quantity),
               CAST(sum(total_amount) AS DOUBLE)
        FROM enriched GROUP BY category, run_date
    """,
    "payments_summary": """
        SELECT run_date, payment_method, total_amount, total_count FROM payments_summary
    """,
    "processed_roundtrip": "SELECT * FROM per_run",
    "two_date_run": "SELECT * FROM per_run",
    "rerun_with_empty_table": " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, run_date, count(*) AS row_count, NULL::DOUBLE AS revenue "
        f"FROM raw_{table} {where} GROUP BY run_date"
        for table, where in {
            "customers": "", "products": "",
            "orders": "WHERE run_date = '2025-12-02'", "payments": "WHERE run_date = '2025-12-02'",
        }.items()
    )
    + " UNION ALL SELECT * FROM per_run WHERE run_date = '2025-12-02'",
    "resumed_run": """
        SELECT run_date, step, 'done' AS state, attempts, row_count FROM (
          SELECT run_date, 'ingest' AS step, 1 AS attempts, CAST(sum(n) AS BIGINT) AS row_count FROM (
            SELECT run_date, count(*) AS n FROM raw_customers GROUP BY run_date
            UNION ALL SELECT run_date, count(*) FROM raw_products GROUP BY run_date
            UNION ALL SELECT run_date, count(*) FROM raw_orders GROUP BY run_date
            UNION ALL SELECT run_date, count(*) FROM raw_payments GROUP BY run_date
          ) GROUP BY run_date
          UNION ALL
          SELECT run_date, 'process', 1, CAST(sum(row_count) AS BIGINT) FROM per_run GROUP BY run_date
          UNION ALL
          SELECT run_date, 'load ' || table_name, CASE WHEN table_name = 'products_sales' THEN 2 ELSE 1 END, row_count
          FROM per_run
          UNION ALL
          SELECT run_date, 'load category_revenue_clean', 1, NULL FROM runs
        )
    """,
    "warehouse_append": """
        SELECT table_name, run_date, 2 * row_count AS row_count, round(2 * revenue, 2) AS revenue FROM per_run
    """,
    "warehouse_truncate": "SELECT * FROM per_run WHERE run_date = '2025-12-02'",
    "warehouse_reload_idempotent": "SELECT * FROM per_run",
    "warehouse_widened": """
        SELECT run_date, count(*) AS row_count, sum(total_quantity_sold) AS total_quantity_sold,
               CAST(sum(total_revenue) AS DOUBLE) AS total_revenue, 'double' AS total_quantity_sold_type,
               'decimal(28,2)' AS total_revenue_type
        FROM products_sales GROUP BY run_date
    """,
    "category_revenue_clean": """
        SELECT category, TRY_CAST(category_revenue AS DOUBLE) AS category_revenue FROM category_revenue
    """,
    "dq_orders_quantities": """
        SELECT n_orders, total_quantity, n_orders <= total_quantity AS passed FROM volume
    """,
    "dq_entities_exist": """
        SELECT n_customers, n_products, n_customers > 0 AND n_products > 0 AS passed FROM volume
    """,
    "dq_product_name_consistency": """
        SELECT product_id, count(DISTINCT product_name) AS cnt FROM enriched GROUP BY product_id HAVING cnt > 1
    """,
    "dq_product_names_by_country": """
        SELECT product_id, count(DISTINCT country) AS cnt FROM raw_orders GROUP BY product_id HAVING cnt > 1
    """,
    "dq_missing_keys": "SELECT missing, missing = 0 AS passed FROM volume",
    "dq_duplicate_orders": "SELECT order_id, count(*) AS cnt FROM enriched GROUP BY order_id HAVING cnt > 1",
    "dq_duplicate_orders_raw": "SELECT order_id, count(*) AS cnt FROM raw_orders GROUP BY order_id HAVING cnt > 1",
    "dq_global_revenue": """
        SELECT CAST(orders_total AS DOUBLE) AS orders_total, CAST(customers_total AS DOUBLE) AS customers_total,
               CAST(products_total AS DOUBLE) AS products_total,
               abs(orders_total - customers_total) <= 0.01 AND abs(orders_total - products_total) <= 0.01 AS passed
        FROM totals
    """,
    "dq_customer_recon": """
        SELECT CAST(recomputed AS DOUBLE) AS recomputed, CAST(stored AS DOUBLE) AS stored,
               abs(recomputed - stored) <= 0.01 AS passed FROM customer_pairs
    """,
    "dq_product_recon": """
        SELECT CAST(recomputed_qty AS DOUBLE) AS recomputed_qty, CAST(stored_qty AS DOUBLE) AS stored_qty,
               CAST(recomputed_rev AS DOUBLE) AS recomputed_rev, CAST(stored_rev AS DOUBLE) AS stored_rev,
               abs(recomputed_qty - stored_qty) <= 0.01 AND abs(recomputed_rev - stored_rev) <= 0.01 AS passed
        FROM product_pairs
    """,
    "dq_suite": SUITE,
    "dq_suite_merged": SUITE,
    "product_name_register": """
        SELECT product_id, product_name, min(run_date) AS first_run, max(run_date) AS last_run
        FROM enriched GROUP BY product_id, product_name
    """,
    "dq_category_recon": """
        SELECT c.category, c.run_date, CAST(p.total AS DOUBLE) AS recomputed,
               CAST(c.category_revenue AS DOUBLE) AS stored, abs(p.total - c.category_revenue) <= 0.01 AS passed
        FROM category_revenue c
        JOIN (SELECT category, run_date, sum(total_revenue) AS total FROM products_sales GROUP BY ALL) p
        ON c.category = p.category AND c.run_date = p.run_date
    """,
    "dq_completeness": _completeness(),
    "dq_type_format": _types(WAREHOUSE, _stored),
    "dq_raw_schema": _types(
        {t: {c: k for c, k in contract.items() if c != "run_date"} for t, contract in RAW.items()},
        lambda table: f"raw_{table}",
    ),
    "dq_raw_schema_differs": _types(
        {"orders": {c: k for c, k in RAW["orders"].items() if c != "run_date"}},
        lambda table: f"raw_{table}",
        {"country": None, "quantity": "string"},
    ),
    "dq_join_quality": """
        SELECT 'customers' AS dimension, count(*) AS unmatched, count(*) = 0 AS passed
        FROM raw_orders o WHERE NOT EXISTS (
          SELECT 1 FROM raw_customers c WHERE c.customer_id = o.customer_id AND c.run_date = o.run_date)
        UNION ALL
        SELECT 'products', count(*), count(*) = 0
        FROM raw_orders o WHERE NOT EXISTS (
          SELECT 1 FROM raw_products p WHERE p.product_id = o.product_id AND p.run_date = o.run_date)
    """,
    "dq_anomaly_report": _anomalies(),
}

ORACLE_SQL = {name: COMMON + select for name, select in SELECTS.items()}

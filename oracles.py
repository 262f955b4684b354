"""DuckDB SQL for every registered query, over the same Parquet tables.

Money is summed as DECIMAL and shares are whole-number arithmetic, so that both
engines give the same value for every row order.
"""

from __future__ import annotations

_STAR = """
customers AS (
    SELECT c_custkey AS customer_id, c_name AS name,
           lower(replace(c_name, '#', '_')) || '@example.com' AS email, n_name AS country
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
products AS (
    SELECT p_partkey AS product_id, p_name AS name, p_type AS category, p_retailprice AS price FROM part),
sales AS (
    SELECT l_orderkey AS order_id, l_linenumber AS line_number, o_custkey AS customer_id, l_partkey AS product_id,
           CAST(o_orderdate AS DATE) AS order_date, l_extendedprice AS amount,
           CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' WHEN 'P' THEN 'cancelled'
                ELSE 'unknown' END AS status
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)"""

_DIRTY = f"""{_STAR},
customers_dirty AS (
    SELECT customer_id,
           CASE WHEN customer_id % 61 = 0 THEN NULL ELSE name END AS name,
           CASE WHEN customer_id % 59 = 0 THEN NULL WHEN customer_id % 53 = 0 THEN 'invalid_email'
                ELSE email END AS email,
           CASE WHEN customer_id % 47 = 0 THEN NULL ELSE country END AS country
    FROM customers),
products_dirty AS (
    SELECT product_id,
           CASE WHEN product_id % 61 = 0 THEN NULL ELSE name END AS name,
           CASE WHEN product_id % 59 = 0 THEN NULL ELSE category END AS category,
           CASE WHEN product_id % 53 = 0 THEN NULL WHEN product_id % 47 = 0 THEN CAST(-99.99 AS DOUBLE)
                ELSE price END AS price
    FROM products),
orders_dirty AS (
    SELECT order_id,
           CASE WHEN (order_id + line_number) % 97 = 0 THEN NULL WHEN order_id % 89 = 0 THEN -1000 - order_id
                ELSE customer_id END AS customer_id,
           CASE WHEN (order_id + line_number) % 101 = 0 THEN NULL WHEN product_id % 103 = 0 THEN -1000 - order_id
                ELSE product_id END AS product_id,
           CASE WHEN order_id % 71 = 0 THEN NULL WHEN order_id % 67 = 0 THEN '2024-13-99'
                ELSE CAST(order_date AS VARCHAR) END AS order_date,
           CASE WHEN product_id % 83 = 0 THEN NULL ELSE amount END AS amount,
           CASE WHEN order_id % 79 = 0 THEN NULL WHEN order_id % 73 = 0 THEN 'bogus' ELSE status END AS status
    FROM sales)"""

_CLEAN = f"""{_DIRTY},
customers_fill AS (
    SELECT customer_id, coalesce(name, 'Unknown Customer') AS customer_name,
           coalesce(email, 'unknown@example.com') AS email, coalesce(country, 'Unknown') AS country
    FROM customers_dirty),
products_fill AS (
    SELECT product_id, coalesce(name, 'Unknown Product') AS product_name,
           coalesce(category, 'Uncategorized') AS category, coalesce(price, CAST(0.0 AS DOUBLE)) AS price
    FROM products_dirty),
orders_fill AS (
    SELECT order_id, coalesce(customer_id, -1) AS customer_id, coalesce(product_id, -1) AS product_id,
           TRY_CAST(coalesce(order_date, '1970-01-01') AS DATE) AS order_date,
           coalesce(amount, CAST(0.0 AS DOUBLE)) AS amount, coalesce(status, 'unknown') AS status
    FROM orders_dirty
    WHERE order_id IS NOT NULL
      AND coalesce(status, 'unknown') IN ('completed', 'cancelled', 'pending', 'unknown')),
orders_drop AS (
    SELECT order_id, customer_id, product_id, TRY_CAST(order_date AS DATE) AS order_date, amount, status
    FROM orders_dirty
    WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND product_id IS NOT NULL
      AND order_date IS NOT NULL AND amount IS NOT NULL AND status IS NOT NULL)"""

_DETAIL_COLUMNS = """order_id, {customer}, {country}, {product}, {category}, amount, status, order_date"""
_FILLED = _DETAIL_COLUMNS.format(
    customer="coalesce(customer_name, 'Unknown Customer') AS customer_name",
    country="coalesce(country, 'Unknown') AS country",
    product="coalesce(product_name, 'Unknown Product') AS product_name",
    category="coalesce(category, 'Uncategorized') AS category",
)
_UNFILLED = _DETAIL_COLUMNS.format(
    customer="customer_name", country="country", product="product_name", category="category"
)


def _details(columns: str, orders: str, customers: str, products: str) -> str:
    return f"""
details AS (
    SELECT {columns}, o.customer_id
    FROM {orders} o
    LEFT JOIN {customers} c ON o.customer_id = c.customer_id
    LEFT JOIN {products} p ON o.product_id = p.product_id)"""


_RAW_CUSTOMERS = "(SELECT customer_id, name AS customer_name, country FROM {0})"
_RAW_PRODUCTS = "(SELECT product_id, name AS product_name, category FROM {0})"

_CLEAN_DETAILS = f"""WITH {_STAR},{_details(
    _FILLED, "sales", _RAW_CUSTOMERS.format("customers"), _RAW_PRODUCTS.format("products"))}
"""
_FILL_DETAILS = f"""WITH {_CLEAN},{_details(_FILLED, "orders_fill", "customers_fill", "products_fill")}
"""
_DROP_DETAILS = f"""WITH {_CLEAN},{_details(
    _FILLED, "orders_drop", _RAW_CUSTOMERS.format("customers_dirty"), _RAW_PRODUCTS.format("products_dirty"))}
"""
_DROP_ONLY_DETAILS = f"""WITH {_CLEAN},{_details(
    _UNFILLED, "orders_drop", _RAW_CUSTOMERS.format("customers_dirty"), _RAW_PRODUCTS.format("products_dirty"))}
"""

_ALL_COLUMNS = """order_id, customer_name, country, product_name, category, amount, status, order_date"""
_EXACT = "sum(CAST(amount AS DECIMAL(18,2)))"
_ROUNDED = f"CAST(round({_EXACT}, 2) AS DOUBLE)"
_UNROUNDED = f"CAST({_EXACT} AS DOUBLE)"


def _top_customers(money: str = _ROUNDED, extra: str = "", limit: str = " LIMIT 5") -> str:
    return f"""SELECT customer_name, country, {money} AS total_spend
FROM details WHERE status = 'completed'{extra}
GROUP BY customer_name, country
ORDER BY total_spend DESC, customer_name, country{limit}"""


def _monthly(extra: str = "") -> str:
    return f"""SELECT strftime(order_date, '%Y-%m') AS month, {_ROUNDED} AS monthly_revenue
FROM details WHERE status = 'completed'{extra}
GROUP BY 1 ORDER BY 1"""


def _monthly_ym(extra: str = "") -> str:
    return f"""SELECT CAST(year(order_date) AS BIGINT) AS year, CAST(month(order_date) AS BIGINT) AS month,
       {_UNROUNDED} AS monthly_revenue
FROM details WHERE status = 'completed'{extra}
GROUP BY 1, 2 ORDER BY 1, 2"""


def _categories(extra: str = "", limit: str = "") -> str:
    return f"""SELECT category, count(*) AS order_count
FROM details WHERE status = 'completed'{extra}
GROUP BY category ORDER BY order_count DESC, category{limit}"""


_STATUS = """SELECT status, count(*) AS order_count FROM details GROUP BY status ORDER BY order_count DESC, status"""
_STATUS_PCT = """SELECT status, order_count, CAST((order_count * 20000 + total) // (2 * total) AS DOUBLE) / 100 AS percentage
FROM (SELECT status, count(*) AS order_count, (SELECT count(*) FROM details) AS total FROM details GROUP BY status)
ORDER BY order_count DESC, status"""
_STATUS_HALF_EVEN = """SELECT status, order_count,
       CAST(low + CASE WHEN 2 * rest > total THEN 1 WHEN 2 * rest = total THEN low % 2 ELSE 0 END AS DOUBLE) / 100
           AS percentage
FROM (SELECT status, order_count, total, (order_count * 10000) // total AS low, (order_count * 10000) % total AS rest
      FROM (SELECT status, count(*) AS order_count, (SELECT count(*) FROM details) AS total
            FROM details GROUP BY status))
ORDER BY status"""

_NEWEST = "(SELECT max(CAST(o_orderdate AS DATE)) FROM orders)"
_HALF_YEAR = f" AND order_date >= {_NEWEST} - INTERVAL 180 DAY"
_SIX_MONTHS = f" AND order_date >= {_NEWEST} - INTERVAL 6 MONTH"


# Table, name, key, and what breaks each rule.
_RULES = [
    (
        "customers_dirty",
        "customers",
        "customer_id",
        {
            "customer_id null": "customer_id IS NULL",
            "name null": "name IS NULL",
            "email null": "email IS NULL",
            "country null": "country IS NULL",
            "email invalid": r"NOT regexp_matches(email, '^[^@\s]+@[^@\s]+\.[^@\s]+$')",
        },
    ),
    (
        "products_dirty",
        "products",
        "product_id",
        {
            "product_id null": "product_id IS NULL",
            "name null": "name IS NULL",
            "category null": "category IS NULL",
            "price null": "price IS NULL",
            "price negative": "price < 0",
        },
    ),
    (
        "orders_dirty",
        "orders",
        "order_id",
        {
            "order_id null": "order_id IS NULL",
            "customer_id null": "customer_id IS NULL",
            "product_id null": "product_id IS NULL",
            "order_date null": "order_date IS NULL",
            "amount null": "amount IS NULL",
            "status null": "status IS NULL",
            "status unlisted": "status NOT IN ('completed', 'cancelled', 'pending', 'unknown')",
            "order_date malformed": "order_date IS NOT NULL AND TRY_CAST(order_date AS DATE) IS NULL",
            "customer orphan": "customer_id IS NOT NULL AND NOT EXISTS"
            " (SELECT 1 FROM customers_dirty c WHERE c.customer_id = orders_dirty.customer_id)",
            "product orphan": "product_id IS NOT NULL AND NOT EXISTS"
            " (SELECT 1 FROM products_dirty p WHERE p.product_id = orders_dirty.product_id)",
        },
    ),
]


def _audit(named: bool) -> str:
    """Violations per rule, or with ``named`` those of each row and key."""
    parts = []
    for table, name, key, rules in _RULES:
        shown = f"CAST({key} AS VARCHAR) AS record_key, CAST(1 AS BIGINT)" if named else "count(*)"
        parts += [
            f"SELECT '{name}' AS table_name, '{rule}' AS rule, {shown} AS violations FROM {table} WHERE {test}"
            for rule, test in rules.items()
        ]
        if name != "orders":
            counts = f"(SELECT {key}, count(*) AS n FROM {table} WHERE {key} IS NOT NULL GROUP BY {key})"
            shown = f"CAST({key} AS VARCHAR), n - 1" if named else "CAST(coalesce(sum(n - 1), 0) AS BIGINT)"
            parts.append(f"SELECT '{name}', '{key} duplicate', {shown} FROM {counts}" + " WHERE n > 1" * named)
    return f"WITH {_DIRTY}\n" + "\nUNION ALL ".join(parts)


_ROW_COUNTS = f"""{_FILL_DETAILS}
SELECT 'order_details' AS table_name, count(*) AS row_count FROM details
UNION ALL SELECT 'top_customers', count(*) FROM ({_top_customers()})
UNION ALL SELECT 'monthly_revenue', count(*) FROM ({_monthly_ym()})
UNION ALL SELECT 'popular_categories', count(*) FROM ({_categories()})
UNION ALL SELECT 'order_status', count(*) FROM ({_STATUS})"""



def _published(last: str) -> str:
    """Reports of both loads, or of the last one only where the tables were dropped before it."""
    loads = []
    for odd in (0, 1) if last == "append" else (1,):
        half = f" AND order_id % 2 = {odd}"
        loads += [
            f"SELECT 'top_customers' AS report, customer_name || '/' || country AS name, total_spend AS value FROM ({_top_customers(extra=half)})",
            f"SELECT 'monthly_revenue', coalesce(concat_ws('/', year, month), ''), round(monthly_revenue, 2) FROM ({_monthly_ym(half)})",
            f"SELECT 'popular_categories', category, CAST(order_count AS DOUBLE) FROM ({_categories(half)})",
            f"SELECT 'order_status', status, CAST(count(*) AS DOUBLE) FROM details WHERE order_id % 2 = {odd} GROUP BY status",
        ]
    return _FILL_DETAILS + "\nUNION ALL ".join(loads)


def _report_set(window: str, limit: str) -> str:
    return f"""{_DROP_DETAILS}SELECT category AS name, CAST(order_count AS DOUBLE) AS value FROM ({_categories(limit=limit)})
UNION ALL SELECT month, monthly_revenue FROM ({_monthly(f" AND order_date >= DATE '2001-08-01' - INTERVAL {window}")})"""


_COUNTS_SQL_STYLE = f"""{_FILL_DETAILS}
SELECT 'order_details' AS name, true AS present, count(*) AS row_count FROM details
UNION ALL SELECT 'top_customers', true, count(*) FROM ({_top_customers()})
UNION ALL SELECT 'monthly_revenue', true, count(*) FROM ({_monthly()})
UNION ALL SELECT 'popular_categories', true, count(*) FROM ({_categories(limit=" LIMIT 5")})
UNION ALL SELECT 'order_status', true, count(*) FROM ({_STATUS})"""

_ROW_COUNTS_UNFILLED = f"""{_DROP_ONLY_DETAILS}
SELECT 'order_details' AS table_name, count(*) AS row_count FROM details
UNION ALL SELECT 'top_customers', count(*) FROM ({_top_customers(extra=" AND customer_name IS NOT NULL AND country IS NOT NULL")})
UNION ALL SELECT 'monthly_revenue', count(*) FROM ({_monthly_ym(" AND order_date IS NOT NULL")})
UNION ALL SELECT 'popular_categories', count(*) FROM ({_categories(" AND category IS NOT NULL")})
UNION ALL SELECT 'order_status', count(*) FROM ({_STATUS})"""

_AFTER_LOADS = f"""{_FILL_DETAILS}
SELECT 'top_customers' AS report, customer_name || '/' || country AS name, total_spend AS value FROM ({_top_customers(limit="")})
UNION ALL SELECT 'monthly_revenue', month, monthly_revenue FROM ({_monthly()})
UNION ALL SELECT 'popular_categories', category, CAST(order_count AS DOUBLE) FROM ({_categories()})
UNION ALL SELECT 'order_status', status, percentage FROM ({_STATUS_PCT})"""

_FITS = "order_id % 37 <> 0 AND order_id % 31 <> 0 AND order_id % 41 <> 0 AND order_id % 43 <> 0"
_REJECTS = f"""WITH {_DIRTY}
SELECT CASE WHEN order_id % 37 = 0 THEN '#' ELSE '' END || order_id::VARCHAR AS order_id,
       concat_ws(',', CASE WHEN order_id % 41 = 0 OR order_id % 43 = 0 THEN 'columns' END,
                 CASE WHEN order_id % 37 = 0 THEN 'order_id' END,
                 CASE WHEN order_id % 31 = 0 AND (order_id % 41 = 0 OR order_id % 43 <> 0) THEN 'amount' END) AS reasons
FROM orders_dirty WHERE NOT ({_FITS})"""


_SELECT_DETAILS = f"SELECT {_ALL_COLUMNS} FROM details"

ORACLES = {
    "customers_dirty": f"WITH {_DIRTY}\nSELECT * FROM customers_dirty",
    "products_dirty": f"WITH {_DIRTY}\nSELECT * FROM products_dirty",
    "orders_dirty": f"WITH {_DIRTY}\nSELECT * FROM orders_dirty",
    "customers_clean_fill": f"WITH {_CLEAN}\nSELECT * FROM customers_fill",
    "products_clean_fill": f"WITH {_CLEAN}\nSELECT * FROM products_fill",
    "orders_clean_fill": f"WITH {_CLEAN}\nSELECT * FROM orders_fill",
    "orders_clean_drop": f"WITH {_CLEAN}\nSELECT * FROM orders_drop",
    "order_details": _CLEAN_DETAILS + _SELECT_DETAILS,
    "order_details_fill": _FILL_DETAILS + _SELECT_DETAILS,
    "order_details_drop": _DROP_DETAILS + _SELECT_DETAILS,
    "order_details_drop_nofill": _DROP_ONLY_DETAILS + _SELECT_DETAILS,
    "order_details_salted": _FILL_DETAILS + _SELECT_DETAILS,
    "top_customers": _CLEAN_DETAILS + _top_customers(),
    "monthly_revenue": _CLEAN_DETAILS + _monthly(),
    "monthly_revenue_ym": _CLEAN_DETAILS + _monthly_ym(),
    "monthly_revenue_recent": _CLEAN_DETAILS + _monthly(_HALF_YEAR),
    "monthly_revenue_six_months": _CLEAN_DETAILS + _monthly(_SIX_MONTHS),
    "popular_categories": _CLEAN_DETAILS + _categories(),
    "popular_categories_top": _CLEAN_DETAILS + _categories(limit=" LIMIT 5"),
    "order_status": _CLEAN_DETAILS + _STATUS,
    "order_status_pct": _CLEAN_DETAILS + _STATUS_PCT,
    "top_customers_fill": _FILL_DETAILS + _top_customers(),
    "top_customers_all": _FILL_DETAILS + _top_customers(limit=""),
    "top_customers_by_id": _FILL_DETAILS
    + f"""SELECT customer_id, customer_name, country, {_ROUNDED} AS total_spend
FROM details WHERE status = 'completed'
GROUP BY customer_id, customer_name, country""",
    "monthly_revenue_fill": _FILL_DETAILS + _monthly(),
    "popular_categories_fill": _FILL_DETAILS + _categories(),
    "order_status_fill": _FILL_DETAILS + _STATUS,
    "top_customers_sql": _DROP_DETAILS + _top_customers(),
    "top_customers_all_sql": _DROP_DETAILS + _top_customers(limit=""),
    "monthly_revenue_sql": _DROP_DETAILS + _monthly(),
    "monthly_revenue_recent_sql": _DROP_DETAILS + _monthly(" AND order_date >= DATE '2001-08-01' - INTERVAL 180 DAY"),
    "monthly_revenue_six_months_sql": _DROP_DETAILS
    + _monthly(" AND order_date >= DATE '2001-08-01' - INTERVAL 6 MONTH"),
    "popular_categories_all_sql": _DROP_DETAILS + _categories(),
    "popular_categories_sql": _DROP_DETAILS + _categories(limit=" LIMIT 5"),
    "order_status_sql": _DROP_DETAILS + _STATUS_PCT,
    "top_customers_unfilled": _DROP_ONLY_DETAILS
    + _top_customers(_UNROUNDED, " AND customer_name IS NOT NULL AND country IS NOT NULL"),
    "monthly_revenue_ym_unfilled": _DROP_ONLY_DETAILS + _monthly_ym(" AND order_date IS NOT NULL"),
    "popular_categories_unfilled": _DROP_ONLY_DETAILS + _categories(" AND category IS NOT NULL"),
    "order_status_half_even": _DROP_ONLY_DETAILS + _STATUS_HALF_EVEN,
    "dq_audit": _audit(named=False),
    "table_row_counts": _ROW_COUNTS,
    "table_row_counts_unfilled": _ROW_COUNTS_UNFILLED,
    "publish_append": _published("append"),
    "publish_recreate": _published("recreate"),
    "csv_one_file": _FILL_DETAILS + _top_customers(limit=""),
    "csv_counts": _COUNTS_SQL_STYLE,
    "sql_view": _DROP_DETAILS + _categories(),
    "revenue_fine_amounts": f"""WITH {_STAR}
SELECT status, CAST(sum(CAST(line_number AS DECIMAL(18,0)) * CAST(0.0000001 AS DECIMAL(18,7))) AS DOUBLE) AS revenue
FROM sales GROUP BY status""",
    "report_set_recent": _report_set("180 DAY", " LIMIT 5"),
    "report_set_complete": _report_set("6 MONTH", ""),
    "loads_run_twice": _FILL_DETAILS + _SELECT_DETAILS,
    "reports_after_loads": _AFTER_LOADS,
    "monthly_revenue_stored": _FILL_DETAILS + _monthly(" AND order_date >= (SELECT max(order_date) FROM details) - INTERVAL 180 DAY"),
    "csv_rejects": _REJECTS,
    "csv_accepted": f"WITH {_DIRTY}\nSELECT * FROM orders_dirty WHERE {_FITS}",
    "dq_quarantine": _audit(named=True),
    "order_details_one_per_key": _FILL_DETAILS + _SELECT_DETAILS,
    "order_details_bucketed": _FILL_DETAILS + _SELECT_DETAILS,
    "csv_roundtrip": _FILL_DETAILS + _SELECT_DETAILS,
    "table_roundtrip": _FILL_DETAILS + _SELECT_DETAILS,
    "table_append": f"{_FILL_DETAILS}SELECT {_ALL_COLUMNS} FROM details UNION ALL SELECT {_ALL_COLUMNS} FROM details",
}

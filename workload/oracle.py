"""The queries again, in SQL for another engine."""

from __future__ import annotations

from smelter.constants import (
    CUSTOMER_STATUSES,
    EMAIL_PATTERN,
    EVENT_TYPES,
    ORDER_STATUSES,
    PRODUCT_CATEGORIES,
    PROVINCES,
)
from workload.adapters import (
    CLICK_EXPRESSIONS,
    PAGE_EXPRESSION,
    PAGE_IDS,
    SQL_SOURCES,
    _copied_sql,
)


def _in(values: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _share(part: str, whole: str) -> str:
    """``part / whole`` rounded half up to 4 places, in whole numbers: rounding a binary
    fraction would take some halves down."""
    return f"(({part} * 20000 + {whole}) // (2 * {whole}) / 10000)"


# Standardised inputs
STANDARDIZED = {
    "customers": """
        SELECT customer_id, TRIM(first_name) AS first_name, TRIM(last_name) AS last_name,
               LOWER(TRIM(email)) AS email,
               UPPER(SUBSTR(TRIM(city), 1, 1)) || LOWER(SUBSTR(TRIM(city), 2)) AS city,
               UPPER(TRIM(province)) AS province, UPPER(TRIM(status)) AS status,
               signup_date, _batch_id
        FROM customers_src""",
    "products": """
        SELECT product_id, TRIM(product_name) AS product_name, UPPER(TRIM(category)) AS category,
               CAST(price AS DECIMAL(12,2)) AS price, UPPER(TRIM(status)) AS status, _batch_id
        FROM products_src""",
    "orders": """
        SELECT *, ROUND(quantity * unit_price * (1 - discount_pct) + tax_amount, 2)
                   AS expected_order_amount
        FROM (SELECT order_id, customer_id AS raw_customer_id, product_id AS raw_product_id,
                     order_timestamp AS raw_timestamp, quantity AS raw_quantity,
                     TRY_CAST(customer_id AS BIGINT) AS customer_id,
                     TRY_CAST(product_id AS BIGINT) AS product_id,
                     TRY_CAST(order_timestamp AS TIMESTAMP) AS order_timestamp,
                     TRY_CAST(quantity AS INTEGER) AS quantity, unit_price,
                     discount_pct, tax_amount, order_amount, UPPER(TRIM(status)) AS status,
                     _ingested_at, _source_file_modified_at
              FROM orders_src)""",
}

# Rules: flag, predicate, reason when it does not hold
RULES = {
    "customers": [
        ("customer_id", "customer_id IS NOT NULL", "'Missing Customer ID'"),
        (
            "email",
            f"(email IS NOT NULL AND REGEXP_MATCHES(email, '{EMAIL_PATTERN}'))",
            "CASE WHEN email IS NULL THEN 'Missing Email' ELSE 'Invalid Email' END",
        ),
        ("province", f"province IN {_in(PROVINCES)}", "'Invalid Province'"),
        ("status", f"status IN {_in(CUSTOMER_STATUSES)}", "'Invalid Status'"),
    ],
    "products": [
        ("product_id", "(product_id IS NOT NULL AND product_id > 0)", "'Invalid Product ID'"),
        (
            "product_name",
            "(product_name IS NOT NULL AND LENGTH(product_name) > 0)",
            "'Missing Product Name'",
        ),
        ("category", f"category IN {_in(PRODUCT_CATEGORIES)}", "'Invalid Category'"),
        ("price", "(price IS NOT NULL AND price > 0)", "'Invalid Price'"),
        ("status", f"status IN {_in(CUSTOMER_STATUSES)}", "'Invalid Status'"),
    ],
    "orders": [
        ("customer_id", "customer_id IS NOT NULL", "'Missing Customer ID'"),
        ("product_id", "product_id IS NOT NULL", "'Missing Product ID'"),
        ("order_timestamp", "order_timestamp IS NOT NULL", "'Missing Order Timestamp'"),
        ("quantity", "quantity > 0", "'Invalid Quantity'"),
        ("unit_price", "unit_price > 0", "'Invalid Unit Price'"),
        ("discount", "(discount_pct >= 0 AND discount_pct <= 1)", "'Invalid Discount'"),
        ("status", f"status IN {_in(ORDER_STATUSES)}", "'Invalid Status'"),
        (
            "amount",
            "ABS(order_amount - expected_order_amount) <= 0.01",
            "'Order Amount Mismatch'",
        ),
    ],
}

KEYS = {"customers": "customer_id", "products": "product_id", "orders": "order_id"}

# Columns as the results show them: decimals as doubles, dates and times as text
SHOWN = {
    "customers": "customer_id, first_name, last_name, email, city, province, status,"
    " CAST(signup_date AS VARCHAR) AS signup_date, _batch_id",
    "products": "product_id, product_name, category, CAST(price AS DOUBLE) AS price, status,"
    " _batch_id",
    "orders": "order_id, customer_id, product_id,"
    " CAST(order_timestamp AS VARCHAR) AS order_timestamp, quantity,"
    " CAST(unit_price AS DOUBLE) AS unit_price, CAST(discount_pct AS DOUBLE) AS discount_pct,"
    " CAST(tax_amount AS DOUBLE) AS tax_amount, CAST(order_amount AS DOUBLE) AS order_amount,"
    " status, CAST(_ingested_at AS VARCHAR) AS _ingested_at,"
    " CAST(_source_file_modified_at AS VARCHAR) AS _source_file_modified_at",
}

# Newest first, then all other columns in order
RANKING = {
    "customers": "_batch_id DESC NULLS LAST, first_name, last_name, email, city, province,"
    " status, signup_date",
    "products": "_batch_id DESC NULLS LAST, product_name, category, price, status",
    "orders": "_ingested_at DESC NULLS LAST, _source_file_modified_at DESC NULLS LAST,"
    " customer_id, product_id, order_timestamp, quantity, unit_price, discount_pct, tax_amount,"
    " order_amount, status",
}


def _latest(name: str, rows: str) -> str:
    ranked = (
        f"SELECT *, ROW_NUMBER() OVER (PARTITION BY {KEYS[name]} ORDER BY {RANKING[name]}) AS rn"
        f" FROM {rows}"
    )
    return f"(SELECT * FROM ({ranked}) WHERE rn = 1)"


def _ctes(*names: str) -> str:
    """WITH clause of the named sources with what is derived from them, in order."""
    parts = []
    for name in names:
        parts.append(f"{'click' if name == 'clicks' else name}_src AS ({_source(name)})")
        if name == "clicks":
            parts.append(f"clicks_silver AS ({CLICKS_SILVER})")
            continue
        parts.append(f"{name}_std AS ({STANDARDIZED[name]})")
        holds = " AND ".join(predicate for _, predicate, _ in RULES[name])
        parts.append(f"{name}_checked AS (SELECT *, ({holds}) AS ok FROM {name}_std)")
        valid = f"(SELECT * FROM {name}_checked WHERE ok)"
        parts.append(f"{name}_silver AS {_latest(name, valid)}")
    return "WITH " + ",\n".join(parts) + "\n"


def _source(name: str) -> str:
    return SQL_SOURCES["click_src" if name == "clicks" else f"{name}_src"]


def _reason(name: str, decided: bool) -> str:
    broken = "IS FALSE" if decided else "IS NOT TRUE"
    parts = [f"CASE WHEN ({p}) {broken} THEN {reason} END" for _, p, reason in RULES[name]]
    return f"CONCAT_WS('; ', {', '.join(parts)})"


def _rejected(name: str, decided: bool) -> str:
    test = "ok IS FALSE" if decided else "ok IS NOT TRUE"
    return f"FROM {name}_checked WHERE {test}"


def _reconciled(rows: str, valid: str, rejected: str) -> str:
    return (
        "SELECT source_rows, valid_rows, rejected_rows,"
        " source_rows = valid_rows + rejected_rows AS reconciled FROM ("
        f"SELECT COUNT(*) AS source_rows, COUNT(*) FILTER (WHERE {valid}) AS valid_rows,"
        f" COUNT(*) FILTER (WHERE {rejected}) AS rejected_rows FROM {rows})"
    )


CLICKS_SILVER = f"""
    SELECT DISTINCT event_id, customer_id, product_id, session_id,
           LOWER(TRIM(event_type)) AS event_type, LOWER(TRIM(page_name)) AS page_name,
           LOWER(TRIM(device)) AS device, UPPER(TRIM(country)) AS country, business_date,
           TRY_CAST(event_time AS TIMESTAMP) AS event_timestamp
    FROM click_src
    WHERE event_id IS NOT NULL AND customer_id IS NOT NULL AND session_id IS NOT NULL
      AND event_type IS NOT NULL AND TRY_CAST(event_time AS TIMESTAMP) IS NOT NULL
      AND LOWER(TRIM(event_type)) IN {_in(EVENT_TYPES)}"""

CLICKS = _ctes("clicks")
ORDERS = _ctes("orders")
CUSTOMERS = _ctes("customers")
PRODUCTS = _ctes("products")

ENGAGEMENT = f"""
    SELECT CAST(business_date AS VARCHAR) AS business_date, total_events, unique_customers,
           unique_sessions, click_count, add_to_cart_count, purchase_count,
           {_share('click_count', 'total_events')} AS click_percentage,
           {_share('add_to_cart_count', 'total_events')} AS cart_percentage,
           {_share('purchase_count', 'total_events')} AS purchase_percentage
    FROM (SELECT business_date, COUNT(*) AS total_events,
                 COUNT(DISTINCT customer_id) AS unique_customers,
                 COUNT(DISTINCT session_id) AS unique_sessions,
                 COUNT(*) FILTER (WHERE event_type = 'click') AS click_count,
                 COUNT(*) FILTER (WHERE event_type = 'add_to_cart') AS add_to_cart_count,
                 COUNT(*) FILTER (WHERE event_type = 'purchase') AS purchase_count
          FROM clicks_silver {{where}} GROUP BY business_date)"""

FACT = (
    _ctes("customers", "products", "orders")
    + """, fact AS (
    SELECT o.order_id, c.customer_id AS customer_key, p.product_id AS product_key,
           CAST(order_timestamp AS VARCHAR) AS order_timestamp,
           CAST(CAST(order_timestamp AS DATE) AS VARCHAR) AS order_date, quantity,
           CAST(CAST(unit_price AS DECIMAL(12,2)) AS DOUBLE) AS unit_price,
           CAST(CAST(discount_pct AS DECIMAL(5,4)) AS DOUBLE) AS discount_pct,
           CAST(tax_amount AS DOUBLE) AS tax_amount, CAST(order_amount AS DOUBLE) AS order_amount,
           o.status AS order_status, CAST(YEAR(order_timestamp) AS INTEGER) AS order_year,
           CAST(MONTH(order_timestamp) AS INTEGER) AS order_month,
           STRFTIME(order_timestamp, '%B') AS order_month_name,
           CAST(QUARTER(order_timestamp) AS INTEGER) AS order_quarter
    FROM orders_silver o LEFT JOIN customers_silver c ON o.customer_id = c.customer_id
         LEFT JOIN products_silver p ON o.product_id = p.product_id)
"""
)

DIM_PRODUCT = (
    PRODUCTS
    + "SELECT product_id AS product_key, product_id, product_name, category,"
    " CAST(price AS DOUBLE) AS current_price, status FROM products_silver"
)

MERGE = """WITH target AS (SELECT * FROM orders WHERE o_orderkey % 6 <> 0),
source AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice,
                  o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 2 = 0)
"""
MERGE_SHOWN = (
    "o_orderkey, o_custkey, o_orderstatus, o_totalprice,"
    " CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority"
)

PAGES = f"""WITH click_src AS (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY customer_id, product_id,
        session_id, event_time, event_type, page_name, device, country, business_date,
        source_page) AS rn
    FROM (SELECT e.*, COUNT(*) OVER (PARTITION BY source_page) AS total_records
          FROM (SELECT {", ".join(f"{e} AS {n}" for n, e in CLICK_EXPRESSIONS.items())},
                       {PAGE_EXPRESSION} AS source_page
                FROM {_copied_sql("events", "event_id % 10 = 0")}) e))
"""


def _flags(name: str) -> str:
    return ", ".join(f"({p}) AS _is_{flag}_valid" for flag, p, _ in RULES[name])


ORACLE: dict[str, str] = {
    "clicks_bronze": PAGES
    + f"""SELECT event_id, customer_id, product_id, session_id, event_time, event_type, page_name,
           device, country, CAST(business_date AS VARCHAR) AS business_date, source_page,
           {PAGE_IDS} AS page_size, 1 AS total_pages, total_records
    FROM click_src WHERE rn = 1""",
    "silver_clicks": CLICKS
    + """SELECT event_id, customer_id, product_id, session_id, event_type, page_name, device,
           country, CAST(business_date AS VARCHAR) AS business_date,
           CAST(event_timestamp AS VARCHAR) AS event_timestamp FROM clicks_silver""",
    "event_type_counts": CLICKS
    + "SELECT event_type, COUNT(*) AS event_count FROM clicks_silver GROUP BY event_type",
    "event_time_span": CLICKS
    + """SELECT COUNT(*) AS total_rows, COUNT(DISTINCT event_id) AS distinct_events,
           CAST(MIN(event_timestamp) AS VARCHAR) AS min_event_timestamp,
           CAST(MAX(event_timestamp) AS VARCHAR) AS max_event_timestamp FROM clicks_silver""",
    "dq_summary": CLICKS
    + """SELECT COUNT(*) AS total_rows, COUNT(DISTINCT event_id) AS distinct_event_ids,
           COUNT(*) FILTER (WHERE customer_id IS NULL) AS null_customer_ids,
           COUNT(*) FILTER (WHERE session_id IS NULL) AS null_session_ids,
           COUNT(*) FILTER (WHERE event_timestamp IS NULL) AS invalid_timestamps
    FROM clicks_silver""",
    "daily_engagement": CLICKS + ENGAGEMENT.format(where=""),
    "daily_engagement_since": CLICKS
    + ENGAGEMENT.format(where="WHERE business_date >= DATE '2024-01-20'"),
    "rule_flags": CUSTOMERS
    + f"""SELECT _is_customer_id_valid, _is_email_valid, _is_province_valid, _is_status_valid,
           COUNT(*) AS count FROM (SELECT {_flags("customers")} FROM customers_std)
    GROUP BY ALL""",
    "rule_flags_products": PRODUCTS
    + "SELECT product_id, _batch_id, "
    + ", ".join(f"COALESCE({p}, FALSE) AS _is_{flag}_valid" for flag, p, _ in RULES["products"])
    + " FROM products_std",
    "rule_flags_orders": ORDERS
    + f"SELECT *, COUNT(*) AS count FROM (SELECT {_flags('orders')} FROM orders_std) GROUP BY ALL",
    "expected_amount": ORDERS
    + """SELECT order_id, product_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
           CAST(discount_pct AS DOUBLE) AS discount_pct, CAST(tax_amount AS DOUBLE) AS tax_amount,
           CAST(order_amount AS DOUBLE) AS order_amount,
           CAST(expected_order_amount AS DOUBLE) AS expected_order_amount FROM orders_std""",
    "null_profile": ORDERS
    + "SELECT "
    + ", ".join(
        f"COUNT(*) FILTER (WHERE {c} IS NULL) AS {c}"
        for c in (
            "order_id", "customer_id", "product_id", "order_timestamp", "quantity", "unit_price",
            "discount_pct", "tax_amount", "order_amount", "status", "_ingested_at",
            "_source_file_modified_at",
        )
    )
    + " FROM orders_src",
    "status_counts": ORDERS + "SELECT status, COUNT(*) AS count FROM orders_std GROUP BY status",
    "reject_reason_counts": ORDERS
    + f"SELECT reject_reason, COUNT(*) AS count FROM (SELECT {_reason('orders', False)}"
    f" AS reject_reason {_rejected('orders', False)}) GROUP BY reject_reason",
    "reject_reason_counts_decided": ORDERS
    + f"SELECT reject_reason, COUNT(*) AS count FROM (SELECT {_reason('orders', True)}"
    f" AS reject_reason {_rejected('orders', True)}) GROUP BY reject_reason",
    "duplicate_keys": ORDERS
    + "SELECT order_id, COUNT(*) AS count FROM orders_src GROUP BY order_id HAVING COUNT(*) > 1",
    "duplicate_customers": CUSTOMERS
    + "SELECT customer_id, COUNT(*) AS count FROM customers_checked WHERE ok"
    " GROUP BY customer_id HAVING COUNT(*) > 1",
    "key_uniqueness": ORDERS
    + "SELECT COUNT(*) AS total_rows, COUNT(DISTINCT order_id) AS distinct_order_ids"
    " FROM orders_src",
    "remaining_invalid_emails": CUSTOMERS
    + """SELECT 'standardized' AS stage, COUNT(*) AS invalid_emails FROM customers_std
        WHERE NOT (email IS NOT NULL AND REGEXP_MATCHES(email, '{pattern}'))
    UNION ALL SELECT 'silver', COUNT(*) FROM customers_silver
        WHERE NOT (email IS NOT NULL AND REGEXP_MATCHES(email, '{pattern}'))""".format(
        pattern=EMAIL_PATTERN
    ),
    "orders_per_day": ORDERS
    + """SELECT CAST(CAST(order_timestamp AS DATE) AS VARCHAR) AS order_date, COUNT(*) AS orders
    FROM orders_std GROUP BY CAST(order_timestamp AS DATE)""",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS record_count FROM {t}"
        for t in ("customer", "part", "orders", "lineitem", "events")
    ),
    "preview_orders": ORDERS
    + """SELECT order_id, product_id, CAST(_ingested_at AS VARCHAR) AS _ingested_at, quantity,
           status FROM orders_src
    ORDER BY order_id, orders_src._ingested_at, product_id, quantity LIMIT 20""",
    "scalar_functions": """
    SELECT o_orderkey, TRIM(CONCAT('  ', c_mktsegment, ' ')) AS trimmed, LOWER(c_name) AS lowered,
           UPPER(o_orderpriority) AS uppered,
           UPPER(SUBSTR(c_mktsegment, 1, 1)) || LOWER(SUBSTR(c_mktsegment, 2)) AS capitalised,
           CAST(LENGTH(c_name) AS INTEGER) AS name_length,
           CONCAT_WS('-', CASE WHEN o_orderkey % 3 <> 0 THEN c_mktsegment END, o_orderstatus)
               AS joined,
           REGEXP_MATCHES(o_orderpriority, '^[12]-') AS is_urgent,
           CASE WHEN o_totalprice > 300000 THEN 'high' WHEN o_totalprice > 100000 THEN 'middle'
                ELSE 'low' END AS band,
           CASE WHEN o_orderstatus = 'F' THEN 1 END AS one_if_final,
           CAST(ROUND(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.0725 AS DECIMAL(5,4)), 2)
               AS DOUBLE) AS tax,
           ABS(c_acctbal - 5000) AS distance, o_totalprice * 2 + o_custkey - 1 AS arithmetic,
           {share} AS share,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date,
           CAST(YEAR(o_orderdate) AS INTEGER) AS order_year,
           CAST(MONTH(o_orderdate) AS INTEGER) AS order_month,
           STRFTIME(o_orderdate, '%B') AS order_month_name,
           CAST(QUARTER(o_orderdate) AS INTEGER) AS order_quarter,
           CAST(SUBSTR(c_name, 10, 9) AS BIGINT) AS number_in_name,
           CASE WHEN o_orderkey % 2 <> 0 THEN CAST(SUBSTR(c_name, 10, 9) AS BIGINT) END
               AS number_if_one,
           CASE WHEN o_orderkey % 2 <> 0 THEN '1998-01-02' END AS date_if_one
    FROM orders JOIN customer ON o_custkey = c_custkey""".format(
        share=_share("o_custkey", "(o_orderkey + 1)")
    ),
    "order_status_rename": "SELECT o_orderkey AS order_id, UPPER(o_orderpriority) AS status"
    " FROM orders",
    "align_schema": ORDERS
    + """SELECT CAST(order_id AS VARCHAR) AS order_id, product_id,
           CAST(quantity AS BIGINT) AS quantity, CAST(unit_price AS DOUBLE) AS unit_price
    FROM orders_std""",
    "dim_customer": CUSTOMERS
    + """SELECT customer_id AS customer_key, customer_id, first_name, last_name,
           CONCAT_WS(' ', first_name, last_name) AS customer_name, email, city, province,
           CAST(signup_date AS VARCHAR) AS signup_date, status FROM customers_silver""",
    "dim_product": DIM_PRODUCT,
    "export_parquet": DIM_PRODUCT,
    "fact_orders": FACT + "SELECT * FROM fact",
    "fact_valid": FACT
    + "SELECT * FROM fact WHERE customer_key IS NOT NULL AND product_key IS NOT NULL",
    "fact_rejected": FACT
    + """SELECT *, CONCAT_WS('; ',
           CASE WHEN customer_key IS NULL THEN 'Missing Customer Dimension Key' END,
           CASE WHEN product_key IS NULL THEN 'Missing Product Dimension Key' END) AS reject_reason
    FROM fact WHERE customer_key IS NULL OR product_key IS NULL""",
    "referential_integrity": FACT
    + """SELECT COUNT(*) FILTER (WHERE customer_key IS NULL) AS missing_customer_keys,
           COUNT(*) FILTER (WHERE product_key IS NULL) AS missing_product_keys FROM fact""",
    "reconcile_fact": FACT
    + _reconciled(
        "fact",
        "customer_key IS NOT NULL AND product_key IS NOT NULL",
        "customer_key IS NULL OR product_key IS NULL",
    ),
    "merge_insert_only": MERGE
    + f"""SELECT {MERGE_SHOWN} FROM (SELECT * FROM target UNION ALL SELECT * FROM source
        WHERE o_orderkey NOT IN (SELECT o_orderkey FROM target))""",
    "merge_upsert": MERGE
    + f"""SELECT {MERGE_SHOWN} FROM (SELECT * FROM source UNION ALL SELECT * FROM target
        WHERE o_orderkey NOT IN (SELECT o_orderkey FROM source))""",
    "load_audit": MERGE
    + """SELECT COUNT(*) FILTER (WHERE t.o_orderkey IS NULL) AS rows_inserted,
           COUNT(*) FILTER (WHERE t.o_orderkey = s.o_orderkey) AS rows_updated,
           COUNT(*) FILTER (WHERE s.o_orderkey IS NULL) AS rows_kept,
           CAST(0 AS BIGINT) AS rows_gone
    FROM target t FULL OUTER JOIN source s ON t.o_orderkey = s.o_orderkey""",
    "ingest_parquet": """SELECT *, 'customer.parquet' AS _source_file_name,
           'customer' AS _source_name, 'CRM' AS _source_system, 'parquet' AS _source_format,
           'batch-7' AS _batch_id FROM customer""",
    "ingest_csv": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           CAST(o_orderdate AS VARCHAR) AS o_orderdate, UPPER(o_orderpriority) AS status,
           'orders' AS _source_name, 'ERP' AS _source_system, 'csv' AS _source_format,
           'batch-7' AS _batch_id FROM orders""",
    "ingest_json": """SELECT *, 'products' AS _source_name, 'PIM' AS _source_system,
           'json' AS _source_format, 'batch-7' AS _batch_id FROM part""",
    "lineage_counts": """SELECT 'customer' AS _source_name, 'CRM' AS _source_system,
           'batch-7' AS _batch_id, COUNT(*) AS record_count FROM customer
    UNION ALL SELECT 'part', 'PIM', 'batch-7', COUNT(*) FROM part""",
    "table_overwrite": """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,
           CAST(LENGTH(c_name) AS INTEGER) AS name_length FROM customer""",
    "table_append_evolve": """SELECT c_custkey, c_name,
           CASE WHEN c_nationkey < 13 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer""",
}

ORACLE["table_merge_two_partition_columns"] = (
    MERGE
    + f"""SELECT {MERGE_SHOWN}, note FROM (
        SELECT *, 'late' AS note FROM source
        UNION ALL SELECT *, NULL FROM target
        WHERE o_orderstatus <> 'P' AND o_orderkey NOT IN (SELECT o_orderkey FROM source))"""
)
ORACLE["run_pipeline_twice_fact"] = FACT + "SELECT * FROM fact WHERE order_id % 1000 <> 1"
ORACLE["run_pipeline_twice_engagement"] = CLICKS + ENGAGEMENT.format(where="").replace(
    "FROM clicks_silver",
    "FROM (SELECT * REPLACE (CASE WHEN event_id % 37 <> 0 THEN business_date END AS business_date)"
    " FROM clicks_silver)",
)

ORACLE["table_overwrite_same_schema"] = "SELECT c_custkey, c_name FROM customer WHERE c_custkey % 2 = 0"
ORACLE["catalog_columns"] = """SELECT table_name, column_name AS col_name,
    CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE LOWER(data_type) END AS data_type
    FROM information_schema.columns WHERE table_name IN ('customer', 'part')"""
ORACLE["processing_stamps"] = (
    CUSTOMERS + "SELECT COUNT(*) AS total_rows, COUNT(*) AS stamped_rows, 1 AS times FROM customers_silver"
)
ORACLE["ingest_append"] = """SELECT p_partkey, p_name,
    CASE WHEN p_partkey % 2 = 0 THEN p_retailprice END AS p_retailprice,
    CASE WHEN p_partkey % 2 = 1 THEN 'new' END AS origin,
    CASE WHEN p_partkey % 2 = 0 THEN 'parquet' ELSE 'json' END AS _source_format,
    CASE WHEN p_partkey % 2 = 0 THEN 'batch-7' ELSE 'batch-8' END AS _batch_id FROM part"""
ORACLE["export_partitioned"] = DIM_PRODUCT
ORACLE["load_history"] = MERGE + """, n AS (
    SELECT COUNT(*) AS orders, COUNT(*) FILTER (WHERE o_orderkey % 6 <> 0) AS target,
        COUNT(*) FILTER (WHERE o_orderkey % 2 = 0) AS source,
        COUNT(*) FILTER (WHERE o_orderkey % 6 = 0) AS fresh,
        COUNT(*) FILTER (WHERE o_orderkey % 10 = 0) AS tens FROM orders)
SELECT 1 AS version, 'create' AS operation, target AS rows_inserted, 0 AS rows_updated, 0 AS rows_kept FROM n
UNION ALL SELECT 2, 'merge insert', fresh, 0, target FROM n
UNION ALL SELECT 3, 'merge upsert', 0, source, orders - source FROM n
UNION ALL SELECT 4, 'append', tens, 0, orders FROM n
UNION ALL SELECT 5, 'overwrite', source, 0, 0 FROM n"""

# The same results by way of tables
ORACLE["table_merge_upsert"] = ORACLE["merge_upsert"]
ORACLE["merge_upsert_filtered"] = ORACLE["merge_upsert"]
ORACLE["matched_rows_filtered"] = "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey % 10 = 3"
ORACLE["daily_engagement_merged"] = ORACLE["daily_engagement"]
ORACLE["distinct_values_merged"] = """
    SELECT o_orderpriority, COUNT(DISTINCT o_custkey) AS customers, COUNT(DISTINCT o_orderdate) AS days
    FROM orders GROUP BY ALL"""
ORACLE["table_merge_upsert_partitioned"] = ORACLE["merge_upsert"]
ORACLE["table_merge_insert"] = ORACLE["merge_insert_only"]
ORACLE["run_pipeline_fact"] = ORACLE["fact_orders"]
ORACLE["run_pipeline_increment"] = ORACLE["fact_orders"]
ORACLE["run_pipeline_engagement"] = ORACLE["daily_engagement"]
ORACLE["run_pipeline_checks"] = FACT + """SELECT *, faults = 0 AS passed FROM (
    SELECT check_name, table_name, CAST(0 AS BIGINT) AS faults FROM (VALUES
        ('lost_rows', 'bronze.customers'), ('lost_rows', 'bronze.products'),
        ('lost_rows', 'bronze.orders'), ('duplicate_keys', 'silver.customers'),
        ('duplicate_keys', 'silver.products'), ('duplicate_keys', 'silver.orders'),
        ('duplicate_keys', 'silver.click_events'), ('duplicate_keys', 'gold.dim_customer'),
        ('duplicate_keys', 'gold.dim_product'), ('duplicate_keys', 'gold.fact_orders'),
        ('invalid_emails', 'silver.customers')) AS clean(check_name, table_name)
    UNION ALL SELECT 'missing_customer_keys', 'gold.fact_orders', COUNT(*) FROM fact
        WHERE customer_key IS NULL
    UNION ALL SELECT 'missing_product_keys', 'gold.fact_orders', COUNT(*) FROM fact
        WHERE product_key IS NULL)"""

for _name, _with in (("customers", CUSTOMERS), ("products", PRODUCTS), ("orders", ORDERS)):
    _kept = SHOWN[_name]
    if _name == "orders":
        _kept = _kept.replace(
            "customer_id, product_id, CAST(order_timestamp AS VARCHAR) AS order_timestamp, quantity",
            "raw_customer_id AS customer_id, raw_product_id AS product_id,"
            " raw_timestamp AS order_timestamp, raw_quantity AS quantity",
        )
        _kept += ", CAST(expected_order_amount AS DOUBLE) AS expected_order_amount"
    ORACLE[f"silver_{_name}"] = _with + f"SELECT {SHOWN[_name]} FROM {_name}_silver"
    ORACLE[f"latest_{_name}"] = (
        _with + f"SELECT {SHOWN[_name]} FROM {_latest(_name, f'{_name}_src')}"
    )
    for _suffix, _decided in (("", False), ("_decided", True)):
        ORACLE[f"silver_{_name}_rejected{_suffix}"] = (
            _with
            + f"SELECT {_kept}, {_reason(_name, _decided)} AS reject_reason"
            f" {_rejected(_name, _decided)}"
        )
        ORACLE[f"reconcile_{_name}{_suffix}"] = _with + _reconciled(
            f"{_name}_checked", "ok", "ok IS FALSE" if _decided else "ok IS NOT TRUE"
        )

ORACLE["run_pipeline_observed"] = FACT + """SELECT *, faults = 0 AS passed FROM (
    SELECT check_name, table_name, CAST(0 AS BIGINT) AS faults FROM (VALUES
        ('lost_rows', 'bronze.customers'), ('lost_rows', 'bronze.products'),
        ('lost_rows', 'bronze.orders'), ('invalid_emails', 'silver.customers')) AS clean(check_name, table_name)
    UNION ALL SELECT 'missing_customer_keys', 'gold.fact_orders', COUNT(*) FROM fact
        WHERE customer_key IS NULL
    UNION ALL SELECT 'missing_product_keys', 'gold.fact_orders', COUNT(*) FROM fact
        WHERE product_key IS NULL)"""
ORACLE["split_observed"] = f"SELECT 'bronze.orders' AS table_name, * FROM ({ORACLE['reconcile_orders']})"
ORACLE["ingest_new_files"] = """SELECT p_partkey, p_name, p_size, 'products' AS _source_name, 'PIM' AS _source_system,
    'json' AS _source_format, 'batch-7-' || p_partkey % 2 AS _batch_id FROM part"""
ORACLE["ingest_unreadable"] = """SELECT CASE WHEN p_partkey % 40 = 0 OR p_partkey % 41 != 0 THEN p_partkey END AS p_partkey,
    CASE WHEN p_partkey % 40 != 0 AND p_partkey % 41 != 0 THEN p_size END AS p_size,
    CASE WHEN p_partkey % 40 = 0 THEN '{"p_partkey": ' || p_partkey || ', "p_size": "x' || p_size || '"}'
         WHEN p_partkey % 41 = 0 THEN '{"p_partkey": ' || p_partkey END AS text,
    'parts' AS _source_name FROM part"""
ORACLE["table_published"] = """SELECT c_custkey, c_nationkey, CAST(LENGTH(c_name) AS INTEGER) AS name_length
    FROM customer WHERE c_custkey % 3 != 0"""
_ODD = f"({PAGE_EXPRESSION}) // {PAGE_IDS} % 2 = 1"
ORACLE["clicks_variant"] = f"""WITH rows AS (SELECT {PAGE_EXPRESSION} AS source_page, *,
        COUNT(*) OVER (PARTITION BY {PAGE_EXPRESSION}) AS total_records, {_ODD} AS odd
    FROM {_copied_sql('events', 'event_id % 10 = 0')})
    SELECT DISTINCT event_id, customer_id, CASE WHEN NOT odd THEN product_id END AS product_id, event_type, source_page,
        total_records, CASE WHEN odd AND product_id IS NOT NULL THEN 'product_id' ELSE '' END AS misfits
    FROM (SELECT source_page, total_records, odd, {", ".join(f"{CLICK_EXPRESSIONS[c]} AS {c}" for c in ("event_id", "customer_id", "product_id", "event_type"))}
        FROM rows) WHERE event_id IS NOT NULL"""
ORACLE["table_changes"] = MERGE + """, merged AS (SELECT * FROM source UNION ALL SELECT * FROM target
        WHERE o_orderkey NOT IN (SELECT o_orderkey FROM source)), later AS (SELECT * FROM merged WHERE o_orderkey % 7 != 0)
    SELECT COALESCE(t.o_orderkey, l.o_orderkey) AS o_orderkey,
        CASE WHEN t.o_orderkey IS NULL THEN 'insert' WHEN l.o_orderkey IS NULL THEN 'delete' ELSE 'update' END AS change,
        t.o_totalprice AS old_price, l.o_totalprice AS new_price
    FROM target t FULL OUTER JOIN later l ON t.o_orderkey = l.o_orderkey
    WHERE t.o_totalprice IS DISTINCT FROM l.o_totalprice"""

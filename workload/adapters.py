"""The given tables in the shape of customers, products, orders and click events.

Copies, NULLs, bad values and stray blanks are planted by key, for testing. The
expressions run in Spark and in the checking engine alike; copies are made by
``explode`` here and by UNION ALL there.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CUSTOMER_EXPRESSIONS = {
    "customer_id": "CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE c_custkey END",
    "first_name": "CONCAT('  ', c_mktsegment, ' ')",
    "last_name": "CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE c_name END",
    "email": "CASE WHEN c_custkey % 11 = 0 THEN NULL"
    " WHEN c_custkey % 13 = 0 THEN CONCAT(c_name, '.example.com')"
    " ELSE CONCAT(' ', REPLACE(c_name, '#', '.'), '@Example.COM ') END",
    "city": "CASE WHEN c_nationkey % 2 = 0 THEN ' toronto' ELSE 'CALGARY ' END",
    "province": "CASE c_nationkey % 7 WHEN 0 THEN 'on' WHEN 1 THEN 'QC ' WHEN 2 THEN ' ab'"
    " WHEN 3 THEN 'BC' WHEN 4 THEN 'mb' WHEN 5 THEN 'NS' ELSE NULL END",
    "status": "CASE c_custkey % 10 WHEN 0 THEN 'closed' WHEN 1 THEN ' inactive ' ELSE 'Active' END",
    "signup_date": "DATE '2024-01-05'",
    "_batch_id": "batch",
}

PRODUCT_EXPRESSIONS = {
    "product_id": "CASE WHEN p_partkey % 89 = 0 THEN NULL"
    " WHEN p_partkey % 83 = 0 THEN -p_partkey ELSE p_partkey END",
    "product_name": "CASE WHEN p_partkey % 23 = 0 THEN '   ' WHEN p_partkey % 29 = 0 THEN NULL"
    " ELSE CONCAT(' ', p_name, ' ') END",
    "category": "CASE p_size % 8 WHEN 0 THEN 'laptop' WHEN 1 THEN ' Monitor'"
    " WHEN 2 THEN 'KEYBOARD' WHEN 3 THEN 'mouse ' WHEN 4 THEN 'phone' WHEN 5 THEN 'Tablet'"
    " WHEN 6 THEN 'widget' ELSE NULL END",
    "price": "CASE WHEN p_partkey % 37 = 0 THEN 0.0 ELSE p_retailprice END",
    "status": "CASE WHEN p_partkey % 41 = 0 THEN 'retired' ELSE ' active' END",
    "_batch_id": "batch",
}

ORDER_LINE_EXPRESSIONS = {
    "order_id": "l_orderkey * 10 + l_linenumber",
    "customer_id": "CASE WHEN l_orderkey % 101 = 0 THEN NULL"
    " WHEN l_orderkey % 109 = 0 THEN CONCAT('C', CAST(o_custkey AS STRING))"
    " ELSE CAST(o_custkey AS STRING) END",
    "product_id": "CASE WHEN l_orderkey % 107 = 0 THEN NULL WHEN l_orderkey % 113 = 0 THEN 'none'"
    " ELSE CAST(l_partkey AS STRING) END",
    "order_timestamp": "CASE WHEN l_orderkey % 103 = 0 THEN NULL"
    " WHEN l_orderkey % 127 = 0 THEN 'not-a-time' ELSE CAST(o_orderdate AS STRING) END",
    "pieces": "CAST(CASE WHEN l_orderkey % 53 = 0 THEN 0 ELSE l_quantity END AS INT)",
    "quantity": "CASE WHEN l_orderkey % 131 = 0 THEN 'abc' WHEN l_orderkey % 53 = 0 THEN '0'"
    " ELSE CAST(CAST(l_quantity AS INT) AS STRING) END",
    "unit_price": "CAST(CAST(p_retailprice AS DECIMAL(12,3))"
    " + CAST((l_orderkey % 10) * 0.001 AS DECIMAL(12,3)) AS DECIMAL(13,3))",
    "discount_pct": "CAST(CASE WHEN l_orderkey % 59 = 0 THEN 1.5 WHEN l_orderkey % 61 = 0 THEN NULL"
    " WHEN l_orderkey % 67 = 0 THEN 15 ELSE l_discount + (l_orderkey % 7) * 0.00001 END"
    " AS DECIMAL(8,5))",
    "tax_amount": "CAST(l_tax * 100 AS DECIMAL(12,2))",
    "status": "CASE o_orderstatus WHEN 'F' THEN ' completed' WHEN 'O' THEN 'Pending '"
    " WHEN 'P' THEN CASE WHEN l_linenumber = 1 THEN 'shipped' WHEN l_linenumber = 2 THEN NULL"
    " ELSE 'REFUNDED' END END",
    "_ingested_at": "l_shipdate",
    "_source_file_modified_at": "o_orderdate",
}

ORDER_EXPRESSIONS = {
    **{
        name: name
        for name in (
            "order_id", "customer_id", "product_id", "order_timestamp", "quantity",
            "unit_price", "discount_pct", "tax_amount",
        )
    },
    "order_amount": "CAST(ROUND(pieces * unit_price * (1 - discount_pct) + tax_amount, 2)"
    " + CASE WHEN order_id % 17 = 0 THEN 1.00 ELSE 0.00 END AS DECIMAL(12,2))",
    **{name: name for name in ("status", "_ingested_at", "_source_file_modified_at")},
}

CLICK_EXPRESSIONS = {
    "event_id": "CASE WHEN event_id % 211 = 0 THEN NULL ELSE event_id END",
    "customer_id": "CASE WHEN event_id % 31 = 0 THEN NULL ELSE user_id END",
    "product_id": "event_id % 2000",
    "session_id": "CASE WHEN event_id % 43 = 0 THEN NULL"
    " ELSE CONCAT('s', CAST(user_id AS STRING), '-', CAST(CAST(ts AS DATE) AS STRING)) END",
    "event_time": "CASE WHEN event_id % 47 = 0 THEN 'not-a-time' ELSE CAST(ts AS STRING) END",
    "event_type": "CASE event_type WHEN 'view' THEN ' Page_View ' WHEN 'signup' THEN 'ADD_TO_CART'"
    " WHEN 'error' THEN 'scroll' ELSE event_type END",
    "page_name": "' /Home'",
    "device": "CASE WHEN event_id % 2 = 0 THEN 'Web ' ELSE 'MOBILE' END",
    "country": "' ca'",
    "business_date": "CAST(ts AS DATE)",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _select(df: DataFrame, expressions: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(e).alias(name) for name, e in expressions.items()])


def _copied(df: DataFrame, twice: str) -> DataFrame:
    """Every row as batch 1, rows that meet ``twice`` as batch 2 as well."""
    batches = F.when(F.expr(twice), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return df.withColumn("batch", F.explode(batches))


def customers_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    copied = _copied(table(spark, sf_dir, "customer"), "c_custkey % 5 = 0")
    return _select(copied, CUSTOMER_EXPRESSIONS)


def products_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    copied = _copied(table(spark, sf_dir, "part"), "p_partkey % 5 = 0")
    return _select(copied, PRODUCT_EXPRESSIONS)


def _of_order(expression: str) -> bool:
    """Does an order decide this value of its lines? Of a line it knows the key, which is its own."""
    columns = set(re.findall(r"\b[lop]_\w+", expression)) - {"l_orderkey"}
    return bool(columns) and all(c.startswith("o_") for c in columns)


def orders_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that the order decides are computed before the join: once for it, not for each line.
    Those of a line alone stay above the joins, as they are wider than what they are made of."""
    lines, orders, parts = (table(spark, sf_dir, name) for name in ("lineitem", "orders", "part"))
    own = {name: e for name, e in ORDER_LINE_EXPRESSIONS.items() if _of_order(e)}
    computed = [F.expr(e).alias(f"_{name}") for name, e in own.items()]
    ordered = orders.withColumn("l_orderkey", F.col("o_orderkey")).select(*orders.columns, *computed)
    joined = (
        lines.join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
    )
    values = {name: f"_{name}" if name in own else e for name, e in ORDER_LINE_EXPRESSIONS.items()}
    return _select(_select(joined, values), ORDER_EXPRESSIONS)


def click_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(_copied(table(spark, sf_dir, "events"), "event_id % 10 = 0"), CLICK_EXPRESSIONS)


# Events of one page: ids are unique, so a page stays this small at any scale.
PAGE_IDS = 5000
PAGE_EXPRESSION = f"event_id - event_id % {PAGE_IDS}"


def click_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click events grouped into page documents, plus a page with no events and one
    with NULL for them."""
    copied = _copied(table(spark, sf_dir, "events"), "event_id % 10 = 0")
    event = {("page" if k == "page_name" else k): e for k, e in CLICK_EXPRESSIONS.items()}
    events = copied.select(
        F.expr(PAGE_EXPRESSION).alias("page"),
        F.struct(*[F.expr(e).alias(name) for name, e in event.items()]).alias("event"),
    )
    pages = events.groupBy("page").agg(
        F.collect_list("event").alias("events"), F.count("*").alias("total_records")
    )
    pages = pages.withColumns(
        {"page_size": F.lit(PAGE_IDS).cast("long"), "total_pages": F.lit(1).cast("long")}
    )
    hollow = spark.range(2).select(
        (-F.col("id") - 1).alias("page"),
        F.when(F.col("id") == 0, F.array().cast(pages.schema["events"].dataType)).alias("events"),
        F.lit(0).cast("long").alias("total_records"),
        F.lit(PAGE_IDS).cast("long").alias("page_size"),
        F.lit(1).cast("long").alias("total_pages"),
    )
    return pages.unionByName(hollow)


def _as_sql(expressions: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {name}" for name, e in expressions.items())


def _copied_sql(name: str, twice: str) -> str:
    return (
        f"(SELECT *, 1 AS batch FROM {name}"
        f" UNION ALL SELECT *, 2 AS batch FROM {name} WHERE {twice})"
    )


# The same inputs as common table expressions, for the checking engine
SQL_SOURCES = {
    "customers_src": f"SELECT {_as_sql(CUSTOMER_EXPRESSIONS)}"
    f" FROM {_copied_sql('customer', 'c_custkey % 5 = 0')}",
    "products_src": f"SELECT {_as_sql(PRODUCT_EXPRESSIONS)}"
    f" FROM {_copied_sql('part', 'p_partkey % 5 = 0')}",
    "orders_src": f"SELECT {_as_sql(ORDER_EXPRESSIONS)} FROM"
    f" (SELECT {_as_sql(ORDER_LINE_EXPRESSIONS)} FROM lineitem"
    " JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)",
    "click_src": f"SELECT {_as_sql(CLICK_EXPRESSIONS)}"
    f" FROM {_copied_sql('events', 'event_id % 10 = 0')}",
}

"""Known counts of the adapted inputs at sf0.01."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from smelter.operators.merge import merge_insert, merge_upsert
from smelter.operators.quality import rejects_by_reason
from smelter.plans.clicks import daily_engagement, silver_clicks
from smelter.plans.customers import CUSTOMERS, dim_customer
from smelter.plans.orders import ORDERS, fact_orders
from smelter.plans.products import PRODUCTS, dim_product
from smelter.sources.pages import PAGE_SCHEMA, bronze_clicks, flatten_pages, read_json_pages
from workload import adapters

SF_DIR = f"{TESTDATA}/sf0.01"
FLOWS = {
    "customers": (CUSTOMERS, adapters.customers_src, ("_batch_id",), (1800, 948, 711, 141, 856)),
    "products": (PRODUCTS, adapters.products_src, ("_batch_id",), (2400, 1561, 585, 254, 1290)),
    "orders": (
        ORDERS,
        adapters.orders_src,
        ("_ingested_at", "_source_file_modified_at"),
        (60000, 44703, 11609, 3688, 34159),
    ),
}


@pytest.mark.parametrize("name", FLOWS)
def test_flow_counts(spark, name):
    flow, source, newest, (total, valid, rejected, undecided, latest) = FLOWS[name]
    rows = source(spark, SF_DIR)
    assert rows.count() == total
    assert flow.split(rows, "drop").valid.count() == valid
    assert flow.split(rows, "reject").valid.count() == valid
    assert flow.split(rows, "drop").rejected.count() == rejected
    assert flow.split(rows, "reject").rejected.count() == rejected + undecided
    silver = flow.refine(rows, newest=newest).clean
    assert silver.count() == latest
    assert silver.select(flow.key).distinct().count() == latest


def test_order_sums(spark):
    rows = adapters.orders_src(spark, SF_DIR)
    valid = ORDERS.split(rows).valid.agg(F.sum("order_amount")).first()
    assert valid[0] == Decimal("1026735248.31")
    silver = ORDERS.refine(rows).clean.agg(F.sum("order_amount"), F.sum("quantity")).first()
    assert tuple(silver) == (Decimal("780958888.66"), 864975)


def test_order_reasons(spark):
    rejected = ORDERS.refine(adapters.orders_src(spark, SF_DIR), "drop").rejected
    top = rejects_by_reason(rejected).limit(6).collect()
    assert [tuple(r) for r in top] == [
        ("Order Amount Mismatch", 2859),
        ("Invalid Status", 2450),
        ("Invalid Discount", 1583),
        ("Invalid Quantity", 984),
        ("Missing Customer ID", 955),
        ("Missing Product ID", 927),
    ]


def test_fact_counts(spark):
    orders = ORDERS.refine(adapters.orders_src(spark, SF_DIR)).clean
    customers = CUSTOMERS.refine(adapters.customers_src(spark, SF_DIR), newest=["_batch_id"]).clean
    products = PRODUCTS.refine(adapters.products_src(spark, SF_DIR), newest=["_batch_id"]).clean
    fact = fact_orders(orders, dim_customer(customers), dim_product(products))
    no_customer, no_product = F.col("customer_key").isNull(), F.col("product_key").isNull()
    counts = fact.agg(
        F.count("*"),
        F.count_if(no_customer),
        F.count_if(no_product),
        F.count_if(no_customer | no_product),
    ).first()
    assert tuple(counts) == (34159, 14662, 11973, 21526)


def test_click_counts(spark):
    source = adapters.click_src(spark, SF_DIR)
    assert source.count() == 11000
    silver = silver_clicks(source)
    days = daily_engagement(silver)
    counts = days.agg(
        F.sum("total_events"),
        F.count("*"),
        F.sum("click_count"),
        F.sum("add_to_cart_count"),
        F.sum("purchase_count"),
    ).first()
    assert tuple(counts) == (7358, 30, 1865, 1852, 1814)


def test_pages_round_trip(spark, tmp_path):
    folder = str(tmp_path / "pages")
    pages = adapters.click_pages(spark, SF_DIR)
    pages.write.option("maxRecordsPerFile", 1).json(folder)
    for schema in (PAGE_SCHEMA, None):
        read = read_json_pages(spark, folder, schema)
        assert read.count() == 2 + 2
        assert flatten_pages(read).count() == 11000
        assert bronze_clicks(read).count() == 9953


def test_merge_counts(spark):
    orders = adapters.table(spark, SF_DIR, "orders")
    target = orders.filter("o_orderkey % 6 <> 0")
    source = orders.filter("o_orderkey % 2 = 0").withColumn("o_totalprice", F.expr("o_totalprice + 1"))
    assert merge_upsert(target, source, ["o_orderkey"]).count() == 15000
    assert merge_insert(target, source, ["o_orderkey"]).count() == 15000

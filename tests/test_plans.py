"""Physical plans: what is pushed down, shuffled and split."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from smelter.operators.latest import latest_per_key
from smelter.operators.lookup import lookup_key
from smelter.operators.merge import untouched
from smelter.plans.clicks import daily_engagement, silver_clicks
from smelter.plans.orders import ORDERS, order_rules
from smelter.operators.quality import null_profile, reconcile
from smelter.scratch import by_rows, stage
from workload import adapters

SF_DIR = f"{TESTDATA}/sf0.01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return re.findall(r"Exchange (\w+)", text)


@pytest.fixture
def conf(spark):
    """Set options for one test."""
    saved = {}

    def set_options(**options):
        for key, value in options.items():
            name = "spark.sql." + key.replace("__", ".")
            saved.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield set_options
    for name, value in saved.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_click_filters_reach_the_scan(spark, tmp_path, conf):
    conf(maxMetadataStringLength="2000")
    adapters.click_src(spark, SF_DIR).write.parquet(str(tmp_path / "clicks"))
    text = plan(silver_clicks(spark.read.parquet(str(tmp_path / "clicks"))))
    pushed = re.search(r"PushedFilters: \[([^\]]*)", text).group(1)
    for column in ("event_id", "customer_id", "session_id", "event_type"):
        assert f"IsNotNull({column})" in pushed
    assert exchanges(text) == ["hashpartitioning"]


def test_engagement_reads_only_its_columns(spark, tmp_path, conf):
    conf(maxMetadataStringLength="2000")
    adapters.click_src(spark, SF_DIR).write.parquet(str(tmp_path / "clicks"))
    text = plan(daily_engagement(spark.read.parquet(str(tmp_path / "clicks"))))
    schema = re.search(r"ReadSchema: struct<([^>]*)", text).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == [
        "business_date",
        "customer_id",
        "event_type",
        "session_id",
    ]


def test_profile_and_reconcile_need_one_small_exchange(spark):
    orders = adapters.table(spark, SF_DIR, "orders")
    assert exchanges(plan(null_profile(orders))) == ["SinglePartition"]
    source = adapters.orders_src(spark, SF_DIR)
    text = plan(reconcile(ORDERS.standardized(source), order_rules()))
    assert exchanges(text).count("SinglePartition") == 1


def hot(spark, n=200_000):
    """A third of the rows share one key, another third have none."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id"))
    return spark.range(0, n, 1, 16).select(
        key.alias("customer_id"), F.sha2(F.col("id").cast("string"), 256).alias("payload"), "id"
    )


SMALL = dict(
    adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
    adaptive__skewJoin__skewedPartitionFactor="2",
    adaptive__advisoryPartitionSizeInBytes="64KB",
    autoBroadcastJoinThreshold="-1",
    adaptive__autoBroadcastJoinThreshold="-1",
)


def test_a_hot_key_is_split_in_a_lookup(spark, conf):
    conf(**SMALL)
    dimension = spark.range(200_000).select(
        F.col("id").alias("customer_id"), F.col("id").alias("customer_key")
    )
    joined = lookup_key(hot(spark), dimension, "customer_id", "customer_key")
    sizes = joined.groupBy(F.spark_partition_id()).agg(F.count("*"), F.max("payload")).collect()
    result = joined.agg(F.count("*"), F.count("customer_key"), F.max("id")).first()
    assert result == (200_000, 133_334, 199_999)
    assert sum(r[1] for r in sizes) == 200_000
    assert max(r[1] for r in sizes) < 200_000 / 3 / 2


def test_a_hot_key_is_split_in_a_merge(spark, conf):
    conf(**SMALL)
    batch = spark.range(0, 200_000, 2).select(F.col("id").alias("customer_id"))
    kept = untouched(hot(spark), batch, ["customer_id"])
    sizes = kept.groupBy(F.spark_partition_id()).agg(F.count("*"), F.max("payload")).collect()
    assert sum(r[1] for r in sizes) == kept.count()
    assert max(r[1] for r in sizes) < 200_000 / 3 / 2


def test_a_hot_key_sends_one_row_per_task(spark):
    latest = latest_per_key(hot(spark), ["customer_id"], ["id"])
    text = plan(latest)
    assert text.index("Exchange hashpartitioning(customer_id") < text.index("1, Partial")
    assert latest.filter("customer_id = 7 OR customer_id IS NULL").count() == 2


def test_orders_are_parsed_once(spark, conf):
    """On both sides of the split; the rules are one mask, read by filter and reasons."""
    conf(maxPlanStringLength="1000000")
    conf(debug__maxToStringFields="1000")
    landed = ", ".join(f"'1' AS {c}" for c in ("order_id", "customer_id", "product_id", "quantity", "unit_price"))
    others = "'1' AS discount_pct, '1' AS tax_amount, '1' AS order_amount, '2024-01-01' AS order_timestamp, 'x' AS status"
    orders = spark.range(3).selectExpr("*", *f"{landed}, {others}".split(", "))
    stored = orders.withColumns({c: F.concat(F.col(c), F.col("id")) for c in orders.columns if c != "id"})
    for side in ORDERS.split(stored):
        text = side._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("as decimal(15,6)") == 3
        assert text.count("IN (COMPLETED") == 1
        assert text.count("as timestamp)") == 1
    counted = reconcile(ORDERS.standardized(stored), order_rules())
    assert counted._jdf.queryExecution().optimizedPlan().toString().count("IN (COMPLETED") == 1


def test_orders_are_read_once_for_an_order(spark):
    """Text of an order's customer and time is made below the join with its lines."""
    text = adapters.orders_src(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    lines = text.splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    joins = [depth(line) for line in lines if "Join Inner" in line]
    made = [depth(line) for line in lines if re.search(r"AS _order_timestamp#", line)]
    assert len(joins) == 2 and made and min(made) > max(joins)


def test_rows_are_weighed_not_files(spark):
    """A million rows in a small file are too many to broadcast, and a thousand are not."""
    many, few = (stage(spark.range(n).select((F.col("id") % 10).alias("k"), F.lit(1).alias("v"))) for n in (1_000_000, 1000))
    left = spark.range(10).withColumnRenamed("id", "k")
    assert "SortMergeJoin" in plan(left.join(by_rows(many), "k", "left"))
    assert "BroadcastHashJoin" in plan(left.join(by_rows(few), "k", "left"))
    assert "SortMergeJoin" in plan(left.join(by_rows(few, rows=1_000_000), "k", "left"))
    assert left.join(by_rows(many), "k", "left").count() == 1_000_000

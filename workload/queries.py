"""One query per operator, over the given tables.

``plain`` turns decimals into doubles and dates and times into text at the very end,
so that two engines' results compare by value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DecimalType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from smelter.config import IngestConfig, PipelineConfig
from smelter.constants import NEWEST_FIRST
from smelter.functions.dates import calendar
from smelter.functions.numbers import ratio
from smelter.functions.text import clean
from smelter.operators.latest import latest_per_key
from smelter.operators.distinct import bitmaps, counted, numbered, united, with_number
from smelter.operators.likely import key_bits, likely, upsert_likely
from smelter.operators.merge import changes, join_keys, load_audit, merge_insert, merge_upsert
from smelter.operators.quality import (
    dq_summary,
    duplicate_keys,
    key_uniqueness,
    null_profile,
    reconcile,
    referential_integrity,
    rejects_by_reason,
    table_counts,
    value_counts,
    violations,
    with_rule_flags,
)
from smelter.operators.shape import align_to_schema, normalise_status, preview
from smelter.plans.checks import Observed, run_checks
from smelter.plans.clicks import (
    SUMMARY,
    EngagementState,
    daily_engagement,
    engagement_of,
    engagement_state,
    silver_clicks,
)
from smelter.plans.customers import CUSTOMERS, customer_rules, dim_customer, email_rule
from smelter.plans.flow import Flow
from smelter.plans.ingest import ingest, ingest_clicks, ingest_new, landed
from smelter.plans.orders import (
    DIMENSION_KEYS,
    ORDERS,
    fact_orders,
    fact_rules,
    order_rules,
    split_fact,
)
from smelter.plans.pipeline import run_pipeline
from smelter.plans.products import PRODUCTS, dim_product, product_rules
from smelter.scratch import new_folder, stage
from smelter.sinks.tables import create_or_merge, export_parquet, save_table
from smelter.sinks.views import expire_published, publish
from smelter.sources.catalog import describe, list_tables
from smelter.sources.landing import UNREADABLE
from smelter.sources.pages import (
    PAGE_SCHEMA,
    bronze_clicks,
    flatten_variant_pages,
    read_json_pages,
    read_variant_pages,
)
from workload.adapters import (
    PAGE_IDS,
    click_pages,
    click_src,
    customers_src,
    orders_src,
    products_src,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Times of processing, which no other engine can repeat
STAMPS = ("_silver_processed_at", "_gold_processed_at", "_rejected_at", "_bronze_ingested_at")
BY_BATCH = ("_batch_id",)
# Label of the batches that queries ingest
BATCH = "batch-7"


def plain(df: DataFrame) -> DataFrame:
    def shown(name: str, kind: object) -> Column:
        if isinstance(kind, DecimalType):
            return F.col(name).cast("double").alias(name)
        if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
            return F.col(name).cast("string").alias(name)
        return F.col(name)

    kept = df.drop(*STAMPS)
    return kept.select(*[shown(f.name, f.dataType) for f in kept.schema.fields])


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: plain(function(spark, sf_dir))
        return function

    return register


def new_database(spark: SparkSession) -> str:
    name = f"smelter_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{new_folder(spark, 'database')}'")
    return name


# ---- clicks


@query("clicks_bronze")
def clicks_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "pages")
    click_pages(spark, sf_dir).write.option("maxRecordsPerFile", 1).json(folder)
    return bronze_clicks(read_json_pages(spark, folder, PAGE_SCHEMA)).drop("_source_file")


@query("clicks_variant")
def clicks_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of which every other one has customers as text and products that are no numbers."""
    folder = new_folder(spark, "pages")
    pages = click_pages(spark, sf_dir)
    odd = F.coalesce(F.expr(f"page DIV {PAGE_IDS} % 2 = 1"), F.lit(False))
    drifted = F.transform(
        "events",
        lambda e: e.withField("customer_id", e["customer_id"].cast("string")).withField(
            "product_id", F.concat(F.lit("p"), e["product_id"])
        ),
    )
    for part in (pages.filter(~odd), pages.filter(odd).withColumn("events", drifted)):
        part.write.mode("append").option("maxRecordsPerFile", 1).json(folder)
    events = flatten_variant_pages(read_variant_pages(spark, folder)).filter("event_id IS NOT NULL")
    columns = ("event_id", "customer_id", "product_id", "event_type", "source_page", "total_records")
    return events.select(*columns, F.array_join("_misfits", ",").alias("misfits")).distinct()


def _silver_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_clicks(click_src(spark, sf_dir))


@query("silver_clicks")
def silver_clicks_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver_clicks(spark, sf_dir)



@query("event_type_counts")
def event_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = value_counts(_silver_clicks(spark, sf_dir), "event_type", name="event_count")
    return counts.orderBy(F.desc("event_count"), "event_type")


@query("event_time_span")
def event_time_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver_clicks(spark, sf_dir).agg(
        F.count("*").alias("total_rows"),
        F.count_distinct(F.col("event_id")).alias("distinct_events"),
        F.min("event_timestamp").alias("min_event_timestamp"),
        F.max("event_timestamp").alias("max_event_timestamp"),
    )


@query("dq_summary")
def clicks_dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq_summary(_silver_clicks(spark, sf_dir), "event_id", SUMMARY)



@query("daily_engagement")
def engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_engagement(_silver_clicks(spark, sf_dir))



@query("daily_engagement_since")
def daily_engagement_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_engagement(_silver_clicks(spark, sf_dir), since="2024-01-20")


@query("daily_engagement_merged")
def daily_engagement_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, the second late for days of the first: the first one's events aren't read again."""
    clicks = stage(_silver_clicks(spark, sf_dir), "clicks")
    late = F.col("event_id") % 3 == 0
    first = engagement_state(clicks.filter(~late))
    kept = EngagementState(*[stage(df, "state") for df in (first.counts, first.actors, first.numbers)])
    return engagement_of(engagement_state(clicks.filter(late), kept))


@query("distinct_values_merged")
def distinct_values_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct customers and days for each priority, from bitmaps of three batches."""
    orders = table(spark, sf_dir, "orders")
    found, by = [], ["o_orderpriority"]
    for column, name in (("o_custkey", "customers"), ("o_orderdate", "days")):
        numbers, maps = None, []
        for part in range(3):
            batch = orders.filter(F.col("o_orderkey") % 3 == part).select(*by, column)
            numbers = stage(numbered(batch.select(column), numbers), "numbers")
            maps.append(bitmaps(with_number(batch, column, numbers, "number"), by, "number"))
        found.append(counted(united(*maps), by, name))
    return found[0].join(found[1], by)


# ---- silver: clean and rejected rows, under both treatments of undecided rows


def _register_flow(
    name: str, flow: Flow, source: Query, newest: tuple[str, ...] | None = None
) -> None:
    """Queries that customers, products and orders have in common."""
    order = {} if newest is None else {"newest": newest}

    def refined(spark: SparkSession, sf_dir: str, null_policy: str):
        return flow.refine(source(spark, sf_dir), null_policy, **order)

    def rejected(null_policy: str) -> Query:
        return lambda spark, sf_dir: plain(refined(spark, sf_dir, null_policy).rejected)

    def reconciled(null_policy: str) -> Query:
        return lambda spark, sf_dir: reconcile(
            flow.standardized(source(spark, sf_dir)), flow.rules(), null_policy
        )

    QUERIES[f"silver_{name}"] = lambda spark, sf_dir: plain(refined(spark, sf_dir, "reject").clean)
    QUERIES[f"silver_{name}_rejected"] = rejected("reject")
    QUERIES[f"silver_{name}_rejected_decided"] = rejected("drop")
    QUERIES[f"reconcile_{name}"] = reconciled("reject")
    QUERIES[f"reconcile_{name}_decided"] = reconciled("drop")
    QUERIES[f"latest_{name}"] = lambda spark, sf_dir: plain(
        latest_per_key(
            source(spark, sf_dir), [flow.key], newest or NEWEST_FIRST
        )
    )


_register_flow("customers", CUSTOMERS, customers_src, BY_BATCH)
_register_flow("products", PRODUCTS, products_src, BY_BATCH)
_register_flow("orders", ORDERS, orders_src)


def _clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ORDERS.refine(orders_src(spark, sf_dir)).clean


@query("rule_flags")
def rule_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undecided flags stay NULL; combinations of flags are counted."""
    customers = with_rule_flags(
        CUSTOMERS.standardized(customers_src(spark, sf_dir)), customer_rules(), "drop"
    )
    flags = [rule.flag_name for rule in customer_rules()]
    return value_counts(customers, *flags)


@query("rule_flags_products")
def rule_flags_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = with_rule_flags(PRODUCTS.standardized(products_src(spark, sf_dir)), product_rules())
    return flagged.select("product_id", "_batch_id", *[r.flag_name for r in product_rules()])


@query("rule_flags_orders")
def rule_flags_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = with_rule_flags(ORDERS.standardized(orders_src(spark, sf_dir)), order_rules(), "drop")
    return value_counts(flagged, *[r.flag_name for r in order_rules()])


@query("expected_amount")
def expected_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ORDERS.standardized(orders_src(spark, sf_dir)).select(
        *("order_id", "product_id", "quantity", "unit_price", "discount_pct", "tax_amount"),
        *("order_amount", "expected_order_amount"),
    )


# ---- checks and profiles


@query("null_profile")
def orders_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_profile(orders_src(spark, sf_dir))



@query("status_counts")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_counts(ORDERS.standardized(orders_src(spark, sf_dir)), "status")


@query("reject_reason_counts")
def reject_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects_by_reason(ORDERS.refine(orders_src(spark, sf_dir)).rejected)


@query("reject_reason_counts_decided")
def reject_reason_counts_decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects_by_reason(ORDERS.refine(orders_src(spark, sf_dir), "drop").rejected)


@query("duplicate_keys")
def orders_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(orders_src(spark, sf_dir), "order_id")



@query("duplicate_customers")
def duplicate_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(CUSTOMERS.split(customers_src(spark, sf_dir)).valid, "customer_id")


@query("key_uniqueness")
def orders_key_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_uniqueness(orders_src(spark, sf_dir), "order_id", distinct="distinct_order_ids")



@query("remaining_invalid_emails")
def remaining_invalid_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Before and after cleaning; after it there must be none."""
    source = customers_src(spark, sf_dir)
    name = "invalid_emails"
    before = violations(CUSTOMERS.standardized(source), email_rule(), name)
    after = violations(CUSTOMERS.refine(source, newest=BY_BATCH).clean, email_rule(), name)
    return before.select(F.lit("standardized").alias("stage"), name).unionAll(
        after.select(F.lit("silver").alias("stage"), name)
    )


@query("orders_per_day")
def orders_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("order_timestamp").try_cast("date").alias("order_date")
    counts = value_counts(orders_src(spark, sf_dir), day, name="orders")
    return counts.orderBy(F.desc("order_date"))


@query("table_counts")
def given_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("customer", "part", "orders", "lineitem", "events")
    return table_counts({name: table(spark, sf_dir, name) for name in names})



@query("preview_orders")
def preview_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("order_id", "product_id", "_ingested_at", "quantity", "status")
    rows = orders_src(spark, sf_dir).select(*columns)
    return preview(rows, 20, "order_id", "_ingested_at", "product_id", "quantity")


@query("scalar_functions")
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    joined = orders.join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    price = F.col("o_totalprice").cast("decimal(12,2)")
    day = F.to_date("o_orderdate")
    band = F.when(F.col("o_totalprice") > 300000, "high").otherwise(
        F.when(F.col("o_totalprice") > 100000, "middle").otherwise("low")
    )
    # every other value is no number and no date
    mixed = F.when(F.col("o_orderkey") % 2 == 0, F.col("c_name"))
    return joined.select(
        "o_orderkey",
        clean(F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")), "trim").alias("trimmed"),
        clean("c_name", "lower").alias("lowered"),
        clean("o_orderpriority", "upper").alias("uppered"),
        clean("c_mktsegment", "initcap").alias("capitalised"),
        F.length("c_name").alias("name_length"),
        F.concat_ws(
            "-", F.when(F.col("o_orderkey") % 3 != 0, F.col("c_mktsegment")), "o_orderstatus"
        ).alias("joined"),
        F.col("o_orderpriority").rlike("^[12]-").alias("is_urgent"),
        band.alias("band"),
        F.when(F.col("o_orderstatus") == "F", F.lit(1)).alias("one_if_final"),
        F.round(price * F.lit("0.0725").cast("decimal(5,4)"), 2).alias("tax"),
        F.abs(F.col("c_acctbal") - 5000).alias("distance"),
        (F.col("o_totalprice") * 2 + F.col("o_custkey") - 1).alias("arithmetic"),
        ratio(F.col("o_custkey"), F.col("o_orderkey") + 1).alias("share"),
        day.alias("order_date"),
        *[column.alias(name) for name, column in calendar(day, "order").items()],
        F.substring("c_name", 10, 9).cast("long").alias("number_in_name"),
        mixed.otherwise(F.substring("c_name", 10, 9)).try_cast("long").alias("number_if_one"),
        F.try_to_date(mixed.otherwise("1998-01-02")).alias("date_if_one"),
    )


# ---- columns and schemas


@query("order_status_rename")
def order_status_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit(" "), F.lower("o_orderpriority"), F.lit("  "))
    landing = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        padded.alias("order_status"),
        F.col("o_orderstatus").alias("status"),
    )
    return normalise_status(landing)


@query("align_schema")
def align_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = StructType.fromDDL(
        "order_id STRING, quantity BIGINT, unit_price DECIMAL(14,4), not_there STRING"
    )
    orders = ORDERS.standardized(orders_src(spark, sf_dir))
    rows = orders.select("order_id", "product_id", "quantity", "unit_price")
    return align_to_schema(rows, target)


# ---- gold


def _dimensions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    customers = CUSTOMERS.refine(customers_src(spark, sf_dir), newest=BY_BATCH).clean
    products = PRODUCTS.refine(products_src(spark, sf_dir), newest=BY_BATCH).clean
    return dim_customer(customers), dim_product(products)


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_orders(_clean_orders(spark, sf_dir), *_dimensions(spark, sf_dir))


QUERIES["dim_customer"] = lambda spark, sf_dir: plain(_dimensions(spark, sf_dir)[0])
QUERIES["dim_product"] = lambda spark, sf_dir: plain(_dimensions(spark, sf_dir)[1])
QUERIES["fact_orders"] = lambda spark, sf_dir: plain(_fact(spark, sf_dir))
QUERIES["fact_valid"] = lambda spark, sf_dir: plain(split_fact(_fact(spark, sf_dir)).valid)
QUERIES["fact_rejected"] = lambda spark, sf_dir: plain(split_fact(_fact(spark, sf_dir)).rejected)
QUERIES["referential_integrity"] = lambda spark, sf_dir: referential_integrity(
    _fact(spark, sf_dir), DIMENSION_KEYS
)
QUERIES["reconcile_fact"] = lambda spark, sf_dir: reconcile(_fact(spark, sf_dir), fact_rules())


# ---- merges


def _merge_fixture(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    source = orders.filter(F.col("o_orderkey") % 2 == 0)
    return (
        orders.filter(F.col("o_orderkey") % 6 != 0),
        source.withColumn("o_totalprice", F.col("o_totalprice") + 1),
    )


@query("merge_insert_only")
def merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_insert(*_merge_fixture(spark, sf_dir), ["o_orderkey"])


@query("merge_upsert")
def orders_merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_upsert(*_merge_fixture(spark, sf_dir), ["o_orderkey"])



@query("merge_upsert_filtered")
def orders_merge_upsert_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``merge_upsert``, with only those target rows shuffled whose key the batch's bits admit."""
    target, source = _merge_fixture(spark, sf_dir)
    batch = stage(source, "batch")
    bits = key_bits(batch, ["o_orderkey"], batch.count())
    return upsert_likely(target, batch, ["o_orderkey"], bits)


@query("matched_rows_filtered")
def matched_rows_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders in a batch, by a key of two columns: bits first, then the join."""
    keys = ["l_orderkey", "l_linenumber"]
    lines = table(spark, sf_dir, "lineitem")
    batch = stage(lines.filter("l_orderkey % 10 = 3").select(*keys).distinct(), "batch")
    bits = key_bits(batch, keys, batch.count())
    return join_keys(likely(lines, bits, keys), batch, keys, "left_semi").select(*keys, "l_quantity")


@query("table_changes")
def table_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders inserted, updated and gone between two states."""
    before, source = _merge_fixture(spark, sf_dir)
    after = merge_upsert(before, source, ["o_orderkey"]).filter("o_orderkey % 7 != 0")
    found = changes(before, after, ["o_orderkey"])
    price = {f"{side}_price": F.col(side)["o_totalprice"] for side in ("old", "new")}
    return found.select("o_orderkey", "change", *[c.alias(name) for name, c in price.items()])


@query("load_audit")
def orders_load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, source = _merge_fixture(spark, sf_dir)
    return load_audit(before, merge_upsert(before, source, ["o_orderkey"]), ["o_orderkey"])



# ---- files and tables: written to shared scratch space and read back


@query("ingest_parquet")
def ingest_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = IngestConfig(
        f"{sf_dir}/customer.parquet", "customers", "customer", "CRM", BATCH, source_format="parquet"
    )
    return landed(spark, config).drop("_source_file", "_source_file_modified_at", "_ingested_at")


LINEAGE_DROPPED = ("_source_file", "_source_file_name", "_source_file_modified_at", "_ingested_at")


@query("ingest_csv")
def ingest_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "landing")
    landing = table(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "order_status")
    landing.write.option("header", True).csv(folder)
    target = f"{new_database(spark)}.orders"
    return ingest(spark, IngestConfig(folder, target, "orders", "ERP", BATCH)).drop(*LINEAGE_DROPPED)


@query("ingest_json")
def ingest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "landing")
    part = table(spark, sf_dir, "part")
    part.write.json(folder)
    target = f"{new_database(spark)}.products"
    config = IngestConfig(
        folder, target, "products", "PIM", BATCH, source_format="json", schema=part.schema
    )
    return ingest(spark, config).drop(*LINEAGE_DROPPED)


@query("lineage_counts")
def lineage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = [("customer", "CRM"), ("part", "PIM")]
    lineage = ["_source_name", "_source_system", "_batch_id"]
    first, second = (
        landed(
            spark,
            IngestConfig(
                f"{sf_dir}/{name}.parquet", name, name, system, BATCH, source_format="parquet"
            ),
        ).select(*lineage)
        for name, system in sources
    )
    return value_counts(first.unionAll(second), *lineage, name="record_count")


@query("table_overwrite")
def table_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced by what is computed from itself, with another schema."""
    name = f"{new_database(spark)}.customers"
    save_table(table(spark, sf_dir, "customer"), name)
    longer = spark.table(name).select(
        F.col("c_custkey").cast("string").alias("c_custkey"), F.length("c_name").alias("name_length")
    )
    save_table(longer, name)
    return spark.table(name)


@query("table_overwrite_same_schema")
def table_overwrite_same_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows replaced under a schema that is held, given in another order of columns."""
    name = f"{new_database(spark)}.customers"
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    save_table(customers, name)
    save_table(customers.filter("c_custkey % 2 = 0").select("c_name", "c_custkey"), name, replace_schema=False)
    return spark.table(name)


@query("catalog_columns")
def catalog_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables made from two of the given ones, listed, with their columns and types."""
    database = new_database(spark)
    for name in ("customer", "part"):
        save_table(table(spark, sf_dir, name), f"{database}.{name}")
    described = [
        describe(spark, f"{database}.{name}").select(F.lit(name).alias("table_name"), "col_name", "data_type")
        for name in list_tables(spark, database)
    ]
    return described[0].unionAll(described[1])


@query("processing_stamps")
def processing_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of a result carry one time, and none is without."""
    rows = CUSTOMERS.refine(customers_src(spark, sf_dir), newest=BY_BATCH).clean
    stamp = F.col("_silver_processed_at")
    return rows.agg(
        F.count("*").alias("total_rows"), F.count(stamp).alias("stamped_rows"), F.count_distinct(stamp).alias("times")
    )


@query("ingest_append")
def ingest_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second batch, of another format and with ids as text, onto a table that exists."""
    first, second = new_folder(spark, "landing"), new_folder(spark, "landing")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    part.filter("p_partkey % 2 = 0").write.parquet(first)
    as_text = F.col("p_partkey").cast("string").alias("p_partkey")
    part.filter("p_partkey % 2 = 1").select(as_text, "p_name", F.lit("new").alias("origin")).write.json(second)
    target = f"{new_database(spark)}.products"
    ingest(spark, IngestConfig(first, target, "products", "PIM", BATCH, source_format="parquet"))
    later = IngestConfig(second, target, "products", "PIM", "batch-8", "append", "json")
    return ingest(spark, later).drop(*LINEAGE_DROPPED, "_source_name", "_source_system")


@query("ingest_new_files")
def ingest_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder that grows, ingested three times: the second time reads the new files, the third none."""
    folder, checkpoint = new_folder(spark, "landing"), new_folder(spark, "checkpoint")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    target = f"{new_database(spark)}.products"
    config = IngestConfig(folder, target, "products", "PIM", BATCH, source_format="json", schema=part.schema)
    for rest in (0, 1):
        part.filter(F.col("p_partkey") % 2 == rest).write.mode("append").json(folder)
        ingest_new(spark, config, checkpoint)
    return ingest_new(spark, config, checkpoint).drop(*LINEAGE_DROPPED)


@query("ingest_unreadable")
def ingest_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of which some have no number or end too early: what was read, and what was not."""
    folder = new_folder(spark, "landing")
    key, size = F.col("p_partkey"), F.col("p_size")
    begin = F.concat(F.lit('{"p_partkey": '), key)
    wrong = F.concat(begin, F.lit(', "p_size": "x'), size, F.lit('"}'))
    sound = F.concat(begin, F.lit(', "p_size": '), size, F.lit("}"))
    line = F.when(key % 40 == 0, wrong).when(key % 41 == 0, begin).otherwise(sound)
    table(spark, sf_dir, "part").select(line.alias("value")).write.text(folder)
    database = new_database(spark)
    config = IngestConfig(
        *(folder, f"{database}.parts", "parts", "PIM", BATCH),
        source_format="json", schema="p_partkey BIGINT, p_size INT", unreadable_table=f"{database}.unreadable",
    )
    read = ingest(spark, config).withColumn("text", F.lit(None).cast("string"))
    torn = spark.table(f"{database}.unreadable").withColumnRenamed(UNREADABLE, "text")
    return read.unionByName(torn).select("p_partkey", "p_size", "text", "_source_name")


@query("table_published")
def table_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three versions behind one view: other columns, and partitions, computed from the one before."""
    name = f"{new_database(spark)}.customers"
    publish(table(spark, sf_dir, "customer"), name)
    shorter = spark.table(name).select("c_custkey", "c_nationkey", F.length("c_name").alias("name_length"))
    publish(shorter, name)
    publish(spark.table(name).filter("c_custkey % 3 != 0"), name, ["c_nationkey"])
    expire_published(spark, name, keep=0)
    return spark.table(name)


@query("export_partitioned")
def export_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "export")
    export_parquet(_dimensions(spark, sf_dir)[1], folder, ["category"])
    return spark.read.parquet(folder)


@query("load_history")
def load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored audit of a table's creation, merges, append and overwrite."""
    database = new_database(spark)
    name, audit = f"{database}.orders", f"{database}.load_audit"
    target, source = _merge_fixture(spark, sf_dir)
    for batch, how in ((target, "upsert"), (source, "insert"), (source, "upsert")):
        create_or_merge(batch, name, ["o_orderkey"], how, audit_table=audit)
    save_table(source.filter("o_orderkey % 10 = 0"), name, mode="append", audit_table=audit)
    save_table(source, name, audit_table=audit)
    return spark.table(audit).drop("table_name", "loaded_at")


@query("table_append_evolve")
def table_append_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, of which the second brings a new column."""
    name = f"{new_database(spark)}.customers"
    customers = table(spark, sf_dir, "customer")
    first = F.col("c_nationkey") < 13
    save_table(customers.filter(first).select("c_custkey", "c_name"), name)
    later = customers.filter(~first)
    # names are the same column in any case
    later = later.select("c_acctbal", F.col("c_custkey").alias("C_CustKey"), "c_name")
    save_table(later, name, mode="append")
    return spark.table(name)


@query("export_parquet")
def product_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "export")
    export_parquet(_dimensions(spark, sf_dir)[1], folder)
    return spark.read.parquet(folder)



def _merged_table(
    spark: SparkSession, sf_dir: str, how: str, partition_by: list[str] | None = None
) -> DataFrame:
    """The merge fixture, merged twice into a table; the second time changes nothing."""
    name = f"{new_database(spark)}.orders"
    target, source = _merge_fixture(spark, sf_dir)
    create_or_merge(target, name, ["o_orderkey"], partition_by=partition_by)
    for _ in range(2):
        create_or_merge(source, name, ["o_orderkey"], how)
    return spark.table(name)


@query("table_merge_upsert")
def table_merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged_table(spark, sf_dir, "upsert")


@query("table_merge_upsert_partitioned")
def table_merge_upsert_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged_table(spark, sf_dir, "upsert", ["o_orderpriority"])


@query("table_merge_insert")
def table_merge_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged_table(spark, sf_dir, "insert")


@query("table_merge_two_partition_columns")
def table_merge_two_partition_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch with a new column, into partitions that the table has and others."""
    name = f"{new_database(spark)}.orders"
    target, source = _merge_fixture(spark, sf_dir)
    known = target.filter(F.col("o_orderstatus") != "P")
    create_or_merge(known, name, ["o_orderkey"], partition_by=["o_orderstatus", "o_orderpriority"])
    create_or_merge(source.withColumn("note", F.lit("late")), name, ["o_orderkey"])
    return spark.table(name)


def _run_twice(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Two runs over the same bronze, some of whose orders lack an id and events a date."""
    config, _ = _bronze(spark, sf_dir)
    orders, clicks = (spark.table(f"{config.bronze}.{name}") for name in ("orders", "click_events"))
    id_or_none = F.when(F.col("order_id") % 1000 != 1, F.col("order_id"))
    save_table(orders.withColumn("order_id", id_or_none), f"{config.bronze}.orders")
    day_or_none = F.when(F.col("event_id") % 37 != 0, F.col("business_date"))
    save_table(clicks.withColumn("business_date", day_or_none), f"{config.bronze}.click_events")
    run_pipeline(spark, config)
    return run_pipeline(spark, config)


@query("run_pipeline_twice_fact")
def run_pipeline_twice_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_twice(spark, sf_dir)["fact_orders"]


@query("run_pipeline_twice_engagement")
def run_pipeline_twice_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_twice(spark, sf_dir)["daily_customer_engagement"]


@query("run_pipeline_increment")
def run_pipeline_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of a first part, then a second part by what it changes: the fact over both.

    In between customers come that orders of the first part were waiting for.
    """
    config, _ = _bronze(spark, sf_dir)
    names = {name: f"{config.bronze}.{name}" for name in ("orders", "customers")}
    orders, customers = (stage(spark.table(name)) for name in names.values())
    early = F.col("order_id") % 3 != 0
    save_table(orders.filter(early), names["orders"])
    save_table(customers.filter("customer_id IS NULL OR customer_id % 4 != 0"), names["customers"])
    run_pipeline(spark, config)
    later = {"_ingested_at": F.col("_ingested_at") + F.expr("INTERVAL 100 YEARS")}
    save_table(orders.filter(~early).withColumns(later), names["orders"], mode="append")
    save_table(customers, names["customers"])
    bounded = replace(config, only_changes=True, bronze_since="2050-01-01")
    return run_pipeline(spark, bounded)["fact_orders"]


def _bronze(spark: SparkSession, sf_dir: str) -> tuple[PipelineConfig, str]:
    """Bronze tables from the given ones, and the folder that the events came from."""
    database = new_database(spark)
    # batches of customers and products as times of ingest
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("_batch_id")).cast("timestamp")
    times = {"_ingested_at": day, "_source_file_modified_at": day}
    for name, source in (("customers", customers_src), ("products", products_src)):
        save_table(source(spark, sf_dir).withColumns(times), f"{database}.{name}")
    save_table(orders_src(spark, sf_dir), f"{database}.orders")
    folder = new_folder(spark, "pages")
    click_pages(spark, sf_dir).write.option("maxRecordsPerFile", 1).json(folder)
    ingest_clicks(spark, folder, f"{database}.click_events", PAGE_SCHEMA)
    silver, gold = new_database(spark), new_database(spark)
    return PipelineConfig(bronze=database, silver=silver, gold=gold), folder


def _run(spark: SparkSession, sf_dir: str) -> tuple[PipelineConfig, dict[str, DataFrame]]:
    """Bronze tables from the given ones, then silver and gold."""
    config, _ = _bronze(spark, sf_dir)
    return config, run_pipeline(spark, config)


@query("run_pipeline_fact")
def run_pipeline_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir)[1]["fact_orders"]


@query("run_pipeline_engagement")
def run_pipeline_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir)[1]["daily_customer_engagement"]


@query("run_pipeline_checks")
def run_pipeline_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    config, _ = _run(spark, sf_dir)
    return run_checks(spark, config)


@query("run_pipeline_observed")
def run_pipeline_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of a run, counted while it wrote."""
    config, _ = _bronze(spark, sf_dir)
    observed = Observed()
    run_pipeline(spark, config, observed=observed)
    return observed.frame(spark)


@query("split_observed")
def split_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source, valid and rejected orders, counted while both sides were written."""
    observed = Observed()
    orders = ORDERS.refine(orders_src(spark, sf_dir), seen=observed.split("orders"))
    stage(orders.clean, "clean")
    stage(observed.stored(orders.rejected, "orders"), "rejected")
    return observed.counts(spark)

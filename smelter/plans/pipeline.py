"""All of silver and gold in order of dependency."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.config import PipelineConfig
from smelter.operators.merge import join_keys, most_broadcast, with_match
from smelter.plans.checks import Observed
from smelter.plans.clicks import daily_engagement, silver_clicks
from smelter.plans.customers import CUSTOMERS, dim_customer, email_rule
from smelter.plans.flow import Flow, Silver
from smelter.plans.orders import DIMENSION_KEYS, fact_orders, order_flow, split_fact
from smelter.plans.products import PRODUCTS, dim_product
from smelter.scratch import by_rows
from smelter.sinks.tables import create_or_merge, export_parquet, save_table
from smelter.sources.catalog import table_exists

# Columns that differ between runs over the same rows
STAMPS = ("_silver_processed_at", "_gold_processed_at")
GOLD_TABLES = ("dim_customer", "dim_product", "fact_orders", "daily_customer_engagement")


def run_pipeline(
    spark: SparkSession,
    config: PipelineConfig | None = None,
    run_at: datetime | None = None,
    observed: Observed | None = None,
) -> dict[str, DataFrame]:
    """Bring silver and gold up to date with bronze; returns the gold tables.

    Customers, products and all rejects are replaced, everything else is merged. All
    rows written carry the same time. Bronze is loaded apart, by ``ingest``. ``observed``
    checks rows while they are written.
    """
    watch = observed or Observed()
    config = config or PipelineConfig()
    at = F.lit(run_at or datetime.now(timezone.utc))
    layers = {"bronze": config.bronze, "silver": config.silver, "gold": config.gold}

    def table(layer: str, name: str) -> DataFrame:
        return spark.table(f"{layers[layer]}.{name}")

    def looked_up(name: str, on: str, key: str) -> DataFrame:
        """What a lookup needs of a dimension; more rows than the driver can take are not broadcast."""
        return by_rows(table("gold", name).select(on, key), limit=most_broadcast(spark))

    def replace(df: DataFrame, layer: str, name: str) -> None:
        save_table(df, f"{layers[layer]}.{name}", audit_table=config.audit_table)

    def merge(
        df: DataFrame, layer: str, name: str, key: str, null_keys: str = config.null_keys
    ) -> DataFrame:
        """All batches hold each key once: they are the latest rows or groups of it."""
        columns = config.partitions.get(f"{layer}.{name}") or ()
        return create_or_merge(
            df,
            f"{layers[layer]}.{name}",
            [key],
            null_keys=null_keys,
            partition_by=[columns] if isinstance(columns, str) else list(columns) or None,
            buckets=config.buckets.get(f"{layer}.{name}"),
            audit_table=config.audit_table,
            check_unique=False,
            skip_same=STAMPS if config.only_changes else None,
        )

    def recent(name: str, time: str) -> DataFrame:
        rows = table("bronze", name)
        if config.bronze_since is None:
            return rows
        return rows.filter(F.col(time) >= F.lit(config.bronze_since).cast("timestamp"))

    def refined(flow: Flow, bronze: DataFrame, name: str) -> Silver:
        return flow.refine(bronze, config.null_policy, at=at, seen=watch.split(name))

    customers = refined(CUSTOMERS, table("bronze", "customers"), "customers")
    invalid = ~email_rule().holds
    clean = watch.faults(customers.clean, "silver.customers", invalid_emails=invalid)
    replace(clean, "silver", "customers")
    replace(watch.stored(customers.rejected, "customers"), "silver", "customer_rejected")

    products = refined(PRODUCTS, table("bronze", "products"), "products")
    replace(products.clean, "silver", "products")
    if config.store_product_rejects:
        replace(watch.stored(products.rejected, "products"), "silver", "product_rejected")

    orders = refined(
        order_flow(config.require_order_id), recent("orders", "_ingested_at"), "orders"
    )
    first_run = not table_exists(spark, f"{layers['gold']}.fact_orders")
    changed_orders = merge(orders.clean, "silver", "orders", "order_id")
    replace(watch.stored(orders.rejected, "orders"), "silver", "order_rejected")

    clicks = silver_clicks(recent("click_events", "_bronze_ingested_at"), at=at)
    merge(clicks, "silver", "click_events", "event_id")

    customers = merge(
        dim_customer(table("silver", "customers"), at), "gold", "dim_customer", "customer_id"
    )
    products = merge(
        dim_product(table("silver", "products"), at), "gold", "dim_product", "product_id"
    )

    partly = config.only_changes and not first_run
    due = table("silver", "orders")
    if partly:
        # Changed orders, which the merge has just put in the table, and those whose customer or
        # product has come or changed since: one look at the table finds these for both
        touched = with_match(due, customers, "customer_id", "_of_customer")
        touched = with_match(touched, products, "product_id", "_of_product")
        touched = touched.filter("_of_customer OR _of_product").select(*due.columns)
        others = join_keys(touched, changed_orders, ["order_id"], "left_anti")
        due = changed_orders.filter(F.col("order_id").isNotNull()).unionByName(others)
    facts = fact_orders(
        due,
        looked_up("dim_customer", "customer_id", "customer_key"),
        looked_up("dim_product", "product_id", "product_key"),
        at,
    )
    orphaned = {check: F.col(key).isNull() for check, key in DIMENSION_KEYS.items()}
    facts = watch.faults(facts, "gold.fact_orders", **orphaned)
    batch = merge(facts, "gold", "fact_orders", "order_id")
    orphans = table("gold", "fact_orders") if partly else batch
    replace(split_fact(orphans, at).rejected, "gold", "fact_order_rejected")

    merge(
        daily_engagement(table("silver", "click_events"), since=config.engagement_since, at=at),
        "gold",
        "daily_customer_engagement",
        "business_date",
        # Events without a date are one group, which a later run replaces
        null_keys="match",
    )

    if config.export_root:
        for name in GOLD_TABLES:
            column = config.export_partitions.get(name)
            export_parquet(
                table("gold", name),
                f"{config.export_root.rstrip('/')}/{name}",
                [column] if column else (),
            )
    return {name: table("gold", name) for name in GOLD_TABLES}

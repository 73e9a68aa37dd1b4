"""Checks of a finished run: what should be 0, counted."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from smelter.config import PipelineConfig
from smelter.functions.numbers import count_where
from smelter.operators.quality import (
    dq_summary,
    duplicate_keys,
    reconcile,
    referential_integrity,
    rejects_by_reason,
    violations,
)
from smelter.plans.clicks import SUMMARY
from smelter.plans.customers import CUSTOMERS, email_rule
from smelter.plans.orders import DIMENSION_KEYS, order_flow
from smelter.plans.products import PRODUCTS

# Tables that hold each key once: layer, table, key
UNIQUE = (
    ("silver", "customers", "customer_id"),
    ("silver", "products", "product_id"),
    ("silver", "orders", "order_id"),
    ("silver", "click_events", "event_id"),
    ("gold", "dim_customer", "customer_key"),
    ("gold", "dim_product", "product_key"),
    ("gold", "fact_orders", "order_id"),
)


# Tables of what was rejected
REJECTS = {
    "customers": "customer_rejected",
    "products": "product_rejected",
    "orders": "order_rejected",
}


CHECK = "check_name string, table_name string, faults long, passed boolean"
COUNTS = "table_name string, source_rows long, valid_rows long, rejected_rows long, reconciled boolean"


def _figures(seen: Observation) -> dict[str, int]:
    """What was observed: nothing where Spark knew that there are no rows, and ran no task."""
    return seen.get if seen._jo.getRow().length() else {}


class Observed:
    """Checks that a run makes while it writes: nothing is read again for them.

    Given to ``run_pipeline``, it watches the rows that the run splits and writes. ``frame`` has the
    rows of ``run_checks`` on lost rows, invalid emails and facts without a dimension row, of what this
    run wrote; with ``only_changes`` or ``bronze_since`` that is a part of the tables.
    """

    def __init__(self):
        self._split: dict[str, Observation] = {}
        self._stored: dict[str, Observation] = {}
        self._faults: list[tuple[str, list[str], Observation]] = []

    def split(self, name: str) -> Observation:
        """For ``refine`` of a flow: its source, valid and rejected rows."""
        self._split[name] = Observation()
        return self._split[name]

    def stored(self, rejected: DataFrame, name: str) -> DataFrame:
        """``rejected``, counted as it is written."""
        self._stored[name] = Observation()
        return rejected.observe(self._stored[name], F.count(F.lit(1)).alias("rows"))

    def faults(self, df: DataFrame, table: str, **faults: Column) -> DataFrame:
        """``df``, with rows that meet a condition counted under its name as it is written."""
        seen = Observation()
        self._faults.append((table, list(faults), seen))
        return df.observe(seen, *[count_where(c).alias(name) for name, c in faults.items()])

    def _sides(self) -> list[tuple[str, int, int, int]]:
        """(table, source rows, valid rows, rejected rows); those stored, where they were watched."""
        found = []
        for name, seen in self._split.items():
            counts = _figures(seen)
            rejected = counts.get("rejected_rows", 0)
            if name in self._stored:
                rejected = _figures(self._stored[name]).get("rows", 0)
            sides = counts.get("source_rows", 0), counts.get("valid_rows", 0), rejected
            found.append((f"bronze.{name}", *sides))
        return found

    def counts(self, spark: SparkSession) -> DataFrame:
        """As ``reconcile``, a row for each split; for when all has been written."""
        rows = [(*row, row[1] == row[2] + row[3]) for row in self._sides()]
        return spark.createDataFrame(rows, COUNTS)

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row for each check, few in all; for when all has been written."""
        found = [("lost_rows", name, all_of - valid - bad) for name, all_of, valid, bad in self._sides()]
        for table, checks, seen in self._faults:
            found += [(check, table, _figures(seen).get(check, 0)) for check in checks]
        return spark.createDataFrame([(*row, row[2] == 0) for row in found], CHECK)


def run_summary(spark: SparkSession, config: PipelineConfig | None = None) -> dict[str, DataFrame]:
    """What a run stored, for reading: silver events in figures, and rejects by table and reason."""
    config = config or PipelineConfig()
    events = dq_summary(spark.table(f"{config.silver}.click_events"), "event_id", SUMMARY)
    stored = [n for n in REJECTS if n != "products" or config.store_product_rejects]
    reasons = [
        rejects_by_reason(spark.table(f"{config.silver}.{REJECTS[n]}")).select(
            F.lit(n).alias("source"), "reject_reason", "count"
        )
        for n in stored
    ]
    return {"events": events, "rejects": reduce(DataFrame.unionAll, reasons)}


def run_checks(spark: SparkSession, config: PipelineConfig | None = None) -> DataFrame:
    """One row per check: its name, the table, the rows or keys at fault, and if it passed.

    Covers bronze rows that are neither valid nor among the stored rejects, keys held
    twice, emails that are still invalid, and facts without a dimension row. Each check reads
    only the columns it is about, in one aggregation. Rejects are those of the last run, so
    bronze must be as that run found it.
    """
    config = config or PipelineConfig()
    layers = {"bronze": config.bronze, "silver": config.silver, "gold": config.gold}

    def table(layer: str, name: str) -> DataFrame:
        return spark.table(f"{layers[layer]}.{name}")

    def labelled(df: DataFrame, check: str, name: str, column: str) -> DataFrame:
        return df.select(
            F.lit(check).alias("check_name"),
            F.lit(name).alias("table_name"),
            F.col(column).cast("long").alias("faults"),
        )

    found = []
    flows = {
        "customers": CUSTOMERS,
        "products": PRODUCTS,
        "orders": order_flow(config.require_order_id),
    }
    for name, flow in flows.items():
        sides = reconcile(
            flow.standardized(table("bronze", name)), flow.rules(), config.null_policy
        )
        rejected = F.col("rejected_rows")
        if name in REJECTS and (name != "products" or config.store_product_rejects):
            # What was stored, counted from the footers of its files
            rejected = F.lit(table("silver", REJECTS[name]).count())
        lost = F.col("source_rows") - F.col("valid_rows") - rejected
        found.append(labelled(sides.withColumn("lost", lost), "lost_rows", f"bronze.{name}", "lost"))
    for layer, name, key in UNIQUE:
        twice = duplicate_keys(table(layer, name), key).agg(F.count("*").alias("keys"))
        found.append(labelled(twice, "duplicate_keys", f"{layer}.{name}", "keys"))
    emails = violations(table("silver", "customers"), email_rule())
    found.append(labelled(emails, "invalid_emails", "silver.customers", "violations"))
    orphans = referential_integrity(table("gold", "fact_orders"), DIMENSION_KEYS)
    # One row becomes one for each key, so that the fact is read once
    each = orphans.unpivot([], list(DIMENSION_KEYS), "check_name", "faults")
    found.append(
        each.select(
            "check_name", F.lit("gold.fact_orders").alias("table_name"), F.col("faults").cast("long")
        )
    )
    return reduce(DataFrame.unionAll, found).withColumn("passed", F.col("faults") == 0)

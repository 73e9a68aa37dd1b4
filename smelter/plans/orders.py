"""Orders: silver flow, fact table and its referential integrity."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.constants import (
    AMOUNT_TOLERANCE,
    FRACTION,
    MONEY,
    ORDER_STATUSES,
    WIDE_FRACTION,
    WIDE_MONEY,
)
from smelter.functions.dates import calendar
from smelter.functions.numbers import expected_amount, fraction, money, whole
from smelter.operators.lookup import lookup_key
from smelter.operators.quality import Split, split
from smelter.operators.rules import Rule, above, between, one_of, required, within
from smelter.plans.flow import Flow, now


def order_rules(require_order_id: bool = False) -> list[Rule]:
    """Comparisons with NULL are undecided here, see ``null_policy``."""
    rules = [
        required("customer_id", "customer_id", "Missing Customer ID"),
        required("product_id", "product_id", "Missing Product ID"),
        required("order_timestamp", "order_timestamp", "Missing Order Timestamp"),
        above("quantity", "quantity", 0, "Invalid Quantity", guarded=False),
        above("unit_price", "unit_price", 0, "Invalid Unit Price", guarded=False),
        between("discount", "discount_pct", 0, 1, "Invalid Discount"),
        one_of("status", "status", ORDER_STATUSES, "Invalid Status"),
        within(
            "amount",
            "order_amount",
            "expected_order_amount",
            AMOUNT_TOLERANCE,
            "Order Amount Mismatch",
        ),
    ]
    identified = required("order_id", "order_id", "Missing Order ID")
    return [identified, *rules] if require_order_id else rules


def order_values() -> dict[str, Column]:
    """Ids, times and exact decimals.

    What cannot be read is NULL and fails its rule. Amounts keep six decimals until gold.
    """
    amounts = ("unit_price", "tax_amount", "order_amount")
    return {
        **{name: whole(name, "long") for name in ("customer_id", "product_id")},
        "order_timestamp": F.col("order_timestamp").try_cast("timestamp"),
        **{name: money(name, WIDE_MONEY) for name in amounts},
        "discount_pct": fraction("discount_pct", WIDE_FRACTION),
        "quantity": whole("quantity"),
    }


def order_amounts() -> dict[str, Column]:
    """The amount an order should have, from the values read."""
    parts = [F.col(c) for c in ("quantity", "unit_price", "discount_pct", "tax_amount")]
    return {"expected_order_amount": expected_amount(*parts)}


def order_flow(require_order_id: bool = False) -> Flow:
    return Flow(
        key="order_id",
        text={"status": ("trim", "upper")},
        derive=order_values,
        combine=order_amounts,
        rules=partial(order_rules, require_order_id),
        helpers=("expected_order_amount",),
    )


ORDERS = order_flow()

DIMENSION_KEYS = {
    "missing_customer_keys": "customer_key",
    "missing_product_keys": "product_key",
}


def fact_orders(
    orders: DataFrame, customers: DataFrame, products: DataFrame, at: Column | None = None
) -> DataFrame:
    """One row per order, also of orders whose customer or product is unknown."""
    keyed = lookup_key(orders, customers, "customer_id", "customer_key")
    keyed = lookup_key(keyed, products, "product_id", "product_key")
    typed = keyed.select(
        F.col("order_id").try_cast("long").alias("order_id"),
        *("customer_key", "product_key", "order_timestamp"),
        F.col("order_timestamp").try_cast("date").alias("order_date"),
        "quantity",
        *[
            F.col(name).try_cast(kind).alias(name)
            for name, kind in (
                ("unit_price", MONEY),
                ("discount_pct", FRACTION),
                ("tax_amount", MONEY),
                ("order_amount", MONEY),
            )
        ],
        F.col("status").alias("order_status"),
        (now() if at is None else at).alias("_gold_processed_at"),
    )
    return typed.withColumns(calendar(F.col("order_date"), "order"))


def fact_rules() -> list[Rule]:
    return [
        required("customer_key", "customer_key", "Missing Customer Dimension Key"),
        required("product_key", "product_key", "Missing Product Dimension Key"),
    ]


def split_fact(fact: DataFrame, at: Column | None = None) -> Split:
    """Facts with both keys, and facts lacking one with the reason and time."""
    valid, rejected = split(fact, fact_rules())
    return Split(valid, rejected.withColumn("_rejected_at", now() if at is None else at))

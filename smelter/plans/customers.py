"""Customers: silver flow and dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.constants import CUSTOMER_STATUSES, EMAIL_PATTERN, PROVINCES
from smelter.operators.rules import Rule, matches, missing, one_of, required
from smelter.operators.shape import dimension_key
from smelter.plans.flow import Flow, now


def email_rule() -> Rule:
    cause = F.when(missing("email"), "Missing Email").otherwise("Invalid Email")
    return matches("email", "email", EMAIL_PATTERN, cause)


def customer_rules() -> list[Rule]:
    return [
        required("customer_id", "customer_id", "Missing Customer ID"),
        email_rule(),
        one_of("province", "province", PROVINCES, "Invalid Province"),
        one_of("status", "status", CUSTOMER_STATUSES, "Invalid Status"),
    ]


CUSTOMERS = Flow(
    key="customer_id",
    text={
        "first_name": ("trim",),
        "last_name": ("trim",),
        "email": ("trim", "lower"),
        "city": ("trim", "initcap"),
        "province": ("trim", "upper"),
        "status": ("trim", "upper"),
    },
    rules=customer_rules,
)


def dim_customer(customers: DataFrame, at: Column | None = None) -> DataFrame:
    """One row per customer; a missing part of the name leaves no blank behind."""
    return customers.select(
        *dimension_key("customer_id", "customer_key"),
        "first_name",
        "last_name",
        F.concat_ws(" ", "first_name", "last_name").alias("customer_name"),
        *("email", "city", "province", "signup_date", "status"),
        (now() if at is None else at).alias("_gold_processed_at"),
    )

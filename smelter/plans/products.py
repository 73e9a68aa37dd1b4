"""Products: silver flow and dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.constants import MONEY, PRODUCT_CATEGORIES, PRODUCT_STATUSES
from smelter.functions.numbers import money
from smelter.operators.rules import Rule, above, non_empty, one_of
from smelter.operators.shape import dimension_key
from smelter.plans.flow import Flow, now


def product_rules() -> list[Rule]:
    return [
        above("product_id", "product_id", 0, "Invalid Product ID"),
        non_empty("product_name", "product_name", "Missing Product Name"),
        one_of("category", "category", PRODUCT_CATEGORIES, "Invalid Category"),
        above("price", "price", 0, "Invalid Price"),
        one_of("status", "status", PRODUCT_STATUSES, "Invalid Status"),
    ]


PRODUCTS = Flow(
    key="product_id",
    text={
        "product_name": ("trim",),
        "category": ("trim", "upper"),
        "status": ("trim", "upper"),
    },
    derive=lambda: {"price": money("price")},
    rules=product_rules,
)


def dim_product(products: DataFrame, at: Column | None = None) -> DataFrame:
    return products.select(
        *dimension_key("product_id", "product_key"),
        *("product_name", "category"),
        F.col("price").cast(MONEY).alias("current_price"),
        "status",
        (now() if at is None else at).alias("_gold_processed_at"),
    )

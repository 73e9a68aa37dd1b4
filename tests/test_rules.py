from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from smelter.functions.numbers import whole
from smelter.operators.quality import (
    MASK,
    dq_summary,
    duplicate_keys,
    key_uniqueness,
    marked,
    mask_flags,
    mask_reason,
    null_profile,
    reconcile,
    reject_reason,
    split,
    split_marked,
    violations,
    with_rule_flags,
)
from smelter.operators.rules import Rule, above, between, compare, non_empty, one_of, required
from smelter.plans.customers import CUSTOMERS, customer_rules, email_rule
from smelter.plans.orders import ORDERS, order_flow
from smelter.plans.products import PRODUCTS

CUSTOMER = dict(
    customer_id=1,
    first_name=" Ann ",
    last_name="B",
    email=" Ann@X.com ",
    city=" quebec city",
    province=" on ",
    status="active",
)
CUSTOMER_DDL = (
    "customer_id bigint, first_name string, last_name string, email string, city string,"
    " province string, status string"
)


def customers(spark, *changes):
    return spark.createDataFrame([{**CUSTOMER, **c} for c in changes], CUSTOMER_DDL)


ORDER = dict(
    order_id=1,
    customer_id=1,
    product_id=1,
    order_timestamp="2024-01-01 10:00:00",
    quantity=1,
    unit_price="10.00",
    discount_pct="0.1",
    tax_amount="0.50",
    order_amount="9.50",
    status=" pending ",
)
ORDER_DDL = (
    "order_id bigint, customer_id bigint, product_id bigint, order_timestamp string, quantity int,"
    " unit_price string, discount_pct string, tax_amount string, order_amount string, status string"
)


def orders(spark, *changes):
    return spark.createDataFrame([{**ORDER, **c} for c in changes], ORDER_DDL)


def test_standardized_customer(spark):
    row = CUSTOMERS.standardized(customers(spark, {})).first()
    assert (row.first_name, row.email, row.city, row.province, row.status) == (
        "Ann",
        "ann@x.com",
        "Quebec City",
        "ON",
        "ACTIVE",
    )


@pytest.mark.parametrize(
    ("province", "drop", "reject"),
    [(None, "lost", "rejected"), ("ZZ", "rejected", "rejected"), (" on ", "valid", "valid")],
)
def test_undecided_rows(spark, province, drop, reject):
    rows = customers(spark, {"province": province})
    for policy, side in (("drop", drop), ("reject", reject)):
        valid, rejected = CUSTOMERS.split(rows, policy)
        where = "valid" if valid.count() else "rejected" if rejected.count() else "lost"
        assert where == side


@pytest.mark.parametrize(
    ("change", "reason"),
    [
        ({"email": None, "status": "x"}, "Missing Email; Invalid Status"),
        ({"email": "a@b"}, "Invalid Email"),
        ({"customer_id": None, "province": "zz"}, "Missing Customer ID; Invalid Province"),
        ({}, ""),
    ],
)
def test_customer_reason(spark, change, reason):
    std = CUSTOMERS.standardized(customers(spark, change))
    for policy in ("reject", "drop"):
        assert std.select(reject_reason(customer_rules(), policy)).first()[0] == reason


def test_reason_of_an_undecided_rule(spark):
    std = CUSTOMERS.standardized(customers(spark, {"province": None, "status": "x"}))
    assert CUSTOMERS.split(std, "reject").rejected.first().reject_reason == (
        "Invalid Province; Invalid Status"
    )
    assert CUSTOMERS.split(std, "drop").rejected.first().reject_reason == "Invalid Status"


def test_unknown_policy(spark):
    with pytest.raises(ValueError, match="null_policy"):
        CUSTOMERS.split(customers(spark, {}), "keep")


@pytest.mark.parametrize(
    ("change", "reason"),
    [
        ({}, None),
        ({"order_amount": "9.51"}, None),
        ({"order_amount": "9.52"}, "Order Amount Mismatch"),
        ({"quantity": 0, "order_amount": "0.50"}, "Invalid Quantity"),
        ({"unit_price": "n/a"}, "Invalid Unit Price; Order Amount Mismatch"),
        ({"discount_pct": "1.5", "order_amount": "-4.50"}, "Invalid Discount"),
        ({"status": "shipped"}, "Invalid Status"),
        ({"customer_id": None, "product_id": None}, "Missing Customer ID; Missing Product ID"),
        ({"order_timestamp": None}, "Missing Order Timestamp"),
        ({"order_id": None}, None),
    ],
)
def test_order_reason(spark, change, reason):
    valid, rejected = ORDERS.split(orders(spark, change))
    found = [r.reject_reason for r in rejected.collect()]
    assert found == ([] if reason is None else [reason])
    assert valid.count() == (1 if reason is None else 0)


def test_order_id_can_be_required(spark):
    rejected = order_flow(require_order_id=True).split(orders(spark, {"order_id": None})).rejected
    assert rejected.first().reject_reason == "Missing Order ID"


def test_expected_amount(spark):
    row = ORDERS.standardized(orders(spark, {})).first()
    assert row.expected_order_amount == Decimal("9.50")
    refined = ORDERS.refine(
        orders(spark, {}, {"status": "?"}).withColumns(
            {"_ingested_at": F.current_timestamp(), "_source_file_modified_at": F.lit(1)}
        )
    )
    assert "expected_order_amount" not in refined.clean.columns
    assert "expected_order_amount" in refined.rejected.columns
    assert "_rejected_at" in refined.rejected.columns


def test_product_reasons(spark):
    rows = spark.createDataFrame(
        [
            (None, " ", "desk", 0.0, "gone"),
            (-1, None, " laptop ", None, " active"),
            (5, " Mouse ", "mouse", 9.999, "INACTIVE"),
        ],
        "product_id bigint, product_name string, category string, price double, status string",
    )
    valid, rejected = PRODUCTS.split(rows)
    assert [r.reject_reason for r in rejected.collect()] == [
        "Invalid Product ID; Missing Product Name; Invalid Category; Invalid Price; Invalid Status",
        "Invalid Product ID; Missing Product Name; Invalid Price",
    ]
    assert [(r.product_name, r.category, r.price) for r in valid.collect()] == [
        ("Mouse", "MOUSE", Decimal("10.00"))
    ]


def test_flags(spark):
    std = CUSTOMERS.standardized(customers(spark, {"province": None, "email": "x"}))
    reject = with_rule_flags(std, customer_rules(), "reject").first()
    drop = with_rule_flags(std, customer_rules(), "drop").first()
    assert (reject._is_province_valid, drop._is_province_valid) == (False, None)
    assert (reject._is_email_valid, drop._is_email_valid) == (False, False)
    assert reject._is_customer_id_valid and reject._is_status_valid


def test_reconcile(spark):
    rows = CUSTOMERS.standardized(customers(spark, {}, {"province": None}, {"status": "x"}))
    assert tuple(reconcile(rows, customer_rules(), "reject").first()) == (3, 1, 2, True)
    assert tuple(reconcile(rows, customer_rules(), "drop").first()) == (3, 1, 1, False)
    assert tuple(reconcile(rows.limit(0), customer_rules()).first()) == (0, 0, 0, True)


def test_profiles(spark):
    rows = spark.createDataFrame(
        [(1, "a"), (1, None), (None, "b"), (None, "c"), (2, "d")], "k int, v string"
    )
    assert tuple(null_profile(rows).first()) == (2, 1)
    assert sorted(map(tuple, duplicate_keys(rows, "k").collect()), key=str) == [(1, 2), (None, 2)]
    assert tuple(key_uniqueness(rows, "k").first()) == (5, 2)
    assert tuple(dq_summary(rows, "k", {"no_v": "v"}).first()) == (5, 2, 1)
    assert violations(customers(spark, {"email": "x"}, {"email": "a@b.ca"}), email_rule()).first()[0] == 1


def test_single_rules(spark):
    rows = spark.createDataFrame([(1, "a"), (5, ""), (None, None)], "n int, s string")
    cases = {
        non_empty("s", "s", "r"): [True, False, False],
        one_of("s", "s", ["a"], "r"): [True, False, None],
        between("n", "n", 1, 4, "r"): [True, False, None],
        Rule("n", compare("n", "!=", 5), "r"): [True, False, None],
    }
    for rule, expected in cases.items():
        assert [r[0] for r in rows.select(rule.holds).collect()] == expected


tri = st.sampled_from([True, False, None])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(tri, tri, tri), min_size=1, max_size=20))
def test_sides_partition_the_source(spark, rows):
    df = spark.createDataFrame(rows, "a boolean, b boolean, c boolean")
    rules = [Rule(c, F.col(c), f"Bad {c}") for c in "abc"]
    reject, drop = split(df, rules, "reject"), split(df, rules, "drop")
    valid = [r for r in rows if all(v is True for v in r)]
    failing = [r for r in rows if any(v is False for v in r)]
    assert reject.valid.count() == drop.valid.count() == len(valid)
    assert reject.rejected.count() == len(rows) - len(valid)
    assert drop.rejected.count() == len(failing)
    assert all(r.reject_reason for r in reject.rejected.collect())


def test_mask_says_what_the_predicates_say(spark):
    """Flags, reasons and sides, of rules that hold, fail and are undecided."""
    rules = [
        required("a", "a", "no a"),
        above("b", "b", 0, "bad b", guarded=False),
        between("c", "c", 0, 1, "bad c"),
    ]
    values = [None, -1, 1]
    rows = spark.createDataFrame(
        [(a, b, c) for a in values for b in values for c in values], "a int, b int, c int"
    )
    for policy in ("reject", "drop"):
        plain = rows.select(
            "*", *[r.flag(policy).alias(r.flag_name) for r in rules], reject_reason(rules, policy).alias("why")
        )
        by_mask = marked(rows, rules).withColumns({**mask_flags(rules, policy), "why": mask_reason(rules, policy)})
        assert sorted(map(str, by_mask.drop(MASK).collect())) == sorted(map(str, plain.collect()))
        for one, other in zip(split_marked(rows, rules, policy), split(rows, rules, policy)):
            assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))
    with pytest.raises(ValueError):
        marked(rows, rules * 11)


def test_whole_numbers_by_type(spark):
    rows = spark.sql(
        "SELECT * FROM VALUES ('7', 7L, 7.0D, 7.00), (' 8 ', 8L, 8.5D, 8.50), ('9.0', 9L, 9.0D, 9.00),"
        " ('9.5', 3000000000L, 3e9D, 3000000000.00), ('x', NULL, NULL, NULL) AS t(s, l, d, m)"
    )
    found = rows.select(*[whole(c).alias(c) for c in rows.columns]).collect()
    assert [r.s for r in found] == [7, 8, 9, None, None]
    assert [r.l for r in found] == [7, 8, 9, None, None]
    assert [r.d for r in found] == [r.m for r in found] == [7, None, 9, None, None]


def longest_method(df):
    """Bytes of the longest method that Spark generates for a plan; the JVM compiles none beyond 8000."""
    debug = getattr(df.sparkSession._jvm, "org.apache.spark.sql.execution.debug.package$")
    stages = getattr(debug, "MODULE$").codegenStringSeq(df._jdf.queryExecution().sparkPlan())
    planned = getattr(debug, "MODULE$").codegenStringSeq(df._jdf.queryExecution().executedPlan())
    return max(seq.apply(i)._3().maxMethodCodeSize() for seq in (stages, planned) for i in range(seq.size()))


def test_many_numbers_from_text_stay_in_short_methods(spark):
    texts = spark.range(5).select(*[(F.col("id") + i).cast("string").alias(f"t{i}") for i in range(24)])
    read = texts.select(*[whole(c, "long").alias(c) for c in texts.columns])
    assert longest_method(read) < 8000
    assert [tuple(r) for r in read.orderBy("t0").collect()] == [tuple(range(k, k + 24)) for k in range(5)]


def test_whole_numbers_of_text_with_letters(spark):
    texts = {"C12": None, "none": None, "12": 12, "1e3": 1000, " 1E2 ": 100, "7.0": 7, "7.5": None, "1f": None, "": None, "-3.": -3, None: None}
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, t string")
    found = rows.select("n", whole("t", "long").alias("t")).orderBy("n").collect()
    assert [r.t for r in found] == [*texts.values()]

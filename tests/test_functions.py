from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from smelter.functions.dates import calendar
from smelter.functions.numbers import count_where, expected_amount, fraction, money, ratio
from smelter.functions.text import clean, standardize


def one(spark, *columns, row="SELECT 1"):
    return tuple(spark.sql(row).select(*columns).first())


@pytest.mark.parametrize(
    ("text", "steps", "expected"),
    [
        ("  a b ", ("trim",), "a b"),
        ("\ta ", ("trim",), "\ta"),
        (" TROIS-rivières ", ("trim", "initcap"), "Trois-rivières"),
        ("quebec CITY", ("initcap",), "Quebec City"),
        (" Ab ", ("lower", "trim"), "ab"),
        ("ab", (F.reverse, "upper"), "BA"),
        (None, ("trim", "upper"), None),
        ("ab", (), "ab"),
    ],
)
def test_clean(spark, text, steps, expected):
    assert one(spark, clean(F.lit(text).cast("string"), *steps)) == (expected,)


def test_unknown_step(spark):
    with pytest.raises(KeyError):
        clean(F.lit("a"), "shout")


def test_standardize_keeps_the_other_columns(spark):
    df = spark.sql("SELECT 1 AS n, ' a ' AS s, ' b ' AS t")
    assert standardize(df, {"s": ["trim", "upper"]}).first().asDict() == {"n": 1, "s": "A", "t": " b "}
    assert standardize(df, {}).columns == df.columns


def test_money_and_fraction(spark):
    row = "SELECT '10.005' AS a, 'ten' AS b, 12345678901.0D AS c, 0.33335D AS d, CAST(NULL AS STRING) AS e"
    assert one(spark, *[money(c) for c in "abce"], fraction("d"), row=row) == (
        Decimal("10.01"),
        None,
        None,
        None,
        Decimal("0.3334"),
    )


def test_expected_amount(spark):
    row = "SELECT 3 AS q, 9.99 AS p, 0.1500 AS d, 1.30 AS t, CAST(NULL AS DECIMAL(5,4)) AS none"
    amounts = one(
        spark,
        expected_amount(F.col("q"), F.col("p"), F.col("d"), F.col("t")),
        expected_amount(F.col("q"), F.col("p"), F.col("none"), F.col("t")),
        row=row,
    )
    assert amounts == (Decimal("26.77"), None)


def test_ratio_rounds_half_up_and_survives_zero(spark):
    cases = {(1, 3): 0.3333, (2, 3): 0.6667, (1, 0): None, (0, 5): 0.0, (1013, 4000): 0.2533}
    for (part, whole), expected in cases.items():
        assert one(spark, ratio(F.lit(part), F.lit(whole))) == (expected,)


def test_count_where(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "n int")
    assert df.agg(count_where(F.col("n") > 2)).first()[0] == 1
    assert df.limit(0).agg(count_where(F.col("n") > 2)).first()[0] == 0


def test_calendar(spark):
    parts = calendar(F.lit(date(2024, 12, 31)), "order")
    assert list(parts) == ["order_year", "order_month", "order_month_name", "order_quarter"]
    assert one(spark, *parts.values()) == (2024, 12, "December", 4)
    assert one(spark, *calendar(F.lit(None).cast("date"), "x").values()) == (None,) * 4

"""Money, rounding and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from smelter.constants import FRACTION, MONEY


def money(column: str, kind: str = MONEY) -> Column:
    """Exact amount; a value that is no amount becomes NULL and so fails its rule."""
    return F.col(column).try_cast(kind)


def fraction(column: str, kind: str = FRACTION) -> Column:
    return F.col(column).try_cast(kind)


def whole(column: str, kind: str = "int") -> Column:
    """Whole number; text that is none, and a number with a fraction, become NULL.

    Whole numbers are narrowed, and text is read, directly; only fractions, and text that isn't plain
    digits such as "7.0", take the way by a decimal. The type is known before a row is read. Text with a
    letter other than that of an exponent is no number, which is seen without an exception. Of text the decimal
    is made once, as the element of a list: Spark evaluates such a projection outside whole-stage code,
    in short methods. With a few of these columns the one method of a stage passes 8000 bytes, which
    the JVM doesn't compile, and takes several times as long.
    """
    def narrowed(exact: Column) -> Column:
        return F.when(exact == F.floor(exact), exact.try_cast(kind))

    exact = F.col(column).try_cast("decimal(38,9)")
    fractional = F.typeof(column).rlike("^(decimal|double|float)")
    direct = F.col(column).try_cast(kind)
    is_text = F.typeof(column).startswith("string")
    numeric = ~F.col(column).cast("string").rlike("[A-DF-Za-df-z]")
    read = F.when(numeric, F.get(F.transform(F.array(exact), narrowed), F.lit(0)))
    return F.when(fractional, narrowed(exact)).when(is_text, F.coalesce(direct, read)).otherwise(direct)


def expected_amount(
    quantity: Column, unit_price: Column, discount: Column, tax: Column, scale: int = 2
) -> Column:
    net = quantity * unit_price * (F.lit(1) - discount)
    return F.round(net + tax, scale)


def ratio(part: Column, whole: Column, scale: int = 4) -> Column:
    """Fraction of ``whole``, NULL where that is 0."""
    return F.round(F.try_divide(part, whole), scale)


def count_where(condition: Column) -> Column:
    """Rows that meet ``condition``; NULL counts as not met, no rows give 0."""
    return F.count_if(condition)

"""Named quality rules: a predicate and the reason given when it does not hold."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

COMPARISONS = {
    ">": operator.gt,
    ">=": operator.ge,
    "<": operator.lt,
    "<=": operator.le,
    "==": operator.eq,
    "!=": operator.ne,
}

NULL_POLICIES = ("reject", "drop")


def check_null_policy(null_policy: str) -> None:
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy {null_policy!r} is none of {NULL_POLICIES}")


@dataclass(frozen=True, eq=False)
class Rule:
    """``reason`` may be a Column, to tell several causes of one rule apart."""

    name: str
    holds: Column
    reason: str | Column

    @property
    def flag_name(self) -> str:
        return f"_is_{self.name}_valid"

    def flag(self, null_policy: str = "reject") -> Column:
        """The predicate as a flag. An undecided (NULL) one is False under "reject"
        and stays NULL under "drop"."""
        check_null_policy(null_policy)
        return F.coalesce(self.holds, F.lit(False)) if null_policy == "reject" else self.holds

    def reason_column(self) -> Column:
        return F.lit(self.reason) if isinstance(self.reason, str) else self.reason


def missing(column: str) -> Column:
    return F.col(column).isNull()


def all_present(columns: Sequence[str]) -> Column:
    """Written as single NOT NULL tests, which reach the scan as ``dropna`` does not."""
    return reduce(operator.and_, (F.col(c).isNotNull() for c in columns))


def compare(column: str, op: str, value: object) -> Column:
    return COMPARISONS[op](F.col(column), F.lit(value))


def required(name: str, column: str, reason: str) -> Rule:
    return Rule(name, F.col(column).isNotNull(), reason)


def one_of(name: str, column: str, values: Sequence[str], reason: str) -> Rule:
    return Rule(name, F.col(column).isin(*values), reason)


def matches(name: str, column: str, pattern: str, reason: str | Column) -> Rule:
    """Present and matching."""
    return Rule(name, F.col(column).isNotNull() & F.col(column).rlike(pattern), reason)


def non_empty(name: str, column: str, reason: str) -> Rule:
    return Rule(name, F.col(column).isNotNull() & (F.length(column) > 0), reason)


def above(name: str, column: str, floor: object, reason: str, guarded: bool = True) -> Rule:
    """Greater than ``floor``. A guarded rule fails on NULL, an unguarded one is undecided."""
    over = compare(column, ">", floor)
    return Rule(name, F.col(column).isNotNull() & over if guarded else over, reason)


def between(name: str, column: str, low: object, high: object, reason: str) -> Rule:
    return Rule(name, compare(column, ">=", low) & compare(column, "<=", high), reason)


def within(name: str, column: str, other: str, tolerance: str, reason: str) -> Rule:
    """Numbers at most ``tolerance`` apart, compared as decimals."""
    gap = F.abs(F.col(column) - F.col(other))
    return Rule(name, gap <= F.lit(tolerance).cast("decimal(12,6)"), reason)


def all_of(rules: Sequence[Rule]) -> Column:
    """Conjunction in three-valued logic: NULL when no rule fails and some are undecided."""
    return reduce(operator.and_, (rule.holds for rule in rules))

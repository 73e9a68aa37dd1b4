"""Data-quality operators: flags, reasons, splits, counts and profiles.

All are narrow projections or one partial-then-final aggregation, whatever the
number of rules or columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from smelter.constants import REASON_SEPARATOR
from smelter.functions.numbers import count_where
from smelter.operators.rules import Rule, all_of, check_null_policy


# Column that holds what all rules say of a row
MASK = "_rules"
# A rule takes two bits of it
MOST_RULES = 31


class Split(NamedTuple):
    valid: DataFrame
    rejected: DataFrame


def marked(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``df`` with ``MASK``: of each rule a bit that it failed and a bit that it is undecided.

    Flags, reasons, splits and counts can be read from it, so that a predicate, and the parsing below
    it, is computed once for a row. The mask depends on the task's number, times 0: a filter on
    it then stays above it, where the optimizer would else copy all predicates into the filter.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules are more than the {MOST_RULES} that a mask holds")
    mask = (F.spark_partition_id() * 0).cast("bigint")
    for place, rule in enumerate(rules):
        outcome = F.coalesce(1 - rule.holds.cast("int"), F.lit(2)).cast("bigint")
        mask = mask.bitwiseOR(F.shiftleft(outcome, 2 * place))
    return df.withColumn(MASK, mask)


def _bits(place: int, null_policy: str) -> int:
    """Bits of the mask that make a rule count as failed."""
    return (3 if null_policy == "reject" else 1) << 2 * place


def _any(bits: int) -> Column:
    return F.col(MASK).bitwiseAND(F.lit(bits)) != 0


def mask_valid() -> Column:
    return F.col(MASK) == 0


def mask_failed(rules: Sequence[Rule], null_policy: str = "reject") -> Column:
    """As ``failed``, read from the mask."""
    check_null_policy(null_policy)
    return _any(sum(_bits(place, null_policy) for place in range(len(rules))))


def mask_reason(rules: Sequence[Rule], null_policy: str = "reject") -> Column:
    """As ``reject_reason``, read from the mask."""
    check_null_policy(null_policy)
    parts = [
        F.when(_any(_bits(place, null_policy)), rule.reason_column())
        for place, rule in enumerate(rules)
    ]
    return F.concat_ws(REASON_SEPARATOR, *parts)


def mask_flags(rules: Sequence[Rule], null_policy: str = "reject") -> dict[str, Column]:
    """As each rule's ``flag``, read from the mask."""
    check_null_policy(null_policy)
    decided = {
        rule.flag_name: (~_any(1 << 2 * place), ~_any(2 << 2 * place))
        for place, rule in enumerate(rules)
    }
    if null_policy == "reject":
        return {name: holds & known for name, (holds, known) in decided.items()}
    return {name: F.when(known, holds) for name, (holds, known) in decided.items()}


def with_rule_flags(
    df: DataFrame, rules: Sequence[Rule], null_policy: str = "reject"
) -> DataFrame:
    return marked(df, rules).withColumns(mask_flags(rules, null_policy)).drop(MASK)


def reject_reason(rules: Sequence[Rule], null_policy: str = "reject") -> Column:
    """Reasons of all failed rules in rule order; '' when none failed."""
    check_null_policy(null_policy)

    def part(rule: Rule) -> Column:
        if null_policy == "drop":
            return F.when(~rule.holds, rule.reason_column())
        return F.when(rule.holds, F.lit(None)).otherwise(rule.reason_column())

    return F.concat_ws(REASON_SEPARATOR, *[part(rule) for rule in rules])


def failed(rules: Sequence[Rule], null_policy: str = "reject") -> Column:
    """Rows to quarantine.

    "reject" takes every row that is not valid. "drop" takes only rows with a rule
    that is False, so rows that are merely undecided end up on neither side.
    """
    check_null_policy(null_policy)
    if null_policy == "drop":
        return ~all_of(rules)
    return ~all_of(rules).eqNullSafe(F.lit(True))


def split(df: DataFrame, rules: Sequence[Rule], null_policy: str = "reject") -> Split:
    """Valid rows as they are, rejected rows with their ``reject_reason``."""
    rejected = df.filter(failed(rules, null_policy))
    return Split(
        df.filter(all_of(rules)),
        rejected.withColumn("reject_reason", reject_reason(rules, null_policy)),
    )


def split_marked(
    df: DataFrame,
    rules: Sequence[Rule],
    null_policy: str = "reject",
    seen: Observation | None = None,
) -> Split:
    """As ``split``, for rules over columns that are dear to compute: each is computed once for a
    row. Predicates don't reach the scan this way, so ``split`` suits rules on stored columns.

    ``seen`` gets what ``reconcile`` counts, while the valid rows are written.
    """
    rows = marked(df, rules)
    rejected = rows.filter(mask_failed(rules, null_policy))
    reasoned = rejected.withColumn("reject_reason", mask_reason(rules, null_policy))
    counted = rows if seen is None else rows.observe(seen, *sides(rules, null_policy))
    return Split(counted.filter(mask_valid()).drop(MASK), reasoned.drop(MASK))


def sides(rules: Sequence[Rule], null_policy: str = "reject") -> list[Column]:
    """Counts of all rows, valid ones and rejected ones, over rows that are marked."""
    return [
        F.count(F.lit(1)).alias("source_rows"),
        count_where(mask_valid()).alias("valid_rows"),
        count_where(mask_failed(rules, null_policy)).alias("rejected_rows"),
    ]


def reconcile(df: DataFrame, rules: Sequence[Rule], null_policy: str = "reject") -> DataFrame:
    """Does every source row turn up on one side? One pass, one row."""
    return marked(df, rules).agg(*sides(rules, null_policy)).withColumn(
        "reconciled", F.col("source_rows") == F.col("valid_rows") + F.col("rejected_rows")
    )


def violations(df: DataFrame, rule: Rule, name: str = "violations") -> DataFrame:
    """Rows for which the rule is False, counted."""
    return df.agg(count_where(~rule.holds).alias(name))


def null_profile(df: DataFrame) -> DataFrame:
    """NULLs per column, one row."""
    return df.agg(*[count_where(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])


def value_counts(df: DataFrame, *by: Column | str, name: str = "count") -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias(name))


def rejects_by_reason(rejected: DataFrame, name: str = "count") -> DataFrame:
    return value_counts(rejected, "reject_reason", name=name).orderBy(
        F.desc(name), F.asc("reject_reason")
    )


def duplicate_keys(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    """Keys held by more than one row and by how many; NULL is a key as well."""
    return value_counts(df, *keys, name=name).filter(F.col(name) > 1)


def key_uniqueness(
    df: DataFrame, key: str, total: str = "total_rows", distinct: str = "distinct_keys"
) -> DataFrame:
    return df.agg(F.count("*").alias(total), F.count_distinct(F.col(key)).alias(distinct))


def dq_summary(df: DataFrame, key: str, required: Mapping[str, str]) -> DataFrame:
    """Total rows, distinct keys, and per entry of ``required`` (output name: column)
    the rows that lack it; sums over no rows are NULL."""
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct(F.col(key)).alias(f"distinct_{key}s"),
        *[F.sum(F.col(c).isNull().cast("int")).alias(name) for name, c in required.items()],
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each table under its name."""
    counted = [
        df.agg(F.count("*").alias("record_count")).select(
            F.lit(name).alias("table_name"), "record_count"
        )
        for name, df in tables.items()
    ]
    result = counted[0]
    for one in counted[1:]:
        result = result.unionAll(one)
    return result


def referential_integrity(fact: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """Per entry of ``keys`` (output name: dimension key) the facts that lack the key."""
    return fact.agg(*[count_where(F.col(k).isNull()).alias(name) for name, k in keys.items()])

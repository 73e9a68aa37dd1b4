"""Click events: silver flow and daily engagement."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.constants import EVENT_TYPES
from smelter.functions.numbers import count_where, ratio
from smelter.functions.text import standardize
from smelter.operators.distinct import bitmaps, counted, numbered, united, with_number
from smelter.operators.latest import latest_per_key
from smelter.operators.rules import all_present
from smelter.plans.flow import now

REQUIRED = ("event_id", "customer_id", "session_id", "event_type")
TEXT = {
    "event_type": ("trim", "lower"),
    "device": ("trim", "lower"),
    "country": ("trim", "upper"),
    "page_name": ("trim", "lower"),
}
# What a summary of silver clicks counts as missing: output name and column
SUMMARY = {
    "null_customer_ids": "customer_id",
    "null_session_ids": "session_id",
    "invalid_timestamps": "event_timestamp",
}

# Daily metrics: distinct actors (column: output name) and events counted by type
# (event type: names of the count and of its share)
ACTORS = {"customer_id": "unique_customers", "session_id": "unique_sessions"}
EVENTS = {
    "click": ("click_count", "click_percentage"),
    "add_to_cart": ("add_to_cart_count", "cart_percentage"),
    "purchase": ("purchase_count", "purchase_percentage"),
}


def silver_clicks(
    bronze: DataFrame, event_types: Sequence[str] = EVENT_TYPES, at: Column | None = None
) -> DataFrame:
    """Valid events, one row per event id. Times and dates that cannot be read are NULL,
    and an event without a time is left out. Rows are checked before copies are dropped,
    so that the checks on ids reach the scan and no faulty copy hides a sound one."""
    present = bronze.filter(all_present(REQUIRED))
    typed = standardize(present, TEXT).withColumns(
        {
            "event_timestamp": F.try_to_timestamp("event_time"),
            "business_date": F.try_to_date("business_date"),
        }
    )
    valid = typed.filter(
        F.col("event_timestamp").isNotNull() & F.col("event_type").isin(*event_types)
    ).drop("event_time")
    newest = [c for c in ("_bronze_ingested_at", "event_timestamp") if c in valid.columns]
    kept = latest_per_key(valid, ["event_id"], newest)
    return kept.withColumn("_silver_processed_at", now() if at is None else at)


def daily_engagement(
    clicks: DataFrame,
    by: str = "business_date",
    actors: Mapping[str, str] = ACTORS,
    events: Mapping[str, tuple[str, str]] = EVENTS,
    since: str | None = None,
    at: Column | None = None,
) -> DataFrame:
    """Events, distinct actors and counts per type for each day.

    The "percentage" columns are fractions of all events of the day. ``since`` limits
    the work to that day and later ones.
    """
    chosen = clicks if since is None else clicks.filter(F.col(by) >= F.lit(since).cast("date"))
    distinct = [F.count_distinct(F.col(actor)).alias(name) for actor, name in actors.items()]
    per_day = chosen.groupBy(by).agg(*_counts(events), *distinct)
    return _finished(per_day, by, actors, events, at)


def _counts(events: Mapping[str, tuple[str, str]]) -> list[Column]:
    """Counts of a day that can be added up."""
    total = F.count("*").alias("total_events")
    typed = [count_where(F.col("event_type") == e).alias(count) for e, (count, _) in events.items()]
    return [total, *typed]


def _finished(
    per_day: DataFrame,
    by: str,
    actors: Mapping[str, str],
    events: Mapping[str, tuple[str, str]],
    at: Column | None,
) -> DataFrame:
    """Columns in order, with shares and the time."""
    counts = [count for count, _ in events.values()]
    shares = [ratio(F.col(c), F.col("total_events")).alias(share) for c, share in events.values()]
    stamp = (now() if at is None else at).alias("_gold_processed_at")
    return per_day.select(by, "total_events", *actors.values(), *counts, *shares, stamp)


@dataclass(frozen=True)
class EngagementState:
    """What daily metrics keep of the events they have seen, so that none is read again.

    ``counts``: a row for each day with counts that add up. ``actors``: (day, actor, bucket, bits), the
    numbers of the distinct values that an actor column had on a day. ``numbers``: (actor, value, number),
    each value of an actor column once. All three can be stored as tables.
    """

    counts: DataFrame
    actors: DataFrame
    numbers: DataFrame


def engagement_state(
    clicks: DataFrame,
    known: EngagementState | None = None,
    by: str = "business_date",
    actors: Mapping[str, str] = ACTORS,
    events: Mapping[str, tuple[str, str]] = EVENTS,
) -> EngagementState:
    """The state after ``clicks``, which holds no event that ``known`` has seen.

    A late batch costs what it holds: its values get numbers, its days new bitmaps and counts. Values
    are kept as text; a number belongs to a value for good.
    """
    maps, numbers = [], []
    for actor in actors:
        before = None
        if known is not None:
            before = known.numbers.where(F.col("actor") == actor).select("value", "number")
        texts = clicks.select(F.col(actor).cast("string").alias("value"))
        given = numbered(texts, before)
        numbers.append(given.select(F.lit(actor).alias("actor"), "value", "number"))
        keyed = clicks.select(by, F.col(actor).cast("string").alias("value"))
        placed = with_number(keyed, "value", given, "number").withColumn("actor", F.lit(actor))
        maps.append(bitmaps(placed, [by, "actor"], "number"))
    counts = clicks.groupBy(by).agg(*_counts(events))
    old = []
    if known is not None:
        old = [known.actors]
        both = known.counts.unionByName(counts)
        added = [F.sum(c).alias(c) for c in counts.columns if c != by]
        counts = both.groupBy(by).agg(*added)
    return EngagementState(counts, united(*maps, *old), reduce(DataFrame.unionByName, numbers))


def engagement_of(
    state: EngagementState,
    by: str = "business_date",
    actors: Mapping[str, str] = ACTORS,
    events: Mapping[str, tuple[str, str]] = EVENTS,
    at: Column | None = None,
) -> DataFrame:
    """As ``daily_engagement`` over all events that the state has seen; it reads the state only."""
    chosen = [
        F.sum(F.when(F.col("actor") == actor, F.col("n"))).alias(name) for actor, name in actors.items()
    ]
    # One row for each day
    distinct = counted(state.actors, [by, "actor"], "n").groupBy(by).agg(*chosen)
    distinct = distinct.withColumnRenamed(by, "_day")
    per_day = state.counts.join(distinct, F.col(by).eqNullSafe(F.col("_day")), "left")
    per_day = per_day.withColumns({name: F.coalesce(name, F.lit(0)) for name in actors.values()})
    return _finished(per_day, by, actors, events, at)

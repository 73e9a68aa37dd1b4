"""Bitmaps of distinct values: exact over batches, and old events are not read again."""

import pytest
from pyspark.sql import functions as F

from smelter.operators.distinct import bitmaps, counted, numbered, united, with_number
from smelter.plans.clicks import EngagementState, daily_engagement, engagement_of, engagement_state
from smelter.scratch import stage


def test_numbers_stay_and_have_no_gaps(spark):
    first = stage(numbered(spark.range(0, 5000, 2).repartition(7)), "numbers")
    second = numbered(spark.range(0, 9000).selectExpr("IF(id % 9 = 0, NULL, id) AS id"), first)
    rows = {r.value: r.number for r in second.collect()}
    assert sorted(rows.values()) == list(range(1, len(rows) + 1))
    assert all(rows[r.value] == r.number for r in first.collect())
    assert set(rows) == set(range(0, 5000, 2)) | {i for i in range(9000) if i % 9}


@pytest.mark.parametrize("parts", [1, 3])
def test_counts_of_batches(spark, parts):
    rows = spark.range(100_000).selectExpr(
        "IF(id % 11 = 0, NULL, id % 4) AS day", "IF(id % 7 = 0, NULL, concat('s', pmod(xxhash64(id), 40000))) AS who"
    )
    batches = [rows.filter(F.pmod(F.xxhash64("who", "day"), F.lit(parts)) == i) for i in range(parts)]
    numbers, maps = None, []
    for batch in batches:
        numbers = stage(numbered(batch.select("who"), numbers), "numbers")
        maps.append(bitmaps(with_number(batch, "who", numbers, "n"), ["day"], "n"))
    # The same batch once more changes nothing
    found = counted(united(*maps, maps[0]), ["day"], "whos")
    expected = rows.groupBy("day").agg(F.count_distinct("who").alias("whos"))
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


CLICKS = "event_id long, business_date date, event_type string, customer_id long, session_id string"


def clicks(spark, n, begin=0):
    return spark.range(begin, begin + n).selectExpr(
        "id AS event_id", "IF(id % 13 = 0, NULL, date_add(DATE '2024-01-01', int(id % 5))) AS business_date",
        "element_at(array('click', 'purchase', 'page_view'), int(id % 3) + 1) AS event_type",
        "IF(id % 17 = 0, NULL, pmod(xxhash64(id), 300)) AS customer_id", "concat('s', id % 211) AS session_id",
    )


def test_late_batch(spark):
    whole = clicks(spark, 4000)
    first = engagement_state(clicks(spark, 3000))
    kept = EngagementState(*[stage(df, "state") for df in (first.counts, first.actors, first.numbers)])
    late = engagement_of(engagement_state(clicks(spark, 1000, 3000), kept)).drop("_gold_processed_at")
    expected = daily_engagement(whole).drop("_gold_processed_at")
    assert late.columns == expected.columns
    assert sorted(map(str, late.collect())) == sorted(map(str, expected.collect()))


def test_old_events_are_not_read(spark, tmp_path):
    old = str(tmp_path / "old")
    clicks(spark, 500).write.parquet(old)
    first = engagement_state(spark.read.parquet(old))
    kept = EngagementState(*[stage(df, "state") for df in (first.counts, first.actors, first.numbers)])
    plan = engagement_of(engagement_state(clicks(spark, 100, 500), kept))._jdf.queryExecution().toString()
    assert "tmp" in plan and old not in plan


def test_no_events(spark):
    empty = spark.createDataFrame([], CLICKS)
    assert engagement_of(engagement_state(empty)).count() == 0
    state = engagement_state(empty, engagement_state(clicks(spark, 50)))
    found = engagement_of(state).drop("_gold_processed_at")
    expected = daily_engagement(clicks(spark, 50)).drop("_gold_processed_at")
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))

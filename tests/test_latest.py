import random

import pytest

from smelter.operators.latest import distinct_by_key, latest_per_key

DDL = "k int, t int, u int, v string"


def latest(spark, rows, **how):
    df = spark.createDataFrame(rows, DDL).repartition(4)
    return sorted(map(tuple, latest_per_key(df, ["k"], ["t", "u"], **how).collect()), key=str)


def test_newest_wins_and_null_is_oldest(spark):
    rows = [(1, 1, 1, "a"), (1, 2, 1, "b"), (1, None, 9, "c"), (2, None, 1, "d"), (2, None, 2, "e")]
    assert latest(spark, rows) == [(1, 2, 1, "b"), (2, None, 2, "e")]


def test_ties_are_broken_the_same_way_each_time(spark):
    rows = [(1, 1, 1, v) for v in ("c", "a", None, "b")]
    for _ in range(3):
        random.shuffle(rows)
        assert latest(spark, rows) == [(1, 1, 1, "a")]
    assert latest(spark, rows, tie_break=["v"]) == [(1, 1, 1, "a")]


def test_null_keys_are_one_key(spark):
    assert latest(spark, [(None, 1, 1, "a"), (None, 2, 1, "b")]) == [(None, 2, 1, "b")]


def test_against_brute_force(spark):
    chance = random.Random(3)
    # one key holds a third of all rows
    rows = [
        (
            7 if chance.random() < 1 / 3 else chance.randrange(50),
            chance.choice([None, *range(5)]),
            chance.choice([None, *range(5)]),
            chance.choice("abcdef"),
        )
        for _ in range(3000)
    ]
    best = {}
    for row in rows:
        low = -1
        rank = (
            low if row[1] is None else row[1],
            low if row[2] is None else row[2],
            -ord(row[3]),
        )
        if row[0] not in best or rank > best[row[0]][0]:
            best[row[0]] = (rank, row)
    assert latest(spark, rows) == sorted((row for _, row in best.values()), key=str)


def test_distinct_by_key(spark):
    df = spark.createDataFrame([(1, 1, 1, "b"), (1, 1, 1, "a"), (2, 1, 1, "c")], DDL)
    assert sorted(map(tuple, distinct_by_key(df, ["k"]).collect())) == [
        (1, 1, 1, "a"),
        (2, 1, 1, "c"),
    ]


def test_unorderable_columns_are_left_out_of_the_tie_break(spark):
    df = spark.sql("SELECT 1 AS k, map('a', 1) AS m, array(1) AS l")
    assert distinct_by_key(df, ["k"]).count() == 1


def test_one_row_per_task_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS t")
    plan = latest_per_key(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("row_number(), 1, Partial")
    assert plan.index("Exchange hashpartitioning(k") < partial

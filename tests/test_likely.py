"""The filter by bits of keys: nothing lost, little let through, and merges that use it."""

import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from smelter import operators
from smelter.operators.likely import WORDS, _words, bits_if_worth, key_bits, likely, upsert_likely
from smelter.operators.merge import merge_upsert, untouched
from smelter.scratch import stage
from smelter.sinks.tables import create_or_merge
from test_plans import conf, plan  # noqa: F401


def target_rows(spark, n=200_000):
    return spark.range(n).select(
        F.when(F.col("id") % 1000 != 0, F.col("id")).alias("k"),
        F.concat(F.lit("n"), F.col("id") % 7).alias("name"), F.col("id").alias("v"),
    )


def test_few_others_pass(spark):
    target = target_rows(spark)
    batch = target.where("v % 20 = 3").select("k", "name")
    bits = key_bits(batch, ["k", "name"], 10_000)
    matched = target.join(batch, ["k", "name"], "left_semi")
    passed, rest = likely(target, bits, ["k", "name"]), likely(target, bits, ["k", "name"], otherwise=True)
    assert passed.columns == rest.columns == target.columns
    assert passed.count() + rest.count() == 200_000
    assert passed.join(matched, "v", "left_semi").count() == matched.count() == 10_000
    assert passed.count() < 1.4 * 10_000
    # The target itself isn't shuffled
    assert "hashpartitioning" not in plan(passed)


def test_sizes(spark):
    batch = spark.range(50_000).withColumnRenamed("id", "k")
    assert key_bits(batch, ["k"], 50_000, largest=4096) is None
    bits = key_bits(batch, ["k"], 50_000)
    assert bits.number == 25 and bits.blocks.count() <= 25
    assert bits_if_worth(stage(spark.range(10).withColumnRenamed("id", "k")), ["k"]) is None
    empty = key_bits(batch.limit(0), ["k"], 0)
    assert likely(batch, empty, ["k"]).count() == 0
    assert likely(batch, empty, ["k"], otherwise=True).count() == 50_000


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.one_of(st.none(), st.floats(width=32)), st.one_of(st.none(), st.text(max_size=2))), max_size=20),
    st.lists(st.tuples(st.one_of(st.none(), st.floats(width=32)), st.one_of(st.none(), st.text(max_size=2))), max_size=20),
)
def test_no_key_is_lost(spark, target, batch):
    ddl, keys = "a double, b string", ["a", "b"]
    left, right = spark.createDataFrame(target, ddl), spark.createDataFrame(batch, ddl)
    passed = likely(left, key_bits(right, keys, max(1, len(batch))), keys)
    same = F.col("l.a").eqNullSafe(F.col("r.a")) & F.col("l.b").eqNullSafe(F.col("r.b"))
    count = lambda rows: rows.alias("l").join(right.alias("r"), same, "left_semi").count()
    assert count(passed) == count(left)


def test_upsert(spark):
    target = target_rows(spark, 5000)
    batch = target.where("v % 3 = 0 OR k IS NULL").withColumn("v", -F.col("v")).where("k IS NOT NULL")
    bits = key_bits(batch, ["k"], 2000)
    ours = upsert_likely(target, batch, ["k"], bits)
    theirs = merge_upsert(target, batch, ["k"])
    assert sorted(map(str, ours.collect())) == sorted(map(str, theirs.collect()))


@pytest.mark.parametrize(
    "how, partition_by, null_keys",
    [("upsert", None, "insert"), ("upsert", ["name"], "match"), ("insert", None, "match")],
)
def test_tables_merge_alike(spark, database, conf, how, partition_by, null_keys):  # noqa: F811
    target = target_rows(spark, 3000).where("k IS NOT NULL OR v = 0")
    batch = target.where("v % 2 = 0").withColumn("v", F.col("v") + 10_000)
    batch = batch.unionByName(spark.sql("SELECT 5001L AS k, 'n9' AS name, 1L AS v"))
    found = []
    for name, limit in (("plain", "10MB"), ("filtered", "-1")):
        conf(autoBroadcastJoinThreshold=limit)
        table = f"{database}.{name}"
        create_or_merge(target, table, ["k"], partition_by=partition_by, null_keys=null_keys)
        create_or_merge(batch, table, ["k"], how, null_keys=null_keys)
        found.append(sorted(map(str, spark.table(table).select("k", "name", "v").collect())))
    assert found[0] == found[1]


def test_only_likely_rows_are_shuffled(spark, conf):  # noqa: F811
    """The shuffle of the target lies above the filter by bits, which lets two percent of others pass at most."""
    conf(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    target = stage(target_rows(spark).where("k IS NOT NULL"))
    batch = stage(target.where("v % 50 = 1").withColumn("v", F.lit(0)))
    bits = bits_if_worth(batch, ["k"])
    text = plan(likely(target, bits, ["k"]).join(batch.select("k"), "k", "left_semi"))
    exchange = text.index("hashpartitioning(k")
    assert text.index("BroadcastHashJoin") > exchange and "BroadcastHashJoin" not in text[:exchange]
    matched = batch.count()
    assert matched <= likely(target, bits, ["k"]).count() <= matched + 0.02 * target.count()


def test_bits_that_the_driver_can_take(spark, conf, monkeypatch):  # noqa: F811
    """Blocks take a part of the driver's memory at most; without them a merge shuffles, with the same rows."""
    batch = stage(spark.range(500_000).withColumnRenamed("id", "k"))
    conf(autoBroadcastJoinThreshold="-1")
    assert bits_if_worth(batch, ["k"], rows=500_001).number * 4096 > 1_000_000
    # A target as small as the batch has nothing to spare
    assert bits_if_worth(batch, ["k"], rows=500_000) is None
    monkeypatch.setattr(operators.likely, "driver_memory", lambda spark: 15_000_000)
    assert bits_if_worth(batch, ["k"], rows=500_001) is None
    assert bits_if_worth(batch, ["k"], largest=2_000_000) is not None


def test_keys_are_broadcast_by_their_number(spark, database, conf, monkeypatch):  # noqa: F811
    """Keys in a small file that are too many for the driver get bits, and are not broadcast in a merge."""
    batch = stage(spark.range(0, 500_000, 2).select(F.col("id").alias("k"), F.lit("new").alias("v")))
    target = stage(spark.range(600_000).select(F.col("id").alias("k"), F.lit("old").alias("v")))
    number = batch.count()
    assert bits_if_worth(batch, ["k"]) is None
    assert "BroadcastHashJoin" in plan(untouched(target, batch, ["k"], number=number))
    for module in (operators.likely, operators.merge):
        monkeypatch.setattr(module, "most_broadcast", lambda spark: 1_000_000)
    assert bits_if_worth(batch, ["k"]) is not None
    for null_keys in ("insert", "match"):
        text = plan(untouched(target, batch, ["k"], null_keys, number))
        assert "SortMergeJoin" in text and "Broadcast" not in text
    name = f"{database}.t"
    create_or_merge(target, name, ["k"])
    create_or_merge(batch, name, ["k"], check_unique=False)
    rows = spark.table(name).groupBy("v").agg(F.count("*").alias("n"), F.count_distinct("k").alias("keys")).collect()
    assert {(r.v, r.n, r["keys"]) for r in rows} == {("old", 350_000, 350_000), ("new", 250_000, 250_000)}


def test_words_of_a_block(spark):
    block = bytes(i * 37 % 256 for i in range(8 * WORDS))
    rows = spark.range(0, 3000, 1, 8).select(F.lit(bytearray(block)).alias("bits"), "id")
    # A block that differs by row, so that none is computed ahead
    rows = rows.select(F.concat(F.substring("bits", 1, 8 * WORDS - 8), F.unhex(F.lpad(F.hex("id"), 16, "0"))).alias("bits"), "id")
    begin = time.time()
    found = rows.select("id", _words("bits").alias("w")).where("w[511] = id").agg(F.count("*"), F.min("w"), F.max("w")).first()
    # 20 ms for each block when the whole block was made text for each word
    assert time.time() - begin < 6
    expected = [int.from_bytes(block[i * 8 : i * 8 + 8], "big", signed=True) for i in range(WORDS - 1)]
    assert found[0] == 3000 and found[1] == [*expected, 0] and found[2] == [*expected, 2999]

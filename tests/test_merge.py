import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from smelter import scratch
from smelter.operators.merge import changes, load_audit, merge_insert, merge_upsert, with_match
from smelter.sinks.tables import create_or_merge, expire_versions

DDL = "k int, v string"
TARGET = [(1, "a"), (2, "b"), (None, "n")]
SOURCE = [(2, "B"), (3, "c"), (None, "m")]


def frame(spark, rows, ddl=DDL):
    return spark.createDataFrame(rows, ddl)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_upsert(spark):
    merged = merge_upsert(frame(spark, TARGET), frame(spark, SOURCE), ["k"])
    assert rows(merged) == [(1, "a"), (2, "B"), (3, "c"), (None, "m"), (None, "n")]


def test_insert(spark):
    merged = merge_insert(frame(spark, TARGET), frame(spark, SOURCE), ["k"])
    assert rows(merged) == [(1, "a"), (2, "b"), (3, "c"), (None, "m"), (None, "n")]


@pytest.mark.parametrize("merge", [merge_upsert, merge_insert])
def test_null_keys_can_be_dropped(spark, merge):
    merged = merge(frame(spark, TARGET), frame(spark, SOURCE), ["k"], null_keys="drop")
    assert rows(merged)[-1] == (None, "n") and merged.count() == 4
    with pytest.raises(ValueError, match="null_keys"):
        merge(frame(spark, TARGET), frame(spark, SOURCE), ["k"], null_keys="?")


def test_key_twice_in_source(spark):
    source = frame(spark, [(2, "x"), (2, "y")])
    with pytest.raises(ValueError, match="more than once"):
        merge_upsert(frame(spark, TARGET), source, ["k"])
    nulls = frame(spark, [(None, "x"), (None, "y")])
    assert merge_upsert(frame(spark, TARGET), nulls, ["k"]).count() == 5


def test_columns(spark):
    wider = frame(spark, [(2, "B", 1.0)], "k int, v string, w double")
    merged = merge_upsert(frame(spark, TARGET), wider, ["k"])
    assert merged.columns == ["k", "v", "w"]
    assert rows(merged) == [(1, "a", None), (2, "B", 1.0), (None, "n", None)]
    with pytest.raises(ValueError, match="lacks"):
        merge_upsert(frame(spark, TARGET), frame(spark, [(2,)], "k int"), ["k"])
    other_type = frame(spark, [("2", "B")], "k string, v string")
    assert merge_upsert(frame(spark, TARGET), other_type, ["k"]).schema == frame(spark, []).schema


def test_two_keys(spark):
    ddl = "k int, l int, v string"
    target = frame(spark, [(1, 1, "a"), (1, 2, "b"), (1, None, "c")], ddl)
    source = frame(spark, [(1, 2, "B"), (1, None, "C")], ddl)
    assert rows(merge_upsert(target, source, ["k", "l"])) == [
        (1, 1, "a"),
        (1, 2, "B"),
        (1, None, "C"),
        (1, None, "c"),
    ]


def test_audit(spark):
    before = frame(spark, [(1, "a"), (2, "b"), (3, "c"), (None, "n"), (5, None)])
    after = frame(spark, [(1, "a"), (2, "B"), (4, "d"), (None, "n"), (None, "m"), (5, "e")])
    assert tuple(load_audit(before, after, ["k"]).first()) == (2, 2, 2, 1)
    assert tuple(load_audit(before, after, ["k"], ignore=["v"]).first()) == (2, 0, 4, 1)
    assert tuple(load_audit(before.limit(0), before.limit(0), ["k"]).first()) == (0, 0, 0, 0)


def test_audit_sees_a_value_change_places(spark):
    ddl = "k int, a int, b int"
    before, after = frame(spark, [(1, None, 1)], ddl), frame(spark, [(1, 1, None)], ddl)
    assert tuple(load_audit(before, after, ["k"]).first()) == (0, 1, 0, 0)


def test_audit_of_an_added_column(spark):
    before = frame(spark, [(1, "a"), (2, "b")])
    after = frame(spark, [(1, "a", None), (2, "b", 1)], "k int, v string, w int")
    assert tuple(load_audit(before, after, ["k"]).first()) == (0, 1, 1, 0)


keyed = st.dictionaries(st.integers(0, 8), st.sampled_from("abc"), max_size=8)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=keyed, new=keyed)
def test_merges_against_dictionaries(spark, old, new):
    target, source = frame(spark, list(old.items())), frame(spark, list(new.items()))
    upserted = merge_upsert(target, source, ["k"])
    assert rows(upserted) == sorted({**old, **new}.items(), key=str)
    assert rows(merge_upsert(upserted, source, ["k"])) == rows(upserted)
    assert rows(merge_insert(target, source, ["k"])) == sorted({**new, **old}.items(), key=str)
    changed = sum(1 for k in old if k in new and new[k] != old[k])
    expected = (len(new.keys() - old.keys()), changed, len(old) - changed, 0)
    assert tuple(load_audit(target, upserted, ["k"]).first()) == expected


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_small_batch_does_not_shuffle_the_target(spark, tmp_path):
    for name, n in (("target", 100000), ("batch", 10)):
        spark.range(n).selectExpr("id AS k", "string(id) AS v").write.parquet(str(tmp_path / name))
    target, batch = (spark.read.parquet(str(tmp_path / n)) for n in ("target", "batch"))
    merged = merge_upsert(target, batch, ["k"], check_unique=False)
    assert "BroadcastHashJoin" in plan(merged)
    assert "Exchange hashpartitioning" not in plan(merged)
    fresh = merge_insert(target, batch, ["k"])
    assert "Exchange hashpartitioning" not in plan(fresh)


# Null keys, names, and what a merge leaves behind


@pytest.mark.parametrize("policy, rows", [("insert", 3), ("drop", 1), ("match", 2)])
def test_rows_without_a_key_merged_twice(spark, database, policy, rows):
    batch = spark.createDataFrame([(1, "a"), (None, "b")], "id int, v string")
    for _ in range(2):
        create_or_merge(batch, f"{database}.t", ["id"], null_keys=policy)
    assert spark.table(f"{database}.t").count() == rows


def test_first_batch_is_checked_too(spark, database):
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "id int, v string")
    with pytest.raises(ValueError, match="more than once"):
        create_or_merge(twice, f"{database}.t", ["id"])
    create_or_merge(twice, f"{database}.t", ["id"], check_unique=False)


def test_buckets_take_no_rows_without_a_key(spark, database):
    batch = spark.createDataFrame([(1, "a"), (None, "b")], "id int, v string")
    with pytest.raises(ValueError, match="one bucket"):
        create_or_merge(batch, f"{database}.t", ["id"], buckets=4)
    create_or_merge(batch, f"{database}.t", ["id"], buckets=4, null_keys="drop")
    with pytest.raises(ValueError, match="one bucket"):
        create_or_merge(batch, f"{database}.t", ["id"])


def test_names_in_another_case_are_the_same_column(spark, database):
    create_or_merge(spark.createDataFrame([(1, "a")], "id int, v string"), f"{database}.t", ["id"])
    create_or_merge(spark.createDataFrame([("b", 1)], "V string, ID int"), f"{database}.t", ["id"])
    assert [tuple(r) for r in spark.table(f"{database}.t").collect()] == [(1, "b")]


def files_of(spark, name):
    return set(spark.table(name).inputFiles())


def test_partitioned_merge_with_a_new_column(spark, database):
    name = f"{database}.t"
    rows = [(i, i % 2, "ab"[i % 3 == 0]) for i in range(12)]
    first = spark.createDataFrame(rows, "id int, p int, q string")
    create_or_merge(first, name, ["id"], partition_by=["p", "q"])
    before = files_of(spark, name)
    batch = spark.createDataFrame([(0, 0, "b", "x"), (50, 7, "z", "x"), (2, None, "a", "x")], "id int, p int, q string, note string")
    create_or_merge(batch, name, ["id"])
    got = {r.id: (r.p, r.q, r.note) for r in spark.table(name).collect()}
    changed = {0: (0, "b", "x"), 50: (7, "z", "x"), 2: (None, "a", "x")}
    assert got == {i: (p, q, None) for i, p, q in rows} | changed
    kept = {f for f in before if "p=1" in f}
    assert kept and kept <= files_of(spark, name)


def test_merge_leaves_little_behind(spark, database):
    name, staged = f"{database}.t", f"{scratch.shared_folder(spark)}/smelter"
    batch = spark.range(10).selectExpr("id", "id * 2 AS v")
    create_or_merge(batch, name, ["id"], audit_table=f"{database}.audit")
    held = len(scratch.list_folders(spark, staged))
    for _ in range(3):
        create_or_merge(batch, name, ["id"], audit_table=f"{database}.audit")
    # What is handed back stays
    assert len(scratch.list_folders(spark, staged)) == held + 3
    assert len(expire_versions(spark, name, keep=1)) == 2
    assert expire_versions(spark, name, keep=1) == []
    assert spark.table(name).count() == 10


def test_expired_versions_of_a_partitioned_table(spark, database):
    name = f"{database}.t"
    batch = spark.range(10).selectExpr("id", "id % 2 AS p")
    create_or_merge(batch, name, ["id"], partition_by=["p"])
    for _ in range(3):
        create_or_merge(batch.where("p = 0"), name, ["id"])
    expire_versions(spark, name, keep=0)
    assert spark.table(name).count() == 10


def test_rows_that_the_table_holds_are_left_out(spark, database):
    name = f"{database}.t"
    first = spark.createDataFrame([(1, 0, "a", 1), (2, 0, None, 1), (3, 1, "c", 1)], "id int, p int, v string, at int")
    create_or_merge(first, name, ["id"], partition_by=["p"])
    before = files_of(spark, name)
    same = first.withColumn("at", F.lit(2))
    assert create_or_merge(same, name, ["id"], skip_same=["at"]).count() == 0
    assert files_of(spark, name) == before
    batch = spark.createDataFrame([(2, 0, "b", 3), (3, 1, "c", 3), (4, 0, "d", 3)], "id int, p int, v string, at int")
    assert rows(create_or_merge(batch, name, ["id"], skip_same=["at"]).select("id")) == [(2,), (4,)]
    assert rows(spark.table(name).select("id", "v", "at")) == [(1, "a", 1), (2, "b", 3), (3, "c", 1), (4, "d", 3)]
    assert {f for f in before if "p=1" in f} <= files_of(spark, name)


def listed(found):
    plain = lambda r: None if r is None else tuple(r)
    return sorted(((r.k, r.change, plain(r.old), plain(r.new)) for r in found.collect()), key=str)


def test_changes(spark):
    before = frame(spark, [(1, "a"), (2, "b"), (3, "c"), (None, "n")])
    after = frame(spark, [(1, "a"), (2, "B"), (4, "d"), (None, "m")])
    assert listed(changes(before, after, ["k"])) == sorted(
        [(2, "update", ("b",), ("B",)), (3, "delete", ("c",), None), (4, "insert", None, ("d",)), (None, "update", ("n",), ("m",))],
        key=str,
    )
    assert changes(before, before, ["k"]).count() == 0
    assert changes(before.limit(0), before.limit(0), ["k"]).count() == 0


def test_changes_of_rows_that_share_a_key(spark):
    before = frame(spark, [(1, "a"), (1, "a"), (1, "b")])
    after = frame(spark, [(1, "a"), (1, "c"), (1, "c"), (1, None)])
    found = listed(changes(before, after, ["k"]))
    assert [f[1] for f in found].count("update") == 2 and [f[1] for f in found].count("insert") == 1
    assert sorted(f[2][0] for f in found if f[2]) == ["a", "b"]
    assert sorted(str(f[3][0]) for f in found if f[3]) == ["None", "c", "c"]


def test_changes_by_columns_that_count(spark):
    before = frame(spark, [(1, "a")]).withColumn("t", F.lit(1))
    after = frame(spark, [(1, "a"), (2, "b")]).withColumn("t", F.lit(2)).withColumn("w", F.lit("new"))
    assert listed(changes(before, after, ["k"], ["t", "w"])) == [(2, "insert", None, ("b", 2, "new"))]
    assert listed(changes(before, after, ["k"], ["t"]))[0][1] == "update"


def test_rows_flagged_by_a_match(spark):
    left = frame(spark, [(1, "a"), (1, "b"), (2, "c"), (None, "n")])
    right = frame(spark, [(1, "x"), (1, "y"), (3, "z"), (None, "m")])
    flagged = with_match(left, right, "k", "held").select("k", "v", "held")
    assert rows(flagged) == [(1, "a", True), (1, "b", True), (2, "c", False), (None, "n", False)]

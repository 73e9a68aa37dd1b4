"""New files only, unreadable records, and publishing behind a view."""

import pytest
from pyspark.sql import functions as F

from smelter import IngestConfig
from smelter.plans.ingest import ingest, ingest_new
from smelter.sinks import views
from smelter.sinks.views import expire_published, publish, published_version
from smelter.sources.landing import UNREADABLE, read_landing

SCHEMA = "id bigint, order_status string, paid decimal(8,2)"


def landing(tmp_path, name, text):
    folder = tmp_path / "landing"
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("id,order_status,paid\n" + text)
    return str(folder)


def test_only_new_files_are_read(spark, database, tmp_path):
    folder = landing(tmp_path, "a.csv", "1, new ,2.50\n2,old,1\n")
    config = IngestConfig(folder, f"{database}.orders", "orders", "ERP", "b", schema=SCHEMA)
    checkpoint = str(tmp_path / "checkpoint")
    assert ingest_new(spark, config, checkpoint).count() == 2
    # What was read is not looked at again, even if it has gone
    (tmp_path / "landing" / "a.csv").unlink()
    landing(tmp_path, "b.csv", "3,new,7\n")
    rows = ingest_new(spark, config, checkpoint).orderBy("id").collect()
    assert [(r.id, r.status, r._batch_id, r._source_file_name) for r in rows] == [
        (1, "NEW", "b-0", "a.csv"), (2, "OLD", "b-0", "a.csv"), (3, "NEW", "b-1", "b.csv"),
    ]
    assert ingest_new(spark, config, checkpoint).count() == 3


def test_a_batch_written_before_a_crash_is_not_added_twice(spark, database, tmp_path):
    folder = landing(tmp_path, "a.csv", "1,new,2\n")
    config = IngestConfig(folder, f"{database}.orders", "orders", "ERP", "b", schema=SCHEMA)
    ingest_new(spark, config, str(tmp_path / "checkpoint"))
    # The write is there, its commit is lost
    (commit,) = (tmp_path / "checkpoint" / "commits").glob("0")
    commit.unlink()
    (tmp_path / "checkpoint" / "commits" / ".0.crc").unlink(missing_ok=True)
    assert ingest_new(spark, config, str(tmp_path / "checkpoint")).count() == 1


def test_files_in_small_batches(spark, database, tmp_path):
    for i in range(5):
        folder = landing(tmp_path, f"{i}.csv", f"{i},new,1\n")
    config = IngestConfig(folder, f"{database}.orders", "orders", "ERP", "b", schema=SCHEMA)
    table = ingest_new(spark, config, str(tmp_path / "checkpoint"), most_files=2)
    assert table.count() == 5 and table.select("_batch_id").distinct().count() == 3


def test_new_files_need_a_schema(spark, database, tmp_path):
    config = IngestConfig(str(tmp_path), f"{database}.orders", "orders", "ERP", "b")
    with pytest.raises(ValueError, match="schema"):
        ingest_new(spark, config, str(tmp_path / "checkpoint"))


def test_unreadable_records(spark, database, tmp_path):
    text = "1,new,2.50\nnone,new,3\n2\n3,old,4,more\n4,,\n"
    folder = landing(tmp_path, "a.csv", text)
    bad = f"{database}.unreadable"
    config = IngestConfig(folder, f"{database}.orders", "orders", "ERP", "b", schema=SCHEMA, unreadable_table=bad)
    sound = ingest(spark, config)
    assert UNREADABLE not in sound.columns
    assert sorted(r.id for r in sound.collect()) == [1, 4]
    torn = {r[UNREADABLE]: r for r in spark.table(bad).collect()}
    assert set(torn) == {"none,new,3", "2", "3,old,4,more"}
    assert all(r._source_file_name == "a.csv" and r._batch_id == "b" for r in torn.values())
    # A second load adds to both
    ingest(spark, IngestConfig(**{**config.__dict__, "load_mode": "append"}))
    assert spark.table(bad).count() == 6 and spark.table(config.target_table).count() == 4


def test_unreadable_records_need_text_and_a_schema(spark, tmp_path):
    for fmt, schema in (("parquet", SCHEMA), ("csv", None)):
        with pytest.raises(ValueError, match="unreadable"):
            read_landing(spark, str(tmp_path), fmt, schema, unreadable=True)


def test_readers_see_the_old_rows_until_the_view_moves(spark, database, monkeypatch):
    name = f"{database}.orders"
    rows = spark.range(10).selectExpr("id", "id % 3 AS kind", "'x' AS note")
    assert published_version(spark, name) is None
    assert publish(rows, name) == f"{name}__v1"

    def fails(*_):
        raise RuntimeError("between the two steps")

    with monkeypatch.context() as m:
        m.setattr(views, "_point", fails)
        with pytest.raises(RuntimeError):
            publish(rows.limit(1).drop("note"), name, ["kind"])
    assert spark.table(name).count() == 10 and "note" in spark.table(name).columns
    # The version that was never published is passed over, and dropped with the others
    assert publish(spark.table(name).filter("id > 4").drop("note"), name, ["kind"]) == f"{name}__v3"
    assert sorted(r.id for r in spark.table(name).collect()) == [5, 6, 7, 8, 9]
    assert spark.table(name).columns == ["id", "kind"]
    assert expire_published(spark, name, keep=1) == [f"{name}__v1"]
    assert expire_published(spark, name, keep=0) == [f"{name}__v2"]
    assert spark.table(name).count() == 5
    plan = spark.table(name).filter(F.col("kind") == 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(kind" in plan

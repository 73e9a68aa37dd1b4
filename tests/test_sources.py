import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from smelter import IngestConfig, PipelineConfig
from smelter.operators.shape import (
    align_to_schema,
    dimension_key,
    explode_rows,
    flatten,
    normalise_status,
    preview,
    with_constants,
)
from smelter.plans.ingest import ingest, ingest_clicks
from smelter.sources.landing import read_landing, require_rows, with_file_metadata
from smelter.sources.pages import (
    PAGE_SCHEMA,
    flatten_pages,
    flatten_variant_pages,
    read_json_pages,
    read_variant_pages,
)

CSV = "order_id,order_status,quantity,paid,at,day\n1, Shipped ,2,10.50,2024-01-05 10:00:00,2024-01-05\n2,,3,1,2024-01-06 11:00:00,\n"
LINEAGE = [
    "_source_file",
    "_source_file_name",
    "_source_file_modified_at",
    "_ingested_at",
    "_source_name",
    "_source_system",
    "_source_format",
    "_batch_id",
]


@pytest.fixture
def csv(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "orders.csv").write_text(CSV)
    return str(folder)


def test_csv_types_are_inferred(spark, csv):
    assert read_landing(spark, csv, "csv").dtypes == [
        ("order_id", "int"),
        ("order_status", "string"),
        ("quantity", "int"),
        ("paid", "double"),
        ("at", "timestamp"),
        ("day", "date"),
    ]


def test_a_schema_spares_inference(spark, csv):
    ddl = "order_id bigint, order_status string, quantity int, paid decimal(12,2), at string, day string"
    read = read_landing(spark, csv, "csv", ddl)
    assert dict(read.dtypes)["paid"] == "decimal(12,2)" and read.count() == 2


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_other_formats(spark, tmp_path, fmt):
    spark.range(3).write.format(fmt).save(str(tmp_path / fmt))
    read = read_landing(spark, str(tmp_path / fmt), fmt)
    assert sorted(r.id for r in read.collect()) == [0, 1, 2]


def test_formats_that_cannot_be_read(spark, tmp_path):
    with pytest.raises(ValueError, match="format"):
        read_landing(spark, str(tmp_path), "xml")
    with pytest.raises(RuntimeError, match="spark-avro"):
        read_landing(spark, str(tmp_path), "avro")


def test_file_metadata(spark, csv):
    row = with_file_metadata(read_landing(spark, csv)).first()
    assert row._source_file_name == "orders.csv" and row._source_file.endswith("/orders.csv")
    assert isinstance(row._source_file_modified_at, datetime)


def test_require_rows(spark):
    assert require_rows(spark.range(1), "here").count() == 1
    with pytest.raises(ValueError, match="no rows in here"):
        require_rows(spark.range(0), "here")


def test_ingest(spark, csv, database):
    name = f"{database}.orders"
    config = IngestConfig(csv, name, "orders", "ERP", "b1")
    first = ingest(spark, config)
    assert first.columns == ["order_id", "quantity", "paid", "at", "day", *LINEAGE, "status"]
    row = first.orderBy("order_id").first()
    assert (row.status, row._source_name, row._source_system, row._source_format, row._batch_id) == (
        "SHIPPED",
        "orders",
        "ERP",
        "csv",
        "b1",
    )
    again = ingest(spark, IngestConfig(csv, name, "orders", "ERP", "b2", "append"))
    assert again.count() == 4
    assert ingest(spark, config).count() == 2


def test_ingest_casts_to_the_tables_types(spark, csv, tmp_path, database):
    name = f"{database}.orders"
    ingest(spark, IngestConfig(csv, name, "orders", "ERP", "b1"))
    other = tmp_path / "other"
    other.mkdir()
    (other / "o.json").write_text('{"order_id": "7", "order_status": "new", "extra": true}')
    loaded = ingest(
        spark, IngestConfig(str(other), name, "orders", "ERP", "b2", "append", "json")
    )
    assert dict(loaded.dtypes)["order_id"] == "int"
    row = loaded.filter("order_id = 7").first()
    assert (row.status, row.extra, row.quantity) == ("NEW", True, None)


def test_empty_landing(spark, tmp_path, database):
    spark.range(0).write.parquet(str(tmp_path / "none"))
    with pytest.raises(ValueError, match="no rows"):
        ingest(spark, IngestConfig(str(tmp_path / "none"), f"{database}.t", "s", "ERP", "b", source_format="parquet"))


def test_config():
    assert IngestConfig("p", "t", "s", "ERP", "b").load_mode == "overwrite"
    assert PipelineConfig().gold == "gold"
    with pytest.raises(TypeError):
        IngestConfig("p")
    for bad in ({"load_mode": "upsert"}, {"source_format": "orc"}, {"landing_path": ""}):
        with pytest.raises(ValueError):
            IngestConfig(**{"landing_path": "p", **dict.fromkeys(("target_table", "source_name", "source_system", "batch_id"), "x"), **bad})


def test_align_to_schema(spark):
    df = spark.sql("SELECT '5' AS n, 'x' AS extra")
    aligned = align_to_schema(df, StructType.fromDDL("n int, absent string"))
    assert aligned.dtypes == [("n", "int"), ("extra", "string")] and tuple(aligned.first()) == (5, "x")


def test_normalise_status(spark):
    df = spark.sql("SELECT ' Shipped ' AS order_status, 'old' AS status")
    assert normalise_status(df).first().asDict() == {"status": "SHIPPED"}
    assert normalise_status(df.drop("order_status")).first().asDict() == {"status": "old"}


def test_small_shapes(spark):
    df = spark.sql("SELECT 1 AS id, array(struct('a' AS x), struct('b' AS x)) AS l")
    events = flatten(explode_rows(df, "l", "e"), "e", {"x": "y"})
    assert sorted(map(tuple, events.collect())) == [("a", 1), ("b", 1)]
    assert with_constants(df, {"c": "z"}).first().c == "z"
    key = df.select(*dimension_key("id", "the_key"))
    assert key.dtypes == [("the_key", "bigint"), ("id", "bigint")]
    numbers = spark.range(10)
    assert [r.id for r in preview(numbers, 2, F.desc("id")).collect()] == [9, 8]


PAGE = {
    "page": 1,
    "page_size": 2,
    "total_pages": 3,
    "total_records": 5,
    "events": [
        {"event_id": 1, "customer_id": 7, "event_type": "click", "page": "/a", "business_date": "2024-01-01"},
        {"event_id": 2, "customer_id": 7, "event_type": "click", "page": "/b", "business_date": "soon"},
        {"event_id": 2, "customer_id": 7, "event_type": "click", "page": "/b", "business_date": "soon"},
    ],
}


def pages(folder, *documents):
    folder.mkdir()
    for number, document in enumerate(documents):
        (folder / f"{number}.json").write_text(json.dumps(document, indent=2))
    return str(folder)


def test_pages(spark, tmp_path):
    folder = pages(tmp_path / "p", PAGE, {**PAGE, "events": []}, {**PAGE, "events": None})
    read = read_json_pages(spark, folder, PAGE_SCHEMA)
    events = flatten_pages(read).orderBy("event_id")
    first = events.first()
    assert read.count() == 3 and events.count() == 3
    assert (first.page_name, first.source_page, first.page_size, first.session_id) == ("/a", 1, 2, None)
    assert [str(r.business_date) for r in events.collect()] == ["2024-01-01", "None", "None"]


def test_ingest_clicks_keeps_known_events(spark, tmp_path, database):
    name = f"{database}.click_events"
    first = pages(tmp_path / "a", PAGE)
    assert ingest_clicks(spark, first, name, PAGE_SCHEMA).count() == 2
    changed = [{**e, "page": "/new"} for e in PAGE["events"]] + [{"event_id": 3, "page": "/c"}]
    second = pages(tmp_path / "b", {**PAGE, "events": changed})
    loaded = ingest_clicks(spark, second, name, PAGE_SCHEMA).orderBy("event_id")
    assert [(r.event_id, r.page_name) for r in loaded.collect()] == [(1, "/a"), (2, "/b"), (3, "/c")]


def test_pages_whose_types_change(spark, tmp_path):
    """Each document keeps its types; what doesn't fit is named, and torn files have their text."""
    pages = [
        {"page": 1, "events": [{"event_id": 1, "customer_id": 7, "page": "/a", "business_date": "2024-01-05"}]},
        {"page": "2", "events": [{"event_id": "2", "customer_id": "x", "page": {"deep": 1}}, {"event_id": None}]},
        {"page": 3, "events": "none"},
        {"page": 4},
    ]
    for i, page in enumerate(pages):
        (tmp_path / f"{i}.json").write_text(json.dumps(page, indent=1))
    (tmp_path / "torn.json").write_text('{"page": 5, "events": [')
    read = read_variant_pages(spark, str(tmp_path))
    (torn,) = read.filter("text IS NOT NULL").collect()
    assert torn.text.startswith('{"page": 5') and torn._source_file.endswith("torn.json")
    rows = flatten_variant_pages(read).orderBy("source_page", F.desc("event_id")).collect()
    assert [(r.source_page, r.event_id, r.customer_id, r._misfits) for r in rows] == [
        (1, 1, 7, []), (2, 2, None, ["customer_id"]), (2, None, None, []),
    ]
    assert [r.page_name for r in rows] == ["/a", '{"deep":1}', None]
    assert str(rows[0].business_date) == "2024-01-05"


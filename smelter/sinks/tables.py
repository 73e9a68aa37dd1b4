"""Catalog tables over parquet folders.

A table cannot be overwritten while it is read, so an overwrite writes a new folder
``v<n>-...`` beside the old one and points the table there. With an unchanged or
widened schema that is one catalog operation; with another schema the table is
dropped and created, and readers may miss it in between. The files of older versions
stay, and a reader that has begun goes on with them. One writer per table is assumed.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from smelter.constants import LOAD_MODES
from smelter.operators.merge import (
    NULL_KEYS,
    changed,
    digest,
    join_keys,
    prepared_source,
    require_unique,
    unmatched,
    untouched,
)
from smelter.operators.likely import KeyBits, bits_if_worth, likely
from smelter.operators.rules import all_present
from smelter.operators.shape import align_to_schema
from smelter.scratch import discard, list_folders, remove_folder, stage
from smelter.sources.catalog import table_exists


class Layout(NamedTuple):
    """How the files of a table are laid out: by the values of columns, or by the hash
    of columns into a number of buckets, which spares joins on these a shuffle."""

    partition_by: tuple[str, ...] = ()
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0

    @classmethod
    def of(
        cls,
        partition_by: Sequence[str] | None = None,
        bucket_by: Sequence[str] | None = None,
        buckets: int | None = None,
    ) -> Layout:
        layout = cls(tuple(partition_by or ()), tuple(bucket_by or ()), buckets or 0)
        if bool(layout.bucket_by) != bool(layout.buckets):
            raise ValueError("buckets need columns and a number")
        if layout.partition_by and layout.bucket_by:
            raise ValueError("a table is partitioned or bucketed, not both")
        return layout

    def grouped(self, df: DataFrame) -> DataFrame:
        """Rows of one partition or bucket brought together before they are written. A
        rebalance, unlike a hash repartition, splits partitions much larger than others."""
        if self.partition_by:
            return df.hint("rebalance", *self.partition_by)
        return df.repartition(self.buckets, *self.bucket_by) if self.buckets else df

    def clause(self) -> str:
        def listed(columns: Sequence[str]) -> str:
            return "(" + ", ".join(f"`{c}`" for c in columns) + ")"

        if self.partition_by:
            return f"PARTITIONED BY {listed(self.partition_by)}"
        if self.buckets:
            columns = listed(self.bucket_by)
            return f"CLUSTERED BY {columns} SORTED BY {columns} INTO {self.buckets} BUCKETS"
        return ""


def _parts(name: str) -> tuple[str, str]:
    *database, table = name.replace("`", "").split(".")
    return (database[-1] if database else ""), table


def _detail(spark: SparkSession, name: str, item: str) -> str | None:
    """A line of the table's description; the last one, as a column may have that name."""
    lines = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter(F.col("col_name") == item)
    found = lines.select("data_type").collect()
    return found[-1][0] if found else None


def table_location(spark: SparkSession, name: str) -> str:
    return _detail(spark, name, "Location")


def table_version(spark: SparkSession, name: str) -> int:
    """Number of the folder a table points to, 0 for a folder from elsewhere."""
    found = re.search(r"/v(\d+)-[0-9a-f]+/?$", table_location(spark, name) or "")
    return int(found.group(1)) if found else 0


def table_layout(spark: SparkSession, name: str) -> Layout:
    columns = spark.catalog.listColumns(name)
    bucketed = [c.name for c in columns if c.isBucket]
    number = int(_detail(spark, name, "Num Buckets")) if bucketed else 0
    return Layout.of([c.name for c in columns if c.isPartition], bucketed, number)


def _root(spark: SparkSession, name: str) -> str:
    database, table = _parts(name)
    uri = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{uri.rstrip('/')}/{table}"


def _new_version(spark: SparkSession, name: str) -> str:
    number = table_version(spark, name) + 1 if table_exists(spark, name) else 1
    return f"{_root(spark, name)}/v{number}-{uuid.uuid4().hex[:8]}"


def _write(df: DataFrame, path: str, layout: Layout, name: str) -> None:
    """Write rows that are grouped already. Spark writes buckets to a table only, so
    one of another name is made for it and given up, its files staying."""
    if layout.partition_by:
        df.write.partitionBy(*layout.partition_by).parquet(path)
    elif layout.buckets:
        passing = f"{name}_{uuid.uuid4().hex[:8]}"
        first, *others = layout.bucket_by
        writer = df.write.format("parquet").option("path", path)
        writer = writer.bucketBy(layout.buckets, first, *others).sortBy(first, *others)
        writer.saveAsTable(passing)
        df.sparkSession.sql(f"DROP TABLE {passing}")
    else:
        df.write.parquet(path)


def _text_literal(value: object) -> str:
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def _ddl(fields: Sequence[StructField]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def _shape(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def _publish(
    spark: SparkSession, name: str, path: str, schema: StructType, layout: Layout
) -> None:
    if table_exists(spark, name) and not layout.partition_by and table_layout(spark, name) == layout:
        present = _shape(spark.table(name).schema)
        wanted = _shape(schema)
        if wanted[: len(present)] == present:
            added = schema.fields[len(present) :]
            if added:
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_ddl(added)})")
            spark.sql(f"ALTER TABLE {name} SET LOCATION {_text_literal(path)}")
            spark.catalog.refreshTable(name)
            return
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({_ddl(schema.fields)}) USING parquet {layout.clause()}"
        f" LOCATION {_text_literal(path)}"
    )
    if layout.partition_by:
        spark.catalog.recoverPartitions(name)


def _replace(grouped: DataFrame, name: str, layout: Layout) -> None:
    """Point the table to a new folder with these rows."""
    spark = grouped.sparkSession
    path = _new_version(spark, name)
    _write(grouped, path, layout, name)
    _publish(spark, name, path, grouped.schema, layout)


def _overwrite(df: DataFrame, name: str, replace_schema: bool, layout: Layout) -> None:
    spark = df.sparkSession
    if table_exists(spark, name):
        if not replace_schema:
            present, wanted = (sorted(_shape(s)) for s in (spark.table(name).schema, df.schema))
            if present != wanted:
                raise ValueError(f"schema of {name} would change from {present} to {wanted}")
            df = df.select(*spark.table(name).columns)
        if layout == Layout():
            layout = table_layout(spark, name)
            if not {*layout.partition_by, *layout.bucket_by} <= {*df.columns}:
                layout = Layout()
    _replace(layout.grouped(df), name, layout)


def _widened(aligned: DataFrame, name: str) -> DataFrame:
    """The table, after adding the columns that only ``aligned`` has."""
    spark = aligned.sparkSession
    target = spark.table(name)
    added = [f for f in aligned.schema.fields if f.name not in target.columns]
    if added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_ddl(added)})")
    return spark.table(name)


def _append(df: DataFrame, name: str) -> None:
    """Add files to the folder; columns new to the table read as NULL in its older files."""
    spark = df.sparkSession
    aligned = align_to_schema(df, spark.table(name).schema)
    target = _widened(aligned, name)
    values = [
        F.col(f"`{f.name}`")
        if f.name in aligned.columns
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in target.schema.fields
    ]
    rows = aligned.select(*values)
    table_layout(spark, name).grouped(rows).write.insertInto(name)


def save_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    replace_schema: bool = True,
    partition_by: Sequence[str] | None = None,
    bucket_by: Sequence[str] | None = None,
    buckets: int | None = None,
    audit_table: str | None = None,
) -> None:
    """Write ``df`` as catalog table ``name``.

    "overwrite" replaces rows and, unless forbidden, the schema; "append" adds rows
    and new columns. A table keeps its layout unless an overwrite names another one.
    """
    if mode not in LOAD_MODES:
        raise ValueError(f"mode {mode!r} is none of {LOAD_MODES}")
    spark = df.sparkSession
    adds = mode == "append" and table_exists(spark, name)
    # Counts of stored rows come from the footers of their files
    kept = spark.table(name).count() if adds and audit_table else 0
    if adds:
        _append(df, name)
    else:
        _overwrite(df, name, replace_schema, Layout.of(partition_by, bucket_by, buckets))
    if audit_table:
        written = spark.table(name).agg((F.count("*") - kept).alias("rows_inserted"))
        counts = written.withColumns({"rows_updated": F.lit(0), "rows_kept": F.lit(kept)})
        record_load(counts, audit_table, name, mode)


def _in_partitions(columns: Sequence[str], values: Sequence[tuple]) -> Column:
    """Filter that prunes partitions; NULL is a value as well."""

    def one(column: str, among: Sequence[object]) -> Column:
        known = [v for v in among if v is not None]
        chosen = F.col(column).isin(*known) if known else F.lit(False)
        return chosen | F.col(column).isNull() if len(known) < len(among) else chosen

    first, *others = columns
    if not others:
        return one(first, [v for (v,) in values])
    under: dict[object, list[tuple]] = {}
    for value, *rest in values:
        under.setdefault(value, []).append(tuple(rest))
    return reduce(or_, [one(first, [v]) & _in_partitions(others, rest) for v, rest in under.items()])


def _partition_folders(written: DataFrame, columns: Sequence[str]) -> dict[tuple, str]:
    """Folder of each partition, from the names of the files."""
    folder = F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]*$", 1)
    plain = F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))
    rows = written.select(*columns, plain).distinct().collect()
    return {tuple(row)[:-1]: row[-1] for row in rows}


def _kept(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    null_keys: str,
    bits: KeyBits | None,
    number: int,
) -> DataFrame:
    """Target rows whose key the batch, of ``number`` rows, lacks. With ``bits`` only likely ones meet
    the batch in a shuffle; the target is read once for these and once for the others."""
    if bits is None:
        return untouched(target, batch, keys, null_keys, number)
    sure = likely(target, bits, keys, otherwise=True)
    return sure.unionByName(untouched(likely(target, bits, keys), batch, keys, null_keys, number))


def _upsert_partitions(
    batch: DataFrame,
    matched: DataFrame,
    name: str,
    keys: Sequence[str],
    null_keys: str,
    bits: KeyBits | None,
    number: int,
) -> None:
    """Rewrite only partitions that hold a key of the batch; append to all others.

    Their number is that of the table's partitions at most, which the catalog
    lists anyway. Columns that the batch brings are added before anything is written.
    Each rewritten partition moves to its new folder in one step. Rows moving to another
    partition are added there before they leave the old one: after a crash they may
    be held twice until the batch is merged again, but never lost.
    """
    spark = batch.sparkSession
    layout = table_layout(spark, name)
    columns = layout.partition_by
    stale = [tuple(row) for row in matched.select(*columns).distinct().collect()]
    target = _widened(batch, name)
    chosen = F.coalesce(_in_partitions(columns, stale), F.lit(False)) if stale else F.lit(False)
    rest = batch.filter(~chosen)
    if not rest.isEmpty():
        _append(rest, name)
    if not stale:
        return
    merged = _kept(target.filter(chosen), batch, keys, null_keys, bits, number).unionByName(
        batch.filter(chosen), allowMissingColumns=True
    )
    path = f"{_root(spark, name)}/merge-{uuid.uuid4().hex[:8]}"
    _write(layout.grouped(merged), path, layout, name)
    folders = _partition_folders(spark.read.schema(merged.schema).parquet(path), columns)
    for values in stale:
        parts = [
            f"`{c}` = {'null' if v is None else _text_literal(v)}" for c, v in zip(columns, values)
        ]
        spec = f"PARTITION ({', '.join(parts)})"
        if values in folders:
            location = _text_literal(folders[values])
            spark.sql(f"ALTER TABLE {name} {spec} SET LOCATION {location}")
        else:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {spec}")
    spark.catalog.refreshTable(name)


def merge_counts(target: DataFrame, batch: DataFrame, matched: DataFrame) -> DataFrame:
    """Rows a merge of ``batch`` inserts, updates and keeps; ``matched``: target rows with its keys."""
    one = [
        df.agg(F.count("*").alias("n")).select(F.lit(label).alias("label"), "n")
        for label, df in (("matched", matched), ("present", target), ("arrived", batch))
    ]
    n = {
        label: F.sum(F.when(F.col("label") == label, F.col("n")))
        for label in ("matched", "present", "arrived")
    }
    return reduce(DataFrame.unionAll, one).agg(
        (n["arrived"] - n["matched"]).alias("rows_inserted"),
        n["matched"].alias("rows_updated"),
        (n["present"] - n["matched"]).alias("rows_kept"),
    )


def record_load(counts: DataFrame, audit_table: str, name: str, operation: str) -> None:
    """Append one row about a write to ``audit_table``; ``version`` numbers a table's writes."""
    spark = counts.sparkSession
    before = 0
    if table_exists(spark, audit_table):
        written = spark.table(audit_table).filter(F.col("table_name") == name)
        before = written.agg(F.max("version")).first()[0] or 0
    row = counts.select(
        F.lit(name).alias("table_name"),
        F.lit(before + 1).cast("long").alias("version"),
        F.lit(operation).alias("operation"),
        *[F.col(c).cast("long").alias(c) for c in ("rows_inserted", "rows_updated", "rows_kept")],
        F.current_timestamp().alias("loaded_at"),
    )
    save_table(row.coalesce(1), audit_table, mode="append")


def _require_keys(rows: DataFrame, keys: Sequence[str]) -> None:
    if not rows.filter(~all_present(keys)).isEmpty():
        raise ValueError("rows without a key would all lie in one bucket: drop or key them")


def _create_unique(first: DataFrame, name: str, keys: Sequence[str], null_keys: str) -> None:
    """Create a plain table. Its files are written once, and checked before the table names them."""
    spark = first.sparkSession
    path = _new_version(spark, name)
    _write(first, path, Layout(), name)
    try:
        require_unique(spark.read.schema(first.schema).parquet(path), keys, null_keys)
    except ValueError:
        remove_folder(spark, path)
        raise
    _publish(spark, name, path, first.schema, Layout())


def create_or_merge(
    df: DataFrame,
    name: str,
    keys: Sequence[str],
    how: str = "upsert",
    null_keys: str = "insert",
    partition_by: Sequence[str] | None = None,
    buckets: int | None = None,
    audit_table: str | None = None,
    check_unique: bool = True,
    skip_same: Sequence[str] | None = None,
) -> DataFrame:
    """Create table ``name`` from ``df``, or merge ``df`` into it; returns this batch's rows.

    The batch is written once and read from there by the check, the join and the
    caller; so are the keys of the table that the batch asks for, in one look at the table.
    What has to be written of the table depends on them: with only unseen keys files
    are added, a partitioned table gets the partitions with changed rows written anew, and
    any other is rewritten whole. ``buckets`` lays a new table out by its keys, so that no
    merge has to shuffle it, however large the batch; it suits tables whose changes
    fall into all partitions, and takes no rows without a key. ``check_unique`` may be
    turned off for a batch known to hold each key once. ``skip_same`` leaves out of an upsert
    (and of what is returned) rows that equal the table's in all columns but these, such as times
    of processing: then a batch costs what it changes.
    """
    if how not in ("upsert", "insert"):
        raise ValueError(f"how {how!r} is neither 'upsert' nor 'insert'")
    if null_keys not in NULL_KEYS:
        raise ValueError(f"null_keys {null_keys!r} is none of {NULL_KEYS}")
    spark = df.sparkSession
    if not table_exists(spark, name):
        by_key = keys if buckets else None
        first = df.filter(all_present(keys)) if null_keys == "drop" else df
        if check_unique and not (partition_by or buckets):
            _create_unique(first, name, keys, null_keys)
        else:
            if check_unique or buckets:
                first = stage(first, "batch")
            if buckets:
                _require_keys(first, keys)
            if check_unique:
                require_unique(first, keys, null_keys)
            save_table(first, name, partition_by=partition_by, bucket_by=by_key, buckets=buckets)
            if check_unique or buckets:
                discard(first)
        created = spark.table(name)
        if audit_table:
            counts = created.agg(F.count("*").alias("rows_inserted")).select(
                "rows_inserted", F.lit(0).alias("rows_updated"), F.lit(0).alias("rows_kept")
            )
            record_load(counts, audit_table, name, "create")
        return created

    target = spark.table(name)
    layout = table_layout(spark, name)
    batch = stage(prepared_source(target, df, keys, null_keys), "batch")
    if layout.buckets:
        _require_keys(batch, keys)
    if how == "upsert" and check_unique:
        require_unique(batch, keys, null_keys)
    placed = [*dict.fromkeys([*layout.partition_by, *keys])]
    # A batch whose keys are too many to broadcast asks by bits first; buckets need no shuffle anyway
    number = batch.count()
    bits = None if layout.buckets else bits_if_worth(batch, keys, null_keys, rows=target.count())
    asked = target if bits is None else likely(target, bits, keys)
    compares = skip_same is not None and how == "upsert" and set(batch.columns) == set(target.columns)
    if compares:
        seen = digest([c for c in target.columns if c not in (*keys, *skip_same)])
        looked_at = asked.select(*placed, seen.alias("_same"))
        found = stage(join_keys(looked_at, batch, keys, "left_semi", null_keys, number), "matched")
        fresh = changed(batch.withColumn("_same", seen), found, keys, "_same", null_keys, found.count())
        batch = stage(fresh.select(*batch.columns), "changed")
        number = batch.count()
        matched = stage(join_keys(found, batch, keys, "left_semi", null_keys, number).drop("_same"), "matched")
        discard(found)
    else:
        asked = asked.select(*placed)
        matched = stage(join_keys(asked, batch, keys, "left_semi", null_keys, number), "matched")
    counts = None
    if how == "insert":
        fresh = unmatched(batch, matched, keys, null_keys, matched.count())
        if audit_table:
            counts = stage(merge_counts(target, fresh, matched.limit(0)), "audit")
        _append(fresh, name)
    else:
        if audit_table:
            counts = stage(merge_counts(target, batch, matched), "audit")
        if layout.partition_by:
            _upsert_partitions(batch, matched, name, keys, null_keys, bits, number)
        elif matched.isEmpty():
            _append(batch, name)
        else:
            kept = _kept(target, batch, keys, null_keys, bits, number)
            if layout.buckets:
                # rows kept from buckets are in buckets still
                merged = kept.unionByName(layout.grouped(batch), allowMissingColumns=True)
            else:
                merged = layout.grouped(kept.unionByName(batch, allowMissingColumns=True))
            _replace(merged, name, layout)
    discard(matched)
    if bits is not None:
        discard(bits.blocks)
    if counts is not None:
        record_load(counts, audit_table, name, f"merge {how}")
        discard(counts)
    return batch


def expire_versions(spark: SparkSession, name: str, keep: int = 1) -> list[str]:
    """Remove folders of earlier versions of a table but the last ``keep``; returns what went.

    The folder the table points to and folders that hold one of its partitions stay. Only
    for times when no one reads an earlier version.
    """
    if keep < 0:
        raise ValueError("keep must not be negative")
    plain = lambda path: re.sub(r"^file:/*", "/", path).rstrip("/")
    used = [plain(table_location(spark, name))]
    if table_layout(spark, name).partition_by:
        files = spark.table(name).select(F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1).alias("f"))
        # One row for each folder of the table, which the catalog lists as well
        used += [plain(r.f) for r in files.distinct().collect()]
    number = re.compile(r"/(?:v(\d+)|merge)-[0-9a-f]+$")
    folders = [f for f in list_folders(spark, _root(spark, name)) if number.search(f)]
    idle = [f for f in folders if not any(f"{u}/".startswith(f"{plain(f)}/") for u in used)]
    idle.sort(key=lambda f: int(number.search(f).group(1) or 0))
    gone = idle[: max(0, len(idle) - keep)]
    for folder in gone:
        remove_folder(spark, folder)
    return gone


def export_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Publish ``df`` as a parquet folder in place of what was there."""
    writer = Layout.of(partition_by).grouped(df).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)

"""Insert and upsert merges as joins, and the count of what a merge changed.

Columns of the target that the source lacks are an error, columns only the source
has are added and NULL on rows kept from the target. A NULL key equals no other
key: under ``null_keys="insert"`` such source rows are added on every merge, under
``"drop"`` they are left out. Under ``"match"`` NULL is a key like any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from smelter.operators.quality import duplicate_keys
from smelter.operators.rules import all_present
from smelter.operators.shape import align_to_schema
from smelter.scratch import by_rows, driver_memory, stage

NULL_KEYS = ("insert", "drop", "match")
# Keys take a few times their own bytes when broadcast, and pass through the driver more than once
SHARE_OF_DRIVER = 32


def most_broadcast(spark: SparkSession) -> int:
    """Bytes of keys, or of rows as narrow, that the driver can take as a broadcast."""
    return driver_memory(spark) // SHARE_OF_DRIVER


def prepared_source(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_keys: str = "insert"
) -> DataFrame:
    """``source`` with the target's types, checked for missing columns."""
    if null_keys not in NULL_KEYS:
        raise ValueError(f"null_keys {null_keys!r} is none of {NULL_KEYS}")
    aligned = align_to_schema(source, target.schema)
    absent = [c for c in target.columns if c not in aligned.columns]
    if absent:
        raise ValueError(f"source lacks target columns {absent}")
    return aligned.filter(all_present(keys)) if null_keys == "drop" else aligned


def require_unique(source: DataFrame, keys: Sequence[str], null_keys: str = "insert") -> None:
    """Two source rows for one key leave open which one updates the target row."""
    keyed = source if null_keys == "match" else source.filter(all_present(keys))
    twice = duplicate_keys(keyed, *keys).select(*keys).take(1)
    if twice:
        raise ValueError(f"source holds key {twice[0].asDict()} more than once")


def join_keys(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    null_keys: str = "insert",
    number: int | None = None,
) -> DataFrame:
    """Semi or anti join on ``keys``. Rows of ``right`` that can match nothing stay out of it.

    ``number`` tells how many rows ``right`` has, where that is known: more than the driver can
    take are not broadcast, however small their files.
    """

    def weighed(others: DataFrame) -> DataFrame:
        return others if number is None else by_rows(others, number, most_broadcast(others.sparkSession))

    if null_keys != "match":
        return left.join(weighed(right.filter(all_present(keys)).select(*keys)), list(keys), how)
    named = weighed(right.select(*[F.col(k).alias(f"_other_{k}") for k in keys]))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_other_{k}")) for k in keys])
    return left.join(named, same, how)


def with_match(left: DataFrame, right: DataFrame, key: str, flag: str) -> DataFrame:
    """``left`` with a flag that tells if ``right`` holds a row's key: all rows, in one join."""
    held = right.filter(F.col(key).isNotNull()).select(key).distinct().withColumn(flag, F.lit(True))
    return left.join(held, [key], "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def unseen(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_keys: str = "insert"
) -> DataFrame:
    """Source rows whose key the target lacks.

    The target is first cut down to the keys the batch asks for: with a small batch
    that is a broadcast filter on its key column, and the target is not shuffled.
    """
    return unmatched(source, join_keys(target, source, keys, "left_semi", null_keys), keys, null_keys)


def unmatched(
    rows: DataFrame,
    others: DataFrame,
    keys: Sequence[str],
    null_keys: str = "insert",
    number: int | None = None,
) -> DataFrame:
    """Rows whose key ``others`` lack. Rows without a key pass by the join, which would
    send them all to one task. ``number``: see ``join_keys``."""
    if null_keys == "match":
        return join_keys(rows, others, keys, "left_anti", null_keys, number)
    without = rows.filter(~all_present(keys))
    kept = join_keys(rows.filter(all_present(keys)), others, keys, "left_anti", number=number)
    return kept.unionByName(without)


def untouched(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    null_keys: str = "insert",
    number: int | None = None,
) -> DataFrame:
    """Target rows whose key the source lacks; only the source's keys meet the target.

    One scan of the target; its hot keys are split at run time. ``number``: see ``join_keys``.
    """
    return join_keys(target, source, keys, "left_anti", null_keys, number)


def merge_insert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_keys: str = "insert"
) -> DataFrame:
    """Target rows as they are, plus source rows with a key the target lacks."""
    batch = prepared_source(target, source, keys, null_keys)
    return target.unionByName(unseen(target, batch, keys, null_keys), allowMissingColumns=True)


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    null_keys: str = "insert",
    check_unique: bool = True,
) -> DataFrame:
    """Source rows, plus target rows with a key the source lacks.

    The check runs a job over the source, which is read again for the merge: pass a
    staged source where it is dear to compute.
    """
    batch = prepared_source(target, source, keys, null_keys)
    if check_unique:
        require_unique(batch, keys, null_keys)
    return untouched(target, batch, keys, null_keys).unionByName(batch, allowMissingColumns=True)


def changed(
    batch: DataFrame,
    matched: DataFrame,
    keys: Sequence[str],
    same: str,
    null_keys: str = "insert",
    number: int | None = None,
) -> DataFrame:
    """Rows of ``batch`` whose key ``matched`` lacks or has with another digest.

    ``matched`` has the keys and, as ``same``, the digest of the target's row, which
    ``batch`` carries as well; the column is dropped. ``number``: see ``join_keys``.
    """
    return unmatched(batch, matched, [*keys, same], null_keys, number).drop(same)


def digest(columns: Sequence[str]) -> Column:
    """128 bits that stand for the values of ``columns``.

    The hash passes over NULLs, hence the markers that keep (NULL, 1) from (1, NULL).
    """
    marked = [part for c in columns for part in (F.col(c), F.col(c).isNull())]
    return F.struct(F.xxhash64(F.lit(1), *marked), F.xxhash64(F.lit(2), *marked))


def changes(
    before: DataFrame, after: DataFrame, keys: Sequence[str], ignore: Sequence[str] = ()
) -> DataFrame:
    """What changed between two states of a table, row by row: (keys, change, old, new).

    ``change`` is "insert", "update" or "delete"; ``old`` and ``new`` are structs of the other columns of
    ``after``. Equal rows are found by digest and never joined: of these only keys and
    digests travel, and rows are fetched for keys that changed. A NULL key is a key like any other.
    Rows that share a key are told apart by number, the spare ones on one side being inserts or deletes;
    ``ignore`` names columns that make no change.
    """
    values = [c for c in after.columns if c not in keys]
    compared = [c for c in values if c not in ignore]
    lacking = {f.name: f.dataType for f in after.schema.fields if f.name not in before.columns}
    known = before.withColumns({c: F.lit(None).cast(t) for c, t in lacking.items()})
    same_type = align_to_schema(known, after.schema).select(*after.columns)
    marked = {
        sign: df.select(*keys, F.struct(*values).alias("_row"), digest(compared).alias("_digest"))
        for sign, df in ((-1, same_type), (1, after))
    }
    signed = [df.select(*keys, "_digest", F.lit(sign).alias("_sign")) for sign, df in marked.items()]
    surplus = signed[0].unionAll(signed[1]).groupBy(*keys, "_digest").agg(F.sum("_sign").alias("_n"))
    surplus = stage(surplus.filter("_n != 0"), "changes")
    other = surplus.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_digest").alias("_same"), "_n"
    )
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])

    def fetched(sign: int) -> DataFrame:
        wanted = other.filter(F.col("_n") * sign > 0).withColumn("_n", F.abs("_n"))
        rows = marked[sign].join(wanted, same & (F.col("_digest") == F.col("_same")))
        one = rows.groupBy(*keys, "_digest").agg(F.first("_row").alias("_row"), F.first("_n").alias("_n"))
        copies = F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_copy")
        each = one.select(*keys, "_digest", "_row", copies)
        number = F.row_number().over(Window.partitionBy(*keys).orderBy("_digest", "_copy"))
        side = "old" if sign < 0 else "new"
        empty = F.lit(None).cast(each.schema["_row"].dataType)
        sides = [(F.col("_row") if s == side else empty).alias(s) for s in ("old", "new")]
        return each.select(*keys, number.alias("_number"), *sides)

    paired = fetched(-1).unionAll(fetched(1)).groupBy(*keys, "_number")
    both = paired.agg(*[F.first(s, ignorenulls=True).alias(s) for s in ("old", "new")])
    kind = F.when(F.col("old").isNull(), "insert").when(F.col("new").isNull(), "delete")
    return both.select(*keys, kind.otherwise("update").alias("change"), "old", "new")


def load_audit(
    before: DataFrame,
    after: DataFrame,
    keys: Sequence[str],
    ignore: Sequence[str] = (),
) -> DataFrame:
    """Rows inserted, updated, kept and gone between two states of a table, one row.

    A row is updated when its key stays and any other column not in ``ignore``
    changes. States are counted per key and digest and never joined, so that rows
    sharing a key (or having none) are matched up by number, not in pairs.
    """
    compared = [c for c in after.columns if c not in keys and c not in ignore]
    lacking = {f.name: f.dataType for f in after.schema.fields if f.name not in before.columns}
    known = before.withColumns({c: F.lit(None).cast(t) for c, t in lacking.items()})

    def digested(df: DataFrame, was: int) -> DataFrame:
        return df.select(*keys, digest(compared).alias("digest"), F.lit(was).alias("was"))

    same_type = align_to_schema(known, after.schema)
    per_row = (
        digested(same_type, 1)
        .unionAll(digested(after, 0))
        .groupBy(*keys, "digest")
        .agg(F.sum("was").alias("old"), F.sum(1 - F.col("was")).alias("new"))
    )
    kept = F.least("old", "new")
    per_key = per_row.groupBy(*keys).agg(
        F.sum(kept).alias("kept"),
        F.sum(F.col("old") - kept).alias("only_old"),
        F.sum(F.col("new") - kept).alias("only_new"),
    )
    updated = F.least("only_old", "only_new")

    def total(rows: Column) -> Column:
        return F.coalesce(F.sum(rows), F.lit(0))

    return per_key.agg(
        total(F.col("only_new") - updated).alias("rows_inserted"),
        total(updated).alias("rows_updated"),
        total(F.col("kept")).alias("rows_kept"),
        total(F.col("only_old") - updated).alias("rows_gone"),
    )

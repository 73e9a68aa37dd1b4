"""Distinct counts that can be kept and added to: exact, and without reading old rows again.

Each distinct value gets a number once, which it keeps; a group's values are then a bitmap over
these numbers, in rows of 4 KB for 32768 numbers. Bitmaps of two batches are united bit by bit, and the
count of a group is the number of its bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smelter.scratch import stage


def numbered(values: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(value, number): those of ``known``, and the distinct values of the one column of ``values`` that it lacks.

    Numbers count from 1 without gaps, in no particular order; NULL gets none. Known values keep theirs, so
    that what was made with them stays good. New values are counted in the files they are staged
    in: no task sees all.
    """
    (name,) = values.columns
    new = values.select(F.col(name).alias("value")).where("value IS NOT NULL").distinct()
    before = 0
    if known is not None:
        new = new.join(known.select("value"), "value", "left_anti")
        before = known.agg(F.max("number")).first()[0] or 0
    # The order inside a task is fixed once the rows lie in a file
    placed = stage(new, "values").select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    files = placed.groupBy("file").agg((F.max("row") + 1).alias("rows"))
    # One row for each file
    ahead = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    begins = files.select("file", (F.coalesce(F.sum("rows").over(ahead), F.lit(0)) + before).alias("begin"))
    fresh = placed.join(F.broadcast(begins), "file").select("value", (F.col("begin") + F.col("row") + 1).alias("number"))
    return fresh if known is None else known.select("value", "number").unionByName(fresh)


def with_number(df: DataFrame, column: str, numbers: DataFrame, name: str) -> DataFrame:
    """``df`` with the number of each value of ``column`` as ``name``; a value without one has NULL."""
    keyed = numbers.select(F.col("value").alias("_value"), F.col("number").alias(name))
    return df.join(keyed, F.col(column) == F.col("_value"), "left").drop("_value")


def bitmaps(df: DataFrame, by: Sequence[str], number: str) -> DataFrame:
    """(by, bucket, bits): the numbers that each group has. NULL numbers count for nothing, NULL is a group."""
    present = df.where(F.col(number).isNotNull())
    bucket = F.bitmap_bucket_number(number).alias("bucket")
    return present.groupBy(*by, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))


def united(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Bitmaps of all: a number that several have is there once."""
    rows = first
    for other in others:
        rows = rows.unionByName(other)
    return rows.groupBy(*[c for c in first.columns if c != "bits"]).agg(F.bitmap_or_agg("bits").alias("bits"))


def counted(maps: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Distinct values of each group that has any."""
    return maps.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(name))

"""Shared scratch space: where a lineage is cut and files wait for their table.

The folder has to outlive executors, so it is the one the cluster names in
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="smelter-"))
    return context.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/smelter/{purpose}-{uuid.uuid4().hex}"


def stage(df: DataFrame, purpose: str = "stage") -> DataFrame:
    """Write ``df`` once and go on from the files.

    For a frame used several times: it is computed once, losing executors cannot
    undo it, and its size is known, so that Spark can decide about a broadcast.
    """
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    return staged


def driver_memory(spark: SparkSession) -> int:
    """Bytes that the driver's heap may grow to; what is broadcast passes through it, several times over."""
    return spark._jvm.java.lang.Runtime.getRuntime().maxMemory()


def row_bytes(df: DataFrame) -> int:
    """Bytes of a row as Spark takes it for its columns' types."""
    return 8 + df._jdf.schema().defaultSize()


def by_rows(df: DataFrame, rows: int | None = None, limit: int | None = None) -> DataFrame:
    """``df`` as one side of a join, which Spark does not broadcast where its rows are too large for that.

    Spark takes the bytes of files for the size of rows. Rows of numbers can take ten times as much and
    more in the driver's memory, which a broadcast passes through. ``rows``: how many there are; by
    default they are counted, which for a staged frame or a table reads the ends of files only. With
    more than ``limit`` bytes (by default Spark's threshold) the hint keeps both sides from being broadcast.
    """
    if limit is None:
        limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    number = df.count() if rows is None else rows
    return df.hint("merge") if number * row_bytes(df) > limit else df


def discard(*staged: DataFrame) -> None:
    """Remove the files of frames from ``stage`` that nothing will read any more."""
    for df in staged:
        remove_folder(df.sparkSession, df._staged_at)


def _file_system(spark: SparkSession, path: str) -> tuple:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    """By the file system the path belongs to, which need not be this machine's."""
    found, system = _file_system(spark, path)
    system.delete(found, True)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    found, system = _file_system(spark, path)
    if not system.exists(found):
        return []
    return sorted(s.getPath().toString() for s in system.listStatus(found) if s.isDirectory())

"""Tables that are published by a view: whatever changes, readers see the old rows or the new ones.

Each overwrite writes a table of its own, ``<name>__v<n>``, and then points the view ``<name>`` to it in one
catalog operation, also where partitions or columns change, for which a table has to be dropped and
created. Older versions stay until ``expire_published`` drops them. One writer per name is assumed.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from smelter.sinks.tables import save_table
from smelter.sources.catalog import list_tables, table_exists

VERSION = "__v"


def _versions(spark: SparkSession, name: str) -> list[tuple[int, str]]:
    """Numbers and names of the versions that were written, also of ones never published."""
    database, _, short = name.rpartition(".")
    here = database or spark.catalog.currentDatabase()
    found = [
        (int(number.group(1)), f"{here}.{table}")
        for table in list_tables(spark, here)
        if (number := re.fullmatch(re.escape(short.lower()) + VERSION + r"(\d+)", table.lower()))
    ]
    return sorted(found)


def _point(spark: SparkSession, name: str, version: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")


def published_version(spark: SparkSession, name: str) -> str | None:
    """The table that readers of the view get; None before the first."""
    if not table_exists(spark, name):
        return None
    # One row
    (text,) = spark.sql(f"SHOW CREATE TABLE {name}").first()
    return re.search(rf"FROM\s+(\S+{VERSION}\d+)", text).group(1).replace("`", "")


def publish(df: DataFrame, name: str, partition_by: Sequence[str] | None = None) -> str:
    """Replace what readers of ``name`` see by ``df``, which may read ``name`` itself; returns the version."""
    spark = df.sparkSession
    written = _versions(spark, name)
    version = f"{name}{VERSION}{written[-1][0] + 1 if written else 1}"
    save_table(df, version, partition_by=partition_by)
    _point(spark, name, version)
    return version


def expire_published(spark: SparkSession, name: str, keep: int = 1) -> list[str]:
    """Drop versions but the published one and ``keep`` before it, for times when no one reads them."""
    if keep < 0:
        raise ValueError("keep must not be negative")
    current = published_version(spark, name)
    older = [v for _, v in _versions(spark, name) if v.split(".")[-1] != (current or "").split(".")[-1]]
    gone = older[: max(0, len(older) - keep)]
    for version in gone:
        spark.sql(f"DROP TABLE {version}")
    return gone

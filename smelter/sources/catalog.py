"""Looking around in the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def list_tables(spark: SparkSession, database: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def describe(spark: SparkSession, name: str) -> DataFrame:
    """Columns and types of a table, one row each."""
    return spark.sql(f"DESCRIBE TABLE {name}")

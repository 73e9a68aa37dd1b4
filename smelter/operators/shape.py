"""Operators on columns and schemas."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from smelter.functions.text import clean


def name_key(df: DataFrame) -> Callable[[str], str]:
    """What two names have in common where the session takes them for the same column."""
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    return str if exact else str.lower


def align_to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Give the columns that ``schema`` knows its names and types; other columns stay, none
    is added. Names are told apart as the session does."""
    key = name_key(df)
    known = {key(field.name): field for field in schema.fields}

    def aligned(name: str, kind: DataType) -> Column:
        column, field = F.col(f"`{name}`"), known.get(key(name))
        if field is None or (field.name, field.dataType) == (name, kind):
            return column
        return column.cast(field.dataType).alias(field.name)

    return df.select(*[aligned(f.name, f.dataType) for f in df.schema.fields])


def normalise_status(df: DataFrame, src: str = "order_status", dst: str = "status") -> DataFrame:
    """Turn ``src``, where present, into ``dst`` in trimmed capitals."""
    if src not in df.columns:
        return df
    return df.withColumn(dst, clean(src, "trim", "upper")).drop(src)


def with_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def explode_rows(df: DataFrame, array: str, alias: str) -> DataFrame:
    """One row per array element, beside the other columns; empty and NULL arrays give none."""
    others = [c for c in df.columns if c != array]
    return df.select(F.explode(array).alias(alias), *others)


def flatten(df: DataFrame, struct: str, fields: Mapping[str, str]) -> DataFrame:
    """Replace a struct by its ``fields`` (field: column name), placed first."""
    others = [F.col(c) for c in df.columns if c != struct]
    return df.select(*[F.col(f"{struct}.{f}").alias(name) for f, name in fields.items()], *others)


def dimension_key(id_column: str, key_column: str) -> tuple[Column, Column]:
    """The natural key as dimension key and as itself."""
    number = F.col(id_column).cast("long")
    return number.alias(key_column), number.alias(id_column)


def preview(df: DataFrame, n: int, *order_by: Column | str) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order_by).limit(n)

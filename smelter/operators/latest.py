"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

_RANK = "__rank"


def _orderable(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (MapType, VariantType))


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    newest: Sequence[str],
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the row of each key that is newest by the columns ``newest``, NULL being oldest.

    Equal rows are told apart by ``tie_break``, ascending, NULL last; by default by
    all other columns, which makes the choice repeatable. Spark keeps one row per
    key in each task before it shuffles, so that a key that holds much of the table
    sends one row per task and not all of them. Rows without a key form one key.
    """
    if tie_break is None:
        used = {*keys, *newest}
        tie_break = [
            f.name for f in df.schema.fields if f.name not in used and _orderable(f.dataType)
        ]
    order: list[Column] = [F.col(c).desc_nulls_last() for c in newest]
    order += [F.col(c).asc_nulls_last() for c in tie_break]
    if not order:
        order = [F.col(keys[0])]
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(_RANK, ranked).filter(F.col(_RANK) == 1).drop(_RANK)


def distinct_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, always the same one."""
    return latest_per_key(df, keys, newest=())

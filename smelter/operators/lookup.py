"""Fact to dimension joins."""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup_key(fact: DataFrame, dimension: DataFrame, on: str, key: str) -> DataFrame:
    """Add the ``key`` of the dimension row with the same ``on``, NULL where there is none.

    The dimension is cut to two columns. Spark broadcasts it where its size allows,
    and else splits the tasks of a hot (or absent) ``on`` at run time: the fact is
    the outer side, so any part of one key's facts can be joined on its own.
    """
    return fact.join(dimension.select(on, key), on, "left")

"""Columns that an operator carries along, whatever their names are."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(names: Iterable[str]) -> list[Column]:
    """Columns by their plain names, dots and backticks included."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in names]


class Aside:
    """Columns of a frame under names that no operator has, and the way back.

    ``replaced``: names, in any case, that the operator gives to columns of its own; columns
    called so are left out.
    """

    def __init__(self, df: DataFrame, *replaced: str):
        new = {name.lower() for name in replaced}
        self.names = [c for c in df.columns if c.lower() not in new]
        self._inner = [f"_column_{i}" for i in range(len(self.names))]
        self._by_name = dict(zip([c.lower() for c in self.names], self._inner)) | dict(zip(self.names, self._inner))
        # In front, and at the end
        self.away = [c.alias(n) for c, n in zip(quoted(self.names), self._inner)]
        self.back = [F.col(n).alias(c) for c, n in zip(self.names, self._inner)]

    def __getitem__(self, name: str) -> str:
        """The name that a column has meanwhile."""
        return self._by_name.get(name) or self._by_name[name.lower()]

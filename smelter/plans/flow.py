"""Bronze to silver: standardise, check, quarantine, keep the latest valid row per key."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from smelter.constants import NEWEST_FIRST
from smelter.functions.text import Step, standardize
from smelter.operators.latest import latest_per_key
from smelter.operators.quality import Split, split_marked
from smelter.operators.rules import Rule


class Silver(NamedTuple):
    clean: DataFrame
    rejected: DataFrame


def now() -> Column:
    return F.current_timestamp()


@dataclass(frozen=True)
class Flow:
    """What one source needs: cleaning steps per text column, columns to derive,
    rules (functions, since a Column needs a session), key, and helper columns that
    only rejected rows keep. ``combine`` gives columns that build on derived ones, so that
    these are computed once.

    A derived column may take the place of one of the source. Rejected rows show the
    source's value again, as it came: a value that could not be read is what has to be
    repaired.
    """

    key: str
    text: Mapping[str, Sequence[Step]]
    rules: Callable[[], list[Rule]]
    derive: Callable[[], dict[str, Column]] = dict
    combine: Callable[[], dict[str, Column]] = dict
    helpers: Sequence[str] = field(default=())

    def standardized(self, bronze: DataFrame) -> DataFrame:
        """Two steps, because derived columns may build on cleaned ones."""
        return self._with_sources(bronze).drop(*self._sources(bronze).values())

    def split(
        self, bronze: DataFrame, null_policy: str = "reject", seen: Observation | None = None
    ) -> Split:
        sources = self._sources(bronze)
        rows = self._with_sources(bronze)
        valid, rejected = split_marked(rows, self.rules(), null_policy, seen)
        as_it_came = rejected.withColumns({name: F.col(kept) for name, kept in sources.items()})
        return Split(valid.drop(*sources.values()), as_it_came.drop(*sources.values()))

    def _sources(self, bronze: DataFrame) -> dict[str, str]:
        """Columns that a derived one replaces, and where they are kept meanwhile."""
        return {name: f"_source_of_{name}" for name in self.derive() if name in bronze.columns}

    def _with_sources(self, bronze: DataFrame) -> DataFrame:
        kept = {kept: F.col(name) for name, kept in self._sources(bronze).items()}
        derived = standardize(bronze, self.text).withColumns(kept).withColumns(self.derive())
        return derived.withColumns(self.combine())

    def refine(
        self,
        bronze: DataFrame,
        null_policy: str = "reject",
        newest: Sequence[str] = NEWEST_FIRST,
        tie_break: Sequence[str] | None = None,
        at: Column | None = None,
        seen: Observation | None = None,
    ) -> Silver:
        """Rows are checked before copies are dropped: a newer copy that fails a rule
        does not hide an older one that passes. ``seen``: see ``split_marked``."""
        stamp = now() if at is None else at
        valid, rejected = self.split(bronze, null_policy, seen)
        latest = latest_per_key(valid.drop(*self.helpers), [self.key], newest, tie_break)
        return Silver(
            latest.withColumn("_silver_processed_at", stamp),
            rejected.withColumn("_rejected_at", stamp),
        )

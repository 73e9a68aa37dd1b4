"""Text cleaning by named steps."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Step = str | Callable[[Column], Column]

STEPS: dict[str, Callable[[Column], Column]] = {
    "trim": F.trim,
    "lower": F.lower,
    "upper": F.upper,
    "initcap": F.initcap,
}


def clean(column: Column | str, *steps: Step) -> Column:
    """Apply ``steps`` from left to right; a step is a name in STEPS or a function."""
    result = F.col(column) if isinstance(column, str) else column
    for step in steps:
        result = (STEPS[step] if isinstance(step, str) else step)(result)
    return result


def standardize(df: DataFrame, steps: Mapping[str, Sequence[Step]]) -> DataFrame:
    """Replace each named column by its cleaned value, all in one projection."""
    return df.withColumns({name: clean(name, *todo) for name, todo in steps.items()})

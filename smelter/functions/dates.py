"""Calendar attributes of a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar(date: Column, prefix: str) -> dict[str, Column]:
    """Year, month, month name and quarter, named ``<prefix>_year`` and so on."""
    return {
        f"{prefix}_year": F.year(date),
        f"{prefix}_month": F.month(date),
        f"{prefix}_month_name": F.date_format(date, "MMMM"),
        f"{prefix}_quarter": F.quarter(date),
    }

"""Layered (bronze, silver, gold) analytics tables as plain Spark jobs.

Every operator maps DataFrames to DataFrames and stays lazy; reading and
writing happens in ``sources`` and ``sinks`` only.
"""

from smelter.config import IngestConfig, PipelineConfig

__all__ = ["IngestConfig", "PipelineConfig"]

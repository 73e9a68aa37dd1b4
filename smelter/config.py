"""Parameters of an ingest and of a whole run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql.types import StructType

from smelter.constants import LANDING_FORMATS, LOAD_MODES


@dataclass(frozen=True)
class IngestConfig:
    """One landing folder and the table it goes to.

    ``schema`` spares the extra pass over the files that type inference needs;
    leave it out only for small or unknown files.
    """

    landing_path: str
    target_table: str
    source_name: str
    source_system: str
    batch_id: str
    load_mode: str = "overwrite"
    source_format: str = "csv"
    schema: StructType | str | None = None
    unreadable_table: str | None = None

    def __post_init__(self) -> None:
        if not self.landing_path:
            raise ValueError("landing_path is empty")
        if self.load_mode not in LOAD_MODES:
            raise ValueError(f"load_mode {self.load_mode!r} is none of {LOAD_MODES}")
        if self.source_format not in LANDING_FORMATS:
            raise ValueError(f"source_format {self.source_format!r} is none of {LANDING_FORMATS}")


@dataclass(frozen=True)
class PipelineConfig:
    """Schemas of the three layers and where gold is published.

    ``partitions`` maps a table (``"gold.fact_orders"``, layer name and table) to
    the column it is partitioned by, so that a merge rewrites only the partitions
    it changes; ``buckets`` maps a table to a number of buckets by its key instead, so
    that a merge need not shuffle it. ``export_root`` is the folder of the published parquet copies;
    None publishes nothing. ``engagement_since`` leaves the metrics of earlier days as
    they are instead of computing all days again. Orders without an id are rejected unless
    ``require_order_id`` is turned off; ``null_keys`` then says what merges do with them.
    ``partitions`` takes one column or several.

    ``bronze_since`` bounds a run to orders and events ingested at that time or later, and
    ``only_changes`` leaves out of merges what the tables hold already and of the fact what
    neither a changed order nor a changed dimension row touches. Rejects are then those of the
    rows looked at; by default a run takes all.
    """

    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    null_policy: str = "reject"
    require_order_id: bool = True
    null_keys: str = "insert"
    store_product_rejects: bool = False
    export_root: str | None = None
    export_partitions: Mapping[str, str] = field(default_factory=dict)
    partitions: Mapping[str, str | Sequence[str]] = field(default_factory=dict)
    buckets: Mapping[str, int] = field(default_factory=dict)
    audit_table: str | None = None
    engagement_since: str | None = None
    bronze_since: str | None = None
    only_changes: bool = False

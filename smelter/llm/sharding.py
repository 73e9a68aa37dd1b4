"""Shards of near-equal bytes by histogram sort.

Rows are ordered by a hash of their text, so that equal texts lie together, then by a hash of
their key. The boundaries between shards are found before any row moves: each pass counts
the exact bytes below candidate boundaries in every partition, adds the counts up, and puts
new candidates into the gap that each boundary must lie in, until it is close enough. Rows
are then exchanged once. A boundary falls between different texts wherever that is within the
tolerance; a group of equal texts too large for it is cut by key, and rows that are equal in
text and key are cut by their number.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smelter.llm.columns import Aside
from smelter.scratch import stage

LEAST, MOST = -(1 << 63), (1 << 63) - 1
LEVELS = ("_by_text", "_by_key", "_by_row")


@dataclass(frozen=True)
class Gap:
    """Where a boundary must lie: keys from ``low`` to ``high``; bytes below each, rows between."""

    low: int
    high: int
    below_low: int
    below_high: int
    rows: int

    def nearest(self, target: int) -> tuple[int, int]:
        """The end of the gap that is nearer to ``target``: (key, bytes off)."""
        before, behind = target - self.below_low, self.below_high - target
        return (self.low, before) if before <= behind else (self.high, behind)

    def settled(self, target: int, tolerance: float) -> bool:
        return self.rows <= 1 or self.nearest(target)[1] <= tolerance


def shard_rows(
    df: DataFrame,
    shards: int,
    size: Column,
    group: Column,
    key: Column,
    tolerance: float = 0.01,
    probes: int = 32,
    parts_per_shard: int = 4,
) -> DataFrame:
    """``df`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard).

    size: bytes of a row, over 0. group: rows that should stay together where bytes allow it.
    key: tells the rows of a group apart. A boundary is exact to half a row wherever it has to
    cut a group, and within ``tolerance`` of a shard's bytes where it doesn't. Slots follow the
    order of (group, key) hashes. ``parts_per_shard`` tasks write a shard, of equal bytes each.
    NULL groups and keys are values like any other. Columns of the same names are replaced.
    No rows: no rows. With fewer rows than shards, some shards are empty.
    """
    aside = Aside(df, "shard", "slot")
    rows = df.select(
        *aside.away, size.cast("bigint").alias("_size"), F.xxhash64(group).alias(LEVELS[0]), F.xxhash64(group, key).alias(LEVELS[1])
    )
    # Written once: the number of a row must not change if a task runs again
    rows = stage(rows.withColumn(LEVELS[2], F.monotonically_increasing_id()), "sized")
    parts = shards * parts_per_shard
    total = rows.agg(F.sum("_size")).first()[0] or 0
    targets = [total * i // parts for i in range(1, parts)]
    # Within a shard a part's edges may fall anywhere; only every n-th is a shard's edge
    cuts = splitters(rows, targets, total / shards * tolerance / 2, probes)
    placed = rows.withColumn("_part", _part_of(cuts))
    sums = placed.groupBy("_part").agg(F.count("*").alias("n"))
    shard = F.floor(F.col("_part") / parts_per_shard).cast("int")
    # One row for each part: a few for each shard
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("shard", shard).select("_part", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*LEVELS)) - 1
    out = placed.withColumn("_within", within).join(F.broadcast(offsets), "_part")
    return out.select(*aside.back, "shard", (F.col("_offset") + F.col("_within")).alias("slot"))


def splitters(rows: DataFrame, targets: list[int], tolerance: float, probes: int) -> list[tuple[int, int, int]]:
    """For each target the key of the first row behind the boundary, over all levels."""
    found: dict[int, tuple] = {}
    # Where to look: keys of the levels above, and the bytes in front of them
    inside: dict[int, tuple[tuple, int]] = {i: ((), 0) for i in range(len(targets))}
    for level, column in enumerate(LEVELS):
        prefixes = sorted({prefix for prefix, _ in inside.values()})
        aims = {i: (prefixes.index(prefix), targets[i] - base) for i, (prefix, base) in inside.items()}
        gaps = refine(_numbered(rows, prefixes), column, aims, tolerance, probes)
        deeper: dict[int, tuple[tuple, int]] = {}
        for i, gap in gaps.items():
            prefix, base = inside[i]
            aim = targets[i] - base
            if level == len(LEVELS) - 1 or gap.settled(aim, tolerance):
                found[i] = (*prefix, gap.nearest(aim)[0], *[LEAST] * (len(LEVELS) - level - 1))
            else:
                deeper[i] = ((*prefix, gap.low), base + gap.below_low)
        inside = deeper
        if not inside:
            break
    return sorted(found.values())


def _numbered(rows: DataFrame, prefixes: list[tuple]) -> DataFrame:
    """Rows below one of the prefixes, which ``_at`` numbers; there are no more than boundaries."""
    if prefixes == [()]:
        return rows.withColumn("_at", F.lit(0))
    number = F.lit(None).cast("int")
    for i, prefix in enumerate(prefixes):
        same = F.lit(True)
        for name, value in zip(LEVELS, prefix):
            same = same & (F.col(name) == F.lit(value))
        number = F.when(same, i).otherwise(number)
    # A simple filter first: it is all that most rows meet
    return rows.where(F.col(LEVELS[0]).isin(sorted({p[0] for p in prefixes}))).withColumn("_at", number).where("_at is not null")


def refine(rows: DataFrame, column: str, aims: dict[int, tuple[int, int]], tolerance: float, probes: int) -> dict[int, Gap]:
    """The gap of each aim (number of the prefix, bytes): an end within the tolerance, or one key in it.

    Each pass is one scan of ``rows``; what comes back is a count for each candidate.
    """
    gaps: dict[int, Gap] = {}
    while True:
        wide: dict[int, set[tuple[int, int]]] = {}
        for i, (at, aim) in aims.items():
            if not gaps:
                wide[at] = {(LEAST, MOST + 1)}
            elif gaps[i].high - gaps[i].low > 1 and not gaps[i].settled(aim, tolerance):
                wide.setdefault(at, set()).add((gaps[i].low, gaps[i].high))
        if not wide:
            return gaps
        count = probes if gaps else max(probes, probes * len(aims) // len(wide))
        edges = {
            at: np.array(sorted({low + (high - low) * i // count for low, high in spans for i in range(count + 1)} - {MOST + 1}), dtype=np.int64)
            for at, spans in wide.items()
        }
        passed = _histogram(rows, column, edges)
        starts = {at: [g.below_low for g in found] for at, found in passed.items()}
        for i, (at, aim) in aims.items():
            if at in wide and (not gaps.get(i) or (gaps[i].low, gaps[i].high) in wide[at]):
                gaps[i] = passed[at][max(0, int(np.searchsorted(starts[at], aim, side="right")) - 1)]


def _histogram(rows: DataFrame, column: str, edges: dict[int, np.ndarray]) -> dict[int, list[Gap]]:
    """For each prefix, from each edge to the next, closed in to the keys that there are: exact bytes and rows."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {}
        for prefix, own in edges.items():
            n = len(own) + 1
            counts[prefix] = np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, MOST), np.full(n, LEAST)
        for batch in batches:
            all_keys, all_sizes, prefixes = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            for prefix in np.unique(prefixes).tolist():
                if prefix not in edges:
                    continue
                keys, sizes = all_keys[prefixes == prefix], all_sizes[prefixes == prefix]
                at = np.searchsorted(edges[prefix], keys, side="right")
                sums, numbers, first, last = counts[prefix]
                np.add.at(sums, at, sizes)
                np.add.at(numbers, at, 1)
                np.minimum.at(first, at, keys)
                np.maximum.at(last, at, keys)
        for prefix, found in counts.items():
            used = np.flatnonzero(found[1])
            columns = [np.full(len(used), prefix, np.int32), used.astype(np.int32), *(x[used] for x in found)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["prefix", "at", "n", "rows", "first", "last"])

    schema = "prefix int, at int, n bigint, rows bigint, first bigint, last bigint"
    counts = rows.select(column, "_size", "_at").mapInArrow(count, schema).groupBy("prefix", "at")
    counts = counts.agg(F.sum("n").alias("n"), F.sum("rows").alias("rows"), F.min("first").alias("first"), F.max("last").alias("last"))
    found = {(row["prefix"], row["at"]): row for row in counts.collect()}
    return {prefix: _gaps(own.tolist(), lambda i, p=prefix: found.get((p, i))) for prefix, own in edges.items()}


def _gaps(edges: list[int], row_at) -> list[Gap]:
    out, below = [], row_at(0).n if row_at(0) else 0
    for i, edge in enumerate(edges, start=1):
        row, end = row_at(i), edges[i] if i < len(edges) else MOST + 1
        if row:
            out.append(Gap(row.first, row.last + 1, below, below + row.n, row.rows))
            below += row.n
        else:
            out.append(Gap(edge, end, below, below, 0))
    return out


def _part_of(cuts: list[tuple[int, int, int]]) -> Column:
    """How many cuts a row lies at or behind."""
    edges = np.array(cuts, dtype=np.int64).reshape(-1, len(LEVELS))

    def behind(edges: np.ndarray, keys: list[np.ndarray]) -> np.ndarray:
        if not keys:
            return np.full(1, len(edges))
        first = edges[:, 0]
        count = np.searchsorted(first, keys[0], side="left")
        for value in np.unique(first):
            rows = keys[0] == value
            if rows.any():
                count[rows] += behind(edges[first == value][:, 1:], [k[rows] for k in keys[1:]])
        return count

    @F.pandas_udf("int")
    def part(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series(behind(edges, [a.to_numpy(), b.to_numpy(), c.to_numpy()]).astype(np.int32))

    return part(*LEVELS)

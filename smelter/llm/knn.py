"""Exact top-k search by inner product: a Voronoi join of queries with data.

Every vector belongs to the cell of its nearest pivot. A summary of each cell (radius, box)
bounds the best score that a query can have in it. A query first visits its most promising
cells, which gives a score that its k-th best cannot fall below; then it is sent only to those
other cells whose bound reaches that score, and is answered there by a product of matrices.
Cells are cut into blocks of bounded size, so that a crowded cell is many small tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smelter.scratch import stage

# Rows of data and of queries that meet in one task at a time
DATA_BLOCK, QUERY_BLOCK = 4096, 1024
# Products up to here are exact in doubles
EXACT = 2.0**53
LONG = (1 << 63) - 1


def quantized(vectors: DataFrame, scale: int = 64, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v array<double>) with ``floor(scale * x)`` for each component x as double.

    Rows whose key or vector is NULL, or whose vector holds a NULL, NaN or infinity (after
    scaling), are left out. Of several rows with one key, that with the smallest vector counts.
    """
    parts = F.transform(F.col(vector).cast("array<double>"), lambda x: x * scale)
    sound = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    # Beyond 2^53 every double is whole
    whole = F.transform(parts, lambda x: F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(x))
    rows = vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & sound)
    return rows.select(F.col(key).alias("vec_id"), whole.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


def top_k(data: DataFrame, is_query: Column, k: int = 20, pivots: int = 128) -> DataFrame:
    """The ``k`` best (query_id, rank, vec_id, score) of every query over all other rows.

    data: (vec_id, v) with whole numbers in v, one row for each vec_id. A query is a row of
    ``data`` too and never finds itself. Ties go to the smaller vec_id. Vectors of unequal
    length are compared as if the shorter ended in zeros. Fewer than ``k`` others: all of
    them. No data or no query: no rows. Scores beyond a long are held at its ends.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    data = stage(data, "vectors")
    width = data.agg(F.max(F.size("v"))).first()[0] or 0
    # A sample of bounded size, the same on every run; any pivots give exact results
    chosen = [row.v for row in data.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).collect()]
    centres = _padded(chosen, width)
    celled = stage(data.mapInArrow(_nearest(centres, width), "vec_id bigint, v array<double>, cell int, far double"), "cells")
    # One row for each pivot
    summary = celled.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).orderBy("cell").collect()
    if not summary:
        return data.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    cells = {r.cell: (r.n, r.far) for r in summary}
    low, high = _boxes(celled, width, len(centres))
    bounds = (centres, cells, low, high)
    # Queries carry their vectors; data goes out in blocks
    queries = stage(celled.where(is_query).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q")), "queries")
    blocks = F.create_map(*[F.lit(x) for c, (n, _) in cells.items() for x in (c, -(-n // DATA_BLOCK))])
    data = celled.select("vec_id", "v", "cell", F.pmod(F.xxhash64("vec_id"), blocks[F.col("cell")]).cast("int").alias("block"))

    first = _visits(queries, bounds, k, width, None)
    near = stage(_answers(first, data, blocks, k, width), "near")
    floor = _best(near, k).groupBy("query_id").agg(F.min("score").alias("floor"), F.count("*").alias("n"))
    floor = floor.select("query_id", F.when(F.col("n") >= k, F.col("floor")).alias("floor"))
    # The same cells come first in both rounds and are left out of the second
    second = _visits(queries.join(floor, "query_id", "left"), bounds, k, width, "floor")
    rest = _answers(second, data, blocks, k, width)
    return _best(near.unionByName(rest), k).select("query_id", "rank", "vec_id", "score")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _padded(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat, offsets = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    if len(flat) == len(column) * width:
        return flat.reshape(len(column), width).astype(float)
    begin = offsets - offsets[0]
    return _padded([flat[a:b] for a, b in zip(begin, begin[1:])], width)


def _nearest(centres: np.ndarray, width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _matrix(batch.column("v"), width)
            squares = (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)
            cell = squares.argmin(1).astype(np.int32)
            far = np.sqrt(((points - centres[cell]) ** 2).sum(1))
            columns = [batch.column("vec_id"), batch.column("v"), pa.array(cell), pa.array(far)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "v", "cell", "far"])

    return run


def _boxes(celled: DataFrame, width: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest component of each cell; a task gives one row for a cell at most."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, seen = np.full((count, width), np.inf), np.full((count, width), -np.inf), np.zeros(count, bool)
        for batch in batches:
            points, cell = _matrix(batch.column("v"), width), batch.column("cell").to_numpy()
            np.minimum.at(low, cell, points)
            np.maximum.at(high, cell, points)
            seen[cell] = True
        used = np.flatnonzero(seen)
        columns = [pa.array(used.astype(np.int32)), pa.array(list(low[used])), pa.array(list(high[used]))]
        types = [pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64())]
        yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, types)], names=["cell", "low", "high"])

    sides = celled.select("v", "cell").mapInArrow(run, "cell int, low array<double>, high array<double>")
    by_part = sides.select("cell", F.posexplode(F.arrays_zip("low", "high"))).groupBy("cell", "pos")
    ends = by_part.agg(F.min("col.low").alias("low"), F.max("col.high").alias("high"))
    low, high = np.zeros((count, width)), np.zeros((count, width))
    for row in ends.collect():
        low[row.cell, row.pos], high[row.cell, row.pos] = row.low, row.high
    return low, high


def _visits(queries: DataFrame, bounds: tuple, k: int, width: int, floor: str | None) -> DataFrame:
    """(query_id, q, cell, floor): the cells a query goes to.

    Without ``floor``: the most promising cells that together hold more than ``k`` rows. With
    it: all others whose bound reaches the query's floor (all, where that is NULL).
    """
    centres, cells, low, high = bounds
    names = sorted(cells)
    counts, far = np.array([cells[c][0] for c in names]), np.array([cells[c][1] for c in names])
    centre, low, high = centres[names], low[names], high[names]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = _matrix(batch.column("q"), width)
            norm = np.sqrt((q**2).sum(1))[:, None]
            by_radius = q @ centre.T + norm * far
            by_box = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
            # Rounded up: a bound may be too high, never too low
            bound = np.minimum(by_radius, by_box)
            bound = bound + 1 + np.abs(bound) * 1e-9
            order = np.argsort(-bound, axis=1, kind="stable")
            held = np.cumsum(counts[order], axis=1)
            leading = np.zeros(bound.shape, bool)
            np.put_along_axis(leading, order, (held - counts[order]) <= k, axis=1)
            if floor is None:
                goes, least = leading, np.full(len(q), np.nan)
            else:
                least = batch.column(floor).cast(pa.float64()).to_numpy(zero_copy_only=False)
                goes = ~leading & ~(bound < np.where(np.isnan(least), -np.inf, least)[:, None])
            which, cell = np.nonzero(goes)
            columns = [
                batch.column("query_id").take(pa.array(which)), batch.column("q").take(pa.array(which)),
                pa.array(np.array(names, np.int32)[cell]), pa.array(least[which], from_pandas=True),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["query_id", "q", "cell", "floor"])

    return queries.mapInArrow(run, "query_id bigint, q array<double>, cell int, floor double")


def _answers(visits: DataFrame, data: DataFrame, blocks: Column, k: int, width: int) -> DataFrame:
    """The up to ``k`` best of each block for each query that visits it."""
    counts = visits.groupBy("cell").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int").alias("part")
    asked = visits.join(counts, "cell").select("query_id", "q", "cell", "floor", part, F.explode(F.sequence(F.lit(0), blocks[F.col("cell")] - 1)).alias("block"))
    held = data.join(counts, "cell").select("vec_id", "v", "cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "block")
    tile = ["cell", "block", "part"]

    def solve(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        ids = rows["vec_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, points = ids[order], _padded(list(rows["v"]), width)[order]
        asks, asked_by = _padded(list(queries["q"]), width), queries["query_id"].to_numpy()
        scores = products(asks, points)
        floors = queries["floor"].to_numpy(dtype=float)
        out = []
        for i, who in enumerate(asked_by):
            fit = ids != who
            if not np.isnan(floors[i]):
                # The floor went through a double; it may have been rounded up by as much
                fit &= scores[i] >= floors[i] - abs(floors[i]) * 1e-12 - 0.5
            at = np.flatnonzero(fit)
            if len(at) > k:
                # Everything above the k-th score, and of its equals those with smaller ids
                kth = np.partition(scores[i][at], len(at) - k)[len(at) - k]
                over = at[scores[i][at] > kth]
                at = np.concatenate([over, at[scores[i][at] == kth][: k - len(over)]])
            out.append((np.full(len(at), who), ids[at], scores[i][at]))
        columns = [np.concatenate(c) for c in zip(*out)]
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns)))

    return held.groupBy(*tile).cogroup(asked.groupBy(*tile)).applyInPandas(solve, "query_id bigint, vec_id bigint, score bigint")


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers, exact, as int64 held at the ends of its range."""
    most = (np.abs(a).max(initial=0.0)) * (np.abs(b).max(initial=0.0)) * max(1, a.shape[1])
    if most < EXACT:
        return (a @ b.T).astype(np.int64)
    large = [[int(x) for x in row] for row in b]
    rows = [[sum(x * y for x, y in zip(q, row)) for row in large] for q in ([int(x) for x in r] for r in a)]
    return np.array([[max(-LONG - 1, min(LONG, x)) for x in row] for row in rows], dtype=np.int64).reshape(len(a), len(b))

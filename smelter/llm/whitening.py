"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its factor.

Spark gathers the scatter of the distinct vectors as exact whole numbers, in one row for
each pair of dimensions and task; what reaches the driver grows with the dimensions only.
There the scatter is factored as ``L L'`` with pivots from large to small, and the columns of
``L`` are rotated against each other until all are orthogonal. Their squared lengths are then
the eigenvalues, and the columns themselves, made unit, the components: the matrix is never
diagonalised itself, so that small eigenvalues keep their leading digits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm.arrow import map_batches, slices
from smelter.scratch import discard, stage

SCALE = 256
COMPONENTS = 4
# Whole numbers up to here are exact as doubles, and sums of them below it
EXACT = 1 << 53
RESULT = "component: int, n: bigint, deviation: bigint, whitened: double, explained: double, identity_error: double"


@dataclass(frozen=True)
class Whitening:
    """What was learned: ``components`` are rows, unit vectors by falling ``eigenvalues``.

    ``identity_error``: the largest entry by which the covariance of the whitened fit list
    departs from the identity, as measured over it.
    """

    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = 0.0


def quantized(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, x): ``floor(scale * entry)`` as a bigint, of rows whose vector is whole.

    Left out: vectors that are NULL, empty, or hold NULL or non-finite entries, and those of another
    length than most (of equal counts, the longer). An entry beyond 64 bits is the nearest that fits.
    """
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    whole = F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    rows = rows.where(whole & (F.size("v") > 0))
    length = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    top = float((1 << 63) - 1024)

    def fitted(c):
        return F.floor(F.greatest(F.least(c * scale, F.lit(top)), F.lit(-top)))

    return rows.where(F.size("v") == (length["d"] if length else 0)).select("id", F.transform("v", fitted).alias("x"))


def fit(distinct: DataFrame, count: int = COMPONENTS) -> Whitening | None:
    """The first ``count`` components of ``distinct`` (column ``x``), fewer if its rank is less; None without rows."""
    first = distinct.mapInArrow(_summed, "dim int, n bigint, high bigint, low bigint").groupBy("dim")
    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    sums = sorted(first.agg(F.sum("n").alias("n"), *wide).collect())
    if not sums:
        return None
    n, totals = sums[0]["n"], [(int(r["high"]) << 32) + int(r["low"]) for r in sums]
    centre = [round(Fraction(s, n)) for s in totals]
    d = len(totals)
    parts = distinct.mapInArrow(_multiplied(centre), "i int, j int, high decimal(38,0), low bigint").groupBy("i", "j")
    products = parts.agg(F.sum("high").alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low"))
    # n times the scatter: whole numbers, centred at whole ones and put right for what these miss
    rest = [s - n * c for s, c in zip(totals, centre)]
    covariance = np.zeros((d, d))
    for row in products.collect():
        i, j, product = row["i"], row["j"], (int(row["high"]) << 32) + int(row["low"])
        covariance[i, j] = covariance[j, i] = float(Fraction(n * product - rest[i] * rest[j], n * n))
    values, components = principal(covariance)
    model = Whitening(n, tuple(totals), values[:count], components[:count], float(np.trace(covariance)))
    return replace(model, identity_error=_identity_error(distinct, model))


def principal(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues over rounding level from large to small, and unit eigenvectors as rows."""
    lower = pivoted_cholesky(covariance)
    rotated = orthogonal_columns(lower)
    lengths = np.sqrt((rotated * rotated).sum(axis=0))
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    return lengths[order] ** 2, (rotated[:, order] / lengths[order]).T


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """``L`` with ``L @ L.T == matrix``: each step takes the largest diagonal entry left as its pivot.

    It ends when what is left is rounding; ``L`` has as many columns as there were pivots.
    """
    left = matrix.copy()
    d = len(left)
    tolerance = d * np.finfo(float).eps * max(left.diagonal().max(initial=0.0), 0.0)
    columns = []
    open_rows = np.ones(d, bool)
    for _ in range(d):
        diagonal = np.where(open_rows, left.diagonal(), -1.0)
        pivot = int(diagonal.argmax())
        if diagonal[pivot] <= tolerance:
            break
        column = np.where(open_rows, left[:, pivot], 0.0) / np.sqrt(diagonal[pivot])
        columns.append(column)
        left -= np.outer(column, column)
        open_rows[pivot] = False
    return np.array(columns).T.reshape(d, len(columns))


def orthogonal_columns(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """One-sided Jacobi: the columns rotated in pairs until all are orthogonal to double precision.

    A sweep meets each pair once, in rounds of pairs that share no column, all rotated together.
    """
    columns = factor.T.copy()
    r = len(columns)
    if r < 2:
        return columns.T
    seats = np.arange(r + r % 2)
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(len(seats) - 1):
            a, b = seats[: len(seats) // 2], seats[len(seats) // 2 :][::-1]
            real = (a < r) & (b < r)
            worst = max(worst, _rotate(columns, a[real], b[real]))
            seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])
        if worst <= 4 * np.finfo(float).eps:
            break
    return columns.T


def _rotate(columns: np.ndarray, a: np.ndarray, b: np.ndarray) -> float:
    """Rotate row ``a[i]`` against ``b[i]``; the largest cosine there was."""
    x, y = columns[a], columns[b]
    xx, yy, xy = (x * x).sum(axis=1), (y * y).sum(axis=1), (x * y).sum(axis=1)
    size = np.sqrt(xx * yy)
    cosine = np.abs(np.divide(xy, size, out=np.zeros_like(xy), where=size > 0))
    turn = cosine > np.finfo(float).eps
    zeta = np.divide(yy - xx, 2 * xy, out=np.zeros_like(xy), where=turn)
    tangent = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
    tangent = np.where(turn, tangent, 0.0)
    cos = 1 / np.hypot(1.0, tangent)
    sin = cos * tangent
    columns[a], columns[b] = cos[:, None] * x - sin[:, None] * y, sin[:, None] * x + cos[:, None] * y
    return float(cosine.max(initial=0.0))


def whitened(vectors: DataFrame, count: int = COMPONENTS, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Each whole vector along the first components: (key, component, n, deviation, whitened, explained, identity_error).

    Vectors are made whole numbers by ``quantized``, which says which rows take no part. Learned from each
    distinct vector once. Repeated rows and ids stay, as do NULL ids; other columns of ``vectors`` play
    no part, whatever their names. ``deviation`` is exact, NULL where it exceeds 64 bits. Components beyond the
    rank have no rows: none at all if all vectors are equal, or none is whole.
    """
    rows = quantized(vectors, key, vector, scale)
    distinct = stage(rows.select("x").distinct(), "vectors")
    model = fit(distinct, count)
    discard(distinct)
    none = rows.where(F.lit(False)).select("id", F.lit(None).cast(f"struct<{RESULT}>").alias("r"))
    along = map_batches(rows, lambda: _projected(model), none.schema) if model else none
    return along.select(F.col("id").alias(key), "r.*")


def _matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _halves(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return values >> 32, values & 0xFFFFFFFF


def _summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, high, low = 0, None, None
    for batch in batches:
        if batch.num_rows:
            upper, lower = _halves(_matrix(batch.column(0)))
            n += batch.num_rows
            high = upper.sum(axis=0) + (0 if high is None else high)
            low = lower.sum(axis=0) + (0 if low is None else low)
    if n:
        d = len(high)
        columns = [np.arange(d, dtype=np.int32), np.full(d, n), high, low]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["dim", "n", "high", "low"])


def _exact_product(y: np.ndarray) -> np.ndarray:
    """``y.T @ y`` without rounding: by doubles where every sum is below ``EXACT``, else by Python's numbers."""
    largest = int(max(y.max(), -y.min(), 1))
    rows = EXACT // (largest * largest)
    if rows == 0 or largest >= EXACT:
        wide = y.astype(object)
        return wide.T @ wide
    total = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    for begin in range(0, len(y), rows):
        part = y[begin : begin + rows].astype(np.float64)
        total += (part.T @ part).astype(np.int64)
    return total


def _multiplied(centre: list[int]):
    """Products of the centred vectors, summed in the task: one row for each pair of dimensions."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        fits = all(abs(c) < 1 << 62 for c in centre)
        for batch in batches:
            for part in slices(batch):
                if part.num_rows:
                    x = _matrix(part.column(0))
                    small = fits and int(np.abs(x // 2).max()) < 1 << 61
                    y = x - np.array(centre) if small else x.astype(object) - np.array(centre, dtype=object)
                    product = _exact_product(y)
                    total = product if total is None else total + product
        if total is not None:
            i, j = np.triu_indices(len(total))
            cells = [int(total[a, b]) for a, b in zip(i, j)]
            high = pa.array([Decimal(c >> 32) for c in cells], pa.decimal128(38, 0))
            low = pa.array([c & 0xFFFFFFFF for c in cells], pa.int64())
            names = ["i", "j", "high", "low"]
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), high, low], names=names)

    return run


def _deviations(x: np.ndarray, model: Whitening) -> np.ndarray:
    """``n * x - S``, exact: 64 bits where they hold it, else Python's numbers."""
    bound = model.n * (int(max(x.max(), -x.min(), 0)) + 1) + max(abs(s) for s in model.sums)
    if bound < 1 << 62:
        return model.n * x - np.array(model.sums)
    return x.astype(object) * model.n - np.array(model.sums, dtype=object)


def _along(apart: np.ndarray, model: Whitening) -> np.ndarray:
    """Rows projected on the components, each over its deviation."""
    centred = apart.astype(np.float64) / model.n
    return centred @ model.components.T / np.sqrt(model.eigenvalues)


def _identity_error(distinct: DataFrame, model: Whitening) -> float:
    k = len(model.eigenvalues)
    if not k:
        return 0.0

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            for part in slices(batch):
                if part.num_rows:
                    w = _along(_deviations(_matrix(part.column(0)), model), model)
                    w = np.column_stack([w, np.ones(len(w))])
                    total += w.T @ w
        i, j = np.indices(total.shape)
        arrays = [pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)), pa.array(total.ravel())]
        yield pa.RecordBatch.from_arrays(arrays, names=["i", "j", "s"])

    total = np.zeros((k + 1, k + 1))
    for row in distinct.mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        total[row["i"], row["j"]] = row["s"]
    mean = total[k, :k] / model.n
    return float(np.abs(total[:k, :k] / model.n - np.outer(mean, mean) - np.eye(k)).max())


def _projected(model: Whitening):
    k = len(model.eigenvalues)
    names = [field.split(":")[0].strip() for field in RESULT.split(",")]
    explained = model.eigenvalues / model.trace if k else model.eigenvalues

    def squared(apart: np.ndarray) -> list[int | None]:
        largest = int(max(apart.max(), -apart.min()))
        if apart.dtype != object and largest * largest * apart.shape[1] < 1 << 63:
            return (apart * apart).sum(axis=1).tolist()
        exact = [sum(int(c) * int(c) for c in row) for row in apart]
        return [s if s < 1 << 63 else None for s in exact]

    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = batch.num_rows
        apart = _deviations(_matrix(batch.column(1)), model) if rows else np.zeros((0, len(model.sums)), np.int64)
        each = [
            pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
            pa.array(np.full(rows * k, model.n)),
            pa.array([s for s in (squared(apart) if rows else []) for _ in range(k)], pa.int64()),
            pa.array(_along(apart, model).ravel()),
            pa.array(np.tile(explained, rows)),
            pa.array(np.full(rows * k, model.identity_error)),
        ]
        ids = batch.column(0).take(pa.array(np.repeat(np.arange(rows), k)))
        return pa.RecordBatch.from_arrays([ids, pa.StructArray.from_arrays(each, names=names)], names=["id", "r"])

    return add

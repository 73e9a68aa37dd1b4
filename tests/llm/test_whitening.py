"""Whitening against numpy's own eigenvectors, and exact whole numbers."""

import math

import duckdb
import numpy as np
import pytest
from conftest import TESTDATA

from smelter.llm import whitening
from smelter.llm.queries import QUERIES

SF = f"{TESTDATA}/sf0.01"


def expected(vectors, count):
    """By (id, component): n, deviation, |whitened|, explained; vectors: [(id, list)]."""
    rows = [(k, [math.floor(256 * float(c)) for c in v]) for k, v in vectors]
    fit = sorted({tuple(x) for _, x in rows})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array(fit, float) - np.array(sums) / n
    covariance = centred.T @ centred / n
    values, columns = np.linalg.eigh(covariance)
    values, columns = values[::-1], columns[:, ::-1]
    out = []
    for key, x in rows:
        apart = [n * c - s for c, s in zip(x, sums)]
        for i in range(count):
            along = np.array(apart) / n @ columns[:, i] / math.sqrt(values[i])
            out.append((key, i + 1, n, sum(c * c for c in apart), abs(along), values[i] / np.trace(covariance)))
    return out


def compared(rows, wanted):
    plain = sorted((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in rows)
    assert len(plain) == len(wanted)
    for ours, theirs in zip(plain, sorted(wanted)):
        assert ours[:4] == theirs[:4]
        assert ours[4:] == pytest.approx(theirs[4:], rel=1e-7, abs=1e-9)
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9


def test_query(spark):
    vectors = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    compared(QUERIES["op13_whitening"](spark, SF).collect(), expected(vectors, 4))


def test_rows_that_take_no_part_and_clashing_names(spark):
    rng = np.random.default_rng(3)
    good = [(i, rng.normal(size=5).tolist()) for i in range(40)]
    good += [(7, good[7][1]), (99, good[3][1])]
    bad = [(50, None), (51, [1.0, None, 0.0, 0.0, 0.0]), (52, [math.nan] * 5), (53, [math.inf, 0.0, 0.0, 0.0, 0.0]), (54, []), (55, [1.0])]
    rows = spark.createDataFrame([(k, v, 1, 2) for k, v in good + bad], "vec_id long, embedding array<float>, n int, id int")
    single = [(k, [float(np.float32(c)) for c in v]) for k, v in good]
    compared(whitening.whitened(rows).collect(), expected(single, 4))


def test_null_ids_stay(spark):
    rows = spark.createDataFrame([(None, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [0.25, 0.25])], "vec_id long, embedding array<double>")
    assert sorted(str(r.vec_id) for r in whitening.whitened(rows, 1).collect()) == ["1", "2", "None"]


@pytest.mark.parametrize("vectors", [[], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_without_spread_there_are_no_rows(spark, vectors):
    rows = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    assert whitening.whitened(rows).collect() == []


def test_rank_bounds_the_components(spark):
    rows = spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0]) for i in range(9)], "vec_id long, embedding array<float>")
    found = whitening.whitened(rows).collect()
    assert {r.component for r in found} == {1}
    assert found[0].explained == pytest.approx(1)


def test_large_numbers_are_exact(spark):
    vectors = [(0, [2.0**50, 1.0]), (1, [-(2.0**50), 2.0]), (2, [3.0, 2.0**48])]
    rows = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    x = [[int(256 * c) for c in v] for _, v in vectors]
    found = whitening.whitened(rows, 2).collect()
    assert all(r.deviation is None for r in found if r.vec_id < 2)
    fitted = whitening.fit(whitening.quantized(rows).select("x").distinct(), 2)
    assert fitted.sums == tuple(map(sum, zip(*x)))
    assert {r.n for r in found} == {3} and found[0].identity_error < 1e-9


@pytest.mark.parametrize("seed", range(4))
def test_factor_and_rotations(seed):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(9, 6)) * np.logspace(0, -6, 6)
    matrix = base @ base.T
    lower = whitening.pivoted_cholesky(matrix)
    assert lower.shape == (9, 6) and lower @ lower.T == pytest.approx(matrix, abs=1e-14)
    values, components = whitening.principal(matrix)
    assert components @ components.T == pytest.approx(np.eye(6), abs=1e-10)
    assert values == pytest.approx(np.linalg.eigvalsh(matrix)[::-1][:6], rel=1e-3)
    assert (components.T * values) @ components == pytest.approx(matrix, abs=1e-13)

"""Every query against the same query in SQL on another engine."""

import math
from pathlib import Path

import duckdb
import pytest

from workload.oracle import ORACLE
from workload.queries import QUERIES
from conftest import TESTDATA

SF_DIR = f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 6)
        return v

    plain = [tuple(value(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, str(type(v)), v) for v in row))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    actual = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLE[name])
    columns = [d[0] for d in expected.description]
    assert sorted(actual.columns) == sorted(columns)
    ours = canonical(actual.columns, [tuple(r) for r in actual.collect()])
    theirs = canonical(columns, expected.fetchall())
    assert len(ours) == len(theirs)
    different = [pair for pair in zip(ours, theirs) if pair[0] != pair[1]]
    assert not different, (sorted(columns), different[:3])

"""Arrow functions over columns of a frame: Spark partitions the rows, a function sees one batch."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


SLICE_BYTES = 4 << 20


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    rows = max(1, batch.num_rows * SLICE_BYTES // max(batch.nbytes, 1))
    for begin in range(0, batch.num_rows, rows):
        yield batch.slice(begin, rows)


def map_batches(df: DataFrame, build: Callable[[], Callable], schema: StructType | str) -> DataFrame:
    """Rows of ``df`` through a function from one Arrow batch to one.

    ``build`` runs once in each task and returns the function, so that models and tables
    are loaded where they are used. A batch is handed on in slices of about ``SLICE_BYTES``, so
    that what a function makes of one stays small; those without rows are passed over.
    """

    names = df.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = build()
        for batch in batches:
            for part in slices(pa.RecordBatch.from_arrays(batch.columns, names=names)):
                yield function(part)

    # Spark's call can't take names with dots or backticks
    return df.toDF(*[f"_column_{i}" for i in range(len(names))]).mapInArrow(run, schema)


def texts_of(column: pa.Array) -> Iterator[str]:
    """Strings of a column one by one; NULL is the empty text."""
    for value in column:
        yield value.as_py() or ""


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of a string column one by one; NULL is the empty text."""
    binary = column.cast(pa.large_binary()) if pa.types.is_large_string(column.type) else column.cast(pa.binary())
    for value in binary:
        yield value.as_py() or b""


class Memo(dict):
    """A dictionary that computes what it lacks, of two generations of bounded size.

    When it is full it is laid aside whole; what is asked for again comes back from there, and
    the rest is gone when the next one is laid aside. It is a cache only: results depend neither
    on ``limit`` nor on ``longest``, the length of the longest key that is kept.
    """

    def __init__(self, compute: Callable, limit: int, longest: int | None = None):
        super().__init__()
        self.compute, self.limit, self.longest, self.aside = compute, limit, longest, {}

    def __missing__(self, key):
        value = self.aside.pop(key, None)
        if value is None:
            value = self.compute(key)
        if self.longest is None or len(key) <= self.longest:
            if len(self) >= self.limit:
                self.aside = dict(self)
                self.clear()
            self[key] = value
        return value

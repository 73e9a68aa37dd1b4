"""Quality classifier by compression.

Two zstandard dictionaries are built, from good and from bad labelled texts. A text is
compressed with both; the normalised difference of the sizes says which it is more like. A
logistic model of the difference, of how far the text can be compressed at all and of its
length turns it into a calibrated probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm.arrow import map_batches, text_bytes
from smelter.llm.columns import quoted
from smelter.scratch import stage

# Labelled rows used at most of each class, half for the dictionary and half for calibration;
# those with longer texts are not among them
SAMPLE_ROWS, SAMPLE_BYTES = 2000, 1 << 16
DICTIONARY_BYTES, LEVEL = 112_640, 3
# Bytes given to the compressor at once
BLOCK_BYTES = 1 << 20


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    low: tuple[float, ...]
    high: tuple[float, ...]
    weights: tuple[float, ...]


def held_out(key: str = "doc_id") -> Column:
    """A third of the documents, by a checksum of their key; NULL keys are held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, longest: int = SAMPLE_BYTES) -> Model:
    """A model from labelled documents that are not held out.

    ``labels``: doc_id and quality (1 good, 0 bad); other values and NULLs don't count, nor do
    documents with both labels. Of each class the first ``rows`` by a hash of doc_id are
    taken, whole, if their texts have no more than ``longest`` bytes: this bounded sample is
    all the driver sees, and only its ids meet the documents. With fewer than two texts of a
    class every score is the share of good labels (0.5 without labels).
    """
    votes = labels.where("quality in (0, 1)").where(~held_out()).groupBy("doc_id")
    votes = votes.agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).where("quality = most").drop("most")
    votes = stage(votes, "votes")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    first = [votes.where(F.col("quality") == q).orderBy(*order).limit(rows) for q in (0, 1)]
    # No more than twice ``rows`` ids
    chosen = F.broadcast(stage(first[0].unionByName(first[1]), "sample"))
    found = docs.where(F.octet_length("text").between(1, longest)).select("doc_id", "text").join(chosen, "doc_id")
    found = sorted((xxhash.xxh64_intdigest(str(r.doc_id)), r.text, r.quality) for r in found.collect())
    texts = {q: [text.encode() for _, text, quality in found if quality == q] for q in (0, 1)}
    shares = {r.quality: r["count"] for r in votes.groupBy("quality").count().collect()}
    share = shares.get(1, 0) / sum(shares.values()) if shares else 0.5
    return trained(texts[1], texts[0], share)


def trained(good: list[bytes], bad: list[bytes], share: float) -> Model:
    if min(len(good), len(bad)) < 2:
        odds = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
        return Model(b"", b"", (), (), (odds,))
    dictionaries = [_dictionary(texts[::2]) for texts in (good, bad)]
    measure = Measure(*dictionaries)
    x = np.array([measure(t) for texts in (good, bad) for t in texts[1::2]])
    y = np.repeat([1.0, 0.0], [len(good[1::2]), len(bad[1::2])])
    low, high = x.min(axis=0), x.max(axis=0)
    # Classes count as often as in all labels
    each = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    return Model(*dictionaries, tuple(low), tuple(high), tuple(_logistic(_terms(x, low, high), y, each)))


def _dictionary(texts: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes()
    except zstandard.ZstdError:
        # Too little text to choose from: all of it
        return b"".join(texts)[:DICTIONARY_BYTES]


class Measure:
    """What the two compressed sizes say of a text."""

    def __init__(self, good: bytes, bad: bytes):
        self.compressors = [self._compressor(d) for d in (good, bad)]

    @staticmethod
    def _compressor(data: bytes) -> zstandard.ZstdCompressor:
        made = zstandard.ZstdCompressionDict(data)
        made.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(dict_data=made, write_content_size=False, write_checksum=False, write_dict_id=False)

    def __call__(self, text: bytes) -> tuple[float, float, float]:
        good, bad = (self._size(c, text) for c in self.compressors)
        difference = (bad - good) / max(good, bad)
        return difference, float(np.log((min(good, bad) + 10) / (len(text) + 10))), float(np.log(len(text) + 10))

    @staticmethod
    def _size(compressor: zstandard.ZstdCompressor, text: bytes) -> int:
        if len(text) <= BLOCK_BYTES:
            return len(compressor.compress(text))
        stream = compressor.compressobj()
        parts = (stream.compress(text[i : i + BLOCK_BYTES]) for i in range(0, len(text), BLOCK_BYTES))
        return sum(map(len, parts)) + len(stream.flush())


def _terms(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Measures within the range seen in calibration, scaled to -1..1, with their products."""
    span = np.maximum(np.asarray(high) - low, 1e-9)
    u = 2 * (np.clip(x, low, high) - low) / span - 1
    d, r, n = u.T
    return np.stack([np.ones(len(u)), d, r, n, d * d, r * r, d * r, d * n, r * n], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, each: np.ndarray, ridge: float = 0.01) -> np.ndarray:
    w, loss = np.zeros(x.shape[1]), np.inf
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (each * (p - y)) + ridge * w
        step = np.linalg.solve((x * (each * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), gradient)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: good likelier) and ``predicted`` (1 from 0.5 on).

    NULL counts as the empty text, which has a score like any other. Whole texts are measured.
    The model (two dictionaries of bounded size) goes out with the function. Columns of the
    new names are replaced.
    """
    keep = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    schema = docs.select(*quoted(keep)).withColumns({"score": F.lit(0.0), "predicted": F.lit(1)}).schema

    def build():
        measure = Measure(model.good, model.bad) if model.low else None
        weights = np.array(model.weights)

        def add(batch: pa.RecordBatch) -> pa.RecordBatch:
            if measure is None:
                z = np.full(batch.num_rows, weights[0])
            else:
                x = np.array([measure(t) for t in text_bytes(batch.column(text))])
                z = _terms(x, np.array(model.low), np.array(model.high)) @ weights
            score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            columns = [*batch.columns, pa.array(score), pa.array((score >= 0.5).astype(np.int32))]
            return pa.RecordBatch.from_arrays(columns, names=[*keep, "score", "predicted"])

        return add

    return map_batches(docs.select(*quoted(keep)), build, schema)

"""Near-duplicates by SimHash fingerprints, found with pigeonring filtering.

A fingerprint is cut into ``distance + 1`` segments that lie on a ring. Of two fingerprints
with at most ``distance`` differing bits, some chain of consecutive segments keeps within its
proportional budget at every length: its first ``l`` segments differ in no more than
``l * distance / segments`` bits. So the first segment of the chain is equal and the second
differs in one bit at most. These two segments are the join key; the side of the pair whose
differing bit is set asks with the bit cleared. Longer prefixes of the chain, then the whole
distance, are checked on the candidates of a key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smelter.llm.arrow import map_batches, text_bytes
from smelter.llm.columns import quoted
from smelter.llm.components import components
from smelter.scratch import by_rows, stage

SEED = 42
SPACE = b" \t\n\x0b\f\r"
# Words of a text handled at once, and fingerprints of a key compared at once
BLOCK_BYTES = 1 << 20
TILE = 512


def simhash(text: bytes, width: int = 3) -> int:
    """Fingerprint of one text as a signed 64-bit number; a text without words has 0.

    Of fewer than ``width`` words, the whole sequence is the one shingle.
    """
    counts, total, carry = np.zeros(64, dtype=np.int64), 0, []
    for part in _parts(text):
        words = carry + part.lower().split()
        if len(words) >= width:
            runs = zip(*(words[i:] for i in range(width)))
            counts += _bit_counts([xxhash.xxh64_intdigest(b" ".join(run), SEED) for run in runs])
            total += len(words) - width + 1
        carry = words[max(0, len(words) - width + 1) :]
    if not total and carry:
        counts, total = _bit_counts([xxhash.xxh64_intdigest(b" ".join(carry), SEED)]), 1
    bits = (2 * counts > total).astype(np.uint64) << np.arange(64, dtype=np.uint64)
    return int(np.bitwise_or.reduce(bits).astype(np.int64))


def _parts(text: bytes) -> Iterator[bytes]:
    """The text in parts that end between words, so that a long one takes no more memory."""
    begin = 0
    while begin < len(text):
        end = begin + BLOCK_BYTES
        while end < len(text) and text[end : end + 1] not in (b" ", b"\t", b"\n", b"\x0b", b"\f", b"\r"):
            end += 1
        yield text[begin:end]
        begin = end


def _bit_counts(hashes: list[int]) -> np.ndarray:
    octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def with_fingerprint(df: DataFrame, text: str = "text", column: str = "fp", width: int = 3) -> DataFrame:
    """All columns but the text, and the fingerprint as a bigint. NULL counts as the empty text."""
    keep = [c for c in df.columns if c != text]
    schema = df.select(*quoted(keep)).withColumn(column, F.lit(0).cast("bigint")).schema

    def build():
        def add(batch: pa.RecordBatch) -> pa.RecordBatch:
            prints = pa.array([simhash(t, width) for t in text_bytes(batch.column(0))], pa.int64())
            return pa.RecordBatch.from_arrays([*batch.columns[1:], prints], names=[*keep, column])

        return add

    return map_batches(df.select(*quoted([text, *keep])), build, schema)


def ring(distance: int) -> list[int]:
    """Widths of the segments."""
    n = distance + 1
    return [64 // n + (i < 64 % n) for i in range(n)]


def links(prints: DataFrame, distance: int = 3) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) at ``distance`` or fewer bits.

    Every link is within a component of those returned: of the links inside one key, a
    spanning forest is given and not every pair. ``distance`` 1 to 15.
    """
    if not 1 <= distance <= 15:
        raise ValueError("distance must be from 1 to 15")
    keys = prints.select("fp").mapInArrow(_chain_keys(distance), "seg int, key bigint, fp bigint, own boolean")
    shared = keys.groupBy("seg", "key").agg(F.count("*").alias("n"), F.max("own").alias("met")).where("n > 1 and met")
    blocks = F.ceil(F.col("n") / TILE).cast("int")
    # Spark takes the keys to be as few as the fingerprints, of which each has dozens, and would broadcast them
    met = keys.hint("merge").join(shared.drop("met"), ["seg", "key"]).select(
        "seg", "key", "fp", "own", F.pmod(F.xxhash64("fp"), blocks).cast("int").alias("block"), blocks.alias("blocks")
    )
    # A key with many rows is cut into blocks; each pair of blocks is one small group
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tiles = met.select("*", other).groupBy("seg", "key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    tiles = tiles.agg(F.collect_list("fp").alias("fps"), F.collect_list("own").alias("owns")).where(F.size("fps") > 1)
    return tiles.select("seg", "fps", "owns").mapInArrow(_verified(distance), "a bigint, b bigint").distinct()


def _rotated(values: np.ndarray, by: int) -> np.ndarray:
    left, right = np.uint64(by % 64), np.uint64((64 - by) % 64)
    return (values << left) | (values >> right) if by % 64 else values


def _chain_keys(distance: int):
    widths = ring(distance)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for seg in range(len(widths)):
                second = widths[(seg + 1) % len(widths)]
                first_two = widths[seg] + second
                key = _rotated(prints, sum(widths[:seg])) >> np.uint64(64 - first_two)
                yield _keyed(seg, key, prints, True)
                for bit in range(second):
                    flag = np.uint64(1 << bit)
                    asks = (key & flag) != 0
                    yield _keyed(seg, key[asks] ^ flag, prints[asks], False)

    return run


def _keyed(seg: int, key: np.ndarray, prints: np.ndarray, own: bool) -> pa.RecordBatch:
    n = len(key)
    columns = [np.full(n, seg, np.int32), key.view(np.int64), prints.view(np.int64), np.full(n, own)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["seg", "key", "fp", "own"])


def _verified(distance: int):
    widths = ring(distance)

    def near(prints: np.ndarray, own: np.ndarray, seg: int) -> np.ndarray:
        """Which of the fingerprints are linked; one of each pair has the key as its own."""
        apart = prints[own][:, None] ^ prints[None, :]
        turned = _rotated(apart, sum(widths[:seg]))
        chain = np.ones(apart.shape, bool)
        for length in range(3, len(widths)):
            seen = sum(widths[(seg + i) % len(widths)] for i in range(length))
            chain &= np.bitwise_count(turned >> np.uint64(64 - seen)) <= length * distance // len(widths)
        chain[chain] = np.bitwise_count(apart[chain]) <= distance
        linked = np.zeros((len(prints), len(prints)), bool)
        linked[own] = chain
        return linked | linked.T

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for seg, prints, own in zip(*(c.to_pylist() for c in batch.columns)):
                values = np.array(prints, dtype=np.int64).view(np.uint64)
                for i, j in forest(near(values, np.array(own), seg)):
                    a.append(prints[i])
                    b.append(prints[j])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def forest(linked: np.ndarray) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric matrix of links."""
    waiting = linked.any(axis=1)
    while waiting.any():
        edge = np.array([np.argmax(waiting)])
        waiting[edge] = False
        while len(edge):
            reached = np.flatnonzero(linked[edge].any(axis=0) & waiting)
            parents = edge[linked[np.ix_(edge, reached)].argmax(axis=0)]
            yield from zip(parents.tolist(), reached.tolist())
            waiting[reached] = False
            edge = reached


def near_duplicates(docs: DataFrame, distance: int = 3, width: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Fingerprint and component of every row: (key, fp bigint, component_id).

    Fingerprints link at ``distance`` or fewer differing bits; ``component_id`` is the
    smallest key reachable over links, the row's own included. NULL and empty texts have
    fingerprint 0 and are linked like any other. Repeated rows stay repeated. A NULL key
    never is the smallest; a component of NULL keys alone has a NULL id. No rows: no rows.
    """
    rows = stage(with_fingerprint(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), width=width), "prints")
    prints = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    roots = stage(components(links(prints, distance)), "roots")
    placed = prints.join(by_rows(roots.withColumnRenamed("node", "fp")), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = placed.join(smallest, "root").select("fp", "component_id")
    return by_rows(rows).join(classes, "fp", "left").select(F.col("doc_id").alias(key), "fp", "component_id")


def one_of_each(docs: DataFrame, distance: int = 3, width: int = 3) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest doc_id.

    Of several rows with that doc_id the first by content stays. Columns are those of ``docs``.
    Rows without a doc_id stay only where no other row of their group has one.
    """
    return first_of_each(docs, lambda rows: near_duplicates(rows, distance, width))


def first_of_each(docs: DataFrame, grouped: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """As ``one_of_each``; ``grouped`` gives rows (text, doc_id) their component_id."""
    mark = F.xxhash64(*quoted(docs.columns))
    groups = grouped(docs.select("text", F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", mark.alias("mark")).alias("doc_id")))
    kept = groups.where("doc_id = component_id").select(F.col("doc_id.doc_id").alias("kept_id"), F.col("doc_id.mark").alias("kept_mark")).distinct()
    marked = docs.select(F.struct(*quoted(docs.columns)).alias("row"), F.col("doc_id").alias("id"), mark.alias("mark"))
    found = marked.join(kept, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("mark") == F.col("kept_mark")), "left_semi")
    first = Window.partitionBy("id", "mark").orderBy("mark")
    return found.withColumn("nth", F.row_number().over(first)).where("nth = 1").select("row.*")


def hex_fingerprint(column: str = "fp"):
    """The fingerprint as 16 lowercase hexadecimal digits."""
    return F.lpad(F.lower(F.hex(column)), 16, "0")

"""Suffix-array dedup: bytes covered by a string of ``width`` bytes that also starts elsewhere.

Strings of that length go to shards by the least hash of the short strings inside them, so that equal
ones meet, and neighbours mostly travel together, as one segment of a text. Segments whose hash
nobody else has are left where they are; equal segments are counted and travel once. Each shard
is then sorted by external induced sorting (``induced``), and neighbours in its order that share
``width`` bytes are the repeated strings. A shard may be far larger than memory.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm import induced
from smelter.llm.arrow import Memo, map_batches, slices, text_bytes
from smelter.scratch import discard, stage

WIDTH = 200
# Length of the short strings by which longer ones are dealt out
SEED_BYTES = 32
# Bytes of a text that are hashed at once
BLOCK_BYTES = 1 << 17
# Bytes of segments that make a shard, as long as there are not more shards than these
SHARD_BYTES, SHARDS = 2 << 20, 1 << 16
# One in so many hashes ends a segment
PARTED = 8
SPAN = "struct<start: bigint, end: bigint>"
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
# Of the rolling hash
BASE, FIRST = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def seed_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """A hash of each ``length`` bytes of ``data``, from every place on."""

    def rolled(n: int) -> np.ndarray:
        if n == 1:
            return (data.astype(np.uint64) + np.uint64(1)) * np.uint64(FIRST)
        half = n // 2
        front = rolled(half)
        power = np.uint64(pow(BASE, half, 1 << 64))
        both = front[: len(front) - half] * power + front[half:]
        if n % 2:
            last = (data[n - 1 :].astype(np.uint64) + np.uint64(1)) * np.uint64(FIRST)
            both = both[: len(last)] * np.uint64(BASE) + last
        return both

    hashes = rolled(length)
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(0x9FB21C651E98DF25)
    hashes ^= hashes >> np.uint64(29)
    return hashes


def _window_least(values: np.ndarray, window: int) -> np.ndarray:
    done = 1
    while 2 * done <= window:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = window - done
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def blocks(texts: Iterable[bytes], width: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Texts in blocks of some (row, start, bytes): short ones together, long ones cut, each string of ``width`` bytes in one."""
    block, size = [], 0
    for row, text in enumerate(texts):
        for start in range(0, max(0, len(text) - width + 1), BLOCK_BYTES):
            piece = text[start : start + BLOCK_BYTES + width - 1]
            if size + len(piece) > BLOCK_BYTES and block:
                yield block
                block, size = [], 0
            block.append((row, start, piece))
            size += len(piece)
    if block:
        yield block


def segments(block: list[tuple[int, int, bytes]], width: int, seed: int) -> tuple[np.ndarray, ...]:
    """(row, key, start, count, weight) of runs of places whose ``width`` bytes have one least hash; each place once.

    ``weight`` is 2 if the hash is that of two places inside the run, so that the run may repeat itself.
    """
    most = width - seed + 1
    data = np.frombuffer(b"".join(piece for _, _, piece in block), np.uint8)
    ends = np.cumsum([len(piece) for _, _, piece in block])
    hashes = seed_hashes(data, seed)
    # The low bits give way to the place, so that the least says where it is
    places = np.uint64((1 << int(len(hashes)).bit_length()) - 1)
    least = _window_least(hashes & ~places | np.arange(len(hashes), dtype=np.uint64), most) & places
    key = hashes[least]
    change = np.append(True, key[1:] != key[:-1])
    # The places of a piece, and those whose string would leave it
    first = np.append(0, ends[:-1])
    change[first[first < len(key)]] = True
    change[ends[:-1] - width + 1] = True
    new = np.flatnonzero(change)
    length = np.diff(np.append(new, len(key)))
    piece = np.searchsorted(ends, new, "right")
    inside = new + width <= ends[piece]
    new, length, piece = new[inside], length[inside], piece[inside]
    # Of a text that repeats itself runs can be long: they are cut
    parts = -(-length // most)
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    start = np.repeat(new, parts) + nth * most
    count = np.minimum(np.repeat(new + length, parts) - start, most)
    weight = 1 + (least[start] != least[start + count - 1])
    piece = np.repeat(piece, parts)
    rows, begins = (np.array(c, np.int64) for c in list(zip(*block))[:2])
    return rows[piece], key[start].view(np.int64), begins[piece] + start - first[piece], count.astype(np.int32), weight.astype(np.int32)


def repeated_spans(texts: DataFrame, width: int = WIDTH, shard_bytes: int = SHARD_BYTES, memory: int = induced.MEMORY) -> DataFrame:
    """(id, mark, spans): maximal runs of repeated bytes of each text that has any, in order, as (start, end).

    ``texts``: id, mark, text; rows equal in id and mark have equal texts, and each counts. ``memory``: items of
    a queue or list that a task holds outside of files.
    """
    seed = max(1, min(SEED_BYTES, width // 4))
    keyed = texts.select("text", "id", "mark")
    schema = texts.select("id", "mark").withColumns({"key": F.lit(0).cast("bigint"), "start": F.lit(0).cast("bigint"), "count": F.lit(0), "weight": F.lit(0)}).schema
    found = stage(map_batches(keyed, lambda: _found(width, seed), schema), "segments")
    # Hashes that occur twice. Their shard is named by the least of their texts, so that hashes of the
    # same texts share a shard, and neighbours travel as one segment
    shared = found.groupBy("key").agg(F.sum("weight").alias("n"), F.min("mark").alias("shard")).where("n > 1")
    shared = stage(shared, "shared")
    # One text may share something with a third of all: hashes of such a shard are dealt out one by one
    runs_of_shard = max(1, 2 * shard_bytes // (width - seed + 1))
    hot = shared.groupBy(F.col("shard").alias("hot")).agg(F.sum("n").alias("runs")).where(F.col("runs") > runs_of_shard)
    parted = shared.join(hot, F.col("shard") == F.col("hot"), "left")
    dealt = stage(parted.select("key", F.when(F.col("hot").isNull(), F.col("shard")).otherwise(F.col("key")).alias("shard")), "dealt")
    wanted = found.join(dealt, "key").groupBy("id", "mark")
    wanted = stage(wanted.agg(F.sort_array(F.collect_set(F.struct("start", "count", "shard", "key"))).alias("at")), "wanted")
    discard(found, shared, dealt)
    cut = keyed.join(wanted.withColumnsRenamed({"id": "i", "mark": "m"}), (F.col("mark") == F.col("m")) & F.col("id").eqNullSafe(F.col("i")))
    schema = texts.select("id", "mark").withColumns({c: F.lit(0).cast("bigint") for c in ("shard", "a", "b", "start", "n_bytes")}).withColumn("content", F.lit(None).cast("binary")).schema
    cut = stage(map_batches(cut.select("text", "at", "id", "mark"), lambda: _cut(width), schema), "cut")
    # Equal segments are sorted once, with their number
    total = cut.agg(F.sum("n_bytes")).first()[0] or 0
    shards = cut.select("shard", "a", "b", "content").repartition(min(SHARDS, max(1, -(-total // shard_bytes))), "shard")
    bodies = shards.groupBy("shard", "a", "b").agg(F.count("*").alias("n"), F.first("content", ignorenulls=True).alias("content"))
    runs = bodies.select("a", "b", "n", "content").mapInArrow(_sorted(width, memory), f"a bigint, b bigint, runs array<{SPAN}>")
    runs = stage(runs, "runs")
    placed = cut.select("id", "mark", "a", "b", "start").distinct().join(runs, ["a", "b"])
    moved = F.transform("runs", lambda r: F.struct((F.col("start") + r["start"]).alias("start"), (F.col("start") + r["end"]).alias("end")))
    spans = placed.groupBy("id", "mark").agg(F.flatten(F.collect_list(moved)).alias("spans"))
    spans = stage(map_batches(spans.select("spans", "id", "mark"), lambda: _united, spans.schema), "spans")
    discard(wanted, cut, runs)
    return spans


def deduplicate(docs: DataFrame, width: int = WIDTH, text: str = "text", key: str = "doc_id", shard_bytes: int = SHARD_BYTES, memory: int = induced.MEMORY) -> DataFrame:
    """Each row's key, n_bytes, n_removed, n_spans (bigint), spans (start, end) that go, and the bytes kept (binary).

    A byte goes if it is covered by a string of ``width`` bytes that starts anywhere else too, in the same text or
    another's. Strings are judged on the input, so of copies none stays. NULL and empty texts have no bytes. Each
    row is a document: rows repeated whole are copies of each other. What is kept may end inside a character, so
    it is binary. Other columns of ``docs`` play no part, whatever their names.
    """
    if width < 1:
        raise ValueError("width must be at least 1")
    body = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(F.col(key).alias("id"), F.xxhash64(body, F.col(key)).alias("mark"), body.alias("text"))
    spans = repeated_spans(texts, width, shard_bytes, memory).withColumnsRenamed({"id": "i", "mark": "m"})
    joined = texts.join(spans, (F.col("mark") == F.col("m")) & F.col("id").eqNullSafe(F.col("i")), "left")
    result = f"n_bytes: bigint, n_removed: bigint, n_spans: bigint, spans: array<{SPAN}>, kept: binary"
    schema = joined.select("id", F.lit(None).cast(f"struct<{result}>").alias("r")).schema
    return map_batches(joined.select("text", "spans", "id"), _kept, schema).select(F.col("id").alias(key), "r.*")


def _found(width: int, seed: int):
    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        none = tuple(np.zeros(0, kind) for kind in (np.int64, np.int64, np.int64, np.int32, np.int32))
        parts = [none, *(segments(block, width, seed) for block in blocks(text_bytes(batch.column(0)), width))]
        rows, *made = (pa.array(np.concatenate(column)) for column in zip(*parts))
        return pa.RecordBatch.from_arrays([batch.column(1).take(rows), batch.column(2).take(rows), *made], names=["id", "mark", "key", "start", "count", "weight"])

    return add


def _joined(at: list[dict]) -> Iterator[tuple[int, int, int]]:
    """(shard, start, count) of runs that follow each other in one shard.

    They are parted again behind every eighth or so, as the hash says, so that copies are parted alike.
    """
    shard, start, end, parted = None, 0, 0, False
    for run in at:
        if shard is not None and (run["shard"] != shard or run["start"] != end or parted):
            yield shard, start, end - start
            shard = None
        if shard is None:
            shard, start = run["shard"], run["start"]
        end, parted = run["start"] + run["count"], run["key"] % PARTED == 0
    if shard is not None:
        yield shard, start, end - start


def _cut(width: int):
    # A task sends an equal segment once, as long as it remembers it
    sent = Memo(lambda digest: [True], 1 << 18)

    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, numbers, contents = [], ([], [], [], [], []), []
        for row, (text, at) in enumerate(zip(text_bytes(batch.column(0)), batch.column(1))):
            for shard, start, count in _joined(at.as_py()):
                content = text[start : start + count + width - 1]
                digest = xxhash.xxh3_128_digest(content)
                halves = (int.from_bytes(half, "little", signed=True) for half in (digest[:8], digest[8:]))
                rows.append(row)
                for column, value in zip(numbers, (shard, *halves, start, len(content))):
                    column.append(value)
                first = sent[shard, digest]
                contents.append(content if first else None)
                first.clear()
        taken = pa.array(rows, pa.int64())
        made = [pa.array(c, pa.int64()) for c in numbers]
        arrays = [batch.column(2).take(taken), batch.column(3).take(taken), *made, pa.array(contents, pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=["id", "mark", "shard", "a", "b", "start", "n_bytes", "content"])

    return add


def _sorted(width: int, memory: int):
    """The repeated strings of a shard's segments, whose text is gathered in a file: (a, b, runs of covered bytes)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory() as folder:
            room = induced.Room(folder, memory)
            names: list[np.ndarray] = []

            def gathered() -> Iterator[np.ndarray]:
                for batch in batches:
                    for part in slices(batch):
                        content = part.column(3)
                        length = np.array([len(c) for c in text_bytes(content)], np.int64)
                        if not len(length):
                            continue
                        data = np.frombuffer(b"".join(text_bytes(content)), np.uint8).astype(np.uint16) + induced.RAISED
                        ends = np.cumsum(length)
                        yield np.insert(data, ends, induced.BETWEEN)
                        fixed = [part.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
                        names.append(np.array([*fixed, length]).T)
                yield np.array([induced.END], np.uint16)

            text = room.kept(gathered(), np.uint16)
            if not names:
                return
            own = np.concatenate(names)
            shared = room.array(len(text), np.bool_)
            last = 0
            for places, common in induced.suffixes(text, 255 + induced.RAISED, width, room):
                alike = common >= width
                shared[places[alike]] = True
                shared[np.append(last, places[:-1])[alike]] = True
                last = int(places[-1])
            begin, out = 0, []
            for a, b, n, length in own.tolist():
                # Its places with a whole string behind them; of a segment that is there twice, all
                here = np.asarray(shared[begin : begin + length - width + 1])
                here = np.ones_like(here) if n > 1 else here
                edges = np.flatnonzero(np.diff(np.concatenate([[False], here, [False]]).astype(np.int8)))
                if len(edges):
                    out.append((a, b, [{"start": s, "end": e - 1 + width} for s, e in edges.reshape(-1, 2).tolist()]))
                begin += length + 1
                if len(out) >= 1 << 14:
                    yield _batch(out)
                    out = []
            yield _batch(out)

    return run


def _united(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Spans in order, those that touch or overlap made one."""
    out = []
    for spans in batch.column(0):
        edges = np.array(sorted((s["start"], s["end"]) for s in spans.as_py()))
        reach = np.maximum.accumulate(edges[:, 1])
        begins = np.append(True, edges[1:, 0] > reach[:-1])
        ends = reach[np.append(begins[1:], True)]
        out.append([{"start": s, "end": e} for s, e in zip(edges[begins, 0].tolist(), ends.tolist())])
    arrays = [batch.column(1), batch.column(2), pa.array(out, SPANS)]
    return pa.RecordBatch.from_arrays(arrays, names=["id", "mark", "spans"])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    a, b, runs = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(runs, SPANS)], names=["a", "b", "runs"])


def _kept():
    kind = pa.struct([
        ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("spans", SPANS), ("kept", pa.binary()),
    ])

    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text, spans in zip(text_bytes(batch.column(0)), batch.column(1)):
            spans = spans.as_py() or []
            edges = [0, *(e for s in spans for e in (s["start"], s["end"])), len(text)]
            kept = b"".join(text[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2)) if spans else text
            out.append({"n_bytes": len(text), "n_removed": len(text) - len(kept), "n_spans": len(spans), "spans": spans, "kept": kept})
        return pa.RecordBatch.from_arrays([batch.column(2), pa.array(out, kind)], names=["id", "r"])

    return add

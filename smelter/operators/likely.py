"""Which rows of a large table may have a key of a batch, before anything is shuffled.

The keys of the batch set bits in a bitmap that is cut into blocks of 32768 bits: one hash
picks the block, others the bits inside. The blocks are rows of 4 KB, so that a table of known
size is broadcast to the tasks that read the target, and of the target only rows whose bits are
all set go on to the join. A row that has a key of the batch is never lost; of the others a few
percent pass and fall out in the join. It pays where the keys are too many to broadcast
themselves: a key takes two bytes here, whatever its columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.operators.merge import join_keys, most_broadcast
from smelter.operators.rules import all_present
from smelter.scratch import driver_memory, row_bytes, stage

BLOCK_BITS = 1 << 15
BITS_PER_KEY = 16
PROBES = 2
# Bytes of all blocks together that may be broadcast, and the part of the driver's memory that they may
# take: it holds what it collects, the table made of it, which doubles as it grows, and the pieces sent out
LARGEST = 256 << 20
SHARE_OF_DRIVER = 16
WORDS = BLOCK_BITS // 64


class KeyBits(NamedTuple):
    """Blocks that were written: (block, words array<bigint>), and how many there could be."""

    blocks: DataFrame
    number: int


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(F.lit("bits"), *keys)


def _block(hashed: Column, number: int) -> Column:
    return F.pmod(hashed, F.lit(number)).cast("int")


def _places(hashed: Column, probes: int = PROBES) -> list[Column]:
    """Bits inside the block, each from other bits of a second hash."""
    mixed = F.xxhash64(hashed)
    return [F.shiftrightunsigned(mixed, 15 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)) for i in range(probes)]


def _words(bits: str) -> Column:
    """The words of a block, array<bigint>: eight bytes make one, the first is its highest.

    They are cut out before they become text: else the whole block would be made text for each word, and
    counted through from its beginning.
    """
    return F.transform(
        F.sequence(F.lit(0), F.lit(WORDS - 1)),
        lambda i: F.conv(F.hex(F.substring(bits, i * 8 + 1, F.lit(8))), 16, -10).cast("bigint"),
    )


def key_bits(batch: DataFrame, keys: Sequence[str], rows: int, largest: int = LARGEST) -> KeyBits | None:
    """Bits of the batch's keys, made for ``rows`` keys; None if that takes more than ``largest`` bytes.

    The blocks are staged: ``discard(bits.blocks)`` removes them. A key that is NULL in part has its bits too.
    """
    number = max(1, -(-rows * BITS_PER_KEY // BLOCK_BITS))
    if number * BLOCK_BITS // 8 > largest:
        return None
    hashed = batch.select(_hash(keys).alias("hash"))
    # Places count from 1, over all blocks
    begin = _block(F.col("hash"), number).cast("bigint") * BLOCK_BITS + 1
    placed = hashed.select(F.explode(F.array(*[begin + p for p in _places(F.col("hash"))])).alias("place"))
    bitmaps = placed.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
    )
    blocks = bitmaps.select((F.col("bucket") - 1).cast("int").alias("_block"), _words("bits").alias("_words"))
    return KeyBits(stage(blocks, "bits"), number)


def likely(target: DataFrame, bits: KeyBits, keys: Sequence[str], otherwise: bool = False) -> DataFrame:
    """Rows of ``target`` whose key may be in the batch; ``otherwise``: those whose key is not.

    Each row is in one of the two. The target is neither shuffled nor sorted: the blocks are broadcast,
    whose size was checked when they were made. ``keys`` have the types that the batch's have.
    """
    hashed = target.withColumn("_hash", _hash(keys))
    met = hashed.withColumn("_at", _block(F.col("_hash"), bits.number)).join(
        F.broadcast(bits.blocks), F.col("_at") == F.col("_block"), "left" if otherwise else "inner"
    )
    found = F.lit(True)
    for place in _places(F.col("_hash")):
        word = F.get("_words", F.shiftrightunsigned(place, 6).cast("int"))
        # Bytes of a word count from its highest, bits of a byte from the lowest
        inside = place.bitwiseAND(F.lit(63)).cast("int")
        shift = 56 - F.shiftright(inside, 3) * 8 + inside.bitwiseAND(F.lit(7))
        found = found & (F.getbit(word, shift) == 1)
    found = F.coalesce(found, F.lit(False))
    # Always true, and different by task: the optimizer would else push a join that follows below this
    # one, and shuffle the whole target for it
    barrier = F.spark_partition_id() >= 0
    return met.filter(~found if otherwise else found).filter(barrier).select(*target.columns)


def upsert_likely(target: DataFrame, batch: DataFrame, keys: Sequence[str], bits: KeyBits, null_keys: str = "insert") -> DataFrame:
    """As ``merge_upsert`` of a batch with the target's types: of the target only likely rows meet the batch."""
    kept = join_keys(likely(target, bits, keys), batch, keys, "left_anti", null_keys)
    return likely(target, bits, keys, otherwise=True).unionByName(kept).unionByName(batch, allowMissingColumns=True)


def bits_if_worth(
    batch: DataFrame, keys: Sequence[str], null_keys: str = "insert", largest: int | None = None, rows: int | None = None
) -> KeyBits | None:
    """Bits of a staged batch whose keys are too many to be broadcast; None where Spark may broadcast them, or where
    the bits are more than ``largest`` bytes: by default what the driver can take, ``LARGEST`` at most.

    ``rows``: those of the target, where known. One with no more rows than the batch has keys costs no more to
    shuffle than the batch does, and gets no bits.
    """
    spark = batch.sparkSession
    keyed = batch.select(*keys) if null_keys == "match" else batch.filter(all_present(keys)).select(*keys)
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    number = keyed.count()
    small = int(str(keyed._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit
    if small and number * row_bytes(keyed) <= most_broadcast(spark):
        return None
    if rows is not None and rows <= number:
        return None
    if largest is None:
        largest = min(LARGEST, driver_memory(spark) // SHARE_OF_DRIVER)
    return key_bits(keyed, keys, number, largest)

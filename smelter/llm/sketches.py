"""Document fingerprints: sketches of all shingle hashes below a fixed threshold.

A sketch holds a fixed fraction of a text's shingles, however many these are. So sketches of
parts unite to that of the whole, and the share of one text found in another can be
estimated for texts of very unequal length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smelter.llm.columns import Aside
from smelter.scratch import stage

BLANK = r"[\x20\x09-\x0D]+"
SHINGLE = 5
FRACTION = 1 / 8


def shingle_hashes(text: Column, words: int = SHINGLE) -> Column:
    """Hashes of all runs of ``words`` words; of fewer words, one of the whole sequence; of none, none."""
    hashed = F.transform(F.filter(F.split(text, BLANK), lambda w: w != ""), lambda w: F.xxhash64(w))

    def runs(all_of: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(all_of) - words)
        long = F.transform(starts, lambda i: F.xxhash64(*[F.get(all_of, i + j) for j in range(words)]))
        short = F.when(F.size(all_of) > 0, F.array(F.xxhash64(all_of))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(all_of) >= words, long).otherwise(short)

    # Bound once: the lambda's variable is not computed again at each use
    return F.get(F.transform(F.array(hashed), runs), F.lit(0))


def sketch(hashes: Column, fraction: float = FRACTION) -> Column:
    """Sorted distinct hashes below ``fraction`` (up to 0.5) of the range of unsigned numbers.

    A text with words whose hashes are all above keeps the least, so that no text with words
    has an empty sketch.
    """
    if not 0 < fraction <= 0.5:
        raise ValueError("fraction must be over 0 and up to 0.5")
    threshold = int(fraction * (1 << 64)) - 1

    def kept(all_of: Column) -> Column:
        low = F.filter(all_of, lambda h: (h >= 0) & (h <= F.lit(threshold)))
        # Least as an unsigned number
        least = F.array_min(F.transform(all_of, lambda h: h.bitwiseXOR(F.lit(-(1 << 63)))))
        alone = F.when(F.size(all_of) > 0, F.array(least.bitwiseXOR(F.lit(-(1 << 63))))).otherwise(all_of)
        return F.get(F.transform(F.array(low), lambda x: F.when(F.size(x) > 0, F.array_sort(F.array_distinct(x))).otherwise(alone)), F.lit(0))

    return F.get(F.transform(F.array(hashes), kept), F.lit(0))


def merged(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """The sketch of two texts together, but for shingles that span both; ``fraction``: that of either."""
    return sketch(F.concat(a, b), fraction)


def likeness(a: Column, b: Column) -> Column:
    """Share of all shingles that both have, from 0 to 1; of two without words, 1."""
    both, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(either == 0, 1.0).otherwise(both / either)


def containment(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """Share of ``a``'s shingles found in ``b``; of none, 1; NULL where ``a`` has words but no hash below ``fraction``.

    The least hash of such a text says nothing: a longer text's sketch can't hold it.
    """
    # The hashes below are all of a sketch or none: only a hash kept alone is above
    low = F.exists(a, lambda h: (h >= 0) & (h <= F.lit(int(fraction * (1 << 64)) - 1)))
    share = F.size(F.array_intersect(a, b)) / F.size(a)
    return F.when(F.size(a) == 0, 1.0).when(low, share)


def as_text(of: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits for each hash, in order."""
    return F.array_join(F.transform(of, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def with_next(docs: DataFrame, columns: list[str], key: str = "doc_id", parts: int | None = None) -> DataFrame:
    """``docs`` with ``next``: a struct of ``columns`` of the row that follows by ``key``; after the last, the first.

    NULL keys come last; rows of one key follow each other in order of a hash of ``columns``.
    Rows are dealt out by ranges of the key, and the first row of each range is handed to the
    range before it, so that no task has all rows.
    """
    spark, aside = docs.sparkSession, Aside(docs, "next")
    key, inner = aside[key], [aside[c] for c in columns]
    docs = docs.select(*aside.away)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [i / parts for i in range(1, parts)]
    bounds = docs.agg(F.percentile_approx(key, cuts, 10000)).first()[0] if cuts else []
    bounds = F.array(*[F.lit(b) for b in sorted(set(bounds or []))]).cast("array<bigint>")
    count = F.when(F.col(key).isNull(), parts).otherwise(F.size(F.filter(bounds, lambda b: b <= F.col(key))))
    placed = docs.withColumn("_range", count).withColumn("_order", F.struct(F.col(key).isNull().alias("last"), F.col(key).alias("key"), F.xxhash64(*inner).alias("h")))
    heads = placed.groupBy("_range").agg(F.min("_order").alias("head"))
    # One row for each range
    order = Window.orderBy("_range")
    everywhere = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("_range").over(order), F.max("_range").over(everywhere))
    heads = stage(heads.select(F.col("_range").alias("_r"), F.col("head.h").alias("_h"), F.col("head.key").alias("_k"), before.alias("_before")), "heads")
    is_head = (F.col("_range") == F.col("_r")) & (F.col("_order.h") == F.col("_h")) & F.col("_order.key").eqNullSafe(F.col("_k"))
    joined = placed.join(F.broadcast(heads), is_head, "left")
    places = F.array(F.struct(F.col("_range").alias("range"), F.lit(False).alias("lent")))
    lent = F.array(F.struct(F.col("_before").alias("range"), F.lit(True).alias("lent")))
    twice = joined.withColumn("_at", F.explode(F.when(F.col("_before").isNull(), places).otherwise(F.concat(places, lent))))
    follow = Window.partitionBy("_at.range").orderBy("_at.lent", "_order")
    out = twice.withColumn("next", F.lead(F.struct(*[F.col(i).alias(c) for c, i in zip(columns, inner)])).over(follow)).where(~F.col("_at.lent"))
    return out.select(*aside.back, "next")


def half_replaced(text: Column, other: Column) -> Column:
    """The last half of the code points replaced by as many from the front of ``other`` (or all)."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(other, F.lit(1), half))

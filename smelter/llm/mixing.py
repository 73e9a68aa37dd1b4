"""Mixing sources to target weights by entropy balancing.

Every source has a target of words. Of all rates of documents, up to the most copies allowed,
whose words meet the targets, those closest to one copy each in relative entropy are
exponential tilts by a document's words, ``min(most, exp(x * size))`` with one ``x`` for each
source. These ``x`` solve the convex dual: each Newton step adds up words and slopes over all
(source, size) classes of the corpus, for all sources at once. Rates are then rounded
into whole copies, spread so that each source's words stay next to its target.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smelter.llm.columns import Aside, quoted
from smelter.scratch import by_rows, discard, stage

WORD = r"[^\x20\x09-\x0D]+"
# Documents of one source and size that are put in order by one task
BUCKET = 5000


def word_count(text: Column) -> Column:
    """Maximal runs of anything but blanks; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Sources in order of code points, NULL last, weigh ``weights`` in turn and share ``share``
    times all sizes. A target stops at ``most`` times its source's size; what is over goes to
    the others by weight, until none is above. ``share`` must not exceed ``most``.
    """
    if share > most:
        raise ValueError("the sources can't give that many words")
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row for each source, so one task can number them
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.array(*[F.lit(w) for w in weights])[(nth % len(weights)).cast("int")]
    totals = stage(totals.withColumn("weight", weight), "sources")
    limit = F.lit(most) * F.col("source_size")
    level = None
    while True:
        # All sums are of whole numbers, so that the order of rows doesn't matter
        full = F.lit(False) if level is None else F.col("weight") * level > limit
        row = totals.agg(
            F.sum("source_size").alias("all"), F.coalesce(F.sum(F.when(full, F.col("source_size"))), F.lit(0)).alias("full"),
            F.sum(F.when(~full, F.col("weight"))).alias("weights"),
        ).first()
        now = (share * (row["all"] or 0) - most * row["full"]) / row["weights"] if row["weights"] else level or 0.0
        if now == level:
            break
        level = now
    return totals.select("source", "source_size", F.least(F.col("weight") * F.lit(level), limit).alias("target"))


def rates(classes: DataFrame, goals: DataFrame, most: float = 2.0, near: float = 1e-6, steps: int = 200) -> DataFrame:
    """``goals`` (source, source_size, target) with the tilt ``x`` and ``typical``, the size that it refers to.

    classes: (source, size, n). Newton's method from ``x`` = 0 on the dual, whose slope is
    ``sum(n * size * min(most, exp(x * size / typical))) - target``. What was too low and too
    high bounds the next step, which is halved towards a bound where Newton would leave them or
    all rates stand at ``most``. It ends when all sources are within ``near`` of their target or
    half a word. Sums are of decimals, so that they don't depend on the order of rows.
    ``x`` is NULL where nothing is to be tilted: all rates are ``most``, or 0 without a target.
    """
    sizes = classes.groupBy("source").agg(F.sum(F.col("n") * F.col("size").cast("double") ** 2).alias("squares"))
    # Rounded: a sum of doubles may differ in its last bits from run to run
    typical = F.round(F.greatest(F.col("squares") / F.greatest("source_size", F.lit(1)), F.lit(1.0)), 3)
    state = goals.join(sizes.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left")
    free = (F.col("target") > 0) & (F.col("target") < most * F.col("source_size"))
    nothing = F.lit(None).cast("double")
    state = state.select(*goals.columns, typical.alias("typical"), F.when(free, 0.0).alias("x"), nothing.alias("low"), nothing.alias("high"))
    state = stage(state.withColumn("gap", F.when(free, F.lit(float("inf")))), "dual")
    words = classes.where("size > 0").withColumnRenamed("source", "s")
    for _ in range(steps):
        if (state.agg(F.max("gap")).first()[0] or 0.0) == 0.0:
            break
        before, state = state, stage(_stepped(words, state, most, near), "dual")
        discard(before)
    return state.select(*goals.columns, "typical", "x")


def _rate(most: float) -> Column:
    exponent = F.col("x") * F.col("size") / F.col("typical")
    return F.when(exponent < math.log(most), F.exp(exponent)).otherwise(float(most))


def _stepped(words: DataFrame, state: DataFrame, most: float, near: float) -> DataFrame:
    """One Newton step of each source that isn't near its target yet; ``gap`` is 0 for the others."""
    given = words.join(state.where("gap > 0").select("source", "typical", "x"), F.col("s").eqNullSafe(F.col("source")))
    weight = (F.col("n") * F.col("size")).cast("double") * _rate(most)
    slope = F.when(_rate(most) < most, weight * F.col("size") / F.col("typical")).otherwise(0.0)
    sums = given.groupBy("s").agg(*[F.sum(c.cast("decimal(38,6)")).cast("double").alias(n) for c, n in ((weight, "words"), (slope, "slope"))])
    found = state.join(sums, F.col("source").eqNullSafe(F.col("s")), "left").withColumn("off", F.col("words") - F.col("target"))
    found = found.withColumn("low", F.when(F.col("off") < 0, F.col("x")).otherwise(F.col("low")))
    found = found.withColumn("high", F.when(F.col("off") > 0, F.col("x")).otherwise(F.col("high")))
    newton = F.when(F.col("slope") > 0, F.col("x") - F.col("off") / F.col("slope"))
    # Without a bound on that side yet, a step goes as far again as all those before, and one more
    below, above = F.coalesce("low", 2 * F.col("high") - 1), F.coalesce("high", 2 * F.col("low") + 1)
    within = newton.between(below, above) & (newton != F.col("x"))
    to = F.when(within, newton).when(F.col("low").isNull(), below).when(F.col("high").isNull(), above).otherwise((below + above) / 2)
    done = (F.abs("off") <= F.greatest(F.lit(0.5), near * F.col("target"))) | (to == F.col("x"))
    moving = F.coalesce(~done, F.lit(False))
    return found.select(
        "source", "source_size", "target", "typical", F.when(moving, to).otherwise(F.col("x")).alias("x"), "low", "high",
        F.when(moving, F.abs("off")).otherwise(0.0).alias("gap"),
    )


def mix(docs: DataFrame, size: Column, source: str = "source", key: str = "doc_id", weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies`` (0 to ``most``).

    The words of a source's copies miss its target by half its longest document at most, and by
    far less where it has short ones: rounding runs from long to short, then short documents
    close the gap. Where a source gives more words than it has, long documents are taken more
    often; where it gives less, short ones. The same
    rows give the same copies on every run; of rows equal in key, source and size, any may be
    the one with more. NULL is a source, NULL texts have no words, documents without words are
    taken once, ``most`` times where their source gives all it can, and not at all without a target.
    Columns of the new names are replaced. No rows: no rows.
    """
    aside = Aside(docs, "size", "source_size", "target", "copies")
    source, key = aside[source], aside[key]
    sized = docs.select(*aside.away, size.alias("size"))
    plain = sized.select(F.col(source).alias("source"), "size")
    classes = stage(plain.groupBy("source", "size").agg(F.count("*").alias("n")), "classes")
    goals = targets(classes.select("source", (F.col("size") * F.col("n")).alias("size")), weights, share, most)
    taken = stage(_class_copies(classes, rates(classes, goals, most), most), "copies")
    return _dealt(sized, taken, source, key).select(*aside.back, "size", "source_size", "target", "copies")


def _class_copies(classes: DataFrame, goals: DataFrame, most: int) -> DataFrame:
    """Copies of all documents of one source and size together: (source, size, n, total, ...)."""
    rows = classes.join(goals.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    full = F.when(F.col("target") > 0, float(most)).otherwise(0.0)
    rate = F.when(F.col("x").isNotNull(), _rate(most)).otherwise(full)
    rows = rows.withColumn("rate", F.round(rate, 9).cast("decimal(20,9)")).drop("x", "typical")
    # Rows are sizes of a source, not documents
    down = Window.partitionBy("source").orderBy(F.desc("size"))
    due = F.col("n") * F.col("rate")
    upto = F.sum(due).over(down.rowsBetween(Window.unboundedPreceding, 0))
    whole = F.floor(upto + F.lit(0.5).cast("decimal(2,1)"))
    rows = rows.withColumn("whole", whole.cast("bigint"))
    rows = rows.withColumn("total", F.col("whole") - F.coalesce(F.lag("whole").over(down), F.lit(0))).drop("whole", "rate")
    for nearer in (_closer, _closer, _closer, _swapped, _swapped):
        rows = nearer(stage(rows, "rounded"), most)
    return rows


def _closer(rows: DataFrame, most: int) -> DataFrame:
    """In each source, the size that brings the words nearest to the target takes up what is missing, or over."""
    gaps = rows.groupBy("source").agg((F.first("target") - F.sum(F.col("total") * F.col("size"))).alias("gap"))
    gaps = gaps.withColumnRenamed("source", "s")
    joined = rows.join(gaps, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    room = F.when(F.col("gap") > 0, F.col("n") * most - F.col("total")).otherwise(F.col("total"))
    moved = F.least(room, F.greatest(F.lit(1), F.floor(F.abs("gap") / F.greatest("size", F.lit(1)))))
    joined = joined.withColumn("moved", moved).withColumn("left", F.abs(F.abs("gap") - F.col("moved") * F.col("size")))
    better = joined.where((F.col("size") > 0) & (F.col("moved") > 0) & (F.col("left") < F.abs("gap")))
    chosen = better.groupBy("source").agg(F.min_by("size", F.struct("left", "size")).alias("chosen")).withColumnRenamed("source", "s")
    joined = joined.join(chosen, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    change = F.when(F.col("size") == F.col("chosen"), F.col("moved") * F.signum("gap").cast("bigint")).otherwise(0)
    return joined.withColumn("total", F.col("total") + change).drop("gap", "chosen", "moved", "left")


def _swapped(rows: DataFrame, most: int) -> DataFrame:
    """In each source, a copy of one size goes for one of another, those two that bring the words nearest to the target.

    Each size looks for the sizes next to its own plus what is missing, in one sort of a source's sizes.
    """
    gaps = rows.groupBy("source").agg((F.first("target") - F.sum(F.col("total") * F.col("size"))).alias("gap"))
    joined = rows.join(gaps.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    none = F.lit(None).cast("bigint")
    leaves = joined.where("total > 0").select("source", "gap", (F.col("size") + F.col("gap")).alias("at"), F.col("size").alias("leaves"), none.alias("comes"))
    comes = joined.where(F.col("total") < F.col("n") * most).select("source", "gap", F.col("size").cast("double").alias("at"), none, F.col("size"))
    order = Window.partitionBy("source").orderBy("at")
    below = F.last("comes", ignorenulls=True).over(order.rangeBetween(Window.unboundedPreceding, 0))
    above = F.first("comes", ignorenulls=True).over(order.rangeBetween(0, Window.unboundedFollowing))
    pairs = leaves.union(comes).withColumns({"below": below, "above": above})
    pairs = pairs.select("source", "gap", "leaves", F.explode(F.array("below", "above")).alias("comes"))
    pairs = pairs.withColumn("left", F.abs(F.col("gap") - F.col("comes") + F.col("leaves"))).where(F.col("left") < F.abs("gap"))
    best = pairs.groupBy("source").agg(F.min(F.struct("left", "leaves", "comes")).alias("best")).withColumnRenamed("source", "s")
    joined = joined.join(best, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    change = F.when(F.col("size") == F.col("best.leaves"), -1).when(F.col("size") == F.col("best.comes"), 1).otherwise(0)
    return joined.withColumn("total", F.col("total") + change).drop("gap", "best")


def _dealt(sized: DataFrame, taken: DataFrame, source: str, key: str) -> DataFrame:
    """Each class's copies dealt to its documents: all get as many, those first by hash one more."""
    parts = F.ceil(F.col("n") / BUCKET).cast("int")
    taken = taken.select(
        F.col("source").alias("_s"), F.col("size").alias("_z"), "source_size", "target", parts.alias("_parts"),
        F.floor(F.col("total") / F.greatest("n", F.lit(1))).cast("int").alias("_each"), F.pmod("total", F.greatest("n", F.lit(1))).alias("_more"),
    )
    same = F.col(source).eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z"))
    part = F.pmod(F.col("_hash"), F.col("_parts")).cast("int")
    rows = sized.join(by_rows(taken), same).drop("_z").withColumn("_hash", F.xxhash64(F.col(key))).withColumn("_part", part)
    # Only a class of more than a bucket of documents has parts whose counts must be known
    large = sized.select(F.col(source).alias("_s"), F.col("size").alias("_z"), F.xxhash64(F.col(key)).alias("_hash"))
    large = large.join(taken.where("_parts > 1").select(F.col("_s").alias("_t"), F.col("_z").alias("_y"), "_parts"), F.col("_s").eqNullSafe(F.col("_t")) & (F.col("_z") == F.col("_y")))
    counts = large.groupBy("_s", "_z", part.alias("_part")).agg(F.count("*").alias("_n"))
    ahead = Window.partitionBy("_s", "_z").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("_s").alias("_t"), F.col("_z").alias("_y"), F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    rows = rows.join(counts, F.col("_s").eqNullSafe(F.col("_t")) & (F.col("size") == F.col("_y")) & (F.col("_part") == F.col("_p")), "left")
    order = Window.partitionBy("_s", "size", "_part").orderBy("_hash", key)
    nth = F.coalesce("_ahead", F.lit(0)) + F.row_number().over(order) - 1
    copies = F.col("_each") + F.when(nth < F.col("_more"), 1).otherwise(0)
    return rows.withColumn("copies", copies.cast("int"))


def copied(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Each document as often as the mix takes it; those it doesn't take are gone."""
    return mixed.where("copies > 0").withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*quoted(columns))

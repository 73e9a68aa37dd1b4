"""Line deduplication: later copies of repeated runs of lines are deleted.

Lines become ids, and the texts sequences of ids over which the classes of a suffix array are
built by prefix doubling: the class of the 2^(k+1) lines from a position is that of the pair of
its 2^k-line classes here and 2^k lines further. A class holds the suffixes that share that
prefix, as an interval of longest common prefixes does; it is named by its first occurrence in
the corpus, so that "is there an earlier copy" needs no further look, and positions whose class
has one member are dropped from later rounds, so that these work on what repeats only.
A run counts from ``min_words`` words on, and goes whole, to the last line that its copy has too; runs
that overlap or touch make a longer one. A long run is that of its parts: those from each line on of
the fewest lines with enough words, and with each line more until those behind the first have enough
of their own, or up to the next line where lines without words stand between. So no part is longer than
``min_words`` lines, or two, and doubling ends there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smelter.llm.columns import Aside, quoted
from smelter.scratch import by_rows, stage

WORD = r"[^\x20\x09-\x0D]+"
DOC = ["_doc", "_mark"]


def deduplicate_lines(docs: DataFrame, min_words: int = 5, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with the text less its later copies, and ``n_lines``, ``removed_lines`` (int).

    Order of the corpus: ``key`` (NULL first), then content, then line. Rows equal in every
    column count as one document and stay equal. Lines without words are no part of a run's
    words; those inside a run go with it. A text that is all copy becomes empty; NULL and
    empty texts stay what they are (no lines and one line). Columns of the new names are
    replaced. Nothing is compared but whole lines as they are.
    """
    if min_words < 1:
        raise ValueError("min_words must be at least 1")
    aside = Aside(docs, "n_lines", "removed_lines")
    marked = docs.select(*aside.away, *[c.alias(DOC[0]) for c in quoted([key])], F.xxhash64(*quoted(aside.names)).alias(DOC[1]))
    text = aside[text]
    runs = copied_runs(marked.select(*DOC, F.col(text).alias("text")), min_words)
    spans = runs.groupBy(*DOC).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_spans"))
    spans = spans.select(F.col(DOC[0]).alias("_d"), F.col(DOC[1]).alias("_m"), "_spans")
    joined = marked.join(spans, (F.col(DOC[1]) == F.col("_m")) & F.col(DOC[0]).eqNullSafe(F.col("_d")), "left")
    lines = F.split(F.col(text), "\n", -1)
    count = F.size("_spans")

    def between(i):
        """The lines kept in front of span ``i``, or behind the last."""
        begin = F.when(i == 0, 0).otherwise(F.get(F.col("_spans"), i - 1)["end"])
        end = F.when(i == count, F.size("_lines")).otherwise(F.get(F.col("_spans"), i)["start"])
        return F.slice(F.col("_lines"), begin + 1, end - begin)

    kept = F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), count), between)), "\n")
    removed = F.aggregate("_spans", F.lit(0), lambda n, s: n + s["end"] - s["start"])
    joined = joined.withColumn("_lines", lines)
    n_lines = F.when(F.col(text).isNull(), 0).otherwise(F.size("_lines"))
    left = F.when(F.col("_spans").isNull(), F.col(text)).otherwise(kept)
    counted = joined.select("*", n_lines.alias("n_lines"), left.alias("_left")).drop(text).withColumnRenamed("_left", text)
    return counted.select(
        *aside.back,
        "n_lines",
        F.coalesce(removed, F.lit(0)).alias("removed_lines"),
    )


def copied_runs(texts: DataFrame, min_words: int) -> DataFrame:
    """Maximal runs of lines that an earlier place has too: (_doc, _mark, start, end), end excluded."""
    # Rows equal in every column count once
    repeated = _repeated_lines(texts).repartition(*DOC).dropDuplicates([*DOC, "seq"])
    repeated = stage(repeated, "lines")
    # Lines of a document that follow each other without one that is unique
    place = Window.partitionBy(*DOC).orderBy("seq")
    islands = repeated.withColumn("island", F.col("seq") - F.row_number().over(place))
    before = Window.partitionBy(*DOC, "island").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    islands = islands.withColumn("ahead", F.coalesce(F.sum("words").over(before), F.lit(0)))
    # The fewest lines from here that have enough words: all that begin within as many words
    reach = Window.partitionBy(*DOC, "island").orderBy("ahead").rangeBetween(0, min_words - 1)
    # This line, and those that end before as many words have followed it
    islands = islands.withColumn("until", F.col("ahead") + F.col("words"))
    few = Window.partitionBy(*DOC, "island").orderBy("until").rangeBetween(0, min_words - 1)
    in_order = Window.partitionBy(*DOC, "island").orderBy("seq")
    following = in_order.rowsBetween(0, max(min_words, 2) - 1)
    # Lines without words that stand before the next line go with a run of the two
    apart = F.coalesce(F.lead("pos").over(in_order) > F.col("pos") + 1, F.lit(False))
    level = islands.select(
        *DOC, "seq", "name", "pos",
        F.count("*").over(reach).cast("int").alias("length"),
        F.sum("words").over(reach).alias("reached"),
        F.count("*").over(few).cast("int").alias("longest"),
        F.collect_list(F.col("pos") + 1).over(following).alias("ends"),
        apart.alias("apart"),
    )
    level = level.withColumn("length", F.when(F.col("reached") >= min_words, F.col("length"))).drop("reached")
    level = level.withColumn("longest", F.when(F.col("length").isNotNull(), F.greatest("length", "longest")))
    level = level.withColumn("least", F.when(F.col("apart") & (F.col("length") == 1), 2).otherwise(1)).drop("apart")
    found, size = [], 1
    while True:
        level = stage(level, "classes")
        most, number = level.agg(F.max(F.greatest("longest", "least")), F.count("*")).first()
        found.append(_copies(level, size, number))
        size *= 2
        if (most or 0) < size:
            break
        level = _doubled(level, size // 2, number)
    spans = found[0]
    for more in found[1:]:
        spans = spans.unionByName(more)
    order = Window.partitionBy(*DOC).orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce((F.col("start") > reached).cast("int"), F.lit(1))
    runs = spans.withColumn("begins", begins).withColumn("run", F.sum("begins").over(order))
    return runs.groupBy(*DOC, "run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("run")


def _repeated_lines(texts: DataFrame) -> DataFrame:
    """Lines with words that occur twice or more: place, words and the first place of the line."""
    lines = F.transform(F.split("text", "\n", -1), lambda line, i: F.struct(i.alias("pos"), line.alias("line")))
    worded = F.filter(lines, lambda x: F.regexp_like(x["line"], F.lit(r"[^\x20\x09-\x0D]")))
    rows = texts.select(*DOC, F.posexplode(worded).alias("seq", "at")).select(
        *DOC, "seq", "at.pos",
        F.size(F.regexp_extract_all("at.line", F.lit(WORD), F.lit(0))).alias("words"),
        # Together 128 bits
        F.xxhash64("at.line").alias("a"), F.xxhash64(F.lit("line"), "at.line").alias("b"),
    )
    # Spark takes lines for as few as their texts, and would broadcast them
    return _named(rows.hint("merge"), ["a", "b"]).drop("a", "b")


def _named(rows: DataFrame, keys: list[str], *also: Column) -> DataFrame:
    """Rows whose keys occur at two places or more, with the first as ``name`` and what ``also`` sums up of them."""
    place = F.struct(*DOC, "seq")
    first = rows.groupBy(*keys).agg(F.min(place).alias("name"), F.max(place).alias("last"), *also)
    return rows.join(first.where("name != last").drop("last"), keys)


def _doubled(level: DataFrame, step: int, number: int) -> DataFrame:
    """Classes of twice the lines, for the positions that still have need of them; ``number``: rows of ``level``."""
    ahead = Window.partitionBy(*DOC).orderBy("seq").rangeBetween(step, step)
    pairs = level.withColumn("next", F.first("name").over(ahead)).where(F.col("next").isNotNull())
    pairs = pairs.withColumnsRenamed({"name": "here", "least": "alone"})
    # Lines that stand apart at one place are taken together at all, as the first copy may be any
    named = _named(by_rows(pairs, number), ["here", "next"], F.max("alone").alias("least"))
    return named.withColumn("longest", F.greatest("longest", "least")).drop("here", "next", "alone")


def _copies(level: DataFrame, size: int, number: int) -> DataFrame:
    """Spans (start, end) of the runs of ``size`` to 2 * ``size`` - 1 lines that an earlier place has too.

    Two classes of ``size`` lines, from the run's first line and up to its last, stand for it. ``number``: rows of ``level``.
    """
    lengths = F.sequence(F.greatest("length", F.lit(size)), F.least("longest", F.lit(2 * size - 1)))
    runs = level.where((F.col("longest") >= size) & (F.col("length") < 2 * size))
    runs = runs.withColumn("length", F.explode(lengths)).withColumn("end", F.get("ends", F.col("length") - 1)).drop("ends", "longest")
    tail = level.select(F.col(DOC[0]).alias("_d"), F.col(DOC[1]).alias("_m"), F.col("seq").alias("at"), F.col("name").alias("tail"))
    same = (F.col(DOC[1]) == F.col("_m")) & F.col(DOC[0]).eqNullSafe(F.col("_d")) & (F.col("seq") + F.col("length") - size == F.col("at"))
    runs = by_rows(runs, number).join(tail, same).select(*DOC, "seq", "pos", "end", "length", F.col("name").alias("head"), "tail")
    named = _named(runs, ["length", "head", "tail"])
    return named.where(F.col("name") < F.struct(*DOC, "seq")).select(*DOC, F.col("pos").alias("start"), "end")

"""The training-data pipeline: documents in, ids of kept, deduplicated and mixed documents out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.llm import lines, mixing, pieces, quality, simhash
from smelter.llm.queries import MODEL, tokenizer_path
from smelter.scratch import stage


def apart(docs: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with all columns but ``used`` under names that no operator has, and the way back."""
    names = {c: c if c in used else f"_column_{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return renamed, lambda df: df.select(*[F.col(n).alias(c) for c, n in names.items()])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject; it learns from the labels given."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows, back = apart(docs, "doc_id", "text")
    return back(quality.scored(rows, model).where("predicted = 1"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts less the lines that earlier documents have too; ``n_chars`` is that of what is left."""
    rows, back = apart(docs, "doc_id", "text", "n_chars")
    kept = lines.deduplicate_lines(rows)
    left = F.when(F.col("removed_lines") > 0, F.char_length("text").cast("bigint"))
    return back(kept.withColumn("n_chars", left.otherwise(F.col("n_chars"))))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, as the operator finds them: three-word shingles, three bits."""
    rows, back = apart(docs, "doc_id", "text")
    return back(simhash.one_of_each(rows, distance=3, width=3))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their targets: documents as often as the mix takes them."""
    rows, back = apart(docs, "doc_id", "text", "source")
    return back(mixing.copied(mixing.mix(rows, mixing.word_count(F.col("text"))), rows.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and whether decoding them gives the text back."""
    rows = pieces.encoded(docs.select("doc_id", "source", "text"), tokenizer_path(MODEL), checked="round_trip")
    return rows.select("doc_id", "source", "ids", F.size("ids").alias("n_ids"), "round_trip")


STAGES = [
    ("quality", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", keep_one_of_each),
    ("mixing", mix_sources),
    ("encoding", encode),
]

# The classifier, the fingerprints and the ids cannot be expressed in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs

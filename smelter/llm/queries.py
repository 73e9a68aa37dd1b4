"""One query for each operator, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.llm import conversations, knn, lines, mixing, pieces, quality, sharding, simhash, sketches, substrings, templates, tokens, whitening

TOKENIZER, MODEL = "word_bpe_49k.json", "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = _table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64("text").alias("group"),
    )
    placed = sharding.shard_rows(rows, 24, F.col("size"), F.col("group"), F.col("doc_id"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.deduplicate_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "text", "n_lines", "removed_lines")


def op4_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = knn.quantized(_table(spark, sf_dir, "embeddings"))
    return knn.top_k(vectors, F.col("vec_id") % 20 == 0, 20)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = _table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("words"))
    mixed = mixing.mix(sized, F.col("words"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.extracted(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = pieces.encoded(docs, tokenizer_path(MODEL), checked="round_trip")
    return rows.select("doc_id", "ids", F.size("ids").alias("n_ids"), "round_trip")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    return quality.scored(docs, model).select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    marked = docs.withColumn("sketch", sketches.sketch(sketches.shingle_hashes(F.col("text"))))
    placed = sketches.with_next(marked, ["text", "sketch"])
    edited = placed.withColumn("edited", sketches.half_replaced(F.col("text"), F.col("next.text")))
    edited = edited.withColumn("edited_sketch", sketches.sketch(sketches.shingle_hashes(F.col("edited"))))
    return edited.select(
        "doc_id", F.char_length("text").cast("bigint").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        sketches.as_text(F.col("sketch")).alias("fingerprint"), sketches.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        sketches.likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        sketches.likeness(F.col("sketch"), F.col("next.sketch")).alias("near_next"),
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.token_counts(docs, tokenizer_path(TOKENIZER))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.damaged(_table(spark, sf_dir, "conversations"))
    return conversations.repair(rows, present="present")


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.deduplicate(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash, op2_sharding, op3_line_dedup, op4_knn, op5_mixing, op6_html, op7_sentencepiece, op8_quality,
        op9_fingerprints, op10_token_counts, op11_conversations, op12_suffix_dedup, op13_whitening, pipeline,
    )
}

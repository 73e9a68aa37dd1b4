"""Extra columns under the operators' own scratch names, with dots, or in another case, are carried along."""

import pytest
from pyspark.sql import functions as F

from smelter.llm import knn, lines, mixing, pieces, quality, sharding, simhash, sketches, templates, tokens
from smelter.llm.columns import Aside
from smelter.llm.queries import MODEL, TOKENIZER, tokenizer_path

SCRATCH = [
    "_size", "_by_text", "_by_key", "_by_row", "_part", "_within", "_offset", "_doc", "_mark", "_d", "_m", "_spans", "_lines", "_left",
    "_s", "_z", "_parts", "_each", "_more", "_hash", "_n", "_ahead", "_t", "_y", "_p", "_range", "_order", "_at", "_before", "_r", "_h", "_k",
    "_name", "_host", "texts", "row", "id", "mark", "nth", "words", "name", "pos", "seq", "host", "fp", "_column_0", "_column_1", "a.b", "c`d", "Doc ID",
]
ROWS = [(1, "one two three four five\nsix", "a"), (2, "one two three four five\nseven", "a"), (3, None, None), (4, "", "b"), (None, "eight nine", "b")]


def tokenized(df):
    return tokens.token_counts(df, tokenizer_path(TOKENIZER))


OPERATORS = {
    "shards": lambda df: sharding.shard_rows(df, 2, F.octet_length(F.coalesce("text", F.lit(""))) + 8, F.col("text"), F.col("doc_id")),
    "lines": lines.deduplicate_lines,
    "mix": lambda df: mixing.mix(df, mixing.word_count(F.col("text"))),
    "copied": lambda df: mixing.copied(mixing.mix(df, F.lit(1).cast("bigint"), share=2.0), df.columns),
    "next": lambda df: sketches.with_next(df, ["text", "a.b"]),
    "one": simhash.one_of_each,
    "ids": lambda df: pieces.encoded(df, tokenizer_path(MODEL), checked="same"),
    "tokens": tokenized,
    "quality": lambda df: quality.scored(df, quality.fit(df, df.sparkSession.createDataFrame([], "doc_id bigint, quality int"))),
    "pages": lambda df: templates.extracted(df.withColumnsRenamed({"text": "html", "source": "url"})),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_extra_columns(spark, name):
    plain = spark.createDataFrame(ROWS, "doc_id bigint, text string, source string")
    clashing = plain.select("*", *[F.concat_ws("/", F.lit(c), "doc_id").alias(c) for c in SCRATCH])
    got = OPERATORS[name](clashing)
    assert [c for c in got.columns if c in SCRATCH] == SCRATCH
    found = [r.asDict() for r in got.collect()]
    assert found
    for row in found:
        held = "" if row["doc_id"] is None else f"/{row['doc_id']}"
        assert all(row[c] == c + held for c in SCRATCH)
    if name not in ("next", "one"):
        # Their results don't depend on what is carried along
        with_one = OPERATORS[name](plain).collect()
        names = [c for c in got.columns if c not in SCRATCH]
        assert sorted(repr([r[c] for c in names]) for r in found) == sorted(repr([r[c] for c in names]) for r in with_one)


def test_aside(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`A.b` int, size int, c int")
    aside = Aside(df, "Size")
    assert df.select(*aside.away).select(*aside.back).columns == ["A.b", "c"]
    assert aside["a.B"] == aside["A.b"] == "_column_0"

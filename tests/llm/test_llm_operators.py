"""Operators on small tables: nulls, empty and long texts, ties, repeats, empty tables, clashing names."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_llm_queries import brute_components, brute_fingerprint

from smelter.llm import components, knn, lines, mixing, pieces, quality, sharding, simhash, sketches, templates, tokens
from smelter.llm.queries import MODEL, TOKENIZER, tokenizer_path
from smelter.scratch import stage

DOCS = "doc_id bigint, text string, source string"


def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def noise(seed, words):
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(5000)}" for _ in range(words))


ODD = [
    (1, None, None), (2, "", "a"), (3, " \n\t", "a"), (None, "one two", "b"), (5, "one two", "b"), (5, "one two", "b"),
    (6, "Ünï cödé\x00 \u2028text \u2581x", "c"), (7, noise(1, 30000), "c"), (8, "x" * 300000, None), (9, "a\n\n\nb", "b"),
]


# Components


def test_components_of_a_long_path(spark):
    pairs = [(i, i + 1) for i in range(200)] + [(1000, 1000), (500, 400), (400, 500), (None, 3)]
    found = components.components(spark.createDataFrame(pairs, "a bigint, b bigint"))
    roots = {r.node: r.root for r in found.collect()}
    assert found.count() == len(roots)
    assert roots == {i: 0 for i in range(201)} | {400: 400, 500: 400}


def test_components_of_nothing(spark):
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# SimHash


def test_simhash_odd_rows(spark):
    rows = simhash.near_duplicates(docs(spark, ODD)).collect()
    prints = [brute_fingerprint(t or "") for _, t, _ in ODD]
    assert sorted(r.fp & (1 << 64) - 1 for r in rows) == sorted(prints)
    by_key = {r.doc_id: r.component_id for r in rows}
    assert by_key[1] == by_key[2] == by_key[3] == 1
    assert by_key[None] == by_key[5] == 5


def test_simhash_blocks_agree(monkeypatch):
    text = (noise(3, 3000) + "\n").encode()
    whole = simhash.simhash(text)
    monkeypatch.setattr(simhash, "BLOCK_BYTES", 50)
    assert simhash.simhash(text) == whole
    assert whole & (1 << 64) - 1 == brute_fingerprint(text.decode())


@pytest.mark.parametrize("distance", [1, 3, 5])
def test_links_keep_components(spark, distance, monkeypatch):
    # Small tiles, so that crowded keys are cut
    monkeypatch.setattr(simhash, "TILE", 8)
    pick = random.Random(distance)
    values = set()
    for _ in range(40):
        value = pick.getrandbits(64)
        for _ in range(8):
            values.add(value)
            for _ in range(pick.randrange(1, 2 * distance)):
                value ^= 1 << pick.randrange(64)
    hub = pick.getrandbits(64)
    values |= {hub ^ (1 << i) for i in range(40)}
    signed = [(v - (1 << 64) * (v >> 63),) for v in values]
    links = {(r.a, r.b) for r in simhash.links(spark.createDataFrame(signed, "fp bigint"), distance).collect()}
    own = [v for v, in signed]

    def classes(pairs):
        root = {v: v for v in own}

        def find(v):
            while root[v] != v:
                v = root[v]
            return v

        for a, b in pairs:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        return {v: find(v) for v in own}

    near = [(a, b) for a in own for b in own if a < b and (a ^ b & (1 << 64) - 1).bit_count() <= distance]
    near = [(a, b) for a in own for b in own if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= distance]
    assert all(bin((a ^ b) & (1 << 64) - 1).count("1") <= distance for a, b in links)
    assert classes(links) == classes(near)


def test_keys_of_fingerprints_are_not_broadcast(spark):
    """Spark takes them for as few as the fingerprints."""
    prints = stage(spark.range(20_000).select(F.xxhash64("id").alias("fp")))
    text = simhash.links(prints)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in text and "SortMergeJoin" in text and "Broadcast" not in text


def test_one_of_each(spark):
    rows = [*ODD, (11, noise(5, 400), "a"), (12, noise(5, 400), "b"), (None, None, "z")]
    kept = simhash.one_of_each(docs(spark, rows)).collect()
    prints = {i: brute_fingerprint(t or "") for i, (_, t, _) in enumerate(rows)}
    assert len(kept) == len(set(brute_components(prints).values()))
    assert {r.doc_id for r in kept} >= {1, 5, 11} and {r.doc_id for r in kept}.isdisjoint({2, 3, 12, None})
    assert simhash.one_of_each(docs(spark, [])).count() == 0


# Jaccard


def test_the_pipeline_keeps_one_of_near_copies(spark):
    """One word of 400 changed: what is within three bits goes, as the fingerprints alone say."""
    import corpus_pipeline
    from test_llm_queries import brute_components, brute_fingerprint

    rows = []
    for seed in range(20):
        words = noise(seed, 400).split()
        rows.append((2 * seed, " ".join(words), "s"))
        rows.append((2 * seed + 1, " ".join("new" if i == 200 else w for i, w in enumerate(words)), "s"))
    rows += [(50, None, "s"), (51, "", "s"), (52, " ", "s")]
    prints = {k: brute_fingerprint(t or "") for k, t, _ in rows}
    kept = corpus_pipeline.keep_one_of_each(spark, docs(spark, rows), "").collect()
    expected = sorted(set(brute_components(prints).values()))
    assert sorted(r.doc_id for r in kept) == expected and len(expected) < 30
    assert corpus_pipeline.keep_one_of_each(spark, docs(spark, []), "").count() == 0



# Shards


@pytest.mark.parametrize("hot", [0, 400])
def test_shards(spark, hot):
    pick = random.Random(hot)
    rows = [(i, "same" if i < hot else f"t{i % 700}", pick.randrange(1, 500)) for i in range(1200)]
    rows += [(None, None, 5)] * 50
    df = spark.createDataFrame(rows, "doc_id bigint, text string, Slot int")
    placed = sharding.shard_rows(df, 7, F.col("Slot"), F.col("text"), F.col("doc_id"))
    out = placed.collect()
    assert len(out) == len(rows) and placed.columns == ["doc_id", "text", "shard", "slot"]
    slots = {}
    for r in out:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_are_even(spark):
    rows = [(i % 3, "same") for i in range(3000)] + [(i, f"t{i}") for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    counts = sharding.shard_rows(df, 8, F.lit(10), F.col("text"), F.col("doc_id")).groupBy("shard").count().collect()
    assert len(counts) == 8 and all(abs(r["count"] - 500) <= 5 for r in counts)


def test_shards_of_few_rows(spark):
    few = spark.createDataFrame([(1, "a"), (2, None)], "doc_id bigint, text string")
    for df, n in ((few, 2), (few.limit(0), 0)):
        assert sharding.shard_rows(df, 5, F.lit(8), F.col("text"), F.col("doc_id")).count() == n


# Lines


def removed(spark, rows, **options):
    return {r.doc_id: (r.text, r.removed_lines) for r in lines.deduplicate_lines(docs(spark, rows), **options).collect()}


def test_lines_keep_the_first_copy(spark):
    long = "a b c d e"
    rows = [(1, f"x\n{long}\ny", "s"), (2, f"{long}\nz", "s"), (3, f"{long}\n{long}", "s"), (4, "x\ny", "s")]
    assert removed(spark, rows) == {1: (f"x\n{long}\ny", 0), 2: ("z", 1), 3: ("", 2), 4: ("x\ny", 0)}


def test_lines_run_over_several_lines(spark):
    rows = [(1, "a b\n\nc d\ne f\ng", "s"), (2, "q\na b\n\nc d\ne f\nz", "s"), (3, "c d\ne f", "s")]
    assert removed(spark, rows) == {1: (rows[0][1], 0), 2: ("q\nz", 4), 3: ("c d\ne f", 0)}


def test_lines_go_to_the_end_of_a_run(spark):
    """Short lines at its end are part of a run, whatever follows."""
    rows = [(1, "a b c d e f g\nh i", "s"), (2, "a b c d e f g\nh i", "s")]
    assert removed(spark, rows) == {1: (rows[0][1], 0), 2: ("", 2)}
    rows = [(1, "a b c d e\ng\nx", "s"), (2, "q\na b c d e\ng\nz", "s"), (3, "a b c d e\nz", "s")]
    assert removed(spark, rows) == {1: (rows[0][1], 0), 2: ("q\nz", 2), 3: ("z", 1)}


def test_lines_that_repeat_within_a_text(spark):
    rows = [(1, "\n".join(["one two"] * 50), "s")]
    text, count = removed(spark, rows)[1]
    assert set(text.split("\n")) == {"one two"} and count > 40


def test_lines_take_the_blank_ones_between(spark):
    """Two lines that have enough words each, at a place that has a blank line between them."""
    rows = [(1, "a b c d e\nf g h i j\nk", "s"), (2, "a b c d e\n\n \nf g h i j\nm", "s"), (3, "f g h i j\n\na b c d e", "s")]
    assert removed(spark, rows) == {1: (rows[0][1], 0), 2: ("m", 4), 3: ("", 2)}
    assert removed(spark, [(0, "a b\na b\n\na b", "s")], min_words=1) == {0: ("a b", 3)}


def test_lines_are_not_broadcast(spark):
    """Spark takes them for as few as their texts."""
    texts = stage(spark.range(2000).select(F.col("id").alias("_doc"), F.col("id").alias("_mark"), F.repeat(F.lit("a b c d e\n"), F.lit(1000)).alias("text")))
    text = lines._repeated_lines(texts)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Broadcast" not in text
    level = stage(spark.range(300_000).select(
        F.lit(1).alias("_doc"), F.lit(1).alias("_mark"), F.col("id").alias("seq"), F.struct(F.lit(1).alias("a")).alias("name"), F.lit(1).alias("pos"),
        F.lit(1).alias("length"), F.lit(2).alias("longest"), F.array(F.lit(1)).alias("ends"),
    ))
    assert "Broadcast" not in lines._copies(level, 1, 300_000)._jdf.queryExecution().executedPlan().toString()


def test_lines_odd_rows(spark):
    out = lines.deduplicate_lines(docs(spark, ODD).withColumn("N_Lines", F.lit("x")))
    rows = out.collect()
    assert len(rows) == len(ODD) and out.columns == ["doc_id", "text", "source", "n_lines", "removed_lines"]
    assert {r.doc_id: r.text for r in rows if r.doc_id != 5} == {k: t for k, t, _ in ODD if k != 5}
    assert lines.deduplicate_lines(docs(spark, [])).count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a b", "c d e", "f", "", "g h i j k l"]), max_size=9), min_size=1, max_size=6), st.integers(1, 9))
def test_lines_as_by_brute_force(spark, texts, least):
    rows = [(i, "\n".join(t), "s") for i, t in enumerate(texts)]
    firsts, gone = {}, {i: set() for i, *_ in rows}
    for i, text, _ in rows:
        all_lines = text.split("\n")
        worded = [(p, x) for p, x in enumerate(all_lines) if x.split()]
        for k in range(len(worded)):
            for end in range(k + 1, len(worded) + 1):
                if sum(len(x.split()) for _, x in worded[k:end]) >= least:
                    if (i, k) != firsts.setdefault(tuple(x for _, x in worded[k:end]), (i, k)):
                        gone[i] |= set(range(worded[k][0], worded[end - 1][0] + 1))
    expected = {i: ("\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone[i]), len(gone[i])) for i, t, _ in rows}
    assert removed(spark, rows, min_words=least) == expected


# Search


def brute_top(vectors, asked, k):
    out = {}
    for q in asked:
        a = vectors[q]
        # Held at the ends of a long
        held = {i: max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b)))) for i, b in vectors.items() if i != q}
        scores = [(-s, i) for i, s in held.items()]
        out[q] = [(rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return out


def searched(df, asked, k, **options):
    out = {}
    for r in knn.top_k(df, asked, k, **options).collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(found) for q, found in out.items()}


def test_search(spark, monkeypatch):
    monkeypatch.setattr(knn, "DATA_BLOCK", 16)
    monkeypatch.setattr(knn, "QUERY_BLOCK", 4)
    pick = np.random.default_rng(1)
    vectors = {i: [int(x) for x in v] for i, v in enumerate(pick.integers(-40, 40, (300, 8)))}
    vectors |= {i: [5] * 8 for i in range(300, 420)} | {420: [1, 2], 421: [], 422: [0] * 8}
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in vectors.items()], "vec_id bigint, v array<double>")
    asked = [i for i in vectors if i % 7 == 0]
    assert searched(df, F.col("vec_id") % 7 == 0, 6, pivots=9) == brute_top(vectors, asked, 6)


def test_search_few_and_large(spark):
    vectors = {1: [2**40, -(2**40)], 2: [2**30 + 1, 3], 3: [2**60, 2**60], 4: [-(2**60), -(2**60)]}
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in vectors.items()], "vec_id bigint, v array<double>")
    assert searched(df, F.col("vec_id") < 3, 9) == brute_top(vectors, [1, 2], 9)
    assert searched(df.where("vec_id = 1"), F.lit(True), 3) == {}
    assert knn.top_k(df.limit(0), F.lit(True), 3).count() == 0


def test_quantized(spark):
    rows = [(1, [0.5, -0.01]), (2, None), (3, [1.0, None]), (4, [float("nan")]), (5, [float("inf")]), (None, [1.0]), (6, []), (7, [2.0]), (7, [1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert {r.vec_id: r.v for r in knn.quantized(df).collect()} == {1: [32.0, -1.0], 6: [], 7: [64.0]}


# Mixing


def test_targets(spark):
    sizes = [("a", 10), ("b", 1000), ("c", 1000), (None, 1000), ("é", 0)]
    out = {r.source: r.target for r in mixing.targets(spark.createDataFrame(sizes, "source string, size bigint")).collect()}
    assert out["a"] == 20 and out["é"] == 0
    assert sum(out.values()) == pytest.approx(1.5 * 3010)
    assert out["b"] / out["c"] == pytest.approx(2) and out[None] / out["c"] == pytest.approx(2)


def test_rates_solve_the_dual(spark):
    """Against bisection; sources that are full or have no target aren't tilted."""
    groups = {
        "less": ([(s, 1 + s % 3) for s in range(1, 60)], 0.4), "more": ([(s, 1) for s in range(0, 400, 7)], 1.7),
        "nearly": ([(1, 50), (5000, 1)], 1.999), "same": ([(9, 4)], 1.3), None: ([(3, 2), (11, 5)], 0.01),
        "full": ([(5, 5)], 2.0), "none": ([(7, 7)], 0.0),
    }
    rows = [(g, s, n) for g, (sizes, _) in groups.items() for s, n in sizes]
    goals = []
    for g, (sizes, share) in groups.items():
        size = sum(s * n for s, n in sizes)
        goals.append((g, size, share * size))
    classes = spark.createDataFrame(rows, "source string, size bigint, n bigint")
    got = mixing.rates(classes, spark.createDataFrame(goals, "source string, source_size bigint, target double"), near=1e-9).collect()
    assert len(got) == len(groups)
    for r in got:
        sizes = groups[r.source][0]
        if r.source in ("full", "none"):
            assert r.x is None
            continue

        def words(x):
            return sum(n * s * (2 if x * s > math.log(2) else math.exp(x * s)) for s, n in sizes)

        low, high = -50.0, 50.0
        for _ in range(200):
            middle = (low + high) / 2
            low, high = (middle, high) if words(middle) < r.target else (low, middle)
        assert abs(words(r.x / r.typical) - r.target) <= 0.5 + 1e-9 * r.target
        assert (r.x > 0) == (low > 0)
        if r.source == "less":
            assert r.x / r.typical == pytest.approx(low, rel=1e-2)


def test_rates_differ_by_document(spark):
    rows = [(i, noise(i, 1 + i % 97), "a" if i % 4 else "b") for i in range(1200)]
    got = mixing.mix(docs(spark, rows), mixing.word_count(F.col("text"))).collect()
    for source, more in (("a", True), ("b", True)):
        found = [r for r in got if r.source == source and r.target < 2 * r.source_size]
        twice, once = ([r["size"] for r in found if r.copies == c] for c in (2, 1))
        if twice and once:
            assert (sum(twice) / len(twice) > sum(once) / len(once)) == more
    assert any(r.target < 2 * r.source_size for r in got)


def test_mix_odd_rows(spark):
    rows = ODD + [(100 + i, noise(i, 1 + i % 60), "d") for i in range(400)] + [(900, "same text", "e")] * 60
    df = docs(spark, rows).withColumn("Copies", F.lit("x"))
    out = mixing.mix(df, mixing.word_count(F.col("text")))
    assert out.columns == ["doc_id", "text", "source", "size", "source_size", "target", "copies"]
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r.copies <= 2 for r in got)
    by_source = {}
    for r in got:
        by_source.setdefault(r.source, []).append(r)
    for source, found in by_source.items():
        miss = sum(r["size"] * r.copies for r in found) - found[0].target
        assert abs(miss) <= (2 if source == "d" else max(r["size"] for r in found) / 2)
    assert mixing.copied(out, df.columns).count() == sum(r.copies for r in got)
    assert mixing.mix(df.limit(0), mixing.word_count(F.col("text"))).count() == 0


def test_mix_deals_large_classes(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 20)
    rows = [(i, "one two three", "a" if i % 3 else "b") for i in range(900)]
    got = mixing.mix(docs(spark, rows), mixing.word_count(F.col("text"))).collect()
    for source in ("a", "b"):
        found = [r for r in got if r.source == source]
        assert abs(sum(r.copies * 3 for r in found) - found[0].target) <= 3
        assert max(r.copies for r in found) - min(r.copies for r in found) <= 1


# Pages


ARTICLE = "<p>One &amp; <b>two</b>&nbsp; three<p>Four<br>five</p><ul><li>six<li>seven</ul>"
TEXT = "One & two three\n\nFour five\n\nsix\n\nseven"


@pytest.mark.parametrize(
    "page",
    [
        f"<html><body><header>Site</header><nav>Menu</nav><article>{ARTICLE}</article><footer>End</footer></body></html>",
        f"<body><div class='cookie-notice'>We use</div><main>{ARTICLE}<aside>More</aside></main><div id=comments><p>Nice</p></div>",
        f"<div class=sidebar>Side</div><div>{ARTICLE}</div><form><label>Name</label><input></form><div class='ad-box'>Buy",
        f"<article>{ARTICLE}<section class='comments'><article class='comment'>First!</article></section></article>",
        f"<script>if (a < b) '</p>'</script><style>p{{}}</style><!-- <p>no --><div>{ARTICLE}</div>",
        f"<ul><li><a href=/a>Home</a><li><a href='/b'>About</a></ul><DIV>{ARTICLE}</DIV><div role=contentinfo>c</div>",
        f"<article>{ARTICLE}</article><div hidden>secret</div><p",
    ],
)
def test_main_text(page):
    assert templates.main_text(page) == TEXT


def test_main_text_of_odd_pages():
    assert templates.main_text("") == "" and templates.main_text("<") == "<"
    assert templates.main_text("plain  text") == "plain text"
    assert templates.main_text("a < b &lt;p&gt; &#233;") == "a < b <p> é"
    assert templates.main_text("<article><header><h1>Title</h1><p>By</p></header><p>x</p></article>") == "Title\n\nx"
    assert templates.main_text("<p>" * 2000 + "x" + "<b>" * 2000 + "y") == "xy"


def test_templates_drop_what_a_host_repeats(spark):
    rows = [(i, f"http://Host.example/{i}", f"<div><p>Terms of use</p><div><p>Text number {i}</p></div></div>") for i in range(8)]
    rows += [(20, None, None), (21, "x", ""), (22, "http://one.example", "<div><p>Terms of use</p></div>")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("Text", F.lit(1))
    out = {r.page_id: (r.text, r.n_chars) for r in templates.extracted(df).collect()}
    assert all(out[i] == (f"Text number {i}", 13) for i in range(8))
    assert out[20] == out[21] == ("", 0) and out[22] == ("Terms of use", 12)
    assert templates.extracted(df.limit(0)).count() == 0


def test_hosts_agree(spark):
    urls = ["http://A.b/c", "https://u:p@h.example:80/x", "//h/x", "h?x", "", None, "mailto:x", "http://a://b"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r.h for r in df.select(templates._host_of(F.col("url")).alias("h")).collect()] == [templates.host(u or "") for u in urls]


# Pieces


@pytest.fixture(scope="module")
def model():
    import sentencepiece

    path = tokenizer_path(MODEL)
    return pieces.Pieces(path), sentencepiece.SentencePieceProcessor(model_file=path)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet=" ▁aehinrst\nEé,.!0", max_size=120))
def test_ids_are_the_library_s(model, text):
    ours, library = model
    ids = ours.encode(text).tolist()
    assert ids == library.encode(text)
    assert ours.decode(np.array(ids, np.int32)) == library.decode(ids) == text.replace("▁", " ")


def test_ids_of_long_texts(model, monkeypatch):
    ours, library = model
    monkeypatch.setattr(pieces, "BLOCK", 100)
    for text in (noise(1, 3000), "ab" * 4000, "anerthe" * 900, " " * 700 + "x" + " " * 9, "中文é" * 500, "\n\n  \n" * 90):
        assert ours.encode(text).tolist() == library.encode(text)


def test_streaming_window_is_bounded(model):
    ours, _ = model
    seen = []
    meeting = ours._meeting
    ours._meeting = lambda back: seen.append(len(back)) or meeting(back)
    try:
        list(ours.ids("thereisnoblankinthistextatall" * 2000))
    finally:
        del ours._meeting
    assert max(seen) <= 8 * ours.longest


def test_encoded_odd_rows(spark, model):
    path = tokenizer_path(MODEL)
    df = docs(spark, ODD).withColumn("IDS", F.lit(1))
    out = pieces.decoded(pieces.encoded(df, path), path).collect()
    assert len(out) == len(ODD)
    for r in out:
        assert r.ids == model[1].encode(r.text or "") and r.decoded == (r.text or "").replace("▁", " ")
    assert pieces.encoded(docs(spark, []), path).count() == 0


# Token counts


def test_token_counts(spark, monkeypatch):
    from tokenizers import Tokenizer

    path = tokenizer_path(TOKENIZER)
    library = Tokenizer.from_file(path)
    special = [(20, "a <|endoftext|> b<|startoftext|>c", "s"), (21, "it's I'LL e\u0301 ΑΣ ΑΣ. \x85x\u3000y", "s")]
    df = docs(spark, ODD + special).withColumn("N_TOKENS", F.lit("x"))
    out = tokens.token_counts(df, path)
    assert out.columns == ["doc_id", "source", "n_bytes", "n_tokens", "over_limit"]
    expected = [(k, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False))) for k, t, _ in ODD + special]
    order = lambda rows: sorted(rows, key=str)
    assert order((r.doc_id, r.n_bytes, r.n_tokens) for r in out.collect()) == order(expected)
    assert tokens.token_counts(df.limit(0), path).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=5))
def test_token_counts_of_any_text(texts):
    path = tokenizer_path(TOKENIZER)
    counter = tokens.counter(path)
    for text in texts:
        assert counter.count(text.encode().split()).sum() == len(counter.tokenizer.encode(text, add_special_tokens=False))


# Quality


def test_quality_odd_rows(spark):
    good = [(i, noise(i, 60), "s") for i in range(200)]
    bad = [(1000 + i, " ".join(f"{w}!!".upper() for w in noise(i + 500, 60).split()), "s") for i in range(200)]
    labels = [(k, 1) for k, *_ in good] + [(k, 0) for k, *_ in bad] + [(None, 1), (3, None), (4, 7), (5, 0)]
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int")
    df = docs(spark, good + bad + ODD).withColumn("Score", F.lit("x"))
    out = quality.scored(df, quality.fit(df, labels))
    assert out.columns == ["doc_id", "text", "source", "score", "predicted"]
    rows = out.collect()
    assert len(rows) == 400 + len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.predicted == 1 for r in rows if r.doc_id in range(20, 200)) > 170
    assert sum(r.predicted == 0 for r in rows if r.doc_id in range(1000, 1200)) > 190
    none = quality.fit(df.limit(0), labels.limit(0))
    assert {r.score for r in quality.scored(df, none).collect()} == {0.5}
    assert quality.scored(df.limit(0), none).count() == 0


# Sketches


def test_sketch_estimates(spark):
    whole, part = noise(1, 20000), " ".join(noise(1, 20000).split()[:2000])
    df = spark.createDataFrame([(whole, part)], "a string, b string")
    a, b = (sketches.sketch(sketches.shingle_hashes(F.col(c))) for c in "ab")
    row = df.select(
        sketches.containment(b, a).alias("inside"), sketches.likeness(a, b).alias("alike"), F.size(a).alias("n"),
        (sketches.merged(a, b) == a).alias("merged"),
    ).first()
    assert row.inside == 1.0 and abs(row.alike - 0.1) < 0.02 and abs(row.n - 2500) < 250 and row.merged


def test_sketch_of_few_words(spark):
    df = spark.createDataFrame([(None,), ("",), (" \n",), ("one",), ("one two",), ("one  two\n",), ("a b c d e",)], "t string")
    sizes = [r.n for r in df.select(F.size(sketches.sketch(sketches.shingle_hashes(F.coalesce("t", F.lit(""))))).alias("n")).collect()]
    assert sizes == [0, 0, 0, 1, 1, 1, 1]


def test_sketches_of_short_parts(spark):
    rows = [(noise(i, 5), noise(i + 500, 400)) for i in range(40)]
    df = spark.createDataFrame(rows, "a string, b string")
    one, two = sketches.shingle_hashes(F.col("a")), sketches.shingle_hashes(F.col("b"))
    both = sketches.sketch(F.concat(one, two))
    a, b = sketches.sketch(one), sketches.sketch(two)
    got = df.select((sketches.merged(a, b) == both).alias("same"), sketches.containment(a, both).alias("inside")).collect()
    assert all(r.same for r in got) and {r.inside for r in got} == {None, 1.0}


def test_next_row(spark):
    rows = [(k, f"t{k}") for k in range(0, 300, 3)] + [(5, "u"), (5, "u"), (None, "last")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = sketches.with_next(df, ["text"], parts=7).collect()
    assert len(out) == len(rows)
    following = {r.doc_id: r.next.text for r in out if r.doc_id != 5}
    keys = sorted({k for k, _ in rows if k is not None and k != 5})
    for a, b in zip(keys, keys[1:]):
        assert following[a] == ("u" if a < 5 < b else f"t{b}")
    assert following[keys[-1]] == "last" and following[None] == "t0"
    one = sketches.with_next(df.where("text = 'last'"), ["text"]).collect()
    assert [r.next.text for r in one] == ["last"]
    assert sketches.with_next(df.limit(0), ["text"]).count() == 0


# Pages whose template has no names


def plain_pages(n):
    """Pages of one host in plain elements: four menu items, two lines of story, two lines of footer."""
    menu = "".join(f"<li><a href='/{m}'>{m}</a></li>" for m in ("Home", "World", "Sport", "About us"))
    for i in range(n):
        story = f"<div><p>Story {i} begins here.</p><p>It ends after {i * 7} words.</p></div>"
        yield f"<html><body><div><ul>{menu}</ul></div>{story}<div><p>Made by us.</p><p>All rights kept.</p></div></body></html>"


def test_template_of_a_host_without_names(spark):
    rows = [(i, f"https://plain.example/{i}", page) for i, page in enumerate(plain_pages(12))]
    rows += [(100 + i, f"https://few.example/{i}", page) for i, page in enumerate(plain_pages(2))]
    out = {r.page_id: r.text for r in templates.extracted(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    for i in range(12):
        assert out[i] == f"Story {i} begins here.\n\nIt ends after {i * 7} words."
    # Two pages make no template
    assert out[100].endswith("All rights kept.")


def brute_template(pages):
    """Texts that lie in elements with the same occurrences on the pages, all of whose tokens lie in such elements."""
    vectors, inside = {}, {}
    for number, page in enumerate(pages):
        for (token, holder, is_text), n in templates.tokens(page).items():
            vectors.setdefault((token, is_text), {})[number] = n
            inside[token, is_text] = holder
    frequent = {t: tuple(sorted(v.items())) for t, v in vectors.items() if len(v) >= max(5, len(pages) * 0.5)}
    elements = {t for t, is_text in frequent if not is_text} | {templates.digest("")}
    bad = {vector for t, vector in frequent.items() if inside[t] not in elements}
    return {
        t for (t, is_text), vector in frequent.items()
        if is_text and vector not in bad and frequent.get((inside[t, True], False)) == vector
    }


def test_classes_as_by_brute_force(spark):
    pages = list(plain_pages(9)) + ["<html><body><div><ul><li>Home</li></ul></div><p>alone</p></body></html>"]
    df = spark.createDataFrame([(f"https://a.example/{i}", p) for i, p in enumerate(pages)], "url string, html string")
    (found,) = templates.templates(df).collect()
    assert set(found.texts) == brute_template(pages) and len(found.texts) >= 5


@pytest.mark.parametrize("name", ["has-sidebar", "no-sidebar", "with-ads", "page-header-fixed", "search-result-page", "social-studies", "sidebar"])
def test_names_around_an_article_do_not_lose_it(name):
    inner = "<p>Real text.</p><p class='notice-of-rights'>Rights.</p><table class='share-prices'><tr><td>1</td></tr></table>"
    page = f"<body><div class='layout {name}' id='{name}'><article>{inner}<div class='comments'>First!</div></article></div></body>"
    assert templates.main_text(page) == "Real text.\n\nRights.\n\n1"


def test_cards_beside_a_body():
    body = "<p>" + "The body of the page says much. " * 20 + "</p><p>And a list of <a href='/x'>sources</a>.</p>"
    page = f"<body><div>{body}</div><article><p>Another page</p></article></body>"
    assert templates.main_text(page).startswith("The body") and "sources" in templates.main_text(page)

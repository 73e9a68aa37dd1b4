"""Queries of the operators over whole tables, against SQL on another engine or brute force."""

import hashlib
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from conftest import TESTDATA
from pyspark.sql import functions as F

from smelter.llm.oracle import ORACLE
from smelter.llm.queries import MODEL, QUERIES, TOKENIZER, tokenizer_path

SF = f"{TESTDATA}/sf0.01"


def table(name):
    return duckdb.sql(f"SELECT * FROM '{SF}/{name}.parquet'").fetchall()


@pytest.fixture(scope="module")
def documents():
    return {row[0]: row[1] for row in table("documents")}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    ours = QUERIES[name](spark, SF)
    duck = duckdb.connect()
    for each in ("documents", "embeddings", "pages", "labels"):
        duck.execute(f"CREATE VIEW {each} AS SELECT * FROM '{SF}/{each}.parquet'")
    theirs = duck.execute(ORACLE[name])
    columns = [d[0] for d in theirs.description]
    assert sorted(columns) == sorted(ours.columns)
    assert sorted(map(tuple, ours.select(columns).collect())) == sorted(theirs.fetchall())


def brute_fingerprint(text):
    words = text.encode().lower().split()
    runs = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """prints: fingerprint by key."""
    values = np.array(sorted(set(prints.values())), dtype=np.uint64)
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, value in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(values ^ value) <= 3):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    place, least = {int(v): find(i) for i, v in enumerate(values)}, defaultdict(list)
    for key, value in prints.items():
        least[place[value]].append(key)
    return {key: min(least[place[value]]) for key, value in prints.items()}


def test_simhash(spark, documents):
    prints = {k: brute_fingerprint(t) for k, t in documents.items()}
    classes = brute_components(prints)
    rows = QUERIES["op1_simhash"](spark, SF).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {k: (f"{prints[k]:016x}", classes[k]) for k in prints}
    assert len(rows) == len(documents)


def test_sharding(spark, documents):
    rows = QUERIES["op2_sharding"](spark, SF).collect()
    assert {(r.doc_id, r["size"], r.text_crc32) for r in rows} == {(k, len(t.encode()) + 8, zlib.crc32(t.encode())) for k, t in documents.items()}
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in rows:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
    assert sorted(slots) == list(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean, largest = sum(sizes.values()) / 24, max(r["size"] for r in rows)
    assert all(abs(s - mean) <= 0.01 * mean + largest for s in sizes.values())


def test_mixing(spark, documents):
    rows = QUERIES["op5_mixing"](spark, SF).collect()
    assert {r.doc_id: r["size"] for r in rows} == {k: len(t.encode().split()) for k, t in documents.items()}
    sources = defaultdict(list)
    for r in rows:
        sources[r.source].append(r)
    total = sum(r["size"] for r in rows)
    names = sorted(sources, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    size = {s: sum(r["size"] for r in sources[s]) for s in names}
    target, capped = {}, set()
    while True:
        left = 1.5 * total - sum(2 * size[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[x] for x in names if x not in capped) for s in names if s not in capped}
        over = {s for s in share if share[s] > 2 * size[s]}
        if not over:
            target = share | {s: 2.0 * size[s] for s in capped}
            break
        capped |= over
    for s in names:
        assert all(r.source_size == size[s] and r.target == pytest.approx(target[s]) for r in sources[s])
        assert all(r.taken <= 2 * r["size"] and r.taken % max(1, r["size"]) == 0 for r in sources[s])
        assert abs(sum(r.taken for r in sources[s]) - target[s]) <= max(10, 0.001 * target[s])
    again = QUERIES["op5_mixing"](spark, SF).collect()
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in again)


def test_pages(spark):
    import html
    import re

    rows = {r.page_id: r for r in QUERIES["op6_html"](spark, SF).collect()}
    pages = table("pages")
    assert len(rows) == len(pages)
    for page_id, url, page in pages:
        article = re.search(r"<article>(.*)</article>", page, re.S)[1]
        parts = [re.sub(r"<br>", " ", p) for p in re.split(r"</?(?:p|h1)>", article)]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts]
        expected = "\n\n".join(b for b in blocks if b)
        assert (rows[page_id].url, rows[page_id].text, rows[page_id].n_chars) == (url, expected, len(expected))


def test_sentencepiece(spark, documents):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(MODEL))
    rows = QUERIES["op7_sentencepiece"](spark, SF).collect()
    assert len(rows) == len(documents)
    assert all(r.ids == library.encode(documents[r.doc_id]) and r.n_ids == len(r.ids) and r.round_trip for r in rows)


def test_quality(spark, documents):
    labels = {row[0]: row[1] for row in table("labels")}
    rows = QUERIES["op8_quality"](spark, SF).collect()
    assert len(rows) == len(documents)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(judged) > 50
    assert sum(p == q for p, q in judged) / len(judged) > 0.9


def test_fingerprints(spark, documents):
    rows = {r.doc_id: r for r in QUERIES["op9_fingerprints"](spark, SF).collect()}
    keys = sorted(documents)

    def hashes(text):
        signed = lambda h: h.to_bytes(8, "little")
        words = text.encode().split()
        each = [xxhash.xxh64_intdigest(w, 42) for w in words]

        def chained(run):
            seed = 42
            for h in run:
                seed = xxhash.xxh64_intdigest(signed(h), seed)
            return seed

        found = {chained(each[i : i + 5]) for i in range(len(each) - 4)} or ({chained(each)} if each else set())
        return {h for h in found if h < 1 << 61} or set(sorted(found)[:1])

    def alike(a, b):
        return len(a & b) / len(a | b) if a | b else 1.0

    sketches = {k: hashes(t) for k, t in documents.items()}
    for i, key in enumerate(keys):
        text, following = documents[key], documents[keys[(i + 1) % len(keys)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r, other = rows[key], hashes(edited)
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == "".join(f"{h:016x}" for h in sorted(sketches[key], key=lambda h: h - (1 << 64) * (h >> 63)))
        assert r.near_edited == pytest.approx(alike(sketches[key], other))
        assert r.near_next == pytest.approx(alike(sketches[key], sketches[keys[(i + 1) % len(keys)]]))


def test_token_counts(spark, documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path(TOKENIZER))
    rows = QUERIES["op10_token_counts"](spark, SF).collect()
    assert len(rows) == len(documents)
    for r in rows:
        text = documents[r.doc_id]
        count = len(library.encode(text, add_special_tokens=False))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), count, count > 2048)


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs]
    for name, function in corpus_pipeline.STAGES:
        seen.append(corpus_pipeline.stage(function(spark, seen[-1], SF), name))
    assert all(df.columns == docs.columns for df in seen[:-1])
    texts = [df.select("doc_id", "text").collect() for df in seen[:-1]]
    assert 0 < len(texts[1]) < len(texts[0])
    assert {r.doc_id for r in texts[2]} == {r.doc_id for r in texts[1]}
    prints = {r.doc_id: brute_fingerprint(r.text) for r in texts[2]}
    kept = set(brute_components(prints).values())
    assert sorted(r.doc_id for r in texts[3]) == sorted(kept)
    assert {r.doc_id for r in texts[4]} <= kept
    assert seen[2].where(F.col("n_chars") != F.char_length("text")).count() == 0
    last = seen[-1]
    assert last.count() == len(texts[4])
    assert last.where("not round_trip").count() == 0

"""Suffix-array dedup against all strings counted, and induced sorting against sorted suffixes."""

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from conftest import TESTDATA

from smelter.llm import induced, substrings
from smelter.llm.queries import QUERIES

SF = f"{TESTDATA}/sf0.01"


def counted(texts, width):
    """(n_bytes, kept, spans) of each text of a list of bytes."""
    seen = Counter(t[i : i + width] for t in texts for i in range(len(t) - width + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - width + 1):
            if seen[t[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        edges = [i for i in range(len(t) + 1) if (gone[i] if i < len(t) else 0) != (gone[i - 1] if i else 0)]
        out.append((len(t), bytes(b for b, g in zip(t, gone) if not g), list(zip(edges[::2], edges[1::2]))))
    return out


def test_query(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    wanted = counted([(t or "").encode() for _, t in rows], 200)
    expected = {k: (n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest()) for (k, _), (n, kept, spans) in zip(rows, wanted)}
    found = QUERIES["op12_suffix_dedup"](spark, SF).collect()
    assert len(found) == len(rows)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == expected
    assert sum(v[1] for v in expected.values()) > 0


def compared(spark, rows, width, **options):
    """rows: (doc_id, text), with more columns of clashing names beside them."""
    frame = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, spans string, mark int")
    found = substrings.deduplicate(frame, width, **options).collect()
    wanted = counted([(t or "").encode() for _, t in rows], width)
    ours = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, [tuple(s) for s in r.spans], bytes(r.kept)) for r in found]
    theirs = [(k, n, n - len(kept), len(spans), spans, kept) for (k, _), (n, kept, spans) in zip(rows, wanted)]
    assert sorted(ours, key=repr) == sorted(theirs, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_small_texts(spark, seed):
    choice = random.Random(seed)
    words = ["".join(choice.choice("abé") for _ in range(choice.randrange(1, 9))) for _ in range(12)]
    rows = [(i, " ".join(choice.choice(words) for _ in range(choice.randrange(25)))) for i in range(60)]
    rows += [(100, None), (101, ""), (None, rows[3][1]), (None, "alone and never seen"), (5, rows[5][1]), (5, rows[5][1]), (6, "ab" * 300)]
    # Small shards whose queues lie in files, and one shard in memory
    compared(spark, rows, (8, 9, 30)[seed], shard_bytes=(200, 1 << 20, 500)[seed], memory=(16, 1 << 20, 64)[seed])


def test_runs_of_one_byte_and_hot_strings(spark):
    hot = "a common line that nearly all the texts have"
    rows = [(i, f"{i * 7919} {hot} {i * 104729}") for i in range(300)] + [(1000 + i, "x" * (i * 37)) for i in range(12)]
    compared(spark, rows, 20, shard_bytes=4000, memory=256)


def test_no_rows(spark):
    compared(spark, [], 200)
    compared(spark, [(1, None)], 200)


def test_blocks_give_each_place_its_key_once(monkeypatch):
    choice = random.Random(1)
    texts = [choice.randbytes(n) for n in (5000, 39, 40, 0, 41, 300, 2)] + [b"ab" * 400]

    def keys():
        found = {}
        for block in substrings.blocks(texts, 40):
            for row, key, start, count, weight in zip(*(c.tolist() for c in substrings.segments(block, 40, 8))):
                for place in range(start, start + count):
                    assert (row, place) not in found
                    found[row, place] = key
                assert weight == 2 or row < 7
        return found

    whole = keys()
    assert sorted(whole) == [(row, i) for row, t in enumerate(texts) for i in range(len(t) - 39)]
    monkeypatch.setattr(substrings, "BLOCK_BYTES", 700)
    assert keys() == whole
    # A key is that of the string alone
    alone = substrings.segments([(0, 0, texts[0][777:817])], 40, 8)
    assert alone[1].tolist() == [whole[0, 777]]


@pytest.mark.parametrize("seed", range(8))
def test_induced_sorting(tmp_path, monkeypatch, seed):
    choice = random.Random(seed)
    for _ in range(60):
        top, cap = choice.choice([1, 2, 3, 5, 26]), choice.choice([3, 10, 1000])
        body = [choice.randrange(1, top + 1) for _ in range(choice.randrange(100))] * choice.randrange(1, 3)
        text = [*body, 0]
        monkeypatch.setattr(induced, "CHUNK", choice.choice([7, 1 << 17]))
        # Memory for a few items: queues in files, and as many recursions as there can be
        room = induced.Room(str(tmp_path), choice.choice([4, 8, 40, 1 << 20]))
        monkeypatch.setattr(induced.Queue, "FILES", choice.choice([2, 32]))
        places, common = [], []
        for p, c in induced.suffixes(np.array(text, np.uint16), top, cap, room):
            places += p.tolist()
            common += c.tolist()
        expected = sorted(range(len(text)), key=lambda i: text[i:], reverse=True)

        def alike(a, b):
            n = 0
            while n < cap and max(a, b) + n < len(text) and text[a + n] == text[b + n]:
                n += 1
            return n

        assert places == expected
        assert common == [0] + [alike(a, b) for a, b in zip(expected, expected[1:])]


def test_files_go_when_they_are_read(tmp_path):
    choice = random.Random(2)
    text = np.array([choice.randrange(1, 9) for _ in range(3000)] + [0], np.uint16)
    room = induced.Room(str(tmp_path), 64)
    assert sum(len(p) for p, _ in induced.suffixes(text, 8, 50, room)) == 3001
    assert len(list(tmp_path.iterdir())) == 0

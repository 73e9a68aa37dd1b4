"""Token counts of whole texts with a tokenizer of the ``tokenizers`` library.

Arrow functions return lengths only. Texts are split at blanks, over which no token reaches,
and each distinct piece is encoded once per worker; the pieces that are not yet known go to
the library in batches of bounded bytes.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm.arrow import map_batches, text_bytes
from smelter.llm.columns import quoted

# Bytes of text that are split, and bytes of pieces that are encoded, at once
BLOCK_BYTES = 1 << 20
# Known pieces of a worker, and the longest that is kept
KNOWN, LONGEST = 400_000, 64
BLANKS = b" \t\n\x0b\x0c\r"


class Counter:
    """Token counts of pieces without ASCII blanks."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[bytes, int] = {}

    def encode(self, pieces: list[bytes]) -> list[int]:
        texts = [p.decode("utf-8", "replace") for p in pieces]
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def count(self, pieces: list[bytes]) -> np.ndarray:
        """Tokens of each piece."""
        known = self.known
        missing = {p for p in pieces if p not in known}
        if len(known) + len(missing) > KNOWN:
            missing = set(pieces)
            known.clear()
        for batch in batches(missing):
            known.update(zip(batch, self.encode(batch)))
        counts = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
        if len(known) > KNOWN or any(len(p) > LONGEST for p in missing):
            for p in missing if len(known) <= KNOWN else list(known):
                if len(p) > LONGEST or len(known) > KNOWN:
                    known.pop(p, None)
        return counts


def batches(pieces) -> Iterator[list[bytes]]:
    """Lists of about equal bytes."""
    batch, held = [], 0
    for piece in pieces:
        batch.append(piece)
        held += len(piece)
        if held >= BLOCK_BYTES:
            yield batch
            batch, held = [], 0
    if batch:
        yield batch


def blocks(text: bytes) -> Iterator[bytes]:
    """Parts of a text that end at a blank."""
    begin = 0
    while begin < len(text):
        end = begin + BLOCK_BYTES
        while end < len(text) and text[end] not in BLANKS:
            end += 1
        yield text[begin:end]
        begin = end


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One for each worker process, kept from task to task."""
    return Counter(path)


def token_counts(docs: DataFrame, path: str, text: str = "text", limit: int = 2048) -> DataFrame:
    """All columns but the text, and ``n_bytes``, ``n_tokens`` (bigint), ``over_limit`` (more than ``limit`` tokens).

    ``path``: a tokenizer file, at the same place on all machines. Its pre-tokenizer must cut
    at blanks and drop them (``blank_safe`` tests that). No special tokens are added; their
    strings in a text are taken as the file says. NULL and empty texts have no tokens. Columns
    of the new names are replaced.
    """
    if not blank_safe(path):
        raise ValueError("the tokenizer's tokens reach over blanks")
    new = ("n_bytes", "n_tokens", "over_limit")
    keep = [c for c in docs.columns if c != text and c.lower() not in new]
    schema = docs.select(*quoted(keep)).withColumns({"n_bytes": F.lit(0).cast("bigint"), "n_tokens": F.lit(0).cast("bigint"), "over_limit": F.lit(True)}).schema

    def build():
        count = counter(path).count

        def add(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, totals = [], np.zeros(batch.num_rows, np.int64)
            pieces: list[bytes] = []
            owners: list[int] = []
            held = 0

            def settle():
                nonlocal held
                if pieces:
                    np.add.at(totals, np.repeat(owners[::2], owners[1::2]), count(pieces))
                pieces.clear(), owners.clear()
                held = 0

            for i, whole in enumerate(text_bytes(batch.column(0))):
                sizes.append(len(whole))
                for block in blocks(whole):
                    found = block.split()
                    pieces.extend(found)
                    owners.extend((i, len(found)))
                    held += len(block)
                    if held >= BLOCK_BYTES:
                        settle()
            settle()
            columns = [*batch.columns[1:], pa.array(sizes, pa.int64()), pa.array(totals), pa.array(totals > limit)]
            return pa.RecordBatch.from_arrays(columns, names=[*keep, *new])

        return add

    return map_batches(docs.select(*quoted([text, *keep])), build, schema)


def blank_safe(path: str) -> bool:
    """Whether counts of texts are sums of the counts of what lies between blanks."""
    tokenizer = Counter(path).tokenizer
    length = lambda t: len(tokenizer.encode(t, add_special_tokens=False))
    parts = ["ab", "12", "x's", "...", "é", "é", "́", "AΣ", "中", "<|endoftext|>", "'s"]
    pairs = [(a, b) for a in parts for b in parts]
    return not length(" \t\n\x0b\x0c\r") and all(length(f"{a}{c}{b}") == length(a) + length(b) for a, b in pairs for c in (" ", "\n", "\t", "  "))

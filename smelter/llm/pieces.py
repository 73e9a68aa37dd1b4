"""SentencePiece encoding and decoding with a BPE model, by streaming Viterbi.

The lattice of a text has an edge for every piece of the model that matches. An edge may follow
another if merging the two by rank leaves them as they are; of the edges that end at a place
exactly one can follow a valid path, and that is the one the model's merges make. So a step
needs the places of the last ``longest`` characters only. Whenever all paths back from that
window meet in one boundary, the ids before it are committed and dropped from memory.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm.arrow import Memo, map_batches, texts_of
from smelter.llm.columns import quoted

SPACE = "▁"
# Known words and pairs of a worker, the longest word that is kept, characters taken at once
KNOWN, LONGEST, BLOCK = 300_000, 64, 1 << 20
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class Pieces:
    """A model's pieces, and texts to ids and back."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as format

        model = format.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        norm, kinds = model.normalizer_spec, {p.type for p in model.pieces}
        plain = not norm.precompiled_charsmap and not norm.remove_extra_whitespaces and norm.escape_whitespaces
        if model.trainer_spec.model_type != 2 or not plain or USER in kinds or UNUSED in kinds or BYTE not in kinds:
            raise ValueError("a BPE model with byte pieces and no normalisation is needed")
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        self.score = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.id = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.bytes = {int(p.piece[3:-1], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.longest = max(map(len, self.score))
        # Characters that follow each other within some piece, and how long a piece that ends in them can be
        self.reach: dict[str, int] = {}
        self.inside = {p[i : i + 2] for p in self.score for i in range(len(p) - 1)}
        for piece in self.score:
            if len(piece) > 1:
                self.reach[piece[-2:]] = max(len(piece), self.reach.get(piece[-2:], 0))
        self.crosses = any(pair[1] == SPACE and pair[0] != SPACE for pair in self.inside)
        counts = Counter(self.score.values())
        self.tied = {p for p, score in self.score.items() if counts[score] > 1}
        spelled = {NORMAL: lambda p: p.replace(SPACE, " ").encode(), BYTE: lambda p: bytes([int(p[3:-1], 16)])}
        self.spelled = [spelled[p.type](p.piece) if p.type in spelled else b"" for p in model.pieces]
        self.spelled[model.trainer_spec.unk_id] = (model.trainer_spec.unk_surface or " ⁇ ").encode()
        self.follows = Memo(lambda pair: self._keeps(*pair), KNOWN)
        self.spines = Memo(self._spines, KNOWN)
        # By what is escaped, and by plain words that follow one blank
        self.units = Memo(self._unit, KNOWN // 4, LONGEST)
        self.words = Memo(lambda word: self._unit(SPACE + word), KNOWN, LONGEST)

    def merged(self, text: str, joins: list | None = None) -> list[str]:
        """What the model's merges make of a short text: best score first, then leftmost."""
        parts = list(text)
        while True:
            pairs = [(-self.score[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.score]
            if not pairs:
                return parts
            at = min(pairs)[1]
            if joins is not None:
                joins.append((parts[at], parts[at + 1]))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _spines(self, piece: str) -> tuple[list, list] | None:
        """The pieces that were at the left and at the right end of a piece, last first.

        Each with when it was made and when it was taken up (negative scores; made -1: from the
        start). None for a piece that the merges don't make.
        """
        joins: list[tuple[str, str]] = []
        if self.merged(piece, joins) != [piece]:
            return None
        halves = {a + b: (a, b) for a, b in joins}
        ends = []
        for side in (0, 1):
            spine, part, taken = [], piece, np.inf
            while True:
                made = -self.score[part] if part in halves else -1.0
                spine.append((part, made, taken))
                if part not in halves:
                    break
                part, taken = halves[part][side], made
            ends.append(spine)
        return ends[0], ends[1]

    def _keeps(self, left: str, right: str) -> bool:
        """Whether the merges leave two neighbours as they are.

        They do unless pieces that were their facing ends at the same time merge before
        either was taken up. At one score the merge further left comes first.
        """
        if left in self.tied or right in self.tied:
            return self.merged(left + right) == [left, right]
        for a, made_a, taken_a in self.spines[left][1]:
            for b, made_b, taken_b in self.spines[right][0]:
                if made_a >= taken_b or made_b >= taken_a:
                    continue
                score = self.score.get(a + b)
                if score is not None and -score < taken_a and -score <= taken_b:
                    return False
        return True

    def _unit(self, unit: str) -> bytes:
        """Ids of a word as bytes; what no piece reaches over is cut off its end first."""
        end = len(unit) - 1
        while end > 0 and unit[end - 1 : end + 1] in self.inside:
            end -= 1
        if end <= 0 or len(unit) > LONGEST:
            return np.fromiter(self.ids(unit), np.int32).tobytes()
        front = self.words[unit[1:end]] if unit[0] == SPACE and unit[1:2] not in ("", SPACE) and end > 1 else self.units[unit[:end]]
        return front + self.units[unit[end:]]

    def ids(self, text: str) -> Iterator[int]:
        """Ids of a text in which blanks are escaped and that begins where a path may begin."""
        for piece in self.viterbi(text):
            if piece in self.id:
                yield self.id[piece]
            else:
                yield from map(self.bytes.__getitem__, piece.encode())

    def viterbi(self, text: str) -> Iterator[str]:
        back = [0]  # for each place behind ``done``: how long the last piece up to it is
        done = 0
        for end in range(1, len(text) + 1):
            back.append(self._last(text, end, back, done))
            if len(back) > 4 * self.longest:
                meet = self._meeting(back)
                if meet:
                    yield from self._path(text, back, done, meet)
                    del back[:meet]
                    done += meet
        yield from self._path(text, back, done, len(back) - 1)

    def _last(self, text: str, end: int, back: list[int], done: int) -> int:
        score, follows = self.score, self.follows
        for size in range(2, min(self.reach.get(text[end - 2 : end], 1), end) + 1):
            begin = end - size
            piece = text[begin:end]
            if piece not in score or self.spines[piece] is None or begin < done:
                continue
            # Nothing precedes the start of the text
            if begin == 0 or follows[text[begin - back[begin - done] : begin], piece]:
                return size
        return 1

    def _meeting(self, back: list[int]) -> int:
        """The last place that all paths from the window pass; 0 if there is none yet."""
        places = set(range(len(back) - self.longest, len(back)))
        while len(places) > 1:
            last = max(places)
            places.discard(last)
            places.add(max(0, last - back[last]))
        return places.pop()

    def _path(self, text: str, back: list[int], done: int, end: int) -> Iterator[str]:
        pieces = []
        while end > 0:
            size = back[end]
            pieces.append(text[done + end - size : done + end])
            end -= size
        return reversed(pieces)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text; the empty text has none."""
        if not text:
            return np.zeros(0, np.int32)
        if self.crosses:
            escaped = self.prefix + text.replace(" ", SPACE)
            return np.fromiter(self.ids(escaped), np.int32)
        out: list[bytes] = []
        begin = 0
        while begin < len(text):
            end = begin + BLOCK
            # No piece reaches from a word into the blank behind it
            while end < len(text) and not (text[end] in (" ", SPACE) and text[end - 1] not in (" ", SPACE)):
                end += 1
            part = text[begin:end]
            first = 0 if begin == 0 and self.prefix else 1
            if (first == 0 or part[0] == " ") and not (part[first : first + 1] in (" ", "") or part[-1] == " " or "  " in part or SPACE in part):
                out.extend(map(self.words.__getitem__, part[first:].split(" ")))
            else:
                escaped = ("" if begin else self.prefix) + part.replace(" ", SPACE)
                out.extend(map(self.units.__getitem__, _UNITS.findall(escaped)))
            begin = end
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        raw = b"".join(map(self.spelled.__getitem__, ids.tolist()))
        text = raw.decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


# Words with the blanks before them
_UNITS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """One for each worker process, kept from task to task."""
    return Pieces(path)


def encoded(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", checked: str | None = None) -> DataFrame:
    """``docs`` with the ids of each text (array<int>).

    ``path``: a model file, at the same place on all machines. Ids are those the model's own
    library gives, without begin and end. NULL and empty texts have no ids. ``checked`` names a
    column that says whether decoding gives the text back (with blanks for U+2581), found in the
    same pass. Columns of the same names are replaced.
    """
    new = [ids] if checked is None else [ids, checked]
    keep = [c for c in docs.columns if c.lower() not in [n.lower() for n in new]]
    kinds = {ids: F.array().cast("array<int>")} | ({checked: F.lit(True)} if checked else {})
    schema = docs.select(*quoted(keep)).withColumns(kinds).schema

    def build():
        model = pieces(path)

        def add(batch: pa.RecordBatch) -> pa.RecordBatch:
            found, same = [], []
            for t in texts_of(batch.column(text)):
                found.append(model.encode(t))
                if checked:
                    same.append(model.decode(found[-1]) == t.replace(SPACE, " "))
            ends = np.concatenate([[0], np.cumsum([len(x) for x in found])])
            flat = pa.array(np.concatenate(found))
            if ends[-1] >= 1 << 31:
                raise ValueError("a batch has too many ids; set spark.sql.execution.arrow.maxBytesPerBatch lower")
            columns = [*batch.columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)]
            return pa.RecordBatch.from_arrays(columns + ([pa.array(same)] if checked else []), names=[*keep, *new])

        return add

    return map_batches(docs.select(*quoted(keep)), build, schema)


def decoded(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the text of their ids. NULL and empty lists give the empty text.

    A round trip gives the text back, but for U+2581, which becomes a blank. A column of the
    same name is replaced.
    """
    keep = [c for c in rows.columns if c.lower() != text.lower()]
    schema = rows.select(*quoted(keep)).withColumn(text, F.lit("").cast("string")).schema

    def build():
        decode = pieces(path).decode

        def add(batch: pa.RecordBatch) -> pa.RecordBatch:
            column = batch.column(ids)
            flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            empty = column.is_null().to_pylist()
            texts = ["" if none else decode(flat[a:b]) for none, a, b in zip(empty, ends, ends[1:])]
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*keep, text])

        return add

    return map_batches(rows.select(*quoted(keep)), build, schema)

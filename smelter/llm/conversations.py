"""Conversation structure repair: the cheapest edits that make turns follow each other as they should.

Roles have to read ``(s?(ua)+)?``: a system turn at most, then user and assistant in turn. A Viterbi
search goes over the rows of a conversation with one survivor for each of the four states that
the text so far can be in. The edits of survivors are a tree of back pointers that counts
references: a survivor that dies takes its branch with it, and once all survivors descend
from one node, the edits up to it are final and leave memory. What is held is the part
still open, however long the conversation is. Of survivors at equal cost the one whose edits
come first in ASCII order wins, by all of their open edits; pointers that skip ahead find
where two branches part without walking them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smelter.llm.arrow import slices

WHITE = " \t\n\x0b\f\r"
KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3
TRUNCATED = 3
# States: nothing yet, after system, after user, after assistant
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
INITIAL = {SYSTEM: "s", USER: "u", ASSISTANT: "a"}
FULL = {USER: "user", ASSISTANT: "assistant"}
# What may follow: state before, state after
STEPS = [(NOTHING, SYSTEM), (NOTHING, USER), (SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)]
LEGAL = ("su", "ua", "au")
# Final edits of a conversation leave the task in pieces of this many
PIECE = 1 << 20
RESULT = (
    "place: bigint, edits: string, states: string, last: boolean, gaps: bigint, blank: bigint, duplicate: bigint, "
    "truncated: bigint, illegal: bigint, cost: bigint, repaired_sha256: string"
)


class Edit:
    """A node of the tree: one edit behind those of ``parent``. ``held`` counts survivors and children."""

    __slots__ = ("parent", "skip", "depth", "letter", "state", "held")

    def __init__(self, parent: Edit | None, letter: str = "", state: str = ""):
        self.parent, self.letter, self.state, self.held = parent, letter, state, 0
        if parent is None:
            self.depth, self.skip = 0, self
        else:
            self.depth = parent.depth + 1
            far = parent.skip
            # Skips double in length wherever two of one length lie behind each other
            even = parent.depth - far.depth == far.depth - far.skip.depth
            self.skip = far.skip if even else parent
            parent.held += 1

    def above(self, depth: int) -> Edit:
        node = self
        while node.depth > depth:
            node = node.skip if node.skip.depth >= depth else node.parent
        return node


def earlier(a: Edit, b: Edit) -> bool:
    """Whether the edits up to ``a`` come before those up to ``b`` in ASCII order.

    Only what follows their last common node is looked at; that is never above the final part.
    """
    depth = min(a.depth, b.depth)
    x, y = a.above(depth), b.above(depth)
    if x is y:
        return a.depth < b.depth
    while x.parent is not y.parent:
        x, y = (x.skip, y.skip) if x.skip is not y.skip else (x.parent, y.parent)
    return x.letter < y.letter


class Search:
    """The search over one conversation. ``add`` takes its rows in order, ``finish`` ends it."""

    def __init__(self):
        self.root = Edit(None)
        self.root.held = 1
        # State: (cost, node, hash of the repaired text so far, whether that has a line)
        self.survivors = {NOTHING: (0, self.root, hashlib.sha256(), False)}
        self.letters: list[str] = []
        self.states: list[str] = []

    def add(self, role: str, text: str, gone: bool, truncated: bool) -> None:
        """One row; ``gone``: it has to be deleted."""
        self._insert()
        best: dict[int, tuple] = {}
        for state, (cost, node, _, _) in self.survivors.items():
            self._offer(best, state, cost + DELETE, node, "D", None, state)
        if not gone:
            penalty = TRUNCATED if truncated else 0
            for state, after in STEPS:
                if state in self.survivors:
                    cost, node = self.survivors[state][:2]
                    if role[:1] == INITIAL[after]:
                        self._offer(best, after, cost + penalty + KEEP, node, "K", role, state)
                    if after != SYSTEM:
                        self._offer(best, after, cost + penalty + REROLE, node, "R", FULL[after], state)
        self._settle(best, text)
        self._prune()
        self._commit()

    def _insert(self) -> None:
        """What an inserted turn adds; two in a row at most can pay."""
        for _ in range(2):
            best = {s: (v[0], v[1], None, None, s) for s, v in self.survivors.items()}
            for state, after in STEPS:
                if after != SYSTEM and state in self.survivors:
                    cost, node = self.survivors[state][:2]
                    self._offer(best, after, cost + INSERT, node, "I", FULL[after], state)
            self._settle(best, "")

    def _offer(self, best: dict, after: int, cost: int, node: Edit, letter: str, role: str | None, origin: int) -> None:
        """A way into state ``after``: the edits up to ``node``, then ``letter``."""
        held = best.get(after)
        if held is None or cost < held[0] or (cost == held[0] and self._before(node, letter, held[1], held[2])):
            best[after] = (cost, node, letter, role, origin)

    @staticmethod
    def _before(node: Edit, letter: str | None, other: Edit, rival: str | None) -> bool:
        """Order of two paths: nodes, each with one more letter or none."""
        if node is other:
            return (letter or "") < (rival or "")
        depth = min(node.depth, other.depth)
        if node.depth == depth and other.above(depth) is node:
            follows = other.above(depth + 1).letter
            return (letter or "") < follows if letter != follows else other.depth > depth + 1 or bool(rival)
        if other.depth == depth and node.above(depth) is other:
            follows = node.above(depth + 1).letter
            return follows < (rival or "") if rival != follows else False
        return earlier(node, other)

    def _settle(self, best: dict, text: str) -> None:
        """The chosen paths become the survivors; the others' branches go."""
        before, self.survivors = self.survivors, {}
        line = None
        for after, (cost, node, letter, role, origin) in best.items():
            _, _, digest, begun = before[origin]
            if letter is None:
                self.survivors[after] = before[origin]
                node.held += 1
                continue
            child = Edit(node, letter, "-" if letter == "D" else INITIAL[after])
            child.held = 1
            if role is not None:
                line = text.encode("utf-8", "replace") if line is None else line
                digest = digest.copy()
                digest.update((("\n" if begun else "") + role + ":").encode("utf-8", "replace"))
                digest.update(line)
                begun = True
            self.survivors[after] = (cost, child, digest, begun)
        for _, node, _, _ in before.values():
            self._release(node)

    @staticmethod
    def _release(node: Edit | None) -> None:
        while node is not None:
            node.held -= 1
            if node.held:
                return
            node = node.parent

    def _prune(self) -> None:
        """A state that another beats whatever follows.

        What may follow "system" may follow "assistant" too. What may follow nothing may as well,
        if a later system turn is deleted instead of kept.
        """
        if ASSISTANT in self.survivors:
            cost = self.survivors[ASSISTANT][0]
            for state, more in ((SYSTEM, 0), (NOTHING, DELETE)):
                if state in self.survivors and cost + more < self.survivors[state][0]:
                    self._release(self.survivors.pop(state)[1])

    def _commit(self) -> None:
        """Edits that all survivors share are final."""
        node = next(iter(self.survivors.values()))[1]
        while self.root.held == 1 and node is not self.root:
            child = node.above(self.root.depth + 1)
            self.letters.append(child.letter)
            self.states.append(child.state)
            self.root, child.parent = child, None

    def drained(self) -> tuple[str, str]:
        """The final edits not yet asked for, and the state after each."""
        out = "".join(self.letters), "".join(self.states)
        self.letters.clear()
        self.states.clear()
        return out

    def finish(self) -> tuple[int, str]:
        """Cost and the hash of the repaired text; all edits are final then."""
        self._insert()
        ends = [self.survivors[s] for s in (NOTHING, ASSISTANT) if s in self.survivors]
        chosen = ends[0]
        for other in ends[1:]:
            if other[0] < chosen[0] or (other[0] == chosen[0] and earlier(other[1], chosen[1])):
                chosen = other
        cost, node, digest, _ = chosen
        tail = []
        while node is not self.root:
            tail.append(node)
            node = node.parent
        self.letters += [n.letter for n in reversed(tail)]
        self.states += [n.state for n in reversed(tail)]
        return cost, digest.hexdigest()


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, present) after the faults that crc32 of ``conv_id:turn`` modulo 20 names.

    0 drops a row (it stays with ``present`` false, to name its conversation), 1 empties the text,
    2 removes ``[.!?]``, 3 repeats the row, 4 sets the role to user. NULLs count as one space each.
    """
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    fault = F.col("fault")
    return (
        rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(name.cast("binary")) % 20).alias("fault"))
        .select(
            "conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(fault <= 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
            (fault != 0).alias("present"), F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        )
        .drop("copy")
    )


def in_order(rows: DataFrame) -> DataFrame:
    """Rows with their faults, whole conversations to a task, each in order of turn, NULL first, then role and text.

    A text that has to go (blank, or role and text seen before) doesn't travel on. One shuffle: the
    window over equal texts, the final order and the search all use the same partitioning.
    """
    bare = F.rtrim(F.col("text"), F.lit(WHITE))
    marked = rows.select(
        F.col("conv_id").alias("id"), "turn", "role", "text", "present", (bare == "").alias("blank"),
        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("truncated"),
    )
    placed = marked.repartition("id")
    # Two hashes name a text, so that the sort of equal ones compares numbers
    same = Window.partitionBy("id", "present", F.xxhash64("role", "text"), F.xxhash64(F.lit("text"), "text", "role"))
    placed = placed.withColumn("duplicate", F.row_number().over(same.orderBy(F.asc_nulls_first("turn"))) > 1)
    ordered = placed.sortWithinPartitions("id", F.asc_nulls_first("turn"), "role", "text", "duplicate")
    gone = F.col("blank") | F.col("duplicate")
    return ordered.select("id", "turn", "role", F.when(~gone, F.col("text")).alias("text"), "present", "blank", "duplicate", "truncated")


def searched(rows: DataFrame) -> DataFrame:
    """Edits of each conversation: (id, r), r as in ``RESULT``; ``rows``: conv_id, turn, role, text, present.

    Rows of one conversation come one after the other, ``place`` numbers its pieces; the ``last`` has the
    figures. ``states`` holds the initial of the role that each edit leaves, ``-`` for a deleted row.
    """
    ordered = in_order(rows)
    schema = ordered.select("id", F.lit(None).cast(f"struct<{RESULT}>").alias("r")).schema
    return ordered.mapInArrow(_repaired(PIECE), schema)


def repair(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: str | None = None) -> DataFrame:
    """One row for each conversation: its key, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``gaps``: turns missing between the first and the last. Each row's first fault counts: blank (no
    characters but white ones), duplicate (role and text seen earlier), truncated (the last such character is not
    ``.``, ``!`` or ``?``). ``illegal``: neighbours whose initials are not su, ua or au. ``audit``: the cheapest
    edits, K keeps, R gives the role user or assistant, D deletes, I inserts an empty text. Equal
    costs: the first in ASCII order. NULL roles and texts count as one space; rows with NULL as conversation are
    one. Repeated rows count each. Where ``present`` (a boolean column) is false a row only names its conversation;
    one without other rows has zeros, an empty audit and the hash of nothing. Other columns are not looked at.
    """
    found = searched(_named(rows, conversation, turn, role, text, present))
    pieces = found.groupBy("id").agg(
        F.max(F.when(F.col("r.last"), F.col("r"))).alias("r"),
        F.sort_array(F.collect_list(F.struct("r.place", "r.edits"))).alias("pieces"),
    )
    figures = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return pieces.select(
        F.col("id").alias(conversation), *[F.col("r")[c].alias(c) for c in figures],
        F.array_join(F.col("pieces.edits"), "").alias("audit"), F.col("r.repaired_sha256").alias("repaired_sha256"),
    )


def repaired(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: str | None = None) -> DataFrame:
    """The repaired conversations: (key, place int, role, text, edit), ``place`` from 0; an inserted row has an empty text."""
    named = _named(rows, conversation, turn, role, text, present)
    edits = searched(named).select("id", "r.place", F.posexplode(F.split("r.edits", "")).alias("nth", "edit"), F.col("r.states").alias("states"))
    edits = edits.where("edit != ''").select("id", "place", "nth", "edit", F.expr("substring(states, nth + 1, 1)").alias("state"))
    inside = Window.partitionBy("id").orderBy("place", "nth")
    edits = edits.withColumn("row", F.sum(F.when(F.col("edit") != "I", 1).otherwise(0)).over(inside))
    edits = edits.where("edit != 'D'").withColumn("at", (F.row_number().over(inside) - 1).cast("int"))
    bodies = named.where("present").select(F.col("conv_id").alias("key"), "turn", F.col("role").alias("was"), "text")
    number = Window.partitionBy("key").orderBy(F.asc_nulls_first("turn"), "was", "text")
    bodies = bodies.withColumn("nr", F.row_number().over(number))
    joined = edits.join(bodies, F.col("id").eqNullSafe(F.col("key")) & (F.col("row") == F.col("nr")) & (F.col("edit") != "I"), "left")
    given = F.when(F.col("state") == "u", "user").otherwise("assistant")
    return joined.select(
        F.col("id").alias(conversation), F.col("at").alias("place"), F.when(F.col("edit") == "K", F.col("was")).otherwise(given).alias("role"),
        F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias("text"), "edit",
    )


def _named(rows: DataFrame, conversation: str, turn: str, role: str, text: str, present: str | None) -> DataFrame:
    def full(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    there = F.coalesce(F.col(present), F.lit(False)) if present else F.lit(True)
    named = F.col(conversation).alias("conv_id"), F.col(turn).cast("bigint").alias("turn")
    return rows.select(*named, full(role).alias("role"), full(text).alias("text"), there.alias("present"))


class _Conversation:
    """Figures of one conversation while its rows pass."""

    def __init__(self):
        self.search, self.place = Search(), 0
        self.turns, self.low, self.high = 0, None, None
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.initial: str | None = None

    def add(self, turn, role, text, blank, duplicate, truncated) -> None:
        if turn is not None:
            # In order, so that a turn not seen yet is another one than the last
            self.turns += self.high is None or turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        if self.initial is not None:
            self.illegal += self.initial + role[:1] not in LEGAL
        self.initial = role[:1]
        self.blank += blank
        self.duplicate += not blank and duplicate
        cut = not blank and not duplicate and truncated
        self.truncated += cut
        self.search.add(role, text or "", blank or duplicate, cut)

    def piece(self) -> dict:
        edits, states = self.search.drained()
        self.place += 1
        return {"place": self.place, "edits": edits, "states": states, "last": False}

    def last(self) -> dict:
        cost, digest = self.search.finish()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        figures = {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal}
        return {**self.piece(), **figures, "last": True, "cost": cost, "repaired_sha256": digest}


def _repaired(piece: int):
    kind = pa.struct([(f.split(":")[0].strip(), _arrow(f.split(":")[1].strip())) for f in RESULT.split(",")])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, key, id_type, out = None, None, None, []

        def emitted() -> pa.RecordBatch:
            ids, found = zip(*out)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array(found, kind)], names=["id", "r"])

        for batch in batches:
            for part in slices(batch):
                id_type = part.schema.field(0).type
                for name, turn, role, text, present, *faults in zip(*(c.to_pylist() for c in part.columns)):
                    if current is None or name != key:
                        if current is not None:
                            out.append((key, current.last()))
                        current, key = _Conversation(), name
                    if present:
                        current.add(turn, role, text, *faults)
                        if len(current.search.letters) >= piece:
                            out.append((key, current.piece()))
                if out:
                    yield emitted()
        if current is not None:
            out.append((key, current.last()))
            yield emitted()

    return run


def _arrow(name: str) -> pa.DataType:
    return {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}[name]

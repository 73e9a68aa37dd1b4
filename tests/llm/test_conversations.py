"""Conversation repair against all edits tried out, and against a plain table of whole strings."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest
from conftest import TESTDATA

from smelter.llm import conversations
from smelter.llm.queries import QUERIES

SF = f"{TESTDATA}/sf0.01"
WHITE = " \t\n\x0b\f\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def faults(rows):
    """(role, text, kind) of rows in order; kind: first fault or None."""
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(WHITE)
        kind = "blank" if not bare else "duplicate" if (role, text) in seen else None if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, kind))
    return out


def tried(rows):
    """Cost and audit of the best of all edits, with two inserted turns at a place at most."""
    marked, best = faults(rows), None
    insertions = [()] + [(a,) for a in ("user", "assistant")] + list(itertools.product(("user", "assistant"), repeat=2))
    for added in itertools.product(insertions, repeat=len(marked) + 1):
        for edits in itertools.product("KDua", repeat=len(marked)):
            if any(k in ("blank", "duplicate") and e != "D" for (_, _, k), e in zip(marked, edits)):
                continue
            cost, audit, roles = 0, "", ""
            for i in range(len(marked) + 1):
                cost, audit, roles = cost + 3 * len(added[i]), audit + "I" * len(added[i]), roles + "".join(a[0] for a in added[i])
                if i < len(marked):
                    role, _, kind = marked[i]
                    edit = edits[i]
                    cost += {"K": 0, "D": 4}.get(edit, 3) + 3 * (kind == "truncated" and edit != "D")
                    audit += edit if edit in "KD" else "R"
                    roles += "" if edit == "D" else (role[:1] or "?") if edit == "K" else edit
            if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def plain(rows):
    """(cost, audit, repaired lines) with whole strings in the table of states."""
    steps = {"": "su", "s": "u", "u": "a", "a": "u"}
    full = {"u": "user", "a": "assistant"}

    def inserted(table):
        for _ in range(3):
            for state, (cost, audit, lines) in list(table.items()):
                for after in steps[state]:
                    if after != "s":
                        offer(table, after, (cost + 3, audit + "I", lines + (full[after] + ":",)))
        return table

    def offer(table, state, path):
        if state not in table or path < table[state]:
            table[state] = path

    table = {"": (0, "", ())}
    for role, text, kind in faults(rows):
        new = {}
        for state, (cost, audit, lines) in inserted(table).items():
            offer(new, state, (cost + 4, audit + "D", lines))
            if kind not in ("blank", "duplicate"):
                more = 3 * (kind == "truncated")
                for after in steps[state]:
                    if role[:1] == after:
                        offer(new, after, (cost + more, audit + "K", lines + (f"{role}:{text}",)))
                    if after != "s":
                        offer(new, after, (cost + more + 3, audit + "R", lines + (f"{full[after]}:{text}",)))
        table = new
    return min(v for s, v in inserted(table).items() if s in ("", "a"))


def summary(rows, names):
    """Expected result by conversation of (conv_id, turn, role, text) rows that are there."""
    found, out = defaultdict(list), {}
    for conv, turn, role, text in rows:
        found[conv].append((turn, role, text))
    for conv in names:
        ordered = sorted(found[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        said = [(role, text) for _, role, text in ordered]
        kinds = [k for _, _, k in faults(said)]
        turns = [t for t, _, _ in ordered if t is not None]
        initials = [r[:1] for r, _ in said]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = plain(said)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"), illegal, cost, audit, digest)
    return out


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        role, text, fault = " " if role is None else role, " " if text is None else text, zlib.crc32(key.encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def as_dict(rows):
    columns = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[c] for c in columns) for r in rows}


def test_query(spark):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF}/conversations.parquet'").fetchall()
    assert as_dict(QUERIES["op11_conversations"](spark, SF).collect()) == summary(damage(rows), {r[0] for r in rows})


def search(rows):
    at_work = conversations.Search()
    letters = []
    for role, text, kind in faults(rows):
        at_work.add(role, text, kind in ("blank", "duplicate"), kind == "truncated")
        letters.append(at_work.drained()[0])
    cost, digest = at_work.finish()
    return cost, "".join(letters) + at_work.drained()[0], digest


def words(choice, n):
    return "".join(choice.choice("abcdefgh") for _ in range(n))


def test_plain_table_finds_the_best_of_all_edits():
    choice = random.Random(5)
    for _ in range(40):
        rows = [(choice.choice(["user", "assistant", "system", "x", ""]), choice.choice(["a.", "b.", "c", " ", words(choice, 3) + "!"])) for _ in range(choice.randrange(3))]
        assert plain(rows)[:2] == tried(rows)


@pytest.mark.parametrize("seed", range(6))
def test_search_agrees_with_whole_strings(seed):
    choice = random.Random(seed)
    for _ in range(300):
        roles = choice.choice([["user", "assistant"], ["user", "assistant", "system"], ["user"], ["system", "user"], ["assistant", "tool", "user", ""]])
        texts = choice.choice([["a.", "b", " "], None])
        rows = [(choice.choice(roles), choice.choice(texts) if texts else words(choice, 4) + choice.choice([".", "", "!"])) for _ in range(choice.randrange(40))]
        cost, audit, lines = plain(rows)
        assert search(rows) == (cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def test_final_edits_leave_memory():
    at_work = conversations.Search()
    for i in range(3000):
        at_work.add("user" if i % 2 == 0 else "assistant", f"{i}.", False, False)
        node = next(iter(at_work.survivors.values()))[1]
        assert node.depth - at_work.root.depth <= 4
    # Of one role only, two ways to pair the turns stay open to the end
    at_work = conversations.Search()
    for i in range(3000):
        at_work.add("user", f"{i}.", False, False)
    cost, _ = at_work.finish()
    assert cost == 4500 and at_work.drained()[0] == "KR" * 1500


def test_nulls_ties_repeats_and_clashing_names(spark):
    rows = [
        (1, None, "user", "b."), (1, None, "assistant", None), (1, 3, None, "c."), (1, 3, "user", "c."), (1, 3, "user", "c."),
        (None, 0, "user", "x."), (None, 1, "assistant", "y"), (2, 5, "system", "only"), (3, 1, "", ""),
    ]
    frame = spark.createDataFrame([(*r, 1, "z") for r in rows], SCHEMA + ", blank int, id string")
    full = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert as_dict(conversations.repair(frame).collect()) == summary(full, {1, 2, 3, None})
    nothing = conversations.repair(frame.selectExpr("*", "conv_id = 1 AS there"), present="there").collect()
    assert as_dict(nothing) == summary([r for r in full if r[0] == 1], {1, 2, 3, None})
    assert conversations.repair(frame.limit(0)).collect() == []


def test_hot_conversation_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(conversations, "PIECE", 7)
    rows = [(1, i, "user" if i % 3 else "assistant", f"{i % 90} is said." + "long " * (i == 5) * 50000) for i in range(800)]
    rows += [(2, i, "system", "s") for i in range(3)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert as_dict(conversations.repair(frame).collect()) == summary(rows, {1, 2})


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "s."), (1, 1, "assistant", "a."), (1, 2, "assistant", "a."), (1, 3, "user", "u"), (2, 0, "user", "q?"), (2, 1, "user", "r.")]
    frame = spark.createDataFrame(rows, SCHEMA)
    for conv, wanted in {1: 3, 2: 2}.items():
        lines = plain([(r, t) for c, _, r, t in rows if c == conv])[2]
        found = sorted((r for r in conversations.repaired(frame).collect() if r.conv_id == conv), key=lambda r: r.place)
        assert [r.place for r in found] == list(range(len(lines))) and len(lines) >= wanted - 1
        assert tuple(f"{r.role}:{r.text}" for r in found) == lines


def test_one_shuffle_brings_rows_to_the_search(spark):
    plan = conversations.in_order(conversations.damaged(spark.createDataFrame([], SCHEMA)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1

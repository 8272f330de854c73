"""Conversation repair against an exhaustive search and against a plain reading of its rules."""

import hashlib
import heapq
import random
import zlib

import pytest

from pulselake.llm import conversations
from pulselake.llm.common import importable, table
from pulselake.llm.queries import op11_conversation_repair

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def cheapest(turns):
    """Cost and ASCII-least edits by Dijkstra over (cost, edits); ``turns`` of (role initial, fault)."""
    queue, done = [(0, "", 0, "")], set()
    while queue:
        cost, audit, i, last = heapq.heappop(queue)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(turns) and last in ("", "a"):
            return cost, audit
        wanted = "a" if last == "u" else "u"
        steps = [(5, "I", i, wanted)]
        if i < len(turns):
            role, fault = turns[i]
            steps.append((2, "D", i + 1, last))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault else 0
                steps.append((1 + more, "R", i + 1, wanted))
                if role == wanted or (role == "s" and last == ""):
                    steps.append((more, "K", i + 1, role))
        for extra, letter, at, state in steps:
            heapq.heappush(queue, (cost + extra, audit + letter, at, state))


def plain(rows):
    """The report by reading the rules one by one."""
    out = {}
    after = {i: [] for i, *_ in rows}
    for ident, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        named = ":".join(" " if v is None else str(v) for v in (ident, turn))
        kind = zlib.crc32(named.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else text.translate(str.maketrans("", "", ".!?")) if kind == 2 else text
        role = "user" if kind == 4 else role
        after[ident] += [(turn, role, text)] * (2 if kind == 3 else 1)
    for ident, turns in after.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        seen, marked = set(), []
        for _, role, text in turns:
            ink = text.strip(SPACE)
            fault = "blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else ""
            seen.add((role, text))
            marked.append((role[:1], fault))
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit = cheapest(marked)
        lines, at, last = [], 0, ""
        for letter in audit:
            wanted = "assistant" if last == "u" else "user"
            if letter == "I":
                lines.append(f"{wanted}:")
            else:
                _, role, text = turns[at]
                at += 1
                if letter != "D":
                    lines.append(f"{role if letter == 'K' else wanted}:{text}")
            if letter in "IR":
                last = wanted[0]
            elif letter == "K":
                last = role[0]
        counts = [sum(f == kind for _, f in marked) for kind in ("blank", "duplicate", "truncated")]
        out[ident] = (ident, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return sorted(out.values(), key=repr)


def test_search_finds_the_cheapest_and_least_edits():
    rng = random.Random(11)
    for k in range(600):
        turns = [(rng.choice(["s", "u", "a", "u", "a", "", " ", "x"]), rng.choice(["", "", "", "blank", "duplicate", "truncated"])) for _ in range(rng.randint(0, 9))]
        codes = bytes(conversations.code_of(r, {"": 0, "truncated": 2}.get(f, 1)) for r, f in turns)
        edits, state, cost = conversations.search(codes)
        assert (cost, edits + conversations.TAIL[state]) == cheapest(turns), turns


def test_long_conversations_are_searched_in_time():
    codes = bytes([1] * 700 + [2] * 500 + [1, 9, 5, 2] * 300)
    edits, state, cost = conversations.search(codes)
    assert len(edits) >= len(codes) and cost > 0


def rows_of(seed, count, longest):
    rng = random.Random(seed)
    rows = []
    for ident in [*range(count), None]:
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool"])
            text = rng.choice(["Yes.", "No!", "Why?  \n", "open", "", " \t", None, "Yes.", "é. ", f"Turn {turn}.", f"{turn} and"])
            rows.append((ident, rng.choice([turn, turn, turn, None, turn + 3]), role, text))
    return rows + rows[:3]


@pytest.mark.parametrize("segment", [512, 6, 1])
def test_whole_report_equals_plain_rules(spark, monkeypatch, segment):
    monkeypatch.setattr(conversations, "SEGMENT", segment)
    rows = rows_of(segment, 25, 30)
    frame = importable(spark).createDataFrame([(*r, "k", 1, "p") for r in rows], SCHEMA + ", name string, segment long, lost string").repartition(5)
    bad = conversations.damaged(frame.drop("lost"))
    found = conversations.report(bad, bad["lost"], segment)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain(rows)


def test_repaired_turns_read_as_they_should(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hello."), (1, 2, "user", "Are you there?"), (1, 4, "assistant", "Yes."), (2, 0, "assistant", "cut off")]
    found = {r["conv_id"]: r for r in conversations.repair(importable(spark).createDataFrame(rows, SCHEMA)).collect()}
    assert (found[1]["edits"], found[1]["cost"], found[1]["gaps"]) == ("KDKK", 2, 1)
    assert [tuple(t) for t in found[1]["repaired"]] == [("system", "Be kind."), ("user", "Are you there?"), ("assistant", "Yes.")]
    assert (found[2]["edits"], found[2]["repaired"]) == ("D", [])


def test_query_equals_plain_rules(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in op11_conversation_repair(spark, sf_dir).collect()), key=repr) == plain(rows)


def test_empty_and_lost_conversations(spark):
    none = importable(spark).createDataFrame([], SCHEMA)
    bad = conversations.damaged(none)
    assert conversations.report(bad, bad["lost"]).collect() == []
    gone = [(i, t, "user", "x.") for i in range(400) for t in (0, 0, 0) if zlib.crc32(f"{i}:0".encode()) % 20 == 0]
    for segment in (512, 2):
        bad = conversations.damaged(spark.createDataFrame(gone, SCHEMA))
        found = sorted(tuple(r) for r in conversations.report(bad, bad["lost"], segment).collect())
        assert found == [(i, *[0] * 6, "", hashlib.sha256(b"").hexdigest()) for i in sorted({g[0] for g in gone})]

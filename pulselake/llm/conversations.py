"""Repair of conversations by iterative-deepening A*.

A conversation is put right by keeping, deleting, re-roling and inserting turns until its roles read
system?, then user and assistant in turn. The search walks the edits depth first in ASCII order under
a bound on their cost and raises the bound to the least cost that exceeded it. A table holds for every
state (turns read, role last read) the cost that the search proved it lacks, so that no failed state
is entered again under the same remaining cost; the first path that is accepted is the answer.

Conversations of up to ``SEGMENT`` turns are read whole, one after the other, in tasks that hold some
conversations each. Longer ones are sorted by range and cut into segments, whatever their number of
turns. A segment is searched from each of the four states in which it can begin, towards the costs
of what follows it; those come from one small table of costs per segment. No task holds more texts
than a segment, only one small row per segment of a conversation meets in a task. The hash over a
whole repaired conversation passes through one task as a stream.

Defined results: null roles and texts are one space; null ids form one conversation; turns are ordered
with nulls first, then by role and text, so repeated rows and ties are stable; empty texts are blank and
very long ones are read whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.llm.common import stored

#: Turns of a conversation that are searched at once; longer conversations are cut.
SEGMENT = 512
#: Costs of the edits, and of a truncated turn that stays.
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
SPACE = " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")
OK, GONE, TRUNCATED = 0, 1, 2  # a turn to delete is blank or a duplicate
ROLES = ("system", "user", "assistant")

#: States: nothing read, system, user, assistant. A user turn may follow all but a user turn.
START, SYSTEM, USER, ASSISTANT = range(4)
TURN = (USER, USER, ASSISTANT, USER)
#: What a whole conversation still needs in each state.
TAIL = ("", "II", "I", "")

SCHEMA = (
    "conv_id long, segment long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long,"
    " edits string, repaired array<struct<role: string, text: string>>"
)
STATS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def code_of(initial: str, fault: int) -> int:
    """A turn as one number: its role by its initial (3 for any other) and what is wrong with it."""
    return ("sua".find(initial) % 4 if initial else 3) + 4 * fault


def _moves(code: int) -> tuple:
    """For each state the edits of a turn in ASCII order: letter, cost, next state, turns read."""
    role, fault = code % 4, code // 4
    more = CUT if fault == TRUNCATED else 0
    out = []
    for state in range(4):
        moves = [("D", DELETE, state, 1), ("I", INSERT, TURN[state], 0)]
        kept = {0: SYSTEM if state == START else None, 1: USER, 2: ASSISTANT}.get(role)
        if fault != GONE:
            if kept == SYSTEM or (kept is not None and kept == TURN[state]):
                moves.append(("K", KEEP + more, kept, 1))
            moves.append(("R", REROLE + more, TURN[state], 1))
        out.append(tuple(moves))
    return tuple(out)


MOVES = tuple(_moves(code) for code in range(12))
#: What a turn costs at least.
LOWEST = tuple(min(cost for moves in _moves(code) for letter, cost, _, step in moves if step) for code in range(12))
ENDS = tuple(INSERT * len(t) for t in TAIL)


def search(codes: bytes, entry: int = START, ends: Sequence[int] = ENDS) -> tuple[str, int, int]:
    """The cheapest edits from state ``entry``, of equal ones the ASCII-least; the state after them; their cost.

    ``ends`` are the costs still to come in each state after the last turn; they are part of the cost.
    """
    n = len(codes)
    lacks = [0] * (4 * n) + list(ends)  # the least that each state still costs, as far as proven
    rest = min(ends)
    for i in range(n - 1, -1, -1):
        rest += LOWEST[codes[i]]
        lacks[4 * i : 4 * i + 4] = [rest] * 4
    while True:
        bound, path = lacks[entry], []
        frames = [[0, entry, 0, 0, None]]  # turns read, state, spent, next edit, least cost of the edits tried
        while frames:
            i, state, spent, edit, least = frame = frames[-1]
            if i == n:
                return "".join(path), state, spent + ends[state]
            moves = MOVES[codes[i]][state]
            if edit < len(moves):
                letter, cost, to, step = moves[edit]
                frame[3] += 1
                needs = cost + lacks[4 * (i + step) + to]
                if spent + needs <= bound:
                    path.append(letter)
                    frames.append([i + step, to, spent + cost, 0, None])
                elif least is None or needs < least:
                    frame[4] = needs
                continue
            frames.pop()
            here = 4 * i + state
            lacks[here] = max(lacks[here], least)
            if frames:
                path.pop()
                before = frames[-1]
                needs = spent - before[2] + lacks[here]
                before[4] = needs if before[4] is None else min(before[4], needs)


def applied(edits: str, state: int, turns: Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
    """Role and text of the turns after the edits."""
    out, at = [], 0
    for letter in edits:
        if letter in "IR":
            state = TURN[state]
        if letter == "I":
            out.append((ROLES[state - 1], ""))
            continue
        role, text = turns[at]
        at += 1
        if letter == "K":
            state = 1 + "sua".index(role[0])
            out.append((role, text))
        elif letter == "R":
            out.append((ROLES[state - 1], text))
    return out


def faults_of(roles: Sequence[str], lasts: Sequence[str], repeated: Sequence[bool]) -> tuple[bytes, list[int], int]:
    """Codes of turns in order; how many are blank, duplicate, truncated; how many neighbours are illegal."""
    codes, counts = bytearray(), [0, 0, 0]
    for role, last, again in zip(roles, lasts, repeated):
        fault = 0 if not last else 1 if again else 2 if last not in ".!?" else None
        if fault is not None:
            counts[fault] += 1
        codes.append(code_of(role[:1], OK if fault is None else TRUNCATED if fault == 2 else GONE))
    illegal = sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:]))
    return bytes(codes), counts, illegal


def mended(turns: Sequence[tuple[int | None, str, str]]) -> tuple:
    """Gaps, faults, cost, edits and repaired turns of a whole conversation of (turn, role, text) in order."""
    named = {t for t, _, _ in turns if t is not None}
    gaps = max(named) - min(named) + 1 - len(named) if named else 0
    seen: set[tuple[str, str]] = set()
    repeated = []
    for _, role, text in turns:
        repeated.append((role, text) in seen)
        seen.add((role, text))
    codes, counts, illegal = faults_of([r for _, r, _ in turns], [t.rstrip(SPACE)[-1:] for _, _, t in turns], repeated)
    edits, state, cost = search(codes)
    edits += TAIL[state]
    return gaps, *counts, illegal, cost, edits, applied(edits, START, [(r, t) for _, r, t in turns])


def _short(rows: DataFrame) -> DataFrame:
    """Conversations of few turns, one row each."""

    def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        out = []
        for ident, own in groupby(turns, key=lambda r: r[0]):
            *stats, edits, repaired = mended([r[1:4] for r in own if not r[4]])
            pairs = [{"role": role, "text": text} for role, text in repaired]
            out.append((ident, 0, *stats, edits, pairs))
            if len(out) >= SEGMENT:
                yield closed(out)
                out = []
        if out:
            yield closed(out)

    kinds = [pa.int64()] * 8 + [pa.string(), pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))]
    names = ["conv_id", "segment", *STATS, "edits", "repaired"]

    def closed(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    return ordered.select("conv_id", "turn", "role", "text", "lost").mapInArrow(conversations, SCHEMA)


def costs_between(codes: bytes) -> list[int]:
    """The least cost from each state before some turns to each state after them, row by row."""
    out = []
    for entry in range(4):
        now = [None] * 4
        now[entry] = 0
        for code in codes:
            for state in (USER, ASSISTANT, USER):  # insertions lead to these; two in a row are enough
                for before in range(4):
                    if TURN[before] == state and now[before] is not None:
                        now[state] = min(c for c in (now[state], now[before] + INSERT) if c is not None)
            after = [None] * 4
            for state in range(4):
                for _, cost, to, step in MOVES[code][state] if now[state] is not None else ():
                    if step and (after[to] is None or now[state] + cost < after[to]):
                        after[to] = now[state] + cost
            now = after
        out += [-1 if c is None else c for c in now]
    return out


def _codes(own: pd.DataFrame) -> pd.DataFrame:
    own = own.sort_values("place")
    codes, counts, illegal = faults_of(own["role"].tolist(), own["last"].tolist(), own["repeated"].tolist())
    ends = [own["role"].iloc[k][:1] for k in (0, -1)]
    return pd.DataFrame([(own["name"].iloc[0], own["segment"].iloc[0], codes, *counts, illegal, *ends, costs_between(codes))],
                        columns=["name", "segment", "codes", "blank", "duplicate", "truncated", "illegal", "head", "foot", "between"])


def _towards(own: pd.DataFrame) -> pd.DataFrame:
    """The costs of all that follows each segment, by the state after it."""
    own = own.sort_values("segment", ascending=False)
    ends, found = list(ENDS), []
    for between in own["between"]:
        found.append(ends)
        ends = [min(c + e for c, e in zip(between[4 * s : 4 * s + 4], ends) if c >= 0) for s in range(4)]
    return own.drop(columns="between").assign(ends=found)


def _searched(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every segment's edits from each state in which it can begin."""
    for own in frames:
        found = [[search(bytes(c), s, e.tolist()) for s in range(4)] for c, e in zip(own["codes"], own["ends"])]
        yield own.drop(columns="codes").assign(
            ways=[[f[0] for f in four] for four in found], exits=[[f[1] for f in four] for four in found],
            costs=[[f[2] - int(e[f[1]]) for f in four] for four, e in zip(found, own["ends"])],
        ).drop(columns="ends")


def _chosen(own: pd.DataFrame) -> pd.DataFrame:
    """The state in which each segment begins, and with it its edits."""
    own = own.sort_values("segment")
    state, foot, out = START, None, []
    for k, row in enumerate(own.itertuples()):
        last, edits, cost = k == len(own) - 1, row.ways[state], int(row.costs[state])
        after = int(row.exits[state])
        if last:
            edits, cost = edits + TAIL[after], cost + ENDS[after]
        illegal = row.illegal + (foot is not None and foot + row.head not in LEGAL)
        out.append((row.name, row.segment, row.blank, row.duplicate, row.truncated, illegal, cost, edits, state, k == 0))
        state, foot = after, row.foot
    return pd.DataFrame(out, columns=["name", "segment", "blank", "duplicate", "truncated", "illegal", "cost", "edits", "state", "first"])


def _long(rows: DataFrame) -> DataFrame:
    """Conversations of many turns, one row for each segment of them."""
    named = rows.where(~F.col("lost")).withColumn("name", F.coalesce(F.concat(F.lit("+"), F.col("conv_id").cast("string")), F.lit("-")))
    ordered = named.repartitionByRange("name", F.asc_nulls_first("turn"), "role", "text").sortWithinPartitions(
        "name", F.asc_nulls_first("turn"), "role", "text"
    )
    place = F.monotonically_increasing_id()  # given once, and stored with the rows
    turns = stored(ordered.withColumn("place", place).select("name", "conv_id", "turn", "role", "text", "place"), "turns")
    turns = turns.withColumn("segment", F.expr(f"place div {SEGMENT}"))
    told = turns.select("name", "segment", "place", "turn", "role", F.sha2("text", 256).alias("mark"), F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1)).alias("last"))
    firsts = told.groupBy("name", "role", "mark").agg(F.min("place").alias("earliest"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = told.join(firsts, ["name", "role", "mark"], "left").withColumn("repeated", F.coalesce(F.col("place") > F.col("earliest"), F.lit(False)))
    counted = "name string, segment long, codes binary, blank long, duplicate long, truncated long, illegal long, head string, foot string"
    codes = stored(again.drop("mark", "earliest").groupBy("name", "segment").applyInPandas(_codes, f"{counted}, between array<long>"), "codes")
    ends = codes.groupBy("name").applyInPandas(_towards, f"{counted}, ends array<long>")
    rest = counted.replace("codes binary, ", "")
    ways = ends.mapInPandas(_searched, f"{rest}, ways array<string>, exits array<long>, costs array<long>")
    chosen = ways.groupBy("name").applyInPandas(
        _chosen, "name string, segment long, blank long, duplicate long, truncated long, illegal long, cost long, edits string, state int, first boolean"
    )
    gaps = turns.groupBy("name", "conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("all_gaps")
    )
    texts = turns.groupBy("name", "segment").agg(F.array_sort(F.collect_list(F.struct("place", "role", "text"))).alias("turns"))

    @F.udf("array<struct<role: string, text: string>>")
    def repaired(edits, state, own):
        return applied(edits, state, [(t["role"], t["text"]) for t in own])

    whole = chosen.join(gaps, "name").join(texts, ["name", "segment"])
    return whole.withColumns({
        "gaps": F.when(F.col("first"), F.col("all_gaps")).otherwise(0), "repaired": repaired("edits", "state", "turns"),
    }).select("conv_id", "segment", *STATS, "edits", "repaired")


def _parted(turns: DataFrame, lost: Column | None, segment: int) -> tuple[DataFrame, DataFrame | None]:
    """Conversations of up to ``segment`` turns, and the longer ones if there are any."""
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        (F.lit(False) if lost is None else lost).alias("lost"),
    )
    many = rows.groupBy("conv_id").agg(F.count_if(~F.col("lost")).alias("turns"), F.count("*").alias("rows")).where(F.col("rows") > segment)
    many = stored(many.select(F.col("conv_id").alias("long_id"), "turns"), "long")
    if many.isEmpty():
        return rows, None
    same = F.col("conv_id").eqNullSafe(F.col("long_id"))
    # a conversation of which nothing is left stays with the short ones, named by its lost rows
    long = rows.join(many.where("turns > 0"), same, "left_semi").where(~F.col("lost"))
    names = rows.join(many.where("turns = 0"), same, "left_semi").select("conv_id").distinct()
    gone = names.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit(" ").alias("role"), F.lit(" ").alias("text"), F.lit(True).alias("lost"))
    return rows.join(many, same, "left_anti").union(gone), long


def repair(turns: DataFrame, lost: Column | None = None, segment: int = SEGMENT) -> DataFrame:
    """Repaired conversations, one row for each, or for each segment of a long one, which ``segment`` orders.

    Columns: ``conv_id``, ``segment``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal`` and ``cost`` (sums
    over the segments are those of the conversation), ``edits``, ``repaired`` (roles and texts). Rows
    for which ``lost`` holds only name their conversation.
    """
    short, long = _parted(turns, lost, segment)
    return _short(short) if long is None else _short(short).union(_long(long))


def _lines(repaired: str = "repaired") -> Column:
    return F.array_join(F.transform(repaired, lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the lines of each conversation, whose segments come in order."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    for ident, own in groupby(rows, key=lambda r: r[0]):
        state, some = hashlib.sha256(), False
        for _, size, lines in own:
            if size:
                state.update((b"\n" if some else b"") + lines.encode())
                some = True
        yield pa.RecordBatch.from_pydict({"conv_id": pa.array([ident], pa.int64()), "repaired_sha256": [state.hexdigest()]})


def report(turns: DataFrame, lost: Column | None = None, segment: int = SEGMENT) -> DataFrame:
    """Per conversation: the counts of ``repair``, ``audit`` (all edits) and ``repaired_sha256``."""
    short, long = _parted(turns, lost, segment)
    whole = _short(short).select("conv_id", *STATS, F.col("edits").alias("audit"), F.sha2(_lines(), 256).alias("repaired_sha256"))
    if long is None:
        return whole
    parts = stored(_long(long), "repaired")
    edits = F.array_sort(F.collect_list(F.struct("segment", "edits")))["edits"]
    sums = parts.groupBy("conv_id").agg(*(F.sum(c).alias(c) for c in STATS), F.array_join(edits, "").alias("audit"))
    streamed = parts.select("conv_id", "segment", F.size("repaired").alias("size"), _lines().alias("lines")).repartition("conv_id")
    hashes = streamed.sortWithinPartitions("conv_id", "segment").drop("segment").mapInArrow(_hashed, "conv_id long, repaired_sha256 string")
    hashes = hashes.withColumnRenamed("conv_id", "hashed_id")
    joined = sums.join(hashes, F.col("conv_id").eqNullSafe(F.col("hashed_id")))
    return whole.union(joined.select("conv_id", *STATS, "audit", "repaired_sha256"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with known faults by a hash of their id and turn; ``lost`` marks those that are gone."""
    part = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat(part["conv_id"], F.lit(":"), part["turn"]).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", part["role"].alias("role"), part["text"].alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") == 0).alias("lost"), copies.alias("copy")).drop("copy")

"""Repair of conversations at least cost: a bidirectional Dijkstra search over the edit lattice.

A node of the lattice is (rows read, state): what may come next after ``EMPTY``, a system turn, a user turn, an assistant
turn. Edits are its edges: Keep (0) and Rerole to user or assistant (2) take a row, Delete (3) drops it, Insert (2) adds an
empty user or assistant turn; a row of fault ``truncated`` that is not deleted costs 1 more, ``blank`` and ``duplicate``
rows must go. The result's role initials match ``(s?(ua)+)?``. A forward and a reverse heap meet; the search ends only when
no crossing of equal cost is left, and of these the ASCII-least audit (edit initials in order) wins. The audit fixes the roles.

Per node each side keeps its cheapest and then ASCII-least way. That suffices: of two ways of equal cost to the same node,
none is a beginning of the other, since the rest would be inserts, which cost.

Rows of a conversation go by turn (null first), then role, beginning and digest of the text before damage. A conversation longer than ``SEGMENT``
rows is cut: each segment is searched between all pairs of states in a task of its own, and the same search runs
over the lattice whose edges are the segments' best ways. One task then holds a conversation's ways (at most
``len(STATES)`` squared characters a row, no texts), and its digest passes its texts one after the other.

Nulls (ids inside the damage key, roles, texts) are one space; a null id is a conversation of its own, null turns leave no
gaps. Empty roles have no initial and match nothing. Repeated rows are rows of their own. Very long texts are one row's.
A table without rows gives no rows; a conversation that damage leaves without rows gives zeros. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from heapq import heappop, heappush
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloom.llm.common import placed, whole_groups, written

SEGMENT = 1024

# Costs and initials of the edits, faults, role initials that may stand side by side.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
BLANK, DUPLICATE, CUT = "blank", "duplicate", "truncated"
LEGAL = ("su", "ua", "au")

# States: nothing yet, after a system turn, after a user turn, after an assistant turn.
EMPTY, SYSTEM, USER, ASSISTANT = STATES = range(4)
NEXT = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
DONE = (EMPTY, ASSISTANT)
ROLE = {"u": "user", "a": "assistant"}
TURN = {state: (initial, after) for (state, initial), after in NEXT.items() if initial in "ua"}


@dataclass(slots=True)
class Way:
    """A way from the start to a node, or from a node to an end: its last (or first) edit and the way before (after) it."""

    cost: int
    step: str
    rest: Way | None
    length: int


def split(way: Way, other: Way) -> tuple[list[str], list[str]]:
    """The steps of two ways outside their common rest, nearest the node first."""
    mine, others = [], []
    while way is not other:
        if way.length >= other.length:
            mine.append(way.step)
            way = way.rest
        else:
            others.append(other.step)
            other = other.rest
    return mine, others


def less(way: Way, other: Way, forward: bool) -> bool:
    mine, others = split(way, other)
    if forward:
        mine, others = mine[::-1], others[::-1]
    return "".join(mine) < "".join(others)


def steps(way: Way) -> list[str]:
    out = []
    while way.rest is not None:
        out.append(way.step)
        way = way.rest
    return out


Edges = Callable[[int, int], list[tuple[int, int, int, str]]]


def search(n: int, starts, ends, after: Edges, before: Edges) -> tuple[int, list[str]] | None:
    """The cost and the edits of the cheapest, then least, audit from a node (0, start) to a node (n, end), or None.

    ``after(i, state)`` lists (i, state, cost, edit) of the edges out of a node, ``before`` those into it. Edges of no
    cost go from a row to a later one, so nodes of equal cost are settled in row order.
    """
    nothing = Way(0, "", None, 0)
    front, back = {(0, s): nothing for s in starts}, {(n, s): nothing for s in ends}
    heaps = [(0, 0, s) for s in starts], [(0, -n, s) for s in ends]
    settled: tuple[set, set] = (set(), set())
    best = 0 if front.keys() & back.keys() else None
    while heaps[0] and heaps[1] and (best is None or heaps[0][0][0] + heaps[1][0][0] <= best):
        side = int((heaps[1][0][0], len(settled[1])) < (heaps[0][0][0], len(settled[0])))
        ways, others, edges = (back, front, before) if side else (front, back, after)
        _, i, s = heappop(heaps[side])
        node = (abs(i), s)
        if node in settled[side]:
            continue
        settled[side].add(node)
        way = ways[node]
        for j, t, price, step in edges(*node):
            cost, known = way.cost + price, ways.get((j, t))
            found = Way(cost, step, way, way.length + 1)
            if known is None or cost < known.cost:
                heappush(heaps[side], (cost, -j if side else j, t))
            elif cost > known.cost or not less(found, known, forward=not side):
                continue
            ways[j, t] = found
            if (j, t) in others and (best is None or cost + others[j, t].cost < best):
                best = cost + others[j, t].cost
    if best is None:
        return None
    crossings = [x for x in front.keys() & back.keys() if front[x].cost + back[x].cost == best and not passed_on(front, back, x)]
    return best, min((steps(front[x])[::-1] + steps(back[x]) for x in crossings), key="".join)


def passed_on(front: dict, back: dict, node: tuple[int, int]) -> bool:
    """Whether the next node on the way back from ``node`` was reached from ``node`` itself: a crossing of the same audit."""
    way = back[node]
    for nxt in ((node[0] + d, s) for d in (0, 1) for s in STATES):
        if way.rest is not None and back.get(nxt) is way.rest and nxt in front:
            return front[nxt].rest is front[node] and front[nxt].step == way.step
    return False


def lattice(initials: list[str], faults: list[str | None]) -> tuple[Edges, Edges]:
    """Edges of a run of rows."""
    n = len(initials)

    def row(i: int, state: int, into: bool) -> Iterator[tuple[int, int, str]]:
        """(other state, cost, edit) of the edits of row ``i`` from or into a state."""
        yield state, DELETE, "D"
        if faults[i] in (BLANK, DUPLICATE):
            return
        more = TRUNCATED if faults[i] == CUT else 0
        for s in STATES:
            a, b = (s, state) if into else (state, s)
            if NEXT.get((a, initials[i])) == b:
                yield s, KEEP + more, "K"
            if a in TURN and TURN[a][1] == b:
                yield s, REROLE + more, "R"

    def after(i: int, state: int) -> list[tuple[int, int, int, str]]:
        out = [(i, TURN[state][1], INSERT, "I")]
        return out + [(i + 1, s, c, e) for s, c, e in row(i, state, False)] if i < n else out

    def before(i: int, state: int) -> list[tuple[int, int, int, str]]:
        out = [(i, s, INSERT, "I") for s in STATES if TURN[s][1] == state]
        return out + [(i - 1, s, c, e) for s, c, e in row(i - 1, state, True)] if i else out

    return after, before


def ways_through(initials: list[str], faults: list[str | None]) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, audit) of the best way between any two states."""
    edges = lattice(initials, faults)
    found = ((a, b, search(len(initials), (a,), (b,), *edges)) for a in STATES for b in STATES)
    return [(a, b, x[0], "".join(x[1])) for a, b, x in found if x is not None]


def best_way(initials: list[str], faults: list[str | None]) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    cost, audit = search(len(initials), (EMPTY,), DONE, *lattice(initials, faults))
    return cost, "".join(audit)


def joined(segments: list[list[tuple[int, int, int, str]]]) -> tuple[int, list[str]]:
    """The cost and the audit, a piece per segment, of the best way through all segments."""

    def after(i: int, state: int) -> list[tuple[int, int, int, str]]:
        return [(i + 1, b, c, e) for a, b, c, e in segments[i] if a == state] if i < len(segments) else []

    def before(i: int, state: int) -> list[tuple[int, int, int, str]]:
        return [(i - 1, a, c, e) for a, b, c, e in segments[i - 1] if b == state] if i else []

    return search(len(segments), (EMPTY,), DONE, after, before)


# Rows ------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with ``kind`` of damage and, unless it drops them, what it makes of them; ``start`` and ``digest`` keep their order."""

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", filled("role").alias("was"), filled("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        "was",
        F.substring("text", 1, 64).alias("start"),
        F.sha2(F.col("text").cast("binary"), 256).alias("digest"),
        F.when(F.col("kind") == 4, "user").otherwise(F.col("was")).alias("role"),
        text.alias("text"),
        F.explode(copies).alias("copy"),
        "kind",
    )


def faults_of(rows: DataFrame) -> DataFrame:
    """(run, pos, conv_id, turn, role's initial, fault) of placed rows."""
    said = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)
    # Where each (role, text) is first: one row per different turn, combined before the shuffle, joined on its unique place.
    firsts = rows.select("run", "pos", said.alias("said")).groupBy("run", "said").agg(F.min("pos").alias("pos"))
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    narrow = rows.select("run", "pos", "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), last.alias("last"))
    narrow = narrow.join(firsts.select("run", "pos", F.lit(True).alias("first")), ["run", "pos"], "left")
    fault = F.when(F.col("last") == "", BLANK).when(F.col("first").isNull(), DUPLICATE).when(~F.col("last").isin(".", "!", "?"), CUT)
    return narrow.select("run", "pos", "conv_id", "turn", "initial", fault.alias("fault"))


KEY = ["run", "segment"]


def arrow(ddl: dict[str, pa.DataType]) -> tuple[pa.Schema, str]:
    return pa.schema(list(ddl.items())), ", ".join(f"{k} {'long' if t == pa.int64() else 'string'}" for k, t in ddl.items())


LONG, TEXT = pa.int64(), pa.string()
COUNTS = (BLANK, DUPLICATE, CUT, "illegal")
# Per segment; ``ends`` are the initials of its first and last row, ``ways`` lists as JSON what ``ways_through`` gives.
SEGMENTS, SEGMENTS_DDL = arrow(
    dict.fromkeys((*KEY, "conv_id", *COUNTS, "first_turn", "last_turn", "turns"), LONG) | {"ends": TEXT, "ways": TEXT}
)
PIECES, PIECES_DDL = arrow(dict.fromkeys((*KEY, "conv_id", "gaps", *COUNTS, "cost"), LONG) | {"audit": TEXT})
RESULT, RESULT_DDL = arrow(dict.fromkeys(("conv_id", "gaps", *COUNTS, "cost"), LONG) | {"audit": TEXT, "repaired_sha256": TEXT})


def segment_of(name: str = "pos") -> Column:
    return F.floor(F.col(name) / SEGMENT).cast("long").alias("segment")


def searched(rows: DataFrame) -> DataFrame:
    """One row per segment: its counts and its best ways; of a conversation that is one segment, the way it needs."""

    def found(run: int, segment: int, rows: list[dict]) -> dict:
        initials, faults = [r["initial"] for r in rows], [r["fault"] for r in rows]
        whole = segment == 0 and len(rows) < SEGMENT
        ways = [(EMPTY, EMPTY, *best_way(initials, faults))] if whole else ways_through(initials, faults)
        turns = [r["turn"] for r in rows if r["turn"] is not None]
        illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
        return {
            **{"run": run, "segment": segment, "conv_id": rows[0]["conv_id"]},
            **{f: faults.count(f) for f in (BLANK, DUPLICATE, CUT)},
            **{"illegal": illegal, "first_turn": min(turns, default=None), "last_turn": max(turns, default=None), "turns": len(set(turns))},
            **{"ends": json.dumps([initials[0], initials[-1]]), "ways": json.dumps(ways)},
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, KEY, SEGMENT):
            groups = groupby(table.to_pylist(), itemgetter(*KEY))
            yield pa.RecordBatch.from_pylist([found(*key, list(rows)) for key, rows in groups], SEGMENTS)

    keyed = rows.select("run", segment_of(), "pos", "conv_id", "turn", "initial", "fault")
    return keyed.repartition(*KEY).sortWithinPartitions(*KEY, "pos").mapInArrow(run, SEGMENTS_DDL)


def answered(segments: DataFrame) -> DataFrame:
    """Per segment its piece of its conversation's audit, with the conversation's counts and cost."""

    def conversation(own: list[dict]) -> list[dict]:
        cost, pieces = joined([json.loads(s["ways"]) for s in own])
        timed, ends = [s for s in own if s["turns"]], [json.loads(s["ends"]) for s in own]
        sums = {c: sum(s[c] for s in own) for c in COUNTS}
        sums["illegal"] += sum(a[1] + b[0] not in LEGAL for a, b in zip(ends, ends[1:], strict=False))
        distinct = sum(s["turns"] for s in own) - sum(a["last_turn"] == b["first_turn"] for a, b in zip(timed, timed[1:], strict=False))
        gaps = timed[-1]["last_turn"] - timed[0]["first_turn"] + 1 - distinct if timed else 0
        return [{c: s[c] for c in (*KEY, "conv_id")} | sums | {"gaps": gaps, "cost": cost, "audit": p} for s, p in zip(own, pieces, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["run"], 256):
            groups = groupby(table.to_pylist(), itemgetter("run"))
            yield pa.RecordBatch.from_pylist([row for _, own in groups for row in conversation(list(own))], PIECES)

    return segments.repartition("run").sortWithinPartitions(*KEY).mapInArrow(run, PIECES_DDL)


class Repaired:
    """The digest of a conversation's repaired rows, fed its audit piece by piece and its rows one by one."""

    def __init__(self):
        self.state, self.digest, self.audit, self.edits, self.first = EMPTY, hashlib.sha256(), [], iter(()), True

    def piece(self, audit: str) -> None:
        self.inserts()
        self.audit.append(audit)
        self.edits = iter(audit)

    def say(self, role: str, text: str) -> None:
        self.digest.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
        self.first = False

    def turn(self, text: str) -> None:
        initial, self.state = TURN[self.state]
        self.say(ROLE[initial], text)

    def inserts(self) -> str | None:
        """Carry out inserts up to the next edit of a row, which is returned."""
        for edit in self.edits:
            if edit != "I":
                return edit
            self.turn("")
        return None

    def row(self, role: str, text: str) -> None:
        edit = self.inserts()
        if edit == "R":
            self.turn(text)
        elif edit == "K":
            self.state = NEXT[self.state, role[:1]]
            self.say(role, text)


def digested(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """One row per conversation; its rows pass one task in order, a batch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, now, done = None, None, []

        def close() -> None:
            if now is not None:
                now.inserts()
                audit = {"audit": "".join(now.audit), "repaired_sha256": now.digest.hexdigest()}
                done.append({c: head[c] for c in ("conv_id", "gaps", *COUNTS, "cost")} | audit)

        for batch in batches:
            for row in (r for at in range(0, len(batch), 64) for r in batch.slice(at, 64).to_pylist()):
                if row["pos"] >= 0:
                    now.row(row["role"], row["text"])
                    continue
                if head is None or head["run"] != row["run"]:
                    close()
                    head, now = row, Repaired()
                now.piece(row["audit"])
            yield pa.RecordBatch.from_pylist(done, RESULT)
            done.clear()
        close()
        yield pa.RecordBatch.from_pylist(done, RESULT)

    heads = pieces.withColumn("pos", F.lit(-1).cast("long"))
    both = heads.unionByName(rows.select("run", segment_of(), "pos", "role", "text"), allowMissingColumns=True)
    return both.repartition("run").sortWithinPartitions(*KEY, "pos").mapInArrow(run, RESULT_DDL)


def repair(conversations: DataFrame) -> DataFrame:
    """Damage and repair of every conversation."""
    rows = damaged(conversations)
    order = [F.col(c) for c in ("turn", "was", "start", "digest", "copy")]
    left = placed(rows.filter("kind <> 0"), ["conv_id"], order, "turns").select("run", "pos", "conv_id", "turn", "role", "text")
    pieces = written(answered(searched(faults_of(left))), "audits")
    lost = rows.groupBy("conv_id").agg(F.max("kind").alias("kind")).filter("kind = 0").select("conv_id")
    nothing = {c: F.lit(0).cast("long") for c in ("gaps", *COUNTS, "cost")} | {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)}
    return digested(left, pieces).unionByName(lost.withColumns(nothing))

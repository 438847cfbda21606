"""Cheapest repair of conversations by bidirectional search over the edit lattice.

A node of the lattice is a place between two rows and what the repaired conversation ends with so far. Edges keep,
rerole or delete the next row, or insert an empty one. One heap searches from the start, one
from the end; they stop when no unmet path can be as cheap as the best crossing. All crossings of that cost
are then compared, and the least audit is taken: the edits' initials in order.

Two audits of one cost are told apart at their first different letter, so of the audits that reach a node
only the least is kept, with those that continue it: which of them is best depends on what follows.

A conversation may be of any length. It is cut into segments of ``SEGMENT`` rows; a segment is summed up by its best
audits from each state to each state, and summaries are joined in a tree, many at a time, until one is left.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import positions
from ..session import cut_lineage

#: Rows that one search covers, and summaries that one task joins at a time.
SEGMENT = 256
JOINED = 64

KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
TRUNCATED = 5

#: What the repaired rows end with: nothing, system, user, assistant. Only the first and the last may end it.
START, SYSTEM, USER, ASSISTANT = range(4)
_ENDS = (START, ASSISTANT)
#: The state that a new row of the fitting role leads to.
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_INSERTS = [(p, q, INSERT, "I") for p, q in _NEXT.items()]

Audits = tuple[int, list[str]]


def _edges(code: str) -> list[tuple[int, int, int, str]]:
    """Edges past a row of ``code``: its role's initial and ``k`` (sound), ``t`` (truncated) or ``d`` (must go)."""
    edges = [(p, p, DELETE, "D") for p in _NEXT]
    if code[1] != "d":
        more = TRUNCATED if code[1] == "t" else 0
        edges += [(p, q, KEEP + more, "K") for p, q in _KEPT.get(code[0], {}).items()]
        edges += [(p, q, REROLE + more, "R") for p, q in _NEXT.items()]
    return edges


_EDGES = {a + b: _edges(a + b) for a in "suax" for b in "ktd"}


def _least(audits: list[str]) -> list[str]:
    """The least audit, and those that continue it and one another."""
    kept: list[str] = []
    for audit in sorted(set(audits)):
        if not kept or audit.startswith(kept[-1]):
            kept.append(audit)
    return kept


class _Front:
    """One of the two searches: nodes are settled by cost, and among equal costs in the order of the rows."""

    def __init__(self, codes: list[str], roots: list[int], forward: bool):
        self.codes, self.forward = codes, forward
        self.settled: dict[tuple[int, int], Audits] = {}
        self.found: dict[tuple[int, int], Audits] = {}
        self.heap: list[tuple[int, int, int]] = []
        for state in roots:
            self.reach(0 if forward else len(codes), state, 0, [""])
        for _ in roots:
            self.settle()

    def reach(self, at: int, state: int, cost: int, audits: list[str]) -> None:
        known = self.found.get((at, state))
        if known and known[0] < cost:
            return
        if known and known[0] == cost:
            audits = known[1] + audits
        self.found[at, state] = (cost, audits)
        if not known or known[0] > cost:
            heapq.heappush(self.heap, (cost, at if self.forward else -at, state))

    def top(self) -> float:
        while self.heap:
            cost, at, state = self.heap[0]
            if (abs(at), state) not in self.settled:
                return cost
            heapq.heappop(self.heap)
        return float("inf")

    def edges(self, at: int, state: int) -> Iterator[tuple[int, int, int, str]]:
        """``(place, state, cost, initial)`` of what lies one edit ahead of a node, seen from this search's root."""
        near, far = (0, 1) if self.forward else (1, 0)
        for edge in _INSERTS:
            if edge[near] == state:
                yield at, edge[far], edge[2], edge[3]
        row, on = (at, at + 1) if self.forward else (at - 1, at - 1)
        if 0 <= row < len(self.codes):
            for edge in _EDGES[self.codes[row]]:
                if edge[near] == state:
                    yield on, edge[far], edge[2], edge[3]

    def settle(self) -> list[tuple[int, int]]:
        """Take the cheapest node, and return what it reaches."""
        cost, at, state = heapq.heappop(self.heap)
        node = (abs(at), state)
        audits = _least(self.found[node][1])
        self.settled[node] = (cost, audits)
        reached = []
        for to, next_state, more, initial in self.edges(*node):
            if (to, next_state) not in self.settled:
                longer = [a + initial if self.forward else initial + a for a in audits]
                self.reach(to, next_state, cost + more, longer)
                reached.append((to, next_state))
        return reached


def search(codes: list[str], entry: int, exits: tuple[int, ...]) -> Audits | None:
    """Least cost from ``entry`` before all rows to one of ``exits`` after them, with the audits worth keeping."""
    ahead, back = _Front(codes, [entry], True), _Front(codes, list(exits), False)
    best = min((cost + back.found[node][0] for node, (cost, _) in ahead.found.items() if node in back.found), default=float("inf"))
    while ahead.top() + back.top() <= best and (ahead.heap or back.heap):
        front, other = (ahead, back) if ahead.top() <= back.top() else (back, ahead)
        for node in front.settle():
            if node in other.found:
                best = min(best, front.found[node][0] + other.found[node][0])
    if best == float("inf"):
        return None
    audits = []
    for node, (cost, heads) in ahead.settled.items():
        if node in back.settled and cost + back.settled[node][0] == best:
            audits += [h + t for h in heads for t in back.settled[node][1]]
        for to, state, more, initial in ahead.edges(*node):
            rest = back.settled.get((to, state))
            if rest and cost + more + rest[0] == best:
                audits += [h + initial + t for h in heads for t in rest[1]]
    return int(best), _least(audits)


def _codes(text: str) -> list[str]:
    return [text[i : i + 2] for i in range(0, len(text), 2)]


@lru_cache(maxsize=1 << 14)
def cheapest(codes: str) -> tuple[int, str]:
    """Cost and audit of a whole conversation given by the codes of its rows."""
    found = search(_codes(codes), START, _ENDS)
    assert found is not None  # every row may be deleted
    return found[0], found[1][0]


#: Best audits by state before and state after.
Summary = dict[tuple[int, int], Audits]


def summary(codes: str) -> Summary:
    found = {(p, q): search(_codes(codes), p, (q,)) for p in _NEXT for q in _NEXT}
    return {pair: audits for pair, audits in found.items() if audits}


def join(first: Summary, second: Summary) -> Summary:
    out: Summary = {}
    for (p, middle), (cost, heads) in first.items():
        for (start, q), (more, tails) in second.items():
            if start != middle:
                continue
            known = out.get((p, q))
            if known and known[0] < cost + more:
                continue
            audits = [h + t for h in heads for t in tails]
            if known and known[0] == cost + more:
                audits += known[1]
            out[p, q] = (cost + more, _least(audits))
    return out


def _close(whole: Summary) -> tuple[int, str]:
    ends = [whole[START, q] for q in _ENDS if (START, q) in whole]
    cost = min(c for c, _ in ends)
    return cost, min(a for c, audits in ends if c == cost for a in audits)


_SUMMARY = "array<struct<before:int,after:int,cost:bigint,audits:array<string>>>"


def _pack(s: Summary) -> list[dict]:
    return [{"before": p, "after": q, "cost": cost, "audits": audits} for (p, q), (cost, audits) in s.items()]


def _unpack(rows) -> Summary:
    return {(r["before"], r["after"]): (r["cost"], list(r["audits"])) for r in rows}


def _whole(segments: DataFrame) -> DataFrame:
    """``conv, cost, audit`` of conversations of one segment, straight from their codes."""

    @F.pandas_udf("struct<cost:bigint,audit:string>")
    def of(codes: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([cheapest(c) for c in codes], columns=["cost", "audit"])

    return segments.select("conv", of("codes").alias("r")).select("conv", "r.*")


def _joined(segments: DataFrame) -> DataFrame:
    """``conv, cost, audit`` of longer conversations, by joining summaries level by level."""

    @F.pandas_udf(_SUMMARY)
    def summed(codes: pd.Series) -> pd.Series:
        return codes.map(lambda c: _pack(summary(c)))

    def merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for parts in frame["parts"]:
                whole = _unpack(parts[0]["s"])
                for part in parts[1:]:
                    whole = join(whole, _unpack(part["s"]))
                out.append(_pack(whole))
            yield frame.drop(columns="parts").assign(s=out)

    def close(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            done = [_close(_unpack(s)) for s in frame["s"]]
            yield pd.DataFrame({"conv": frame["conv"], "cost": [c for c, _ in done], "audit": [a for _, a in done]})

    level = cut_lineage(segments.select("conv", "seg", summed("codes").alias("s")))
    most = level.agg(F.max("seg")).first()[0] or 0
    while most > 0:
        part = F.struct("seg", "s")
        groups = level.groupBy("conv", F.floor(F.col("seg") / JOINED).alias("to")).agg(F.sort_array(F.collect_list(part)).alias("parts"))
        merged = groups.withColumnRenamed("to", "seg").mapInPandas(merge, f"conv string, seg bigint, s {_SUMMARY}")
        level, most = cut_lineage(merged), most // JOINED
    return level.select("conv", "s").mapInPandas(close, "conv string, cost bigint, audit string")


def faults(turns: DataFrame) -> DataFrame:
    """Each row's place ``pos`` in its conversation and its first ``fault``: blank, duplicate, truncated or none.

    ``turns`` holds ``conv`` (not null), ``turn``, ``role`` and ``text`` (not null). Rows stand by turn, nulls first; those of
    one turn by role and digest of the text.
    """
    said = turns.withColumn("said", F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    placed = cut_lineage(positions(said, ["conv"], ["turn", "role", "said"], "pos"))
    # Only what is said twice is joined; a hot key among it is split as skewed.
    twice = placed.groupBy("conv", "said").agg(F.min("pos").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = (
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit("blank"))
        .when(F.col("pos") > F.col("first"), F.lit("duplicate"))
        .when(~last.isin(".", "!", "?"), F.lit("truncated"))
    )
    return placed.join(twice, ["conv", "said"], "left").withColumn("fault", fault).drop("said", "first")


def _segments(rows: DataFrame) -> DataFrame:
    """``conv, seg, codes, illegal``: the rows of a segment as codes, and their pairs of neighbours that may not meet."""
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    state = F.when(F.col("fault").isin("blank", "duplicate"), "d").when(F.col("fault") == "truncated", "t").otherwise("k")
    at = F.col("pos") - 1
    own = F.floor(at / SEGMENT)
    # The first row of a segment also stands behind the last one of the segment before.
    seen = F.when((at > 0) & (at % SEGMENT == 0), F.array(own, own - 1)).otherwise(F.array(own))
    narrow = rows.select("conv", "pos", F.concat(known, state).alias("code"), own.alias("own"), F.explode(seen).alias("seg"))
    there = F.sort_array(F.collect_list(F.struct("pos", "code", (F.col("own") == F.col("seg")).alias("own"))))
    grouped = narrow.groupBy("conv", "seg").agg(there.alias("rows"))
    pair = F.transform(
        F.slice("rows", F.lit(2), F.greatest(F.size("rows") - 1, F.lit(0))),
        lambda r, i: F.concat(F.substring(F.get("rows", i)["code"], 1, 1), F.substring(r["code"], 1, 1)),
    )
    codes = F.array_join(F.transform(F.filter("rows", lambda r: r["own"]), lambda r: r["code"]), "")
    illegal = F.size(F.filter(pair, lambda p: ~p.isin("su", "ua", "au"))).cast("bigint")
    return grouped.select("conv", "seg", codes.alias("codes"), illegal.alias("illegal"))


def _lines(audit: str) -> Iterator[tuple[int, int | None, str | None]]:
    """Number, place of the row it comes from and new role of each repaired row. Roles alternate after a system row, if there is one."""
    odd = (len(audit) - audit.count("D")) % 2  # one system row, then pairs
    line = pos = 0
    for edit in audit:
        pos += edit != "I"
        if edit != "D":
            role = ("user", "assistant")[(line - odd) % 2] if edit in "RI" else None
            yield line, None if edit == "I" else pos, role
            line += 1


def _steps(audits: DataFrame) -> DataFrame:
    """One row per repaired row: ``conv, line``, the ``pos`` it comes from and its ``given`` role, null if kept."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("conv", "line", "pos", "given")
        types = (pa.string(), pa.int64(), pa.int64(), pa.string())
        for batch in batches:
            lines = ((conv, *step) for conv, audit in zip(*map(pa.Array.to_pylist, batch.columns), strict=True) for step in _lines(audit))
            while some := list(islice(lines, 16384)):
                columns = zip(*some, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return audits.select("conv", "audit").mapInArrow(walk, "conv string, line bigint, pos bigint, given string")


@dataclass
class Repaired:
    """``summary``: one row per conversation; ``lines``: its repaired rows ``conv, line, role, text``."""

    summary: DataFrame
    lines: DataFrame


def repair(turns: DataFrame) -> Repaired:
    """The cheapest repair of every conversation of ``turns`` (``conv, turn, role, text``; only ``turn`` may be null).

    ``summary`` holds ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit``. Empty tables give empty
    tables. Equal rows of one turn stand next to each other, and all but the first are duplicates. No texts are gathered:
    a conversation's rows meet as codes of two letters, a segment at a time.
    """
    rows = cut_lineage(faults(turns.select("conv", "turn", "role", "text")))
    segments = cut_lineage(_segments(rows))
    longer = segments.where("seg > 0").select("conv").distinct()
    audits = _whole(segments.join(longer, "conv", "left_anti")).unionByName(_joined(segments.join(longer, "conv", "left_semi")))
    audits = cut_lineage(audits)
    counts = rows.groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")).cast("bigint").alias("gaps"),
        *[F.count_if(F.col("fault") == name).alias(name) for name in ("blank", "duplicate", "truncated")],
    )
    illegal = segments.groupBy("conv").agg(F.sum("illegal").alias("illegal"))
    summary = counts.na.fill(0, ["gaps"]).join(illegal, "conv").join(audits, "conv")
    source = rows.select("conv", "pos", F.col("role").alias("own"), "text")
    lines = _steps(audits).join(source, ["conv", "pos"], "left").select(
        "conv", "line", F.coalesce("given", "own").alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return Repaired(summary, lines)


def line_digests(lines: DataFrame) -> DataFrame:
    """``conv`` and the SHA-256 of its ``role:text`` lines, joined by newlines.

    A digest is sequential, so one task reads a conversation's rows in order; it holds a batch of them at a time.
    """

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, digest = None, sha256()
        for frame in frames:
            done = []
            for owner, said in zip(frame["conv"], frame["said"], strict=True):
                if owner == conv:
                    digest.update(b"\n")
                else:
                    if conv is not None:
                        done.append((conv, digest.hexdigest()))
                    conv, digest = owner, sha256()
                digest.update(said.encode())
            yield pd.DataFrame(done, columns=["conv", "digest"])
        if conv is not None:
            yield pd.DataFrame([(conv, digest.hexdigest())], columns=["conv", "digest"])

    said = lines.select("conv", "line", F.concat("role", F.lit(":"), "text").alias("said"))
    ordered = said.repartition("conv").sortWithinPartitions("conv", "line")
    return ordered.select("conv", "said").mapInPandas(hashed, "conv string, digest string")


def damaged(conversations: DataFrame, conv: Column, key: Column) -> DataFrame:
    """Rows ``conv, turn, role, text`` with the damage that ``crc32(key) % 20`` names; a null role or text is one space.

    0 drops the row, 1 empties its text, 2 removes full stops, exclamation and question marks, 3 repeats the row, 4 makes the
    role user.
    """
    kind = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    hurt = conversations.select(
        conv.alias("conv"),
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 3, F.lit(2)).when(kind == 0, F.lit(0)).otherwise(F.lit(1)).alias("copies"),
    )
    return hurt.withColumn("copies", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).drop("copies")

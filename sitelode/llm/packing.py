"""Best-fit packing of token sequences by exact complements.

Documents are cut into pieces of at most ``capacity`` tokens. Only the number of pieces of
each length matters for a plan, and there are ``capacity`` lengths at most, whatever the
number of documents. The plan consumes lengths that fill a gap exactly: single, pair
and triple sums are indexed by sum, and each combination that has a gap's sum is taken
as often as the counts allow. What has no exact complement is packed best-fit,
longest first. The plan is a short list of runs, "pieces ``from``..``to`` of this length go
to sequences ``s, s + 1, ...`` at this offset", and the pieces find their run by their
rank within their length.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import positions
from ..session import cut_lineage
from .tokens import Encoder

PIECE = "struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>"


def pieces(text: Column, tokenizer: str, end_id: int = 1, capacity: int = 4096, with_ids: bool = False) -> Column:
    """An array of pieces for each text: its token ids, then ``end_id``, cut only where longer than ``capacity``.

    A null text is empty and gives one piece that holds ``end_id`` alone. ``with_ids`` adds the ids.
    """
    import zlib

    kind = PIECE[:-1] + (",ids:array<int>>" if with_ids else ">")

    @F.arrow_udf(f"array<{kind}>")
    def of(texts: pa.Array) -> pa.Array:
        encoder = Encoder.shared(tokenizer)
        counts, starts, lengths, numbers, sums, kept = [], [], [], [], [], []
        for ids, bounds in encoder.batches(texts):
            for a, b in zip(bounds, bounds[1:]):
                own = np.append(ids[a:b], np.uint32(end_id)).astype("<u4")
                cuts = range(0, len(own), capacity)
                counts.append(len(cuts))
                for i, at in enumerate(cuts):
                    part = own[at : at + capacity]
                    numbers.append(i)
                    starts.append(at)
                    lengths.append(len(part))
                    sums.append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        kept.append(part.astype(np.int32))
        fields = {
            "piece": pa.array(numbers, pa.int32()), "start": pa.array(starts, pa.int64()),
            "length": pa.array(lengths, pa.int64()), "ids_crc32": pa.array(sums, pa.int64()),
        }
        if with_ids:
            flat = pa.array(np.concatenate(kept) if kept else np.zeros(0, np.int32))
            fields["ids"] = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32()), flat)
        rows = pa.StructArray.from_arrays(list(fields.values()), list(fields))
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), rows)

    return of(text)


@dataclass(frozen=True)
class Run:
    """Pieces ``first .. first + count - 1`` of a length go to consecutive sequences at one offset."""

    length: int
    first: int
    count: int
    sequence: int
    offset: int


class _Sums:
    """Sums of two and three of the given lengths, indexed by sum up to ``capacity``; a single length is its own index.

    ``pairs(s)`` holds the longer members of all pairs with sum ``s``, ``triples(s)`` the longest members of all triples,
    which the pairs of the rest complete. Both are longest first, and are tables of (sum, member) sorted by sum: at
    most a quarter and a third of ``capacity`` squared entries. ``alive`` counts the pairs of a sum that are still available.
    """

    def __init__(self, lengths: list[int], capacity: int) -> None:
        self.capacity = capacity
        known = np.array(sorted(lengths, reverse=True), np.int32)
        self._pair_at, self._pair = self._table([(known[i:], n) for i, n in enumerate(known.tolist())])
        self.alive = np.diff(self._pair_at)
        # The shortest longer member of the pairs of a sum tells whether a third length can be the longest.
        shortest = np.full(capacity + 1, capacity + 1, np.int32)
        full = np.flatnonzero(np.diff(self._pair_at))
        shortest[full] = self._pair[self._pair_at[full + 1] - 1]
        sums = np.arange(capacity + 1, dtype=np.int32)
        self._triple_at, self._triple = self._table([(sums[shortest <= n], n) for n in known.tolist()])

    def _table(self, parts: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Members by the sum of what stands beside them and themselves."""
        sums, members = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
        for others, n in parts:
            fits = others[others + n <= self.capacity] + n
            sums.append(fits)
            members.append(np.full(len(fits), n, np.int32))
        every = np.concatenate(sums)
        order = np.argsort(every, kind="stable")
        return np.searchsorted(every[order], np.arange(self.capacity + 2)), np.concatenate(members)[order]

    def use_up(self, length: int, available: np.ndarray) -> None:
        """Take the pairs of a length out of ``alive``, before it leaves ``available``."""
        self.alive[length:][available[: self.capacity + 1 - length]] -= 1

    def pairs(self, total: int) -> np.ndarray:
        return self._pair[self._pair_at[total] : self._pair_at[total + 1]]

    def triples(self, total: int) -> np.ndarray:
        return self._triple[self._triple_at[total] : self._triple_at[total + 1]]


class _Plan:
    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.capacity = capacity
        self.left = {n: c for n, c in counts.items() if c > 0}
        self.available = np.zeros(capacity + 1, bool)
        self.available[list(self.left)] = True
        self.sums = _Sums(list(self.left), capacity)
        self.used: dict[int, int] = defaultdict(int)
        self.runs: list[Run] = []
        self.sequences = 0

    def take(self, length: int, count: int, sequence: int, offset: int) -> None:
        self.runs.append(Run(length, self.used[length], count, sequence, offset))
        self.used[length] += count
        self.left[length] -= count
        if not self.left[length]:
            del self.left[length]
            self.sums.use_up(length, self.available)
            self.available[length] = False

    def times(self, parts: tuple[int, ...]) -> int:
        """How often the counts allow a combination."""
        return min(self.left.get(n, 0) // parts.count(n) for n in set(parts))

    def consume(self, parts: tuple[int, ...]) -> None:
        count = self.times(parts)
        if not count:
            return
        offset = 0
        for n in parts:
            self.take(n, count, self.sequences, offset)
            offset += n
        self.sequences += count

    def exact(self) -> None:
        """Consume combinations that fill a sequence to the end: each length, longest first, with what the index has for its gap.

        What is used up never returns, so every entry of the index is tried once a gap, as often as the counts allow.
        """
        for n in sorted(self.left, reverse=True):
            for parts in self._complements(self.capacity - n, n):
                self.consume((n, *parts))
                if n not in self.left:
                    break

    def _complements(self, gap: int, most: int) -> Iterator[tuple[int, ...]]:
        """Singles, pairs and triples, still available, that fill the gap with lengths of ``most`` at most."""
        if not gap:
            yield ()
            return
        if gap <= most and self.available[gap]:
            yield (gap,)
        yield from self._pairs(gap, most)
        longest = self.sums.triples(gap)
        open_ = (longest <= most) & self.available[longest] & (self.sums.alive[gap - longest] > 0)
        for x in longest[open_].tolist():
            if not self.sums.alive[gap - x]:
                continue
            for two in self._pairs(gap - x, x):
                if not self.available[x]:
                    break
                yield x, *two

    def _pairs(self, gap: int, most: int) -> Iterator[tuple[int, int]]:
        longer = self.sums.pairs(gap)
        for a in longer[(longer <= most) & self.available[longer] & self.available[gap - longer]].tolist():
            if self.available[a] and self.available[gap - a]:
                yield a, gap - a

    def best_fit(self) -> None:
        """The rest, longest first, each into the open sequences with the smallest gap that holds it."""
        gaps: list[int] = []
        open_: dict[int, list[list[int]]] = defaultdict(list)

        def put(gap: int, sequence: int, count: int) -> None:
            if gap:
                if not open_[gap]:
                    insort(gaps, gap)
                open_[gap].append([sequence, count])

        for n in sorted(self.left, reverse=True):
            while n in self.left:
                at = bisect_left(gaps, n)
                if at < len(gaps):
                    gap = gaps[at]
                    group = open_[gap][-1]
                    count = min(group[1], self.left[n])
                    sequence = group[0]
                    group[0] += count
                    group[1] -= count
                    if not group[1]:
                        open_[gap].pop()
                        if not open_[gap]:
                            del gaps[at]
                    self.take(n, count, sequence, self.capacity - gap)
                    put(gap - n, sequence, count)
                else:
                    each = self.capacity // n
                    # As many full stacks of this length as there are, then one that is not full.
                    stacks, rest = divmod(self.left[n], each)
                    high, count = (each, stacks) if stacks else (rest, 1)
                    first = self.sequences
                    self.sequences += count
                    for i in range(high):
                        self.take(n, count, first, i * n)
                    put(self.capacity - high * n, first, count)


def plan(counts: dict[int, int], capacity: int = 4096) -> list[Run]:
    """Runs for pieces counted by length, all lengths between 1 and ``capacity``."""
    made = _Plan(counts, capacity)
    made.exact()
    made.best_fit()
    return made.runs


def pack(rows: DataFrame, capacity: int = 4096, length_column: str = "length", order: list[str] | None = None) -> DataFrame:
    """``rows`` with ``sequence_id`` and ``offset`` (bigint): their place in sequences of ``capacity`` tokens.

    Every row keeps its columns; columns of these two names are replaced. Rows of equal
    length are told apart by ``order`` (all other columns, if not given); equal rows are
    interchangeable. Lengths must lie between 1 and ``capacity``. No row gives no row.
    """
    rows = rows.drop("sequence_id", "offset")
    order = order or [c for c in rows.columns if c != length_column]
    rows = cut_lineage(rows)
    length = F.col(length_column)
    # One number for each length: at most ``capacity`` of them reach the driver.
    counts = {int(r[0]): int(r[1]) for r in rows.groupBy(length).count().collect()}
    if any(not 1 <= n <= capacity for n in counts):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    runs = plan(counts, capacity)
    firsts: dict[int, list[Run]] = defaultdict(list)
    for run in runs:
        firsts[run.length].append(run)
    table = {n: tuple(np.array(x) for x in zip(*[(r.first, r.sequence, r.offset) for r in own])) for n, own in firsts.items()}

    @F.arrow_udf("struct<sequence_id:bigint,offset:bigint>")
    def place(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        n, rank = pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False), ranks.to_numpy(zero_copy_only=False)
        sequence, offset = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
        for value in np.unique(n):
            at = np.flatnonzero(n == value)
            begin, first, where = table[int(value)]
            run = np.searchsorted(begin, rank[at], "right") - 1
            sequence[at] = first[run] + rank[at] - begin[run]
            offset[at] = where[run]
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    ranked = positions(rows, [length_column], order, "_rank")
    placed = ranked.withColumn("_place", place(length, F.col("_rank") - 1))
    return placed.select(*rows.columns, "_place.sequence_id", "_place.offset")

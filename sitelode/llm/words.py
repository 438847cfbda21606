"""Words of whole Arrow batches, found and hashed with numpy.

A word is a run of bytes other than space and ``\\t\\n\\v\\f\\r``. Work is done on
the flat UTF-8 buffer of many texts at once, so nothing is done per word in Python.
Word hashes are 64 bits wide and the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; a longer text makes a step of its own.
STEP_BYTES = 512 * 1024

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_BYTE_LOWER = _BYTE[_LOWER]
_BASE = 0xD6E8FEB86659FD93
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of an odd base modulo 2^64."""
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 1024), _BASE, np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps)
    return _powers[:n]


@dataclass
class Texts:
    """Consecutive texts in one buffer: text ``i`` is ``buffer[bounds[i]:bounds[i + 1]]``."""

    buffer: np.ndarray
    bounds: np.ndarray
    first: int

    def __len__(self) -> int:
        return len(self.bounds) - 1


@dataclass
class Words:
    """Byte spans of words; those of text ``i`` are ``bounds[i]:bounds[i + 1]``."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def owners(self) -> np.ndarray:
        """The text that each word stands in."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def steps(column: pa.Array | pa.ChunkedArray, step_bytes: int = STEP_BYTES) -> Iterator[Texts]:
    """Runs of texts of about ``step_bytes``; a null text is empty. ``first`` is the index of the first text."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    before = 0
    for chunk in chunks:
        if chunk.null_count:
            chunk = chunk.fill_null("")
        chunk = chunk.cast(pa.large_string())
        n = len(chunk)
        if not n:
            continue
        offsets = np.frombuffer(chunk.buffers()[1], np.int64, n + 1, chunk.offset * 8)
        data = chunk.buffers()[2]
        data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        at = 0
        while at < n:
            to = int(np.searchsorted(offsets, offsets[at] + step_bytes, "right")) - 1
            to = min(n, max(to, at + 1))
            yield Texts(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], before + at)
            at = to
        before += n


#: Bytes that are no part of a letter run: ASCII other than letters.
NOT_LETTERS = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])


def find_words(texts: Texts, gaps: np.ndarray = _SPACE, cuts: np.ndarray | None = None) -> Words:
    """Runs of bytes that are not ``gaps``; a run ends with its text, and before each byte marked in ``cuts``."""
    inside = ~gaps[texts.buffer]
    n = len(inside)
    breaks = np.zeros(n + 1, bool)
    if cuts is not None:
        breaks[:n] = cuts
    breaks[texts.bounds] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | breaks[:n]))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | breaks[1:])) + 1
    return Words(starts, ends, np.searchsorted(starts, texts.bounds))


def hash_spans(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hashes of byte spans that do not overlap, in order; A-Z counts as a-z if ``lower``."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    before = np.cumsum(lengths) - lengths
    at = np.arange(int(lengths.sum()))
    place = at - np.repeat(before, lengths)
    values = (_BYTE_LOWER if lower else _BYTE)[buffer[at + np.repeat(starts - before, lengths)]]
    values *= powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(values, before) + lengths.astype(np.uint64))


def word_hashes(texts: Texts, found: Words, lower: bool = False) -> np.ndarray:
    return hash_spans(texts.buffer, found.starts, found.ends, lower)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive words, texts not told apart."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(hashes) - n + 1, np.uint64)
    for i in range(n):
        total = total * np.uint64(_BASE) + hashes[i : i + len(total)]
    return mix(total)


def whole_grams(found: Words, n: int) -> np.ndarray:
    """For each run of :func:`gram_hashes`, whether it lies in one text."""
    owners = found.owners()
    return owners[: max(0, len(owners) - n + 1)] == owners[n - 1 :]


def sums_by_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive bounds; 0 where nothing lies between."""
    total = np.concatenate((np.zeros((1, *values.shape[1:]), np.int64), np.cumsum(values, axis=0, dtype=np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]

"""Quality rules by repetition coverage.

Rolling hashes of word runs of several lengths, and of lines, show which characters of
a text lie inside runs or lines that the text holds more than once. A text whose
share of such characters passes the limit of any length is not kept.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .words import Texts, find_words, gram_hashes, hash_spans, mix, steps, sums_by_text, whole_grams, word_hashes

_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))


@dataclass(frozen=True)
class Limits:
    """Largest shares of word characters that may be repeated."""

    #: By run length in words: characters inside runs that stand in the text twice or more.
    runs: dict[int, float] = field(
        default_factory=lambda: {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
    )
    #: Characters inside lines equal to an earlier line.
    line_chars: float = 0.20
    min_words: int = 50
    max_repeat_words: float = 0.50


def _measure(texts: Texts, limits: Limits) -> dict[str, np.ndarray]:
    n = len(texts)
    found = find_words(texts)
    words = np.diff(found.bounds)
    owners = found.owners()
    starts_char = (texts.buffer & 0xC0) != 0x80
    chars_before = np.concatenate(([0], np.cumsum(starts_char)))
    chars = chars_before[found.ends] - chars_before[found.starts]
    word_chars = sums_by_text(chars, found.bounds)
    hashes = word_hashes(texts, found)
    salt = mix(np.arange(1, n + 1, dtype=np.uint64))[owners] if len(owners) else np.zeros(0, np.uint64)

    def repeated(length: int, of: np.ndarray) -> np.ndarray:
        """Among the runs at positions ``of``, those whose text holds an equal one."""
        keys = mix(grams[length][of] + salt[of])
        order = np.argsort(keys)
        ranked = keys[order]
        same = np.zeros(len(ranked) + 1, bool)
        same[1:-1] = ranked[1:] == ranked[:-1]
        out = np.zeros(len(of), bool)
        out[order] = same[1:] | same[:-1]
        return of[out]

    def covered(at: np.ndarray, length: int) -> np.ndarray:
        edge = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + length, -1)
        return np.cumsum(edge)[:-1] > 0

    grams = {k: gram_hashes(hashes, k) for k in (3, *sorted(limits.runs))}
    at = repeated(3, np.flatnonzero(whole_grams(found, 3)))
    repeat_words = sums_by_text(covered(at, 3).astype(np.int64), found.bounds)
    out = {"n_words": words, "word_chars": word_chars, "n_repeat_words": repeat_words}
    out["n_symbols"] = sums_by_text(_SYMBOL[texts.buffer].astype(np.int64), texts.bounds)

    # A repeated run begins with a repeated shorter run, so each length looks only at what is left of the one before.
    shares, length = {}, 3
    for k in sorted(limits.runs):
        inside = np.zeros(len(hashes) + 1, bool)
        inside[at] = True
        at = at[at <= len(hashes) - k]
        at = at[(owners[at] == owners[at + k - 1]) & inside[at + k - length]]
        at = repeated(k, at)
        length = k
        shares[k] = sums_by_text(np.where(covered(at, k), chars, 0), found.bounds)

    breaks = np.flatnonzero(texts.buffer == 10)
    size = len(texts.buffer)
    begins = np.union1d(breaks + 1, texts.bounds[:-1])
    begins = begins[begins < size]
    next_break = np.append(breaks, size)[np.searchsorted(breaks, begins)]
    next_text = texts.bounds[np.searchsorted(texts.bounds, begins, "right")]
    ends = np.minimum(next_break, next_text)
    held = np.searchsorted(found.starts, ends) - np.searchsorted(found.starts, begins)
    begins, ends = begins[held > 0], ends[held > 0]
    owner = np.searchsorted(texts.bounds, begins, "right") - 1
    keys = mix(hash_spans(texts.buffer, begins, ends) + mix(owner.astype(np.uint64) + np.uint64(1)))
    first = np.zeros(len(keys), bool)
    first[np.unique(keys, return_index=True)[1]] = True
    words_before = np.concatenate(([0], np.cumsum(chars)))
    line_chars = (
        words_before[np.searchsorted(found.starts, ends)] - words_before[np.searchsorted(found.starts, begins)]
    )
    out["n_dup_lines"] = np.bincount(owner, ~first, n).astype(np.int64)
    dup_line_chars = np.bincount(owner, np.where(first, 0, line_chars), n)

    most = np.maximum(word_chars, 1)
    bad = dup_line_chars > limits.line_chars * most
    for k, limit in limits.runs.items():
        bad |= shares[k] > limit * most
    out["run_share"] = np.max([shares[k] / most for k in limits.runs], axis=0) if limits.runs else np.zeros(n)
    out["line_share"] = dup_line_chars / most
    out["base_failed"] = (words < limits.min_words) | (repeat_words > limits.max_repeat_words * words)
    out["kept"] = ~out["base_failed"] & ~bad
    return out


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_TYPES = (
    [(c, pa.int64()) for c in _COUNTS]
    + [("base_failed", pa.bool_()), ("kept", pa.bool_())]
    + [("run_share", pa.float64()), ("line_share", pa.float64())]
)


def repetition(text: Column, limits: Limits | None = None) -> Column:
    """A struct of counts, shares and the verdict ``kept`` for each whole text.

    A null, empty or blank text has no words: all counts are 0, it fails the base rules
    and is not kept. Each row is judged by itself, so repeated rows get equal results.
    """
    limits = limits or Limits()

    @F.arrow_udf(
        "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,"
        "base_failed:boolean,kept:boolean,run_share:double,line_share:double>"
    )
    def of(texts: pa.Array) -> pa.Array:
        parts = [_measure(t, limits) for t in steps(texts)]
        columns = [
            pa.array(np.concatenate([p[c] for p in parts]) if parts else [], kind) for c, kind in _TYPES
        ]
        return pa.StructArray.from_arrays(columns, [c for c, _ in _TYPES])

    return of(text)

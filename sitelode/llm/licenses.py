"""Licence notices in texts by an exact set-similarity join with templates.

A template is a set of words. A block of text meets it if it holds at least ``threshold`` of the
template's words. Blocks are windows: for each size class of templates, twice as many words as
the largest template of the class has, one starting every half window, so a notice that stands in one piece
always lies whole in some block.

Words are ranked by how many texts hold them, rarest first; only words of templates can be shared, so only these are counted, over all
texts. If a block meets a template that needs ``a`` of its ``n`` words, it shares one of the template's ``n - a + 1`` rarest (prefix
filter), has ``a`` template words (length filter), and has enough of them left from the first shared place on (positional
filter). Blocks without a prefix word never leave the scan; the others are joined to the index of prefixes by word,
and what passes is counted exactly. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .words import NOT_LETTERS, Texts, find_words, steps, word_hashes

#: Bytes that are no part of a word: ASCII other than letters and digits.
_GAPS = NOT_LETTERS & ~np.isin(np.arange(256), np.frombuffer(b"0123456789", np.uint8))

#: Phrases and the labels they stand for.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Opening words of common licence notices, with their labels.
NOTICES = [
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("you may obtain a copy of the license at http www apache org licenses license 2 0", "apache-2.0"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("under the terms of the gnu lesser general public license", "lgpl"),
    ("under the terms of the gnu affero general public license", "agpl"),
    ("licensed under cc by 4 0", "cc-by-4.0"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by-4.0"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "cc0"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("copyright all rights reserved", "all-rights-reserved"),
]


@dataclass(frozen=True)
class Settings:
    #: Least share of a template's words that a block must hold.
    threshold: float = 0.9
    #: Largest template of each size class, in words; a larger one makes a class of its own.
    classes: tuple[int, ...] = (8, 16, 32)
    phrases: dict[str, str] = field(default_factory=lambda: dict(PHRASES))
    notices: list[tuple[str, str]] = field(default_factory=lambda: list(NOTICES))


def _hashes(words: list[str]) -> np.ndarray:
    texts = next(steps(pa.array([" ".join(words)])))
    return word_hashes(texts, find_words(texts, _GAPS), lower=True)


def _needed(n: int, threshold: float) -> int:
    return max(1, ceil(threshold * n - 1e-9))


def _class_of(n: int, classes: tuple[int, ...]) -> int:
    return next((c for c in classes if n <= c), n)


def vocabulary(settings: Settings) -> list[str]:
    return sorted({w for text, _ in settings.notices for w in text.split()})


def _held(texts: Texts, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word bounds of the texts, places of known words among all words, and which known word each is."""
    found = find_words(texts, _GAPS)
    hashes = word_hashes(texts, found, lower=True)
    order = np.argsort(known)
    at = np.minimum(np.searchsorted(known[order], hashes), len(known) - 1)
    hit = np.flatnonzero(known[order][at] == hashes) if len(known) else np.zeros(0, np.int64)
    return found.bounds, hit, order[at[hit]]


def document_counts(docs: DataFrame, text: str, words: list[str]) -> dict[str, int]:
    """How many texts hold each word of a bounded vocabulary. Batches are summed where they are read."""
    known = _hashes(words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(words), np.int64)
        for batch in batches:
            for texts in steps(batch.column(0)):
                bounds, places, which = _held(texts, known)
                owner = np.searchsorted(bounds, places, "right") - 1
                pairs = np.unique(owner * len(words) + which)
                total += np.bincount(pairs % len(words), minlength=len(words))
        yield pa.RecordBatch.from_pydict({"word": np.arange(len(words), dtype=np.int32), "n": total})

    rows = docs.select(text).mapInArrow(count, "word int, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {r["word"]: r["n"] for r in rows}
    return {w: found.get(i, 0) for i, w in enumerate(words)}


@dataclass(frozen=True)
class Index:
    """Templates as sets of ranks (rarest word first) and their prefixes, by size class. Its size is that of the templates."""

    words: list[str]
    #: ``(template, class, label, ranks, needed)``
    templates: list[tuple[int, int, str, list[int], int]]

    @property
    def sizes(self) -> list[int]:
        return sorted({t[1] for t in self.templates})

    def prefix(self, size: int) -> set[int]:
        return {r for t in self.templates if t[1] == size for r in t[3][: len(t[3]) - t[4] + 1]}


def template_sizes(settings: Settings) -> list[int]:
    """The size class of each notice: its own, or that of the largest notice that holds all of its words."""
    sets = [set(text.split()) for text, _ in settings.notices]
    own = [_class_of(len(text.split()), settings.classes) for text, _ in settings.notices]
    return [max([own[i], *(own[j] for j, wider in enumerate(sets) if words < wider)]) for i, words in enumerate(sets)]


def build_index(settings: Settings, counts: dict[str, int]) -> Index:
    words = sorted(counts, key=lambda w: (counts[w], w))
    rank = {w: i for i, w in enumerate(words)}
    templates = []
    for i, ((text, label), size) in enumerate(zip(settings.notices, template_sizes(settings), strict=True)):
        ranks = sorted({rank[w] for w in text.split()})
        templates.append((i, size, label, ranks, _needed(len(ranks), settings.threshold)))
    return Index(words, templates)


_BASE = "n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,base:array<boolean>"
_BLOCKS = "array<struct<size:int,at:bigint,ranks:array<int>>>"


def _phrase_starts(hashes: np.ndarray, bounds: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Places where the words of a phrase follow one another inside one text."""
    last = len(hashes) - len(phrase)
    at = np.flatnonzero(hashes[: last + 1] == phrase[0]) if last >= 0 else np.zeros(0, np.int64)
    for i, h in enumerate(phrase[1:], 1):
        at = at[hashes[at + i] == h]
    ends = bounds[np.searchsorted(bounds, at, "right")] if len(at) else at
    return at[at + len(phrase) <= ends]


def _blocks(bounds: np.ndarray, places: np.ndarray, ranks: np.ndarray, index: Index) -> list[list[dict]]:
    """Blocks of each text that hold a prefix word of a template of their class."""
    out: list[list[dict]] = [[] for _ in range(len(bounds) - 1)]
    owners = np.searchsorted(bounds, places, "right") - 1
    local = places - bounds[owners]
    for size in index.sizes:
        rare = np.flatnonzero(np.isin(ranks, list(index.prefix(size))))
        half = local[rare] // size
        # A word stands in the window that starts at its half, and in the one before.
        pairs = np.concatenate((np.stack((owners[rare], half)), np.stack((owners[rare], half - 1))), axis=1)
        pairs = np.unique(pairs[:, pairs[1] >= 0], axis=1)
        begins = bounds[pairs[0]] + pairs[1] * size
        ends = np.minimum(begins + 2 * size, bounds[pairs[0] + 1])
        lo, hi = np.searchsorted(places, begins), np.searchsorted(places, ends)
        for owner, half_at, a, b in zip(pairs[0], pairs[1], lo, hi, strict=True):
            out[owner].append({"size": size, "at": int(half_at) * size, "ranks": np.unique(ranks[a:b]).tolist()})
    return out


def scan(text: Column, index: Index, phrases: list[str]) -> Column:
    """What one reading of a whole text yields: its words, the places of phrases, and the blocks worth joining."""
    known = _hashes(index.words)
    wanted = [_hashes(p.split()) for p in phrases]

    @F.arrow_udf(f"struct<{_BASE},blocks:{_BLOCKS}>")
    def of(column: pa.Array) -> pa.Array:
        parts: dict[str, list] = {n: [] for n in ("n_words", "n_base", "first_word", "last_word", "base", "blocks")}
        for texts in steps(column):
            found = find_words(texts, _GAPS)
            hashes = word_hashes(texts, found, lower=True)
            starts = [_phrase_starts(hashes, found.bounds, p) for p in wanted]
            every = np.sort(np.concatenate(starts)) if starts else np.zeros(0, np.int64)
            lo, hi = np.searchsorted(every, found.bounds[:-1]), np.searchsorted(every, found.bounds[1:])
            some = hi > lo
            padded = np.append(every, 0)
            first, last = padded[np.where(some, lo, len(every))], padded[np.where(some, hi - 1, len(every))]
            parts["n_words"].append(np.diff(found.bounds))
            parts["n_base"].append(hi - lo)
            parts["first_word"] += [int(v) if s else None for v, s in zip(first - found.bounds[:-1], some, strict=True)]
            parts["last_word"] += [int(v) if s else None for v, s in zip(last - found.bounds[:-1], some, strict=True)]
            each = [np.diff(np.searchsorted(s, found.bounds)) > 0 for s in starts]
            parts["base"] += np.stack(each, axis=1).tolist() if each else [[]] * len(texts)
            bounds, places, which = _held(texts, known)
            parts["blocks"] += _blocks(bounds, places, which, index)
        whole = [np.concatenate(parts[n]) if parts[n] else [] for n in ("n_words", "n_base")]
        block = pa.list_(pa.struct([("size", pa.int32()), ("at", pa.int64()), ("ranks", pa.list_(pa.int32()))]))
        arrays = [
            pa.array(whole[0], pa.int64()), pa.array(whole[1], pa.int64()), pa.array(parts["first_word"], pa.int64()),
            pa.array(parts["last_word"], pa.int64()), pa.array(parts["base"], pa.list_(pa.bool_())), pa.array(parts["blocks"], block),
        ]
        return pa.StructArray.from_arrays(arrays, list(parts))

    return of(text)


def matches(blocks: DataFrame, index: Index, keys: list[str]) -> DataFrame:
    """Every block that meets a template: ``keys``, ``at``, ``size``, ``label``, ``template`` and ``containment``.

    ``blocks`` holds ``keys`` and ``block``. The index of prefixes is as small as the templates and may be broadcast.
    """
    spark = blocks.sparkSession
    prefixes = [(t, size, r, i, len(ranks), need) for t, size, _, ranks, need in index.templates for i, r in enumerate(ranks[: len(ranks) - need + 1])]
    prefix = spark.createDataFrame(prefixes, "template int, size int, word int, i int, n int, needed int")
    sets = spark.createDataFrame([(t, label, ranks) for t, _, label, ranks, _ in index.templates], "template int, label string, words array<int>")
    opened = blocks.select(*keys, "block.*").select(*keys, "size", "at", "ranks", F.posexplode("ranks").alias("j", "word"))
    length = F.size("ranks")
    # The first shared place must leave enough on both sides.
    left = F.least(F.col("n") - F.col("i"), length - F.col("j"))
    met = opened.join(prefix, ["size", "word"]).where((length >= F.col("needed")) & (left >= F.col("needed")))
    shared = F.size(F.array_intersect("ranks", "words"))
    exact = met.join(sets, "template").withColumn("shared", shared).where(F.col("shared") >= F.col("needed"))
    return exact.select(*keys, "at", "size", "label", "template", (F.col("shared") / F.col("n")).alias("containment")).distinct()


def narrowest(found: DataFrame, index: Index, keys: list[str]) -> DataFrame:
    """Matches without those of a template whose words all belong to another template that the same block meets."""
    wider = [(t, [u for u, _, _, other, _ in index.templates if set(ranks) < set(other)]) for t, _, _, ranks, _ in index.templates]
    table = found.sparkSession.createDataFrame(wider, "template int, wider array<int>")
    block = [*keys, "size", "at"]
    met = found.groupBy(*block).agg(F.collect_set("template").alias("met"))
    alone = ~F.arrays_overlap("met", "wider")
    return found.join(met, block).join(table, "template").where(alone).drop("met", "wider")


def license_scan(docs: DataFrame, text: str, carry: list[str], settings: Settings | None = None) -> DataFrame:
    """Licences of every row: ``carry``, the base counts, ``base_labels``, ``labels`` and ``score``.

    Where a block meets a template and another one that has all its words and more, only the latter's label counts.
    ``score`` is the best containment of a template in a block of the text, 1 where a phrase stands, 0 where nothing is met.
    A null or empty text has no words and no labels. Every row is judged by itself, so repeated rows get equal
    results; an empty table gives an empty one. A very long text is cut into blocks, never shortened.
    """
    settings = settings or Settings()
    phrases = list(settings.phrases)
    index = build_index(settings, document_counts(docs, text, vocabulary(settings)))
    read = docs.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)], scan(F.col(text), index, phrases).alias("r"))
    # Stored with a number for each row, which stays the same when a task runs again.
    stored = cut_lineage(read.select("*", F.monotonically_increasing_id().alias("row")))
    blocks = stored.select("row", F.explode("r.blocks").alias("block"))
    found = narrowest(matches(blocks, index, ["row"]), index, ["row"])
    best = found.groupBy("row").agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))
    names = F.array(*[F.lit(settings.phrases[p]) for p in phrases])
    base = F.array_sort(F.array_distinct(F.filter(F.transform("r.base", lambda b, i: F.when(b, F.get(names, i))), lambda x: x.isNotNull())))
    labels = F.array_sort(F.array_union(base, F.coalesce("more", F.array().cast("array<string>"))))
    score = F.when(F.col("r.n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0)))
    return stored.join(best, "row", "left").select(
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)], "r.n_words", "r.n_base", "r.first_word", "r.last_word",
        F.array_join(base, ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"),
    )

"""Language-model scoring by deleted interpolation.

``p(w | h) = a * c(hw) / c(h) + b * c(w) / N + d / (V + 1)``, where the weights ``a, b, d`` depend on
how frequent the context ``h`` is, and are learned by expectation-maximisation on training
texts that are left out of the counts for that purpose.

Counts of all words and word pairs stay distributed. Texts are encoded once into blocks of
a bounded number of tokens, written to the shared folder. A block sends each distinct pair
once, with its count, to the partition of its hash range, which adds up and sends the totals
back in the order of the request. So a frequent pair meets at most once per block, and
no count is ever held for all texts in one place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .words import find_words, mix, steps, word_hashes

HELD_OUT, COUNTED, DELETED = 0, 1, 2
#: The token that ends a text, and the context of its first word.
END = np.uint64(0x9AE16A3B2F90404F)


@dataclass(frozen=True)
class Settings:
    #: Tokens of one block; a longer text makes a block of its own.
    block_tokens: int = 1 << 21
    #: Steps per doubling in the histogram that the weights are learned from.
    resolution: int = 8
    rounds: int = 200
    #: Contexts are told apart by the binary logarithm of their count, up to this.
    levels: int = 24


def _pack(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes."""
    wide = np.ascontiguousarray(values)
    planes = np.ascontiguousarray(wide.view(np.uint8).reshape(-1, wide.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def _pack_sorted(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=np.zeros(1, values.dtype)))


def _unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, np.uint64), dtype=np.uint64)


_BLOCK = "block bigint, role int, ids array<bigint>, sizes array<int>, words binary, codes binary"
_BLOCK_NAMES = ["block", "role", "ids", "sizes", "words", "codes"]


def _blocks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Rows ``id, text, role`` to blocks of one role: word hashes and, for each token, the place of its word."""
    held: dict[int, tuple[list, list, list]] = {r: ([], [], []) for r in (HELD_OUT, COUNTED, DELETED)}
    size = dict.fromkeys(held, 0)
    number = TaskContext.get().partitionId() << 32

    def flush(role: int) -> pa.RecordBatch:
        nonlocal number
        ids, sizes, tokens = held[role]
        words, codes = np.unique(np.concatenate(tokens), return_inverse=True)
        held[role] = ([], [], [])
        number += 1
        row = [[number - 1], [role], [ids], [sizes], [_pack_sorted(words)], [_pack(codes.astype(np.uint32))]]
        kinds = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds)], _BLOCK_NAMES)

    for batch in batches:
        ids, roles = batch.column(0).to_pylist(), batch.column(2).to_numpy()
        for part in steps(batch.column(1)):
            found = find_words(part)
            hashes = word_hashes(part, found, lower=True)
            # One end after each text.
            at = found.bounds[1:]
            tokens = np.insert(hashes, at, END)
            bounds = found.bounds + np.arange(len(found.bounds))
            for i, (a, b) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())):
                role = int(roles[part.first + i])
                block = held[role]
                if block[1] and size[role] + b - a > limit:
                    yield flush(role)
                    block = held[role]
                    size[role] = 0
                block[0].append(ids[part.first + i])
                block[1].append(b - a)
                block[2].append(tokens[a:b])
                size[role] += b - a
    for role in held:
        if held[role][1]:
            yield flush(role)


def _tokens(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block: word hashes, each token's word and its context's word, and where texts begin."""
    words, codes = _unpack_sorted(row["words"]), _unpack(row["codes"], np.uint32).astype(np.int64)
    sizes = np.array(row["sizes"], np.int64)
    starts = np.cumsum(sizes) - sizes
    context = np.empty_like(codes)
    context[1:] = codes[:-1]
    context[starts] = np.searchsorted(words, END)
    return words, codes, context, starts


def _pairs(words: np.ndarray, codes: np.ndarray, context: np.ndarray) -> np.ndarray:
    return mix(words[context] * np.uint64(0x9E3779B97F4A7C15) + words[codes])


_REQUEST = "unit int, block bigint, role int, keys binary, n binary"


def _requests(batches: Iterator[pa.RecordBatch], ranges: int) -> Iterator[pa.RecordBatch]:
    """Distinct words and pairs of each block with their counts, by hash range. Units of pairs follow those of words."""
    for batch in batches:
        for row in batch.to_pylist():
            words, codes, context, _ = _tokens(row)
            pairs, counts = np.unique(_pairs(words, codes, context), return_counts=True)
            for order, (keys, n) in enumerate(((words, np.bincount(codes, minlength=len(words))), (pairs, counts))):
                cuts = np.searchsorted((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32), np.arange(ranges + 1))
                full = np.flatnonzero(np.diff(cuts))
                spans = [(int(cuts[i]), int(cuts[i + 1])) for i in full]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(full + order * ranges, pa.int32()),
                        pa.array([row["block"]] * len(full), pa.int64()),
                        pa.array([row["role"]] * len(full), pa.int32()),
                        pa.array([_pack_sorted(keys[a:b]) for a, b in spans], pa.binary()),
                        pa.array([_pack(n[a:b].astype(np.uint32)) for a, b in spans], pa.binary()),
                    ],
                    ["unit", "block", "role", "keys", "n"],
                )


_REPLY = "block bigint, role int, unit int, total binary, counted binary, types bigint, types_counted bigint"


def _replies(unit: pa.Table) -> pa.Table:
    """Totals over training blocks, and over those that are counted, in the order of each request."""
    rows = unit.sort_by([("block", "ascending")]).to_pylist()
    keys = [_unpack_sorted(r["keys"]) for r in rows]
    n = [_unpack(r["n"], np.uint32) for r in rows]
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    role = np.repeat([r["role"] for r in rows], [len(k) for k in keys])
    n_all = np.concatenate(n).astype(np.float64)
    total = np.bincount(place, np.where(role != HELD_OUT, n_all, 0), len(distinct)).astype(np.uint64)
    counted = np.bincount(place, np.where(role == COUNTED, n_all, 0), len(distinct)).astype(np.uint64)
    out, at = [], 0
    for i, (r, k) in enumerate(zip(rows, keys)):
        own = place[at : at + len(k)]
        at += len(k)
        out.append(
            {
                "block": r["block"], "role": r["role"], "unit": r["unit"], "total": _pack(total[own]),
                # Only texts that the weights are learned from need both.
                "counted": _pack(counted[own]) if r["role"] == DELETED else None,
                "types": int((total > 0).sum()) if not i else 0, "types_counted": int((counted > 0).sum()) if not i else 0,
            }
        )
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    names = ["block", "role", "unit", "total", "counted", "types", "types_counted"]
    return pa.Table.from_pylist(out, pa.schema(list(zip(names, kinds))))


def _counts(replies: pa.Table, ranges: int, column: str) -> tuple[np.ndarray, np.ndarray]:
    """A block's totals of words and of distinct pairs, in ascending order of their hashes."""
    rows = sorted(replies.select(["unit", column]).to_pylist(), key=lambda r: r["unit"])
    parts: tuple[list, list] = ([], [])
    for r in rows:
        parts[r["unit"] >= ranges].append(_unpack(r[column], np.uint64))
    return tuple(np.concatenate(p).astype(np.float64) if p else np.zeros(0) for p in parts)


@dataclass(frozen=True)
class Totals:
    tokens: int
    types: int

    def chances(self, word: np.ndarray, context: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Maximum-likelihood estimates of the pair and the word, and the even share."""
        given = np.divide(pair, context, out=np.zeros_like(pair), where=context > 0)
        return given, word / max(1, self.tokens), 1.0 / (self.types + 1)


def _level(context: np.ndarray, levels: int) -> np.ndarray:
    return np.minimum(np.where(context > 0, np.log2(np.maximum(context, 1)).astype(np.int64) + 1, 0), levels)


def _statistics(block: pa.Table, replies: pa.Table, ranges: int, totals: Totals, settings: Settings) -> pa.Table:
    """Tokens of a block by context level and by the ratios of the three estimates, in small logarithmic steps."""
    words, codes, context, _ = _tokens(block.to_pylist()[0])
    of_word, of_pair = _counts(replies, ranges, "counted")
    _, place = np.unique(_pairs(words, codes, context), return_inverse=True)
    c = of_word[context]
    pair, word, even = totals.chances(of_word[codes], c, of_pair[place])

    def steps_of(x: np.ndarray, to: np.ndarray | float) -> np.ndarray:
        ratio = np.divide(x, to, out=np.zeros_like(x), where=x > 0)
        s = np.rint(settings.resolution * np.log2(np.where(ratio > 0, ratio, 1))).astype(np.int64)
        return np.where(ratio > 0, np.clip(s, -500, 500), -1000)

    cells = np.stack([_level(c, settings.levels), steps_of(pair, even), steps_of(word, even)], axis=1)
    cells, n = np.unique(cells, axis=0, return_counts=True)
    return pa.table(
        {"level": pa.array(cells[:, 0]), "pair": pa.array(cells[:, 1]), "word": pa.array(cells[:, 2]), "n": pa.array(n)}
    )


def learn_weights(cells: np.ndarray, settings: Settings) -> np.ndarray:
    """Weights of pair, word and even share for each level, from rows ``level, pair, word, n``.

    A level without tokens, and every estimate, starts from even weights and one token of each.
    """
    weights = np.full((settings.levels + 1, 3), 1 / 3)
    for level in range(settings.levels + 1):
        own = cells[cells[:, 0] == level]
        ratio = np.where(own[:, 1:3] > -1000, 2.0 ** (own[:, 1:3] / settings.resolution), 0.0)
        ratio = np.concatenate((ratio, np.ones((len(own), 1))), axis=1)
        n = own[:, 3].astype(float)
        for _ in range(settings.rounds):
            share = ratio * weights[level]
            share /= share.sum(axis=1, keepdims=True)
            new = n @ share + (0.0 if level == 0 else 1.0, 1.0, 1.0)
            new /= new.sum()
            moved = np.abs(new - weights[level]).max()
            weights[level] = new
            if moved < 1e-7:
                break
    return weights


def _scores(block: pa.Table, replies: pa.Table, ranges: int, totals: Totals, weights: np.ndarray) -> pa.Table:
    row = block.to_pylist()[0]
    words, codes, context, starts = _tokens(row)
    of_word, of_pair = _counts(replies, ranges, "total")
    _, place = np.unique(_pairs(words, codes, context), return_inverse=True)
    c, n = of_word[context], of_word[codes]
    pair, word, even = totals.chances(n, c, of_pair[place])
    a, b, d = weights[_level(c, len(weights) - 1)].T
    model = np.log10(a * pair + b * word + d * even)
    base = np.log10((n + 1) / (totals.tokens + totals.types + 1))
    return pa.table(
        {
            "id": pa.array(row["ids"], pa.int64()),
            "held_out": pa.array([row["role"] == HELD_OUT] * len(starts)),
            "n_tokens": pa.array(row["sizes"], pa.int64()),
            "n_known": pa.array(np.add.reduceat((n > 0).astype(np.int64), starts)),
            "base_score": pa.array(np.add.reduceat(base, starts)),
            "score": pa.array(np.add.reduceat(model, starts)),
        }
    )


def score(rows: DataFrame, id_column: str, text_column: str, role: Column, settings: Settings | None = None) -> DataFrame:
    """``<id>, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    ``role`` is ``HELD_OUT``, ``COUNTED`` or ``DELETED``: texts of the last two are the training texts, and
    those of the last are where weights are learned. A null or blank text is one token,
    the end. Ids are bigint, may be null and may repeat; each row is scored for itself.
    Without a training text every estimate is the even share. No row gives no row.
    """
    settings = settings or Settings()
    spark = rows.sparkSession
    texts = rows.select(
        F.col(id_column).cast("bigint").alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"), role.cast("int").alias("role")
    )
    place = scratch_path(spark, "lm-blocks")
    limit = settings.block_tokens
    texts.mapInArrow(lambda b: _blocks(b, limit), _BLOCK).write.parquet(place)
    blocks = spark.read.parquet(place)
    ranges = max(1, blocks.count())

    asked = blocks.mapInArrow(lambda b: _requests(b, ranges), _REQUEST)
    replies_place = scratch_path(spark, "lm-replies")
    asked.groupBy("unit").applyInArrow(_replies, _REPLY).write.parquet(replies_place)
    replies = spark.read.parquet(replies_place)

    sizes = blocks.select("role", F.aggregate("sizes", F.lit(0).cast("bigint"), lambda x, y: x + y).alias("n"))
    tokens = dict(sizes.groupBy("role").agg(F.sum("n")).collect())
    of_words = replies.where(F.col("unit") < ranges).agg(F.sum("types"), F.sum("types_counted")).first()
    counted = Totals(tokens.get(COUNTED, 0), of_words[1] or 0)
    totals = Totals(counted.tokens + tokens.get(DELETED, 0), of_words[0] or 0)

    def joined(where: Column, function, schema: str) -> DataFrame:
        left = blocks.where(where).groupBy("block")
        right = replies.where(where).drop("role", "types", "types_counted").groupBy("block")
        return left.cogroup(right).applyInArrow(function, schema)

    cells = joined(
        F.col("role") == DELETED,
        lambda a, b: _statistics(a, b, ranges, counted, settings),
        "level bigint, pair bigint, word bigint, n bigint",
    ).groupBy("level", "pair", "word").agg(F.sum("n").alias("n"))
    # Cells are bounded by levels and steps, whatever the number of tokens.
    found = cells.toArrow()
    weights = learn_weights(np.stack([found[c].to_numpy() for c in found.column_names], axis=1).reshape(-1, 4), settings)
    scored = joined(
        F.lit(True),
        lambda a, b: _scores(a, b, ranges, totals, weights),
        "id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double",
    )
    return scored.select(
        F.col("id").alias(id_column), "held_out", "n_tokens", "n_known",
        F.lit(totals.tokens).cast("bigint").alias("train_tokens"), "base_score", "score",
    )

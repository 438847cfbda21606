"""SimHash fingerprints and groups of near copies, found with BK-trees.

Fingerprints that differ in at most ``radius`` bits are linked. Equal fingerprints
are reduced to one first. A pair within the radius agrees in at least two of
``radius + 2`` bit blocks, so fingerprints meet in buckets by the values of two
blocks. Each bucket is cut into shards of at most ``shard_size`` fingerprints; every
shard becomes a BK-tree that is sent to all shards of its own bucket, and a search
follows only edges whose distance lies within the radius. A task holds two shards at
most, whatever a bucket's size. Links are returned as stars, never as all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .graph import components

BITS = 64
_CHUNK = 1 << 16


def shingle_hashes(text: str | None, words: int) -> Iterator[np.ndarray]:
    """XXH64 of all ``words``-word shingles, A-Z lower-cased, in bounded parts; a shorter text is one shingle."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) for t in tokens]) + np.arange(len(tokens))
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(words, len(tokens))
    starts, ends = starts[: len(tokens) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), _CHUNK):
        spans = zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK])
        yield np.array([digest(joined[a:b], 42) for a, b in spans], np.uint64)


def fingerprint_text(text: str | None, words: int = 3) -> int:
    """Majority of the bits of all shingles; 0 without a word."""
    ones, n = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(text, words):
        n += len(hashes)
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprint(text: Column, words: int = 3) -> Column:
    """The fingerprint of a text as a bigint with the same 64 bits."""

    @F.arrow_udf("bigint")
    def of(texts: pa.Array) -> pa.Array:
        found = np.fromiter((fingerprint_text(t.as_py(), words) for t in texts), np.uint64, len(texts))
        return pa.array(found.view(np.int64))

    return of(text)


class BKTree:
    """Children are keyed by their Hamming distance to the parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        node = len(self.values)
        self.values.append(value)
        self.children.append({})
        if not node:
            return
        at = 0
        while True:
            distance = (self.values[at] ^ value).bit_count()
            below = self.children[at].setdefault(distance, node)
            if below == node:
                return
            at = below

    def within(self, value: int, radius: int) -> list[int]:
        """Nodes at most ``radius`` away."""
        found, open_ = [], [0] if self.values else []
        values, children = self.values, self.children
        while open_:
            at = open_.pop()
            distance = (values[at] ^ value).bit_count()
            if distance <= radius:
                found.append(at)
            below = children[at]
            if below:
                for key in range(distance - radius, distance + radius + 1):
                    child = below.get(key)
                    if child is not None:
                        open_.append(child)
        return found


def _stars(tree_side: list[int], query_side: list[int] | None, radius: int) -> Iterator[tuple[int, int]]:
    """Links that join what is within the radius: each fingerprint to the first of its kind, n - 1 at most."""
    tree = BKTree()
    parent = list(range(len(tree_side) + len(query_side or ())))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, value in enumerate(tree_side):
        if query_side is None:
            for j in tree.within(value, radius):
                parent[root(i)] = root(j)
        tree.add(value)
    for i, value in enumerate(query_side or (), len(tree_side)):
        for j in tree.within(value, radius):
            parent[root(i)] = root(j)
    values = tree_side + (query_side or [])
    for i, value in enumerate(values):
        top = root(i)
        if top != i:
            yield value, values[top]


def _search_units(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by unit: the two shards that meet in it, trees first."""

    def links(units: np.ndarray, sides: np.ndarray, values: np.ndarray) -> list[tuple[int, int]]:
        edges = np.flatnonzero((units[1:] != units[:-1]).any(axis=1)) + 1
        out: list[tuple[int, int]] = []
        bounds = np.concatenate(([0], edges, [len(units)])).tolist()
        for a, b in zip(bounds, bounds[1:]):
            if b - a > 1:
                own = values[a:b].tolist()
                alone = units[a, 2] == units[a, 3]
                cut = b - a if alone else int((sides[a:b] == 0).sum())
                out.extend(_stars(own[:cut], None if alone else own[cut:], radius))
        return out

    def batch(out: list[tuple[int, int]]) -> pa.RecordBatch:
        pairs = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    kept: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
    for rows in batches:
        if not rows.num_rows:
            continue
        columns = [rows.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
        units = np.stack([c.astype(np.int64) for c in columns[:4]], axis=1)
        now = (units, columns[4], columns[5].view(np.uint64))
        if kept is not None:
            now = tuple(np.concatenate(x) for x in zip(kept, now))
        units, sides, values = now
        differs = np.flatnonzero((units != units[-1]).any(axis=1))
        cut = int(differs[-1]) + 1 if len(differs) else 0
        if cut:
            yield batch(links(units[:cut], sides[:cut], values[:cut]))
        kept = (units[cut:], sides[cut:], values[cut:])
    if kept is not None:
        yield batch(links(*kept))


def near_links(fingerprints: DataFrame, radius: int = 2, shard_size: int = 4096) -> DataFrame:
    """Links ``a, b`` that join all fingerprints within the radius of each other.

    ``fingerprints`` has one distinct bigint column. Two fingerprints are joined by
    a path of links exactly if a chain of steps within the radius joins them.
    """
    value = F.col(fingerprints.columns[0])
    blocks = radius + 2
    cuts = [round(i * BITS / blocks) for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    keys = []
    for i, chosen in enumerate(combinations(range(blocks), 2)):
        mask = sum(masks[c] for c in chosen)
        signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
        keys.append(F.struct(F.lit(i).alias("part"), value.bitwiseAND(F.lit(signed)).alias("bucket")))
    keyed = fingerprints.select(value.alias("value"), F.explode(F.array(*keys)).alias("key")).select("key.*", "value")
    shared = keyed.groupBy("part", "bucket").agg(F.count("*").alias("n")).where("n > 1")
    shards = F.ceil(F.col("n") / shard_size).cast("int")
    met = keyed.join(shared, ["part", "bucket"]).select(
        "part", "bucket", "value", shards.alias("shards"),
        F.pmod(F.xxhash64("value"), shards).cast("int").alias("shard"),
    )
    met = met.select("*", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("other"))
    units = met.select(
        "part", "bucket",
        F.least("shard", "other").alias("tree"), F.greatest("shard", "other").alias("query"),
        F.when(F.col("shard") <= F.col("other"), 0).otherwise(1).alias("side"), "value",
    )
    unit = ["part", "bucket", "tree", "query"]
    placed = units.repartition(*unit).sortWithinPartitions(*unit, "side", "value")
    return placed.mapInArrow(lambda batches: _search_units(batches, radius), "a bigint, b bigint")


def near_groups(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = 3,
    radius: int = 2,
    shard_size: int = 4096,
) -> DataFrame:
    """``<id>, fingerprint, component_id`` of every row; the last is the smallest id reachable over links.

    A null or blank text has fingerprint zero and is linked like any other. Repeated
    rows stay and share a component. A null id stays; it names no component unless all
    ids of the component are null, and then that is null. An empty table gives an empty
    one. Other columns of the input, whatever their names, play no part.
    """
    marked = cut_lineage(
        documents.select(F.col(id_column).alias("_id"), fingerprint(F.col(text_column), words).alias("fingerprint"))
    )
    return marked.join(component_table(marked, "_id", radius, shard_size), "fingerprint").select(
        F.col("_id").alias(id_column), "fingerprint", "component_id"
    )


def component_table(marked: DataFrame, id_column: str, radius: int = 2, shard_size: int = 4096) -> DataFrame:
    """``fingerprint, component_id`` of every distinct fingerprint; the id may be of any type that has an order."""
    distinct = cut_lineage(marked.groupBy("fingerprint").agg(F.min(id_column).alias("_least")))
    roots = components(near_links(distinct.select("fingerprint"), radius, shard_size))
    placed = distinct.join(roots, distinct["fingerprint"] == roots["vertex"], "left").select(
        "fingerprint", "_least", F.coalesce("root", "fingerprint").alias("_root")
    )
    least = placed.groupBy("_root").agg(F.min("_least").alias("component_id"))
    return placed.join(least, "_root").select("fingerprint", "component_id")


def keep_one(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = 3,
    radius: int = 2,
    shard_size: int = 4096,
) -> DataFrame:
    """``documents`` with one row of each component of ``near_groups``: the one with the smallest id, null ids last.

    Rows that are equal in id and text are one row, and all texts without a word, null or not, are
    copies of each other. Columns stay as they are, extra ones too. An empty table gives an empty one.
    """
    key = F.xxhash64(F.col(id_column), F.col(text_column))
    who = F.struct(F.col(id_column).isNull().alias("none"), F.col(id_column).alias("id"), key.alias("key"))
    marked = cut_lineage(documents.select(who.alias("_who"), fingerprint(F.col(text_column), words).alias("fingerprint")))
    least = component_table(marked, "_who", radius, shard_size)
    kept = least.select(F.col("component_id.key").alias("_keep")).distinct()
    found = documents.select(F.struct("*").alias("_row"), key.alias("_key")).join(
        kept, F.col("_key") == F.col("_keep"), "left_semi"
    )
    first = Window.partitionBy("_key").orderBy("_key")
    return found.withColumn("_n", F.row_number().over(first)).where("_n = 1").select("_row.*")

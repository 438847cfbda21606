"""Approximate nearest neighbours by collision counting.

Vectors are projected to single random directions; every block of rows keeps, for each direction,
its projections in sorted order. A query opens a window around its own projection in every
direction and counts how often each vector falls inside. Vectors with enough collisions
are verified by their true distance. Windows grow by virtual rehashing, that is by radius,
until the nearest found lie within the radius, or all of the block is inside. There
is no limit on the number of verified vectors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


@dataclass(frozen=True)
class Settings:
    directions: int = 48
    #: Width of a window for radius 1, and the share of directions in which a vector must collide.
    width: float = 2.7
    threshold: float = 0.62
    #: Growth of the radius from round to round.
    growth: float = 1.2
    #: Rows of one block and queries of one chunk; a task holds one of each.
    block_rows: int = 8192
    chunk_queries: int = 4096
    #: Vectors that the first radius is estimated from.
    sample: int = 1000
    seed: int = 5


def usable(vector: Column) -> Column:
    """Whether a vector is not null, not zero, and has finite components only."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def directions(dimensions: int, settings: Settings) -> np.ndarray:
    return np.random.default_rng(settings.seed).normal(size=(dimensions, settings.directions))


def _first_radius(vectors: np.ndarray) -> float:
    """Half the distance below which one pair in a thousand lies; 1 if all are equal."""
    if len(vectors) < 2:
        return 1.0
    square = (vectors * vectors).sum(axis=1)
    d = np.sqrt(np.maximum(square[:, None] + square[None, :] - 2 * vectors @ vectors.T, 0))
    d = d[np.triu_indices(len(vectors), 1)]
    d = d[d > 1e-9]
    return float(np.quantile(d, 0.001)) / 2 if len(d) else 1.0


class Block:
    """Sorted projections of a block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, lines: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        values = vectors @ lines
        self.order = np.argsort(values, axis=0, kind="stable").T.astype(np.int32).copy()
        self.values = np.take_along_axis(values.T, self.order, axis=1)

    def nearest(self, own: int, query: np.ndarray, centre: np.ndarray, k: int, radius: float, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
        """Places of the ``k`` nearest found and their distances, ties to the smaller id."""
        n, m = len(self.ids), len(self.values)
        count = np.zeros(n, np.int16)
        need = max(1, int(np.ceil(settings.threshold * m)))
        checked = self.ids == own
        low = [int(np.searchsorted(v, c)) for v, c in zip(self.values, centre)]
        high = list(low)
        places, distances = np.zeros(0, np.int64), np.zeros(0)
        while True:
            reach = settings.width * radius / 2
            open_ = False
            for j in range(m):
                values, order = self.values[j], self.order[j]
                a = int(np.searchsorted(values, centre[j] - reach))
                z = int(np.searchsorted(values, centre[j] + reach, "right"))
                if a < low[j]:
                    count[order[a : low[j]]] += 1
                if z > high[j]:
                    count[order[high[j] : z]] += 1
                low[j], high[j] = min(low[j], a), max(high[j], z)
                open_ |= low[j] > 0 or high[j] < n
            new = np.flatnonzero((count >= need) & ~checked)
            if len(new):
                checked[new] = True
                apart = self.vectors[new] - query
                places = np.concatenate((places, new))
                distances = np.concatenate((distances, np.sqrt((apart * apart).sum(axis=1))))
                best = np.lexsort((self.ids[places], distances))[:k]
                places, distances = places[best], distances[best]
            if not open_ or (len(distances) >= k and distances[k - 1] <= radius):
                return places, distances
            radius *= settings.growth


def nearest(
    rows: DataFrame, queries: Column, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding",
    settings: Settings | None = None,
) -> DataFrame:
    """``query_id, rank, <id>, score``: the ``k`` nearest rows found for every row that ``queries`` selects.

    ``score`` is the Euclidean distance in double precision. A row is no neighbour of a query with its own
    id. Null, zero and non-finite vectors take no part, nor do rows without an id, nor vectors
    of another length than the most frequent one. Repeated rows are neighbours each for itself.
    Fewer than ``k`` candidates give fewer rows; an empty table gives none.
    """
    settings = settings or Settings()
    vector = F.col(vector_column).cast("array<double>")
    kept = rows.select(F.col(id_column).cast("bigint").alias("id"), vector.alias("v"), F.coalesce(queries, F.lit(False)).alias("asks"))
    kept = kept.where(F.col("id").isNotNull() & usable(F.col("v")))
    common = kept.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    out = "query_id bigint, q bigint, vec_id bigint, score double"
    if common is None:
        return rows.sparkSession.createDataFrame([], f"query_id bigint, rank int, {id_column} bigint, score double")
    dimensions = int(common["d"])
    kept = cut_lineage(kept.where(F.size("v") == dimensions).withColumn("q", F.xxhash64("id", "v")))
    n, asked = kept.agg(F.count("*"), F.count_if("asks")).first()
    blocks, chunks = max(1, -(-n // settings.block_rows)), max(1, -(-asked // settings.chunk_queries))
    rate = min(1.0, settings.sample / max(1, n))
    drawn = kept.where(F.pmod(F.col("q"), F.lit(1 << 20)) < rate * (1 << 20)).select("v").limit(2 * settings.sample).toArrow()
    radius = _first_radius(np.array(drawn["v"].to_pylist(), float).reshape(-1, dimensions))

    stored = kept.select(
        "id", "v", F.pmod("q", F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"),
    )
    asking = kept.where("asks").dropDuplicates(["id", "q"]).select(
        "id", "v", "q", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.pmod(F.xxhash64("q"), F.lit(chunks)).cast("int").alias("chunk"),
    )

    def matrix(table: pa.Table) -> np.ndarray:
        lists = table["v"].combine_chunks()
        return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)

    def search(data: pa.Table, asks: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = [[], [], [], []]
        if len(data) and len(asks):
            lines = directions(dimensions, settings)
            block = Block(data["id"].to_numpy(), matrix(data), lines)
            wanted = matrix(asks)
            centres = wanted @ lines
            for i, (own, q) in enumerate(zip(asks["id"].to_pylist(), asks["q"].to_pylist())):
                places, distances = block.nearest(own, wanted[i], centres[i], k, radius, settings)
                for part, values in zip(found, (np.full(len(places), own), np.full(len(places), q), block.ids[places], distances)):
                    part.append(values)
        arrays = [np.concatenate(p) if p else np.zeros(0, int) for p in found]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        return pa.table([pa.array(a, t) for a, t in zip(arrays, kinds)], names=["query_id", "q", "vec_id", "score"])

    pairs = stored.groupBy("block", "chunk").cogroup(asking.groupBy("block", "chunk")).applyInArrow(search, out)
    order = Window.partitionBy("query_id", "q").orderBy("score", "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("vec_id").alias(id_column), "score")

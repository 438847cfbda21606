"""Mixing sources to target weights by blocks.

The words of each source, its texts one after the other, are cut into blocks of a fixed
length. A mix is a list of output shards of a fixed number of blocks. For each shard the
number of blocks from every source is drawn; the draws are multinomial given what is left of
each source's target, so all together they meet the targets. The ``t``-th block that is
drawn from a source is block ``p(t)`` of that source, where ``p`` is a pseudorandom permutation of
its block numbers, and blocks are joined by number. A block comes again only after all others have come.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import running_totals
from ..session import cut_lineage
from .words import find_words, mix, steps

_SLOTS_PER_TASK = 1 << 18
#: A word, as Spark's and SQL's patterns write it.
WORD = "[^\\x20\\x09-\\x0D]+"


@dataclass(frozen=True)
class Settings:
    #: Weights of the sources in the order of their names, repeating; a null source comes last.
    weights: tuple[float, ...] = (5, 2, 1)
    #: Words of the mix as a share of all words, and of each source's words at most.
    share: float = 1.5
    most: float = 2.0
    #: Words of a block, and number of output shards.
    block: int = 64
    shards: int = 256
    seed: int = 20


def targets(sizes: list[tuple[str | None, int]], settings: Settings) -> dict[str | None, float]:
    """Words that each source is to give. What a source cannot give is shared by weight among the others."""
    ordered = sorted(sizes, key=lambda s: (s[0] is None, (s[0] or "").encode("utf-32-be")))
    weight = {s: settings.weights[i % len(settings.weights)] for i, (s, _) in enumerate(ordered)}
    limit = {s: settings.most * n for s, n in ordered}
    left, out, open_ = settings.share * sum(n for _, n in ordered), {}, dict(weight)
    while open_:
        total = sum(open_.values())
        over = [s for s, w in open_.items() if left * w / total > limit[s]]
        if not over:
            return out | {s: left * w / total for s, w in open_.items()}
        for s in over:
            out[s] = limit[s]
        left -= sum(limit[s] for s in over)
        for s in over:
            del open_[s]
    return out


def draw_shards(slots: list[int], settings: Settings) -> np.ndarray:
    """Number of blocks from each source (columns) in each output shard; columns add up to ``slots``."""
    rng = np.random.default_rng(settings.seed)
    left = np.array(slots, np.int64)
    out = np.zeros((settings.shards, len(slots)), np.int64)
    for shard in range(settings.shards):
        size = int(left.sum()) // (settings.shards - shard)
        while size:
            # What a nearly finished source cannot give any more is drawn again from the others.
            drawn = np.minimum(rng.multinomial(size, left / left.sum()), left)
            out[shard] += drawn
            left -= drawn
            size -= int(drawn.sum())
    return out


def permute(index: np.ndarray, size: np.ndarray, salt: np.ndarray, rounds: int = 24) -> np.ndarray:
    """A pseudorandom permutation of ``0 .. size - 1`` for each salt, by swap-or-not rounds."""
    x, size, salt = (np.asarray(v).astype(np.uint64) for v in (index, size, salt))
    for i in range(rounds):
        key = mix(salt + np.uint64(2 * i + 1))
        partner = (key % size + size - x) % size
        swap = mix(np.maximum(x, partner) ^ mix(salt + np.uint64(2 * i + 2))) >> np.uint64(63)
        x = np.where(swap == 1, partner, x)
    return x.astype(np.int64)


def _permuted(index: pa.Array, size: pa.Array, salt: pa.Array) -> pa.Array:
    return pa.array(permute(*[c.to_numpy(zero_copy_only=False) for c in (index, size, salt)]))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _row_key(id_column: str, text_column: str, source_column: str) -> Column:
    """What tells rows apart. Rows of two sources are two, even with one id and text."""
    return F.xxhash64(F.col(id_column), F.col(text_column), F.lit("source"), F.col(source_column).cast("string"))


@dataclass(frozen=True)
class Mix:
    #: ``_source, _key, _id, size, begin``: every text and its place in its source's words. Texts without a word share places.
    texts: DataFrame
    #: ``_source, source_size, target, blocks, slots`` by source.
    sources: DataFrame
    #: ``_source, begin, block, first, last, shard, slot``: words ``first .. last - 1`` of a text, drawn as ``slot`` of its source.
    taken: DataFrame


def mix_sources(
    rows: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
    settings: Settings | None = None,
) -> Mix:
    """Draw a mix of ``rows``. The result depends on ids, texts and sources only, so reruns agree.

    A null source is a source of its own, the last one. A null text has no word, and a text without
    one gives nothing. Null ids and repeated rows are texts like others. Without a word
    the mix is empty. Sources are few against texts: one row of each reaches the driver.
    """
    settings = settings or Settings()
    spark = rows.sparkSession
    key = _row_key(id_column, text_column, source_column)
    source = F.col(source_column).cast("string")
    narrow = rows.select(
        # Null keys would not join: a null source gets a name that no other has.
        F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), source)).alias("_source"),
        key.alias("_key"), F.col(id_column).alias("_id"), word_count(F.col(text_column)).alias("size"),
    )
    # Words are counted once: dealing rows out by range reads them twice.
    placed = running_totals(cut_lineage(narrow), ["_source"], ["_id", "_key"], {"_end": F.col("size")})
    texts = cut_lineage(placed.select("_source", "_key", "_id", "size", (F.col("_end") - F.col("size")).alias("begin")))

    sizes = {r[0]: int(r[1]) for r in texts.groupBy("_source").agg(F.sum("size")).collect()}
    named = {s: (None if s == "-" else s[1:]) for s in sizes}
    wanted = targets([(named[s], n) for s, n in sizes.items()], settings)
    table = []
    for s in sorted(sizes):
        blocks = -(-sizes[s] // settings.block)
        slots = round(wanted[named[s]] * blocks / sizes[s]) if sizes[s] else 0
        table.append((s, sizes[s], float(wanted[named[s]]), blocks, min(slots, int(settings.most * blocks))))
    sources = spark.createDataFrame(table, "_source string, source_size bigint, target double, blocks bigint, slots bigint")

    drawn = draw_shards([r[4] for r in table], settings)
    before = np.cumsum(drawn, axis=0) - drawn
    runs = [
        (r[0], r[3], shard, int(before[shard, i]), int(drawn[shard, i]))
        for i, r in enumerate(table) for shard in range(settings.shards) if drawn[shard, i]
    ]
    # A long run is cut before its slots are listed, so no row holds a long list.
    step = 4096
    cut = spark.createDataFrame(runs, "_source string, blocks bigint, shard int, run bigint, n bigint").select(
        "_source", "blocks", "shard", F.explode(F.sequence(F.col("run"), F.col("run") + F.col("n") - 1, F.lit(step).cast("bigint"))).alias("a"),
        (F.col("run") + F.col("n")).alias("z"),
    )
    # The few rows here become many: as many tasks as the slots need, whatever the bytes that come in.
    tasks = 1 + int(drawn.sum()) // _SLOTS_PER_TASK
    slots = cut.repartition(tasks, "_source", "a").select(
        "_source", "blocks", "shard", F.explode(F.sequence("a", F.least(F.col("a") + step, "z") - 1)).alias("slot")
    )
    slots = slots.select(
        "_source", "shard", "slot",
        F.arrow_udf(_permuted, "bigint")(F.col("slot") % F.col("blocks"), F.col("blocks"), F.xxhash64("_source", F.lit(settings.seed))).alias("block"),
    )
    whole = F.col("begin") + F.col("size")
    width = F.lit(settings.block)
    spans = texts.where("size > 0").select(
        "_source", "begin", "size",
        F.explode(F.sequence(F.floor(F.col("begin") / width), F.floor((whole - 1) / width))).alias("block"),
    )
    spans = spans.select(
        "_source", "begin", "block",
        F.greatest(F.col("block") * width - F.col("begin"), F.lit(0)).alias("first"),
        F.least((F.col("block") + 1) * width - F.col("begin"), F.col("size")).alias("last"),
    )
    return Mix(texts, sources, spans.join(slots.hint("merge"), ["_source", "block"]))


def taken_words(mixed: Mix) -> DataFrame:
    """``_id, size, source_size, target, taken`` of every text; ``taken`` counts repeats."""
    words = mixed.taken.groupBy("_source", "begin").agg(F.sum(F.col("last") - F.col("first")).alias("taken"))
    # A text without a word shares its place with the next text, and takes nothing.
    given = mixed.texts.join(words, ["_source", "begin"], "left").join(mixed.sources, "_source")
    return given.select(
        "_id", "size", "source_size", "target",
        F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(0).cast("bigint").alias("taken"),
    )


def _cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """Of each text, the parts between the first and the last word of each span; a whole text stays as it is."""
    out = []
    for part in steps(texts):
        found = find_words(part)
        data = part.buffer.tobytes()
        for i in range(len(part)):
            a, b = int(found.bounds[i]), int(found.bounds[i + 1])
            own = []
            for s in spans[part.first + i].as_py():
                if s["first"] == 0 and s["last"] == b - a:
                    own.append(texts[part.first + i].as_py())
                else:
                    own.append(data[found.starts[a + s["first"]] : found.ends[a + s["last"] - 1]].decode("utf-8"))
            out.append(own)
    return pa.array(out, pa.list_(pa.string()))


def mixed_documents(
    rows: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
    settings: Settings | None = None,
) -> DataFrame:
    """The mix as rows of the same columns: what is taken of each text, neighbouring blocks of one round joined.

    A text that is taken once and whole is one row as it was; one taken twice is two rows.
    Texts without a word are left out: they have nothing to give.
    """
    mixed = mix_sources(rows, id_column, text_column, source_column, settings)
    own = mixed.taken.join(mixed.sources.select("_source", "blocks"), "_source").join(
        mixed.texts.where("size > 0").select("_source", "begin", "_key"), ["_source", "begin"]
    )
    own = own.select(
        "_key", F.struct(F.col("begin"), F.floor(F.col("slot") / F.col("blocks")).alias("round"), "first", "last").alias("s")
    )
    # A text has as many spans as it has blocks, taken twice at most.
    joined = own.groupBy("_key").agg(F.array_sort(F.collect_list("s")).alias("s"))
    kind = "array<struct<begin:bigint,round:bigint,first:bigint,last:bigint>>"
    merged = F.aggregate(
        F.col("s").cast(kind),
        F.array().cast(kind),
        lambda done, s: F.when(
            (F.size(done) > 0)
            & (F.element_at(done, -1)["begin"] == s["begin"])
            & (F.element_at(done, -1)["round"] == s["round"])
            & (F.element_at(done, -1)["last"] == s["first"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        s["begin"].alias("begin"), s["round"].alias("round"),
                        F.element_at(done, -1)["first"].alias("first"), s["last"].alias("last"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
    spans = joined.select(F.col("_key"), merged.alias("_spans"))
    key = _row_key(id_column, text_column, source_column)
    # Equal rows have equal texts, and the spans of all of them: one of them is enough.
    first = Window.partitionBy("_key").orderBy("_key")
    texts = rows.select(key.alias("_key"), F.struct("*").alias("_row")).join(spans, "_key")
    texts = texts.withColumn("_n", F.row_number().over(first)).where("_n = 1")
    parts = texts.select("_row", F.explode(F.arrow_udf(_cut, "array<string>")(F.col(f"_row.{text_column}"), F.col("_spans"))).alias("_part"))
    return parts.select(
        *[F.col("_part").alias(c) if c == text_column else F.col("_row")[c].alias(c) for c in rows.columns]
    )

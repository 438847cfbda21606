"""Repeated passages by sparse suffix arrays.

A suffix of a text's words is retained where the hash of its first words is the least of its
neighbourhood, so the choice depends on content alone and equal passages retain the same
suffixes. All retained suffixes are sorted across the cluster by their first ``anchor`` words, then by all words
around them that a passage of ``least`` words may hold, then by text and place. Suffixes with equal surroundings
are a class, matched to its first; classes that cross partitions are joined by one row per partition.

Suffixes of one run that begin alike but stand in different surroundings may share a passage with some and only
a part of it with others. There the first of each class asks for the windows of ``least`` words in which it is the
least, and equal windows are matched to the first of their kind. So every window of ``least`` words that stands
in two places is matched in all but the earliest. Matches on one diagonal are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .words import find_words, mix, steps, word_hashes

_BASE = np.uint64(0x9FB21C651E98DF25)
_INVERSE = np.uint64(pow(0x9FB21C651E98DF25, -1, 1 << 64))


@dataclass(frozen=True)
class Settings:
    #: Least words of a passage.
    least: int = 50
    #: Words whose hash decides on retention, and neighbourhood in which it is the least.
    gram: int = 8
    window: int = 16

    @property
    def anchor(self) -> int:
        """Words that equal suffixes agree in at least: a passage's first window holds a retained place."""
        return self.least - self.window + 1


class Runs:
    """Hashes of runs of words by differences of prefix sums, so the length costs nothing."""

    def __init__(self, hashes: np.ndarray) -> None:
        power = np.full(len(hashes), _BASE)
        power[:1] = 1
        inverse = np.full(len(hashes), _INVERSE)
        inverse[:1] = 1
        self.prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * np.cumprod(power))))
        self.inverse = np.cumprod(inverse)

    def of(self, n: int) -> np.ndarray:
        """All runs of ``n`` words."""
        if len(self.inverse) < n:
            return np.zeros(0, np.uint64)
        return mix((self.prefix[n:] - self.prefix[:-n]) * self.inverse[: len(self.inverse) - n + 1])

    def between(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Runs that are not empty, of any lengths."""
        return mix((self.prefix[ends] - self.prefix[starts]) * self.inverse[starts])


def _retained(grams: np.ndarray, window: int) -> np.ndarray:
    """For each neighbourhood the place of its least gram, the first of equals."""
    size = max(0, len(grams) - window + 1)
    least = np.zeros(size, np.int64)
    value = grams[:size].copy()
    for i in range(1, window):
        other = grams[i : i + size]
        less = other < value
        value = np.where(less, other, value)
        least[less] = i
    return least + np.arange(size)


#: ``run`` is the same for suffixes that begin alike, ``key`` for those in equal surroundings; ``place`` holds the
#: word and the number of words from there that ``key`` covers.
_SUFFIX = "run bigint, key bigint, doc bigint, place bigint"
_COVER = 6
#: Parts that the rows of one head are joined in.
_PARTS = 32


def _suffixes(batches: Iterator[pa.RecordBatch], settings: Settings) -> Iterator[pa.RecordBatch]:
    """Rows ``text key, text`` to retained suffixes long enough to be matched."""
    anchor, window = settings.anchor, settings.window
    for batch in batches:
        owners_key = batch.column(0).to_numpy()
        for part in steps(batch.column(1)):
            found = find_words(part)
            runs = Runs(word_hashes(part, found))
            keys = runs.of(anchor)
            if not len(keys):
                continue
            # Windows of all texts at once; those that reach into the next text are dropped.
            chosen = _retained(runs.of(settings.gram), window)
            owners = found.owners()
            span = window + settings.gram - 1
            whole = owners[: len(chosen)] == owners[span - 1 : span - 1 + len(chosen)]
            at = np.unique(chosen[whole])
            at = at[at + anchor <= len(owners)]
            at = at[owners[at] == owners[at + anchor - 1]]
            begin, end = found.bounds[owners[at]], found.bounds[owners[at] + 1]
            left, right = np.minimum(window - 1, at - begin), np.minimum(settings.least, end - at)
            around = mix(runs.between(at - left, at + right) + mix((left * 64 + right + 1).astype(np.uint64)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((keys[at] >> np.uint64(24)).view(np.int64)),
                    pa.array(around.view(np.int64)),
                    pa.array(owners_key[part.first + owners[at]]),
                    pa.array(((at - begin) << _COVER | right).astype(np.int64)),
                ],
                ["run", "key", "doc", "place"],
            )


def _windows(batches: Iterator[pa.RecordBatch], settings: Settings) -> Iterator[pa.RecordBatch]:
    """Rows ``text key, text, places`` to windows of ``least`` words whose least place is among those given."""
    least = settings.least
    for batch in batches:
        owners_key = batch.column(0).to_numpy()
        asked = batch.column(2)
        for part in steps(batch.column(1)):
            found = find_words(part)
            runs = Runs(word_hashes(part, found))
            keys = runs.of(least)
            if not len(keys):
                continue
            chosen = _retained(runs.of(settings.gram), settings.window)[: len(keys)]
            owners = found.owners()
            wanted = np.zeros(len(owners), bool)
            for i in range(len(part)):
                wanted[found.bounds[i] + asked[part.first + i].values.to_numpy()] = True
            at = np.flatnonzero(wanted[chosen] & (owners[: len(keys)] == owners[least - 1 :]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((keys[at] >> np.uint64(24)).view(np.int64)),
                    pa.array(keys[at].view(np.int64)),
                    pa.array(owners_key[part.first + owners[at]]),
                    pa.array(((at - found.bounds[owners[at]]) << _COVER | least).astype(np.int64)),
                ],
                ["run", "key", "doc", "place"],
            )


_SORTED = "doc bigint, place bigint, head_doc bigint, head_place bigint, key bigint, side int"


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted suffixes, each compared with the one before and matched to the first of its class.

    The first of a class is matched to itself, and left out if its class is a whole run. Side 1 marks the
    partition's first class, which may have begun in the partition before; one row of side 2 tells how the last
    class began. A partition's first and last run may have more classes elsewhere, so theirs are never left out.
    """
    names = [f.split()[0] for f in _SORTED.split(", ")]
    first_run = first_key = None
    # The class and run that the next batch may go on with, and the first of that run while it is left out.
    run_, key_, head, held = 0, 0, (0, 0), None
    for batch in batches:
        if not batch.num_rows:
            continue
        run, key, doc, place = (batch.column(i).to_numpy() for i in range(4))
        begun = first_run is None
        if begun:
            first_run, first_key = run[0], key[0]
        new_run, new = np.ones(len(run), bool), np.ones(len(run), bool)
        new_run[1:] = run[1:] != run[:-1]
        new_run[0] = begun or run[0] != run_
        new[1:] = key[1:] != key[:-1]
        new[0] = begun or key[0] != key_
        new |= new_run
        begins, of = np.flatnonzero(new), np.cumsum(new)
        head_doc = np.concatenate(([head[0]], doc[begins]))[of]
        head_place = np.concatenate(([head[1]], place[begins]))[of]
        # Runs by number, 0 being the one that the batch before ended with.
        number = np.cumsum(new_run)
        many = np.zeros(number[-1] + 1, bool)
        many[number[new & ~new_run]] = True
        shown = ~new | (run == first_run) | many[number]
        columns = [doc, place, head_doc, head_place, key, (key == first_key).astype(np.int32)]
        columns = [c[shown] for c in columns]
        if held is not None and many[0]:
            more = [held[0], held[1], held[0], held[1], held[2], 0]
            columns = [np.concatenate((np.array([v], c.dtype), c)) for v, c in zip(more, columns)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)
        if number[-1]:
            last = int(np.flatnonzero(new_run)[-1])
            held = None if many[-1] or run[-1] == first_run else (doc[last], place[last], key[last])
        elif many[0]:
            held = None
        run_, key_, head = run[-1], key[-1], (head_doc[-1], head_place[-1])
    if first_run is not None:
        rows = [[0, 0, *head, key_, 2]] if held is None else [[0, 0, *head, key_, 2], [held[0], held[1], held[0], held[1], held[2], 0]]
        kinds = [pa.int64()] * 5 + [pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array([int(v) for v in c], k) for c, k in zip(zip(*rows), kinds)], names)


def _with_heads(batches: Iterator[pa.RecordBatch], begun: dict[int, tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    """All matches, those in the first class of a partition with the head of the whole class."""
    for batch in batches:
        doc, place, head_doc, head_place, key, side = (batch.column(i).to_numpy() for i in range(6))
        head_doc, head_place = head_doc.copy(), head_place.copy()
        for value in np.unique(key[side == 1]):
            doc_, place_ = begun.get(int(value), (None, None))
            if doc_ is not None:
                later = (side == 1) & (key == value) & ((head_doc > doc_) | ((head_doc == doc_) & (head_place > place_)))
                head_doc[later], head_place[later] = doc_, place_
        columns = [doc, place >> _COVER, head_doc, head_place >> _COVER, (place & ((1 << _COVER) - 1)).astype(np.int32)]
        columns[1], columns[3] = columns[1].astype(np.int32), columns[3].astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc", "at", "head_doc", "head_at", "cover"])


def _classes(suffixes: DataFrame) -> DataFrame:
    """``doc, at, head_doc, head_at, cover``: suffixes with the first of their class; a first with itself, if its run has more."""
    # A range of (run, key, doc, place) holds few rows even of a run that is a third of all suffixes.
    order = ["run", "key", "doc", "place"]
    ordered = suffixes.repartitionByRange(*order).sortWithinPartitions(*order)
    runs = cut_lineage(ordered.mapInArrow(_neighbours, _SORTED))
    # One row of each partition tells how its last class began, and of a class over several partitions the first counts.
    begun: dict[int, tuple[int, int]] = {}
    for row in runs.where("side = 2").select("key", "head_doc", "head_place").collect():
        own = (row.head_doc, row.head_place)
        begun[row.key] = min(begun.get(row.key, own), own)
    matched = "doc bigint, at int, head_doc bigint, head_at int, cover int"
    return runs.where("side < 2").mapInArrow(lambda b: _with_heads(b, begun), matched)


_LATER = "doc <> head_doc or at <> head_at"


def _retained_classes(texts: DataFrame, settings: Settings) -> DataFrame:
    return _classes(texts.mapInArrow(lambda b: _suffixes(b, settings), _SUFFIX))


def matched_suffixes(texts: DataFrame, settings: Settings) -> DataFrame:
    """``doc, at, head_doc, head_at, cover``: retained suffixes that stand in the surroundings of an earlier one, and the first of those.

    ``texts`` has a bigint key and a text. Earlier is by key, then by place. Texts of equal keys count as one.
    ``cover`` words are equal from the suffix on, and before it as many as there are, less than ``window``.
    """
    return _retained_classes(texts, settings).where(_LATER)


def _segments(matches: DataFrame) -> DataFrame:
    """Equal spans ``doc, head_doc, shift, first, last`` of one diagonal that touch, as one."""
    one = ["doc", "head_doc", "shift"]
    along = Window.partitionBy(*one).orderBy("first", "last")
    before = F.max("last").over(along.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce(F.col("first") > before, F.lit(False)).cast("int")
    numbered = matches.distinct().withColumn("_apart", apart).withColumn("_n", F.sum("_apart").over(along))
    return numbered.groupBy(*one, "_n").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("_n")


def _spans(matches: DataFrame, left: int) -> DataFrame:
    """Matches as equal spans, which begin up to ``left`` words before the place, as far as the text goes."""
    return matches.where(_LATER).select(
        "doc", "head_doc", (F.col("at") - F.col("head_at")).alias("shift"),
        F.greatest(F.col("at") - left, F.lit(0)).alias("first"), (F.col("at") + F.col("cover")).alias("last"),
    )


def text_key(id_column: str, text_column: str) -> Column:
    return F.xxhash64(F.col(id_column), F.col(text_column))


def repeated_passages(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", settings: Settings | None = None
) -> DataFrame:
    """``_doc, <id>, first, last, of_<id>, of_first, of_last``: passages that also stand in an earlier place.

    Places count words from 0, ``last`` is the one after the passage. Earlier means a text with a smaller
    hash of id and text, or an earlier place of the same text; the earliest place of a passage is in no
    row but as what others repeat. Null and short texts repeat nothing, null ids stay null, rows that are
    equal in id and text count as one, and other columns play no part.
    """
    settings = settings or Settings()
    texts = documents.where(F.col(text_column).isNotNull()).select(
        text_key(id_column, text_column).alias("_doc"), F.col(text_column).alias("_text"), F.col(id_column).alias("_id")
    )
    classes = cut_lineage(_retained_classes(texts.select("_doc", "_text"), settings))
    firsts = classes.where(f"not ({_LATER})").groupBy("doc").agg(F.collect_set("at").alias("_places"))
    asked = texts.select("_doc", "_text").join(firsts, F.col("_doc") == F.col("doc")).select("_doc", "_text", "_places")
    windows = _classes(asked.mapInArrow(lambda b: _windows(b, settings), _SUFFIX))
    spans = _spans(classes, settings.window - 1).union(_spans(windows, 0))
    segments = cut_lineage(_segments(spans).where(F.col("last") - F.col("first") >= settings.least))
    ids = texts.select("_doc", "_id").dropDuplicates(["_doc"])
    # The earliest text of a common passage is the head of very many rows, so heads are spread over parts.
    segments = segments.withColumn("_part", F.pmod(F.xxhash64("doc"), F.lit(_PARTS)))
    heads = segments.select("head_doc").distinct().join(ids.select(F.col("_doc").alias("head_doc"), F.col("_id").alias("of_id")), "head_doc")
    heads = heads.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(_PARTS - 1).cast("bigint"))).alias("_part"))
    named = segments.join(ids.select(F.col("_doc").alias("doc"), F.col("_id").alias("id")), "doc").join(heads, ["head_doc", "_part"])
    return named.select(
        F.col("doc").alias("_doc"), F.col("id").alias(id_column), "first", "last", F.col("of_id").alias(f"of_{id_column}"),
        (F.col("first") - F.col("shift")).alias("of_first"), (F.col("last") - F.col("shift")).alias("of_last"),
    ).distinct()


def _without(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """Each text without the words of its spans and the white space after them; none if no word is left."""
    out = []
    for part in steps(texts):
        found = find_words(part)
        data = part.buffer.tobytes()
        for i in range(len(part)):
            a, b = int(found.bounds[i]), int(found.bounds[i + 1])
            end = int(part.bounds[i + 1])
            at, kept = int(part.bounds[i]), []
            cuts = spans[part.first + i].as_py() or []
            for s in sorted(cuts, key=lambda s: (s["first"], s["last"])):
                begin = int(found.starts[a + s["first"]])
                stop = int(found.starts[a + s["last"]]) if a + s["last"] < b else end
                if begin > at:
                    kept.append(data[at:begin])
                at = max(at, stop)
            kept.append(data[at:end])
            left = b"".join(kept)
            out.append([left.decode("utf-8")] if left.split() or not cuts else [])
    return pa.array(out, pa.list_(pa.string()))


def without_repeats(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", settings: Settings | None = None
) -> DataFrame:
    """``documents`` with every repeated passage left in its earliest place only.

    A document of which no word is left goes; one that had no word before stays. Columns stay as they are.
    """
    found = repeated_passages(documents, id_column, text_column, settings)
    spans = found.groupBy("_doc").agg(F.collect_set(F.struct("first", "last")).alias("_spans"))
    keyed = documents.select(text_key(id_column, text_column).alias("_doc"), F.struct("*").alias("_row"))
    text = F.col(f"_row.{text_column}")
    # What is left comes as a list of one text or none: a filter on it would have Spark cut every text twice.
    left = F.when(F.col("_spans").isNull(), F.array(text)).otherwise(F.arrow_udf(_without, "array<string>")(text, F.col("_spans")))
    cut = keyed.join(spans, "_doc", "left").select("_row", F.explode(left).alias("_left"))
    return cut.select(
        *[F.col("_left").alias(c) if c == text_column else F.col("_row")[c].alias(c) for c in documents.columns]
    )

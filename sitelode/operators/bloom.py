"""Bloom filters of keys, tested where rows are read, before they are shuffled.

The filter is an array of 64-bit words. A key marks a few bits of one word, so a test looks at one word. The array is built by one
aggregate over the keys and handed to the scan as a scalar subquery. Its size is fixed beforehand and bounds what reaches
the driver. A filter with too many keys lets more rows pass, never fewer, so a join behind it gives the same rows
at any filling.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One megabyte: with 800,000 keys, about three of a hundred other keys pass.
WORDS = 1 << 17
_MARKS = 4


def _word_and_mask(key: Column, words: int) -> tuple[Column, Column]:
    spread = F.xxhash64(key, F.lit("marks"))
    one = F.lit(1).cast("bigint")
    marks = [F.call_function("shiftleft", one, F.pmod(F.shiftright(spread, 6 * i), F.lit(64)).cast("int")) for i in range(_MARKS)]
    return F.pmod(F.xxhash64(key), F.lit(words)), reduce(Column.bitwiseOR, marks)


def key_words(keys: DataFrame, key: str, words: int = WORDS) -> DataFrame:
    """One row, one array: the words of the filter. They are combined where the keys are read; null keys are left out."""
    word, mask = _word_and_mask(F.col(key), words)
    marked = keys.filter(F.col(key).isNotNull()).select(word.alias("word"), mask.alias("bits"))
    blank = keys.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    every = marked.unionByName(blank).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    ordered = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return every.agg(F.transform(ordered, lambda w: w["bits"]).alias("words"))


def probable(rows: DataFrame, key: str, wanted: DataFrame, words: int = WORDS) -> DataFrame:
    """The rows whose ``key`` may be among those of ``wanted``, decided in the scan of ``rows``.

    ``wanted`` is read here and again in the join that follows; store it before if it is dear.
    """
    word, mask = _word_and_mask(F.col(key), words)
    held = F.get(key_words(wanted, key, words).scalar(), word.cast("int"))
    return rows.filter(held.bitwiseAND(mask) == mask)

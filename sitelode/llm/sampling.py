"""Bounded samples of rows to fit small models on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Most labels a sample is taken of, and most rows of all labels together.
MAX_LABELS = 1024
MAX_ROWS = 20_000


class TooManyLabels(ValueError):
    """A label column holds more values than a model is fitted for."""


def balanced_sample(
    rows: DataFrame, key: Column, label: str, per_label: int, seed: str, max_labels: int = MAX_LABELS, max_rows: int = MAX_ROWS
) -> DataFrame:
    """About ``per_label`` keys of every label (all, where there are fewer), one row of each, with the hash ``_draw`` that chose it.

    ``key`` is what rows should differ in, such as their text: rows that share it count once, so neither one id on many
    rows nor one text a million times makes the sample large or empty. One narrow pass counts the keys of each label; the choice
    is by a hash of the key and the same in every run. At most ``max_rows`` rows are expected for all labels together; more than
    ``max_labels`` labels raise an error instead of dropping some.
    """
    drawn = rows.withColumn("_draw", F.xxhash64(key, F.lit(seed)))
    sizes = drawn.where(F.col(label).isNotNull()).groupBy(label).agg(F.approx_count_distinct("_draw", 0.02).alias("n"))
    found = {r[0]: max(1, r[1]) for r in sizes.limit(max_labels + 1).collect()}
    if len(found) > max_labels:
        raise TooManyLabels(f"{label} has more than {max_labels} values")
    if not found:
        return drawn.limit(0)
    each = max(1, min(per_label, max_rows // len(found)))
    place = F.pmod("_draw", F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*[x for k, n in sorted(found.items()) for x in (F.lit(k), F.lit(min(1.0, each / n)))])
    chosen = drawn.where(F.col(label).isin(*found) & (place < share[F.col(label)]))
    return chosen.dropDuplicates([label, "_draw"])


def fold(key: Column, folds: int) -> Column:
    """``crc32`` of the key as text, modulo ``folds``."""
    return F.crc32(key.cast("string")) % folds

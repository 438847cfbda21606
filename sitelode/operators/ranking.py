"""Positions and running totals inside groups of any size.

A plain window puts a whole group into one task. Here each group is cut into
ordered slices; slice totals are accumulated first (one small row per slice)
and every slice then counts on from its own offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def running_totals(
    df: DataFrame,
    group: list[str],
    order: list[str],
    totals: dict[str, Column],
    slice_by: Column | None = None,
) -> DataFrame:
    """Add inclusive running sums of ``totals`` in ``order`` within ``group``.

    ``slice_by`` is a number that never falls along ``order`` and of which every
    value covers a bounded number of rows. Without one, rows are range-partitioned
    and the partition is the slice; that placement is checkpointed so that it
    cannot change between its two uses.
    """
    if slice_by is None:
        placed = cut_lineage(df.repartitionByRange(*group, *order).withColumn("_slice", F.spark_partition_id()))
    else:
        placed = df.withColumn("_slice", slice_by)

    keys = [*group, "_slice"]
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(*keys).agg(*[F.sum(c).alias(f"_sum_{n}") for n, c in totals.items()]).select(
        *keys, *[F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0)).alias(f"_before_{n}") for n in totals]
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = placed.select("*", *[F.sum(c).over(inside).alias(f"_local_{n}") for n, c in totals.items()])
    return local.join(offsets, keys).select(
        *df.columns, *[(F.col(f"_local_{n}") + F.col(f"_before_{n}")).alias(n) for n in totals]
    )


def positions(df: DataFrame, group: list[str], order: list[str], name: str, slice_by: Column | None = None) -> DataFrame:
    """Add the 1-based position of each row in its group."""
    return running_totals(df, group, order, {name: F.lit(1).cast("bigint")}, slice_by)

"""Counts of running crawls from a stream of fetches, in any order of arrival.

Each micro-batch is reduced by Spark to slices of visits, a few sums for each crawl and slice, and stored with its visits
under its batch number; a batch that is played again replaces itself. Sums commute, so late visits only add to their
slice, and no task ever holds a crawl's visits. Where a crawl ends is found from the slices, and then
exactly in the visits of the one or two slices where it can be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.ranking import running_totals
from ..plans.progress import TIME_BUDGET_MS, close_crawls
from .batches import read_batches, write_batch, write_batches

#: Input rows, one per fetch; ``is_end`` rows close a crawl and carry no visit of their own.
ARRIVALS = (
    "crawl_id string, visit bigint, has_content boolean, elapsed_ms bigint, is_end boolean, "
    "max_pages bigint, source_total bigint, arrived timestamp"
)
_VISITS_PER_SLICE = 8192


def slices(fetches: DataFrame, visits_per_slice: int = _VISITS_PER_SLICE) -> DataFrame:
    """Sums by crawl and slice; combined where the rows are read, so a hot crawl is many small rows."""
    visit = ~F.col("is_end")
    return fetches.groupBy("crawl_id", F.floor(F.col("visit") / visits_per_slice).alias("slice")).agg(
        F.count_if(visit & F.col("has_content")).alias("pages"),
        F.sum(F.when(visit, F.col("elapsed_ms")).otherwise(0)).alias("ms"),
        F.bool_or("is_end").alias("is_end"),
        F.max("max_pages").alias("max_pages"),
        F.max("source_total").alias("source_total"),
        F.min("arrived").alias("started"),
    )


def store_fetches(batch: DataFrame, batch_id: int, location: str, visits_per_slice: int = _VISITS_PER_SLICE) -> None:
    """What one micro-batch adds; the same batch again changes nothing."""
    placed = batch.withColumn("slice", F.floor(F.col("visit") / visits_per_slice))
    write_batch(placed.filter(~F.col("is_end")).select("crawl_id", "slice", "visit", "has_content", "elapsed_ms"), batch_id, f"{location}/visits")
    # The sums go last: a batch counts once they are there.
    write_batch(slices(batch, visits_per_slice), batch_id, f"{location}/slices")


def count_stream(fetches: DataFrame, location: str, checkpoint: str, available_now: bool = True, visits_per_slice: int = _VISITS_PER_SLICE) -> StreamingQuery:
    """Keep the counts at ``location`` up to date with a stream of ``ARRIVALS``."""
    return write_batches(fetches, lambda batch, n: store_fetches(batch, n, location, visits_per_slice), checkpoint, available_now)


def crawl_counts(spark: SparkSession, location: str, budget_ms: int = TIME_BUDGET_MS, now: Column | None = None) -> DataFrame:
    """``(crawl_id, completed, total, capped, reason, is_closed)`` of every crawl seen so far.

    A crawl is closed by its end row, its page cap or its budget. With ``now``, also by a deadline, ``budget_ms`` after
    its first row arrived; that deadline is set once and does not move with later rows.
    """
    parts = read_batches(spark, f"{location}/slices")
    summed = parts.groupBy("crawl_id", "slice").agg(F.sum("pages").alias("pages"), F.sum("ms").alias("ms"))
    limits = parts.groupBy("crawl_id").agg(
        F.max("max_pages").alias("max_pages"), F.max("source_total").alias("source_total"), F.bool_or("is_end").alias("is_end"),
        F.min("started").alias("started"),
    )
    upto = running_totals(summed, ["crawl_id"], ["slice"], {"pages_upto": F.col("pages"), "ms_upto": F.col("ms")}, slice_by=F.floor(F.col("slice") / 1024))
    upto = upto.join(limits.select("crawl_id", "max_pages"), "crawl_id")
    # The page that fills the cap or passes the budget stands in the first slice that reaches either, or, where only failed
    # fetches passed the budget, at the start of the next slice with a page.
    reached = (F.col("pages_upto") >= F.col("max_pages")) | (F.col("ms_upto") >= budget_ms)
    near = upto.filter(reached & (F.col("pages") > 0)).groupBy("crawl_id").agg(F.min("slice").alias("first"))
    later = upto.filter("pages > 0").join(near, "crawl_id").filter(F.col("slice") > F.col("first")).groupBy("crawl_id").agg(F.min("slice").alias("second"))
    wanted = near.select("crawl_id", F.col("first").alias("slice")).unionByName(later.select("crawl_id", F.col("second").alias("slice")))
    before = upto.join(wanted, ["crawl_id", "slice"]).select(
        "crawl_id", "slice", (F.col("pages_upto") - F.col("pages")).alias("pages_before"), (F.col("ms_upto") - F.col("ms")).alias("ms_before"), "max_pages"
    )
    visits = read_batches(spark, f"{location}/visits").join(before, ["crawl_id", "slice"])
    order = Window.partitionBy("crawl_id", "slice").orderBy("visit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    page_no = F.col("pages_before") + F.sum(F.col("has_content").cast("bigint")).over(order)
    t_ms = F.col("ms_before") + F.sum("elapsed_ms").over(order)
    counted = visits.select("crawl_id", "has_content", "max_pages", page_no.alias("page_no"), t_ms.alias("t_ms")).filter("has_content and page_no <= max_pages")
    over = counted.filter(F.col("t_ms") >= budget_ms).groupBy("crawl_id").agg(F.min("page_no").alias("over_no"))
    total = summed.groupBy("crawl_id").agg(F.sum("pages").alias("pages"))
    late = F.lit(False) if now is None else ~F.col("is_end") & (F.unix_millis(now) - F.unix_millis("started") >= budget_ms)
    ended = limits.join(total, "crawl_id").join(over, "crawl_id", "left").withColumns(
        {
            "full": F.col("over_no").isNull() & (F.col("pages") >= F.col("max_pages")),
            "completed": F.coalesce("over_no", F.least("pages", "max_pages")),
        }
    )
    judged = ended.withColumn("over_budget", F.col("over_no").isNotNull() | (late & ~F.col("full")))
    closed = F.col("is_end") | F.col("full") | F.col("over_budget")
    return close_crawls(judged).select("crawl_id", "completed", "total", "capped", "reason", closed.alias("is_closed"))

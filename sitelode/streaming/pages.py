"""Pages from captures as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.text import has_text
from ..functions.urls import canonical_url, default_prefix, netloc
from ..operators.content import COLUMNS, Extractor
from ..operators.fetch import is_html
from ..operators.scope import in_scope
from .batches import write_batch, write_batches


def page_stream(
    captured: DataFrame,
    extractor: Extractor = COLUMNS,
    arrival: str | None = None,
    horizon: str = "1 day",
) -> DataFrame:
    """One page per canonical URL from a stream of captures: ``(key, source_url, title, description, content)``.

    With an ``arrival`` timestamp column, seen keys are forgotten after ``horizon``
    and state stays bounded; without one every key is remembered, its key alone. Each page is read once. Pages without content
    are dropped first, so a blank capture does not stand in the way of a later full one.
    """
    pages = _read_pages(captured, extractor).withColumn("key", canonical_url(F.col("url")))
    if arrival:
        fresh = pages.withWatermark(arrival, horizon).dropDuplicatesWithinWatermark(["key"])
    else:
        fresh = pages.dropDuplicates(["key"])
    return fresh.select("key", F.col("url").alias("source_url"), "title", "description", "content")


def _read_pages(captured: DataFrame, extractor: Extractor) -> DataFrame:
    """Captured pages that hold content, with it and without their bodies."""
    pages = captured.filter(is_html(F.col("status"), F.col("content_type")))
    read = extractor.read(pages).drop("body")
    # What was read passes through inline(): the filter would else move below the reading, which then ran for the filter and again.
    found = ["title", "description", "content", "content_status"]
    once = read.select(*[c for c in read.columns if c not in found], F.inline(F.array(F.struct(*found))))
    return once.filter((F.col("content_status") == "content") & has_text(F.col("content")))


def crawl_pages(
    captured: DataFrame,
    requests: DataFrame,
    arrival: str,
    extractor: Extractor = COLUMNS,
    period: str = "30 days",
    lateness: str = "1 day",
) -> DataFrame:
    """Pages of every crawl, from a stream or a table of captures with an ``arrival`` time.

    ``requests`` is a table of parsed requests (``crawl_id, url, path_prefix, include_regex, exclude_regex``); captures meet it by
    host and are scoped by each request on that host. Of the spellings of one key in one crawl, the first by
    arrival and then by URL counts, whatever order they come in. Returns ``(crawl_id, key, period, first)``, ``first`` holding
    ``arrived, source_url, title, description, content``.

    As a stream it runs in update mode: a row is sent again when an earlier spelling turns up, and :func:`first_pages` reads what
    counts in the end. State is kept for the keys of one ``period`` and let go once ``lateness`` has passed after it.
    """
    scope = requests.select(
        "crawl_id",
        netloc(F.col("url")).alias("_host"),
        F.coalesce("path_prefix", default_prefix(F.col("url"))).alias("_prefix"),
        F.col("include_regex").alias("_include"),
        F.col("exclude_regex").alias("_exclude"),
    )
    read = _read_pages(captured.withWatermark(arrival, lateness), extractor).withColumn("_host", netloc(F.col("url")))
    inside = in_scope(F.col("url"), F.col("_host"), F.col("_prefix"), F.col("_include"), F.col("_exclude"))
    placed = read.join(scope, "_host").filter(inside)
    page = F.struct(F.col(arrival).alias("arrived"), F.col("url").alias("source_url"), "title", "description", "content")
    found = placed.groupBy("crawl_id", canonical_url(F.col("url")).alias("key"), F.window(arrival, period).alias("period"))
    return found.agg(F.min(page).alias("first")).select("crawl_id", "key", F.col("period.start").alias("period"), "first")


def store_crawl_pages(pages: DataFrame, location: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Keep the pages of a stream at ``location``, each micro-batch under its number."""
    return write_batches(pages, lambda batch, n: write_batch(batch, n, location), checkpoint, available_now, mode="update")


def first_pages(sent: DataFrame) -> DataFrame:
    """Of all rows that :func:`crawl_pages` sent, those that count: ``(crawl_id, key, period, source_url, title, description, content)``."""
    return sent.groupBy("crawl_id", "key", "period").agg(F.min("first").alias("first")).select(
        "crawl_id", "key", "period", "first.source_url", "first.title", "first.description", "first.content"
    )


def write_stream(rows: DataFrame, location: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append a stream to a parquet table; exactly once across restarts of the same checkpoint."""
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(location)

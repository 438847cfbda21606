"""The capture store: every settled capture read once, clustered by fetch key.

Captured bodies are scanned and shuffled once, to settle which capture of a key counts; that shuffle places them by key.
There each body is read once, by the extractor and by the column expressions, and what was read is written in buckets of the
key: references, sitemap entries, title, description, content, and the bodies of API replies. Later steps
join narrow columns, or the content of the pages they keep, without moving the stored rows.

Nothing stored depends on the URL a page was asked by. Pages that several URLs redirect to are stored once; what such a URL
sees is worked out from the key index of redirects when it is looked up.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.links import link_references, resolve_references
from ..functions.urls import host, scheme
from ..operators.content import Extractor
from ..operators.fetch import captures, final_keys, is_html, is_redirect, is_success, through_redirects, unique_captures
from ..operators.guard import guard_hosts
from ..operators.markup import PARSED
from ..session import cut_lineage, read_clustered, store_clustered
from .sitemaps import is_robots, site_file_columns
from .wiki import advertises, endpoint_references, first_endpoint


def read_captures(responses: DataFrame, extractor: Extractor = PARSED, captured_at: str | None = None) -> DataFrame:
    """The rows of the store: one per fetch key, with what one reading of its body tells."""
    settled = unique_captures(captures(responses), captured_at)
    page = is_html(F.col("status"), F.col("content_type"))
    # A usable API reply is JSON, whatever URL it was asked by.
    is_json = is_success(F.col("status")) & F.col("body").rlike(r'\A\s*[\[{"0-9tfn-]')
    marked = settled.withColumns({"is_page": page, "_html": F.when(page, F.col("body"))})
    return extractor.read(marked, "_html").select(
        "fetch_key",
        "url",
        "status",
        "content_type",
        "location",
        "elapsed_ms",
        "is_page",
        F.when(F.col("is_page"), F.col("content_status")).alias("content_status"),
        F.when(F.col("is_page"), link_references(F.col("_html"))).alias("refs"),
        *site_file_columns(any_key=True),
        F.when(advertises(), endpoint_references(F.col("body"))).alias("endpoint_refs"),
        F.when(is_json, F.col("body")).alias("reply"),
        "title",
        "description",
        "content",
    )


@dataclass(frozen=True)
class CaptureStore:
    """A stored table of :func:`read_captures`, and who may see what of it."""

    table: DataFrame
    dns: DataFrame | None = None

    @cached_property
    def allowed(self) -> DataFrame:
        """The stored captures whose scheme and host pass the address guard, all of them without name records."""
        if self.dns is None:
            return self.table
        keyed = self.table.select("fetch_key", scheme(F.col("url")).alias("s"), host(F.col("url")).alias("h"))
        judged = guard_hosts(keyed.select("s", "h").distinct(), self.dns, F.col("s"), F.col("h"))
        blocked = cut_lineage(keyed.join(judged.filter("verdict <> 'ok'"), ["s", "h"], "left_semi").select("fetch_key"))
        return self.table.join(blocked, "fetch_key", "left_anti")

    @cached_property
    def redirects(self) -> DataFrame:
        """The key index ``(fetch_key, final_key)``."""
        return final_keys(self.allowed, self.dns)

    def facts(self) -> DataFrame:
        """What a client sees of every key it may ask by, without content.

        ``fetch_key, status, content_type, elapsed_ms, is_page, content_status, has_content, links, named, children, pages,
        endpoint, body``; a redirecting key answers as its final page does, its links and endpoint resolved against
        itself, and ``body`` is that of JSON replies only.
        """
        plain = self.allowed.filter(~is_redirect()).drop("url", "location", "title", "description", "content")
        led = self.redirects.withColumnRenamed("fetch_key", "asked").join(plain.withColumnRenamed("fetch_key", "final_key"), "final_key")
        seen = plain.unionByName(led.drop("final_key").withColumnRenamed("asked", "fetch_key"))
        key = F.col("fetch_key")
        return seen.select(
            "fetch_key",
            "status",
            "content_type",
            "elapsed_ms",
            "is_page",
            "content_status",
            F.coalesce(F.col("content_status") == "content", F.lit(False)).alias("has_content"),
            resolve_references(F.col("refs"), key).alias("links"),
            F.when(is_robots(key), F.col("named")).alias("named"),
            "children",
            "pages",
            first_endpoint(F.col("endpoint_refs"), key).alias("endpoint"),
            F.col("reply").alias("body"),
        )

    def contents(self, kept: DataFrame) -> DataFrame:
        """``kept`` (with a ``fetch_key``) and the ``title, description, content`` of the page that answers."""
        read = self.allowed.select("fetch_key", "title", "description", "content")
        return through_redirects(kept, self.redirects).join(read, "fetch_key")


def store_captures(
    responses: DataFrame,
    location: str,
    extractor: Extractor = PARSED,
    captured_at: str | None = None,
    dns: DataFrame | None = None,
    buckets: int | None = None,
) -> CaptureStore:
    """Read every capture once and keep what was read at ``location``, in the shared storage of a cluster."""
    rows = read_captures(responses, extractor, captured_at)
    return CaptureStore(store_clustered(rows, "fetch_key", location, buckets), dns)


def open_store(spark: SparkSession, location: str, dns: DataFrame | None = None) -> CaptureStore:
    """A store that an earlier job wrote."""
    return CaptureStore(read_clustered(spark, location), dns)

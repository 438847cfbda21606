"""Breadth-first traversal of captured link graphs, all crawls at once.

The order of a page is ``(depth, trail)``. A trail is eight hex digits per level,
the position of each followed link among the sorted links of its page, so
comparing trails as text gives first-in-first-out order without ranking a level.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.links import extract_links
from ..functions.urls import canonical_url, netloc, without_fragment
from ..session import cut_lineage, store_columns
from .content import COLUMNS, Extractor
from .fetch import is_html
from .scope import in_scope


def graph_columns(extractor: Extractor = COLUMNS) -> list[Column]:
    """What traversal needs of a capture, from its ``fetch_key, status, content_type, body``.

    Links of a blank page are kept, since blank pages are followed but not emitted.
    """
    page = is_html(F.col("status"), F.col("content_type"))
    return [
        page.alias("is_page"),
        F.when(page, extractor.status(F.col("body"))).alias("content_status"),
        F.when(page, extract_links(F.col("body"), F.col("fetch_key"))).alias("links"),
    ]


def link_graph(captured: DataFrame, extractor: Extractor = COLUMNS) -> DataFrame:
    """The captures without their bodies: one scan serves all levels of a traversal.

    Rows are placed by key, so that a stored graph is joined level after level where it lies.
    """
    narrow = captured.select("fetch_key", "elapsed_ms", *graph_columns(extractor))
    return with_content_flag(narrow).repartition("fetch_key")


def with_content_flag(facts: DataFrame) -> DataFrame:
    """``has_content`` from the status an extractor gave."""
    return facts.withColumn("has_content", F.coalesce(F.col("content_status") == "content", F.lit(False)))


def link_edges(graph: DataFrame) -> DataFrame:
    """The graph as one row per link: ``(src_url, pos, dst_url, dst_key)``."""
    return graph.select(F.col("fetch_key").alias("src_url"), F.posexplode("links").alias("pos", "dst_url")).withColumn(
        "dst_key", canonical_url(F.col("dst_url"))
    )


def _link_step() -> Callable[[DataFrame], DataFrame]:
    """In-scope links of one level, one row per crawl and key, earliest trail first."""
    scope = F.col("scope")
    followed = F.col("is_page") & (F.col("depth") < scope["max_depth"])
    allowed = in_scope(
        F.col("url"), scope["host"], scope["path_prefix"], scope["include_regex"], scope["exclude_regex"]
    )
    link = F.struct(
        (F.col("depth") + 1).alias("depth"),
        F.concat("trail", F.lpad(F.hex("pos"), 8, "0")).alias("trail"),
        "url",
        "scope",
    )
    exploded = ["crawl_id", "depth", "trail", "scope", F.posexplode("links").alias("pos", "url")]
    keyed = ["crawl_id", canonical_url(F.col("url")).alias("key"), link.alias("link")]

    def expand(hits: DataFrame) -> DataFrame:
        links = hits.filter(followed).select(*exploded).filter(allowed).select(*keyed)
        # min() combines on the map side, so a link on every page is no hot key.
        first = links.groupBy("crawl_id", "key").agg(F.min("link").alias("link"))
        return first.select("crawl_id", "key", "link.*")

    return expand


def traverse(starts: DataFrame, graph: DataFrame) -> DataFrame:
    """Visit log ``(crawl_id, depth, trail, url, is_page, has_content, elapsed_ms)``.

    ``starts`` holds ``crawl_id, url, path_prefix, include_regex, exclude_regex,
    max_pages, max_depth``, one row per crawl. The graph is joined once per level;
    a crawl that has enough pages stops after the level that completed it, which
    may log visits past its cap but never too few. Levels are stored by column: what tells visited keys does not read the
    links again. The pages of a level are counted once; the counts of crawls are carried from level to level, one small row
    each.
    """
    level = starts.select(
        "crawl_id",
        canonical_url(F.col("url")).alias("key"),
        F.lit(0).alias("depth"),
        F.lit("").alias("trail"),
        "url",
        F.struct(
            netloc(F.col("url")).alias("host"), "path_prefix", "include_regex", "exclude_regex", "max_pages", "max_depth"
        ).alias("scope"),
    )
    deepest = starts.agg(F.max("max_depth")).first()[0]
    if deepest is None:
        deepest = 0

    pages = graph.select("fetch_key", "elapsed_ms", "is_page", "has_content", "links")
    levels: list[DataFrame] = []
    expand = _link_step()
    counts = starts.select("crawl_id", F.lit(0).cast("bigint").alias("pages"), "max_pages")
    for depth in range(deepest + 1):
        hits = store_columns(
            level.withColumn("fetch_key", without_fragment(F.col("url"))).join(pages, "fetch_key", "left").drop("fetch_key"),
            "level",
        )
        levels.append(hits.drop("links"))
        if depth == deepest:
            break
        here = hits.groupBy("crawl_id").agg(F.count_if("has_content").alias("here"))
        counts = cut_lineage(
            counts.join(here, "crawl_id", "inner").select("crawl_id", (F.col("pages") + F.col("here")).alias("pages"), "max_pages")
        )
        # A crawl that found nothing new has no count any more; neither has one that is full.
        going = counts.filter("pages < max_pages").select("crawl_id")
        if going.isEmpty():
            break
        seen = reduce(DataFrame.unionByName, [found.select("crawl_id", "key") for found in levels])
        level = expand(hits.join(going, "crawl_id", "left_semi")).join(seen, ["crawl_id", "key"], "left_anti")
    log = reduce(DataFrame.unionByName, levels)
    return log.select(
        "crawl_id",
        "depth",
        "trail",
        "url",
        F.coalesce("is_page", F.lit(False)).alias("is_page"),
        F.coalesce("has_content", F.lit(False)).alias("has_content"),
        F.coalesce("elapsed_ms", F.lit(0)).alias("elapsed_ms"),
    )

"""Whole crawls: requests and captured responses to pages, progress and rejects."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_text
from ..functions.urls import default_prefix, host, scheme, without_fragment
from ..operators.content import Extractor
from ..operators.docsroot import find_docs_roots
from ..operators.frontier import traverse
from ..operators.guard import guard_hosts
from ..operators.markup import PARSED
from ..session import cut_lineage, scratch_path, store_columns
from ..sources.captures import CaptureStore, store_captures
from ..sources.requests import parse_requests
from ..sources.sitemaps import MAX_SITEMAPS, sitemap_pages, unread_sitemaps
from ..sources.wiki import list_titles, wiki_pages
from .progress import TIME_BUDGET_MS, apply_caps, crawl_summary, page_log, progress_table
from .router import route_requests, wiki_facts


@dataclass
class Harvest:
    """Result tables of one run."""

    pages: DataFrame
    progress: DataFrame
    summary: DataFrame
    rejects: DataFrame


def drop_blocked(captured: DataFrame, dns: DataFrame) -> DataFrame:
    """Captures whose scheme and host pass the address guard.

    They are judged without bodies; the few pairs that fail are then anti-joined.
    """
    parts = {"_scheme": scheme(F.col("url")), "_host": host(F.col("url"))}
    pairs = captured.select(*[c.alias(n) for n, c in parts.items()]).distinct()
    judged = guard_hosts(pairs.select(F.col("_scheme").alias("s"), F.col("_host").alias("h")), dns, F.col("s"), F.col("h"))
    blocked = judged.filter("verdict <> 'ok'").select(F.col("s").alias("_scheme"), F.col("h").alias("_host"))
    return captured.withColumns(parts).join(blocked, list(parts), "left_anti").drop(*parts)


def extract_urls(urls: DataFrame, graph: DataFrame, order: list[str], slice_by: Column | None = None) -> DataFrame:
    """Page log of an explicit URL list ``(crawl_id, <order>, url)``; nothing is traversed."""
    facts = graph.select("fetch_key", "has_content", "elapsed_ms")
    fetched = (
        urls.withColumn("fetch_key", without_fragment(F.col("url")))
        .join(facts, "fetch_key", "left")
        .select(
            "crawl_id",
            *order,
            "url",
            F.coalesce("has_content", F.lit(False)).alias("has_content"),
            F.coalesce("elapsed_ms", F.lit(0)).alias("elapsed_ms"),
        )
    )
    return page_log(fetched, order, slice_by)


def crawl_links(starts: DataFrame, graph: DataFrame) -> DataFrame:
    """Page log of breadth-first crawls from ``starts``."""
    return page_log(traverse(starts, graph), ["depth", "trail"])


def page_rows(kept: DataFrame, store: CaptureStore) -> DataFrame:
    """The kept pages with the content that was read when their captures were stored."""
    return store.contents(kept.withColumn("fetch_key", without_fragment(F.col("url")))).select(
        "crawl_id", "page_no", F.col("url").alias("source_url"), "title", "description", "content"
    )


def harvest(
    requests: DataFrame,
    responses: DataFrame,
    dns: DataFrame | None = None,
    extractor: Extractor = PARSED,
    budget_ms: int = TIME_BUDGET_MS,
    strict: bool = False,
    captured_at: str | None = None,
    max_sitemaps: int | None = MAX_SITEMAPS,
    namespace: int = 0,
) -> Harvest:
    """Run every request against the captured responses.

    ``captured_at`` names a timestamp column of ``responses``; of several captures of a URL the latest counts
    (the first in a fixed order without one). ``max_sitemaps`` caps sub-sitemaps per crawl, None reads all,
    and the summary's ``unread_sitemaps`` counts what was left. ``namespace`` is that of wiki listings.
    Visited pages that the extractor calls malformed are among the rejects.
    """
    parsed, bad_requests = parse_requests(requests)
    parsed = cut_lineage(parsed)
    spark = responses.sparkSession
    store = store_captures(responses, scratch_path(spark, "captures"), extractor, captured_at, dns)
    # Read several times, a few narrow columns at a time.
    facts = store_columns(store.facts(), "facts")
    graph = cut_lineage(facts.select("fetch_key", "elapsed_ms", "is_page", "has_content", "links").repartition("fetch_key"))
    files = facts.filter("named is not null or pages is not null").select("fetch_key", "named", "children", "pages")
    advertised = facts.filter("endpoint is not null").select("fetch_key", "endpoint")

    sitemap = cut_lineage(sitemap_pages(parsed, files, max_sitemaps))
    unread = unread_sitemaps(parsed.select("crawl_id", "url"), files, max_sitemaps)
    routed, not_wikis = route_requests(parsed, wiki_facts(parsed, advertised, facts), sitemap, strict)
    routed = cut_lineage(routed)

    # Wiki route: titles are cut to max_pages first, then scoped.
    wikis = routed.filter("route = 'wiki'")
    titles = cut_lineage(list_titles(wikis.select("crawl_id", "api_url", "max_pages"), facts, namespace))
    replies = store.allowed.select("fetch_key", "status", F.col("reply").alias("body"), "elapsed_ms")
    articles = cut_lineage(wiki_pages(wikis, titles, replies, store.redirects))
    # A malformed article took its time too, but is no page.
    read = ~F.coalesce("malformed", F.lit(False)) & has_text(F.col("content"))
    wiki_log = page_log(articles.withColumn("has_content", read), ["title_no"])
    title_counts = titles.groupBy("crawl_id").agg(F.count("*").alias("title_total"))

    # Sitemap route.
    listed = sitemap.join(routed.filter("route = 'sitemap'").select("crawl_id"), "crawl_id", "left_semi")
    sitemap_log = extract_urls(listed, graph, ["pos", "sub_pos", "loc_pos"])

    # Link route: the start is the docs root where discovery is on.
    linked = routed.filter("route = 'links'")
    roots = find_docs_roots(linked.filter("discover").select("crawl_id", "url"), facts)
    started = linked.join(roots.select("crawl_id", "docs_root"), "crawl_id", "left").withColumn(
        "url", F.coalesce("docs_root", "url")
    )
    starts = started.select(
        "crawl_id",
        "url",
        F.coalesce("path_prefix", default_prefix(F.col("url"))).alias("path_prefix"),
        "include_regex",
        "exclude_regex",
        "max_pages",
        "max_depth",
    )
    visits = cut_lineage(traverse(cut_lineage(starts), graph))
    link_log = page_log(visits, ["depth", "trail"])

    limits = routed.join(title_counts, "crawl_id", "left").select(
        "crawl_id",
        "max_pages",
        F.when(F.col("route") == "wiki", F.coalesce("title_total", F.lit(0)))
        .when(F.col("route") == "sitemap", F.col("sitemap_total"))
        .alias("source_total"),
    )
    html_log = sitemap_log.select("crawl_id", "page_no", "t_ms", "url").unionByName(
        link_log.select("crawl_id", "page_no", "t_ms", "url")
    )
    kept_html = cut_lineage(apply_caps(html_log, limits, budget_ms))
    kept_wiki = cut_lineage(apply_caps(wiki_log, limits, budget_ms))
    clock = ["crawl_id", "page_no", "t_ms", "over_budget"]
    kept = kept_html.select(*clock).unionByName(kept_wiki.select(*clock))

    pages = page_rows(kept_html, store).unionByName(
        kept_wiki.select("crawl_id", "page_no", "source_url", "title", F.lit("").alias("description"), "content")
    )
    malformed = articles.filter("malformed").select("crawl_id", F.col("source_url").alias("url"), F.lit("malformed markup").alias("reason"))
    unreadable = facts.filter("content_status = 'malformed'").select("fetch_key")
    fetched = listed.select("crawl_id", "url").unionByName(visits.select("crawl_id", "url"))
    broken = (
        fetched.withColumn("fetch_key", without_fragment(F.col("url"))).join(unreadable, "fetch_key")
        .select("crawl_id", "url", F.lit("malformed markup").alias("reason")).distinct()
    )
    rejects = bad_requests.unionByName(not_wikis).unionByName(malformed).unionByName(broken)
    summary = crawl_summary(kept, limits).join(unread, "crawl_id", "left").withColumn(
        "unread_sitemaps", F.coalesce("unread", F.lit(0).cast("bigint"))
    )
    return Harvest(pages, progress_table(kept, limits), summary.drop("unread"), rejects)

"""Page URLs from captured robots.txt files and sitemaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.links import named_sitemaps, sitemap_locs
from ..functions.text import SPACE_CHARACTERS
from ..functions.urls import default_prefix, netloc, site_root, without_fragment
from ..operators.fetch import is_success
from ..operators.scope import in_scope
from ..session import cut_lineage

# Fixed value: sub-sitemaps read per crawl.
MAX_SITEMAPS = 50
_CONVENTIONAL = 2**31 - 1  # position of <root>/sitemap.xml, after everything robots.txt names


def looks_like_sitemap(content_type: Column, body: Column) -> Column:
    """The type says XML, or the start of the body does."""
    head = F.lower(F.substring(F.ltrim(body, F.lit(SPACE_CHARACTERS)), 1, 512))
    sniffed = head.startswith("<?xml") | F.contains(head, F.lit("<urlset")) | F.contains(head, F.lit("<sitemapindex"))
    return F.coalesce(F.contains(F.lower(content_type), F.lit("xml")), F.lit(False)) | F.coalesce(sniffed, F.lit(False))


def is_robots(key: Column) -> Column:
    return key.endswith("/robots.txt")


def site_file_columns(any_key: bool = False) -> list[Column]:
    """What robots files and sitemaps say, from a capture's ``fetch_key, status, content_type, body``.

    A sitemap with any ``.xml`` entry is an index and contributes no pages of its own
    when it is a candidate. With ``any_key``, sitemaps are taken from whatever names some, since a robots file
    may be the answer to a redirect; the reader then looks at the requested key.
    """
    success = is_success(F.col("status"))
    is_sitemap = success & looks_like_sitemap(F.col("content_type"), F.col("body"))
    locs = sitemap_locs(F.col("body"))

    def is_xml(u: Column) -> Column:
        return F.lower(u).endswith(".xml")

    names = F.col("body").rlike("(?i)sitemap:") if any_key else is_robots(F.col("fetch_key"))
    return [
        F.when(success & names, named_sitemaps(F.col("body"))).alias("named"),
        F.when(is_sitemap, F.filter(locs, is_xml)).alias("children"),
        F.when(is_sitemap, F.filter(locs, lambda u: ~is_xml(u))).alias("pages"),
    ]


def site_files(captured: DataFrame) -> DataFrame:
    """Robots files and sitemaps in one scan: ``(fetch_key, named, children, pages)``.

    ``named`` is null for all but robots files, the other two for all but sitemaps.
    Bodies stop here; nothing after carries them.
    """
    return captured.select("fetch_key", *site_file_columns()).filter("named is not null or pages is not null")


def robots_entries(bases: DataFrame, files: DataFrame) -> DataFrame:
    """Sitemaps named by each site's robots.txt: ``(crawl_id, pos, url)``."""
    wanted = bases.select("crawl_id", F.concat(site_root(F.col("url")), F.lit("/robots.txt")).alias("fetch_key"))
    named = files.filter("named is not null").select("fetch_key", "named")
    return wanted.join(named, "fetch_key").select("crawl_id", F.posexplode("named").alias("pos", "url"))


def sitemap_candidates(bases: DataFrame, files: DataFrame) -> DataFrame:
    """Robots entries, then the conventional path, each once at its first position."""
    conventional = bases.select(
        "crawl_id",
        F.lit(_CONVENTIONAL).alias("pos"),
        F.concat(site_root(F.col("url")), F.lit("/sitemap.xml")).alias("url"),
    )
    every = robots_entries(bases, files).unionByName(conventional)
    return every.groupBy("crawl_id", "url").agg(F.min("pos").alias("pos"))


def _entries(candidates: DataFrame, files: DataFrame) -> DataFrame:
    """Candidates that were captured, with their children."""
    return candidates.withColumn("fetch_key", without_fragment(F.col("url"))).join(
        files.filter("children is not null").select("fetch_key", "children"), "fetch_key"
    )


def unread_sitemaps(bases: DataFrame, files: DataFrame, max_sitemaps: int | None = MAX_SITEMAPS) -> DataFrame:
    """Sub-sitemaps left beyond the cap: ``(crawl_id, unread)``, for crawls that have any.

    Candidates are opened in order until one yields pages, so those after the winner leave nothing unread.
    """
    entries = _entries(sitemap_candidates(bases, files), files)
    if max_sitemaps is None:
        return entries.limit(0).select("crawl_id", F.lit(0).cast("bigint").alias("unread"))
    winner = _winners(_productive(cut_lineage(_documents(sitemap_candidates(bases, files), files, max_sitemaps)), files))
    opened = entries.join(winner.withColumnRenamed("pos", "won"), "crawl_id", "left").filter("won is null or pos <= won")
    counted = opened.groupBy("crawl_id").agg(F.sum(F.size("children")).alias("n"))
    return counted.filter(F.col("n") > max_sitemaps).select("crawl_id", (F.col("n") - max_sitemaps).alias("unread"))


def _productive(documents: DataFrame, files: DataFrame) -> DataFrame:
    """Documents that hold pages, with them."""
    return documents.join(files.filter(F.size("pages") > 0).select("fetch_key", "pages"), "fetch_key")


def _winners(productive: DataFrame) -> DataFrame:
    """The first candidate of each crawl that yields pages: ``(crawl_id, pos)``."""
    return productive.groupBy("crawl_id").agg(F.min("pos").alias("pos"))


def _documents(candidates: DataFrame, files: DataFrame, max_sitemaps: int | None) -> DataFrame:
    """Documents that contribute pages: ``(crawl_id, pos, sub_pos, fetch_key)``."""
    entries = _entries(candidates, files)
    flat = entries.filter(F.size("children") == 0).select("crawl_id", "pos", F.lit(-1).alias("sub_pos"), "fetch_key")
    if max_sitemaps is None:
        every = entries.select("crawl_id", "pos", F.posexplode("children").alias("sub_pos", "child"))
        return flat.unionByName(every.select("crawl_id", "pos", "sub_pos", without_fragment(F.col("child")).alias("fetch_key")))
    # The cap counts attempts over all candidates of a crawl, so no file needs more than the cap.
    attempt = Window.partitionBy("crawl_id").orderBy("pos", "sub_pos")
    subs = (
        entries.select(
            "crawl_id", "pos", F.posexplode(F.slice("children", 1, max_sitemaps)).alias("sub_pos", "child")
        )
        .withColumn("attempt", F.row_number().over(attempt))
        .filter(F.col("attempt") <= max_sitemaps)
        .select("crawl_id", "pos", "sub_pos", without_fragment(F.col("child")).alias("fetch_key"))
    )
    return flat.unionByName(subs)


def find_sitemap_urls(bases: DataFrame, files: DataFrame, max_sitemaps: int | None = MAX_SITEMAPS) -> DataFrame:
    """Page URLs of each crawl's sitemap: ``(crawl_id, pos, sub_pos, loc_pos, url)``.

    The first candidate that yields pages wins; its order is (pos, sub_pos, loc_pos)
    and repeated URLs stay. ``bases`` holds one ``(crawl_id, url)`` per crawl and
    ``files`` is a stored ``site_files`` table, which is read several times.
    """
    documents = cut_lineage(_documents(sitemap_candidates(bases, files), files, max_sitemaps))
    productive = _productive(documents, files)
    return productive.join(_winners(productive), ["crawl_id", "pos"], "left_semi").select(
        "crawl_id", "pos", "sub_pos", F.posexplode("pages").alias("loc_pos", "url")
    )


def sitemap_pages(requests: DataFrame, files: DataFrame, max_sitemaps: int | None = MAX_SITEMAPS) -> DataFrame:
    """Sitemap URLs inside each request's own scope; the scope never changes which source wins."""
    found = find_sitemap_urls(requests.select("crawl_id", "url"), files, max_sitemaps)
    scope = requests.select(
        "crawl_id",
        netloc(F.col("url")).alias("host"),
        F.coalesce(F.nullif("path_prefix", F.lit("")), default_prefix(F.col("url"))).alias("path_prefix"),
        "include_regex",
        "exclude_regex",
    )
    allowed = in_scope(
        F.col("url"), F.col("host"), F.col("path_prefix"), F.col("include_regex"), F.col("exclude_regex")
    )
    return found.join(scope, "crawl_id").filter(allowed).select(*found.columns)

"""Registered queries: every operator over the given tables or tables derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelode.functions import addresses, entities, globs, links, text, urls, wikiurls
from sitelode.operators import content, docsroot, fetch, frontier, guard, markup, ranking, scope
from sitelode.plans import harvest as whole
from sitelode.plans import progress, router
from sitelode.session import cut_lineage, scratch_path
from sitelode.sources import captures as capture_store
from sitelode.sources import requests, sitemaps, tables, wiki
from sitelode.streaming import batches, counts
from sitelode.streaming import captures as arriving_captures
from sitelode.streaming import pages as page_streams
from sitelode.streaming import progress as progress_streams

from . import derive as d


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tables.read_table(spark, f"{sf_dir}/{name}.parquet")


def _captures(spark: SparkSession, sf_dir: str, text_: str) -> DataFrame:
    return fetch.captures(d.derive(spark, sf_dir, text_))


# --- URLs, links and scope -------------------------------------------------------------


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of every page with their keys and a scope verdict."""
    pages = _table(spark, sf_dir, "pages")
    found = pages.select("page_id", "url", F.explode(links.extract_links(F.col("html"), F.col("url"))).alias("link"))
    nothing = F.lit(None).cast("string")
    return found.select(
        "page_id",
        "link",
        urls.canonical_url(F.col("link")).alias("key"),
        scope.in_scope(F.col("link"), urls.netloc(F.col("url")), F.lit("/t"), nothing, nothing).alias("is_in_scope"),
    )


def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.concat(F.regexp_replace("url", "^https?://", "HTTPS://User@"), F.lit(";v=1"))
    return _table(spark, sf_dir, "pages").select(
        "page_id",
        urls.canonical_url(F.col("url")).alias("key"),
        urls.default_prefix(F.col("url")).alias("prefix"),
        urls.site_root(F.col("url")).alias("root"),
        urls.path(url).alias("odd_path"),
        urls.host(url).alias("odd_host"),
        urls.scheme(url).alias("odd_scheme"),
    )


def resolved_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relative references of every kind against each page's URL."""
    kind = F.col("page_id") % 10
    reference = (
        F.when(kind == 0, F.concat(F.lit("x"), F.col("page_id").cast("string")))
        .when(kind == 1, F.lit("../up?q=1"))
        .when(kind == 2, F.lit("?only=query#f"))
        .when(kind == 3, F.lit("//Other.example/a/../b"))
        .when(kind == 4, F.lit("/abs/./x/../y/"))
        .when(kind == 5, F.lit("../../../../top"))
        .when(kind == 6, F.lit("mailto:a@b"))
        .when(kind == 7, F.lit("HTTP://up.example/Case"))
        .when(kind == 8, F.lit("a//b///c/"))
        .otherwise(F.lit(".."))
    )
    return _table(spark, sf_dir, "pages").select("page_id", urls.resolve_url(F.col("url"), reference).alias("resolved"))


def decoded_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = entities.decode_entities(F.col("html"))
    return (
        _table(spark, sf_dir, "pages")
        .select("page_id", decoded.alias("decoded"))
        .select("page_id", F.length("decoded").cast("bigint").alias("n_chars"), F.md5("decoded").alias("digest"))
    )


def canonical_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First page of every canonical key, over http and https and slash variants."""
    keyed = _table(spark, sf_dir, "pages").select(
        urls.canonical_url(F.regexp_replace("url", "/[0-9]+", "/1")).alias("key"), "page_id"
    )
    return keyed.groupBy("key").agg(F.min("page_id").alias("first_page"), F.count("*").alias("n_pages"))


def asset_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("page_id") % 7
    ending = (
        F.when(kind == 0, F.lit("a.PNG")).when(kind == 1, F.lit("a.jpeg?x=1")).when(kind == 2, F.lit("a.woff2"))
        .when(kind == 3, F.lit("a.txt")).when(kind == 4, F.lit("a.xml/")).when(kind == 5, F.lit("a.tar.gz")).otherwise(F.lit("apdf"))
    )
    full = F.concat(urls.site_root(F.col("url")), F.lit("/"), ending)
    return _table(spark, sf_dir, "pages").select("page_id", scope.is_asset(urls.path(full)).alias("is_asset"))


def glob_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literal lists, and lists that differ by row."""
    page_path = urls.path(F.col("url"))
    own = F.array(F.concat(F.lit("/"), F.regexp_extract("url", "//[^/]+/([a-z]+)/", 1), F.lit("/1?")), F.lit(" "))
    return _table(spark, sf_dir, "pages").select(
        "page_id",
        globs.path_matches(page_path, F.array(F.lit("e?/*"), F.lit("[!a-e]r"))).alias("in_list"),
        globs.path_matches(page_path, F.array(F.lit("*[0-4].html"))).alias("in_class"),
        globs.path_matches(page_path, own).alias("in_own"),
    )


def csv_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma lists, made of the words of each document."""
    listed = text.csv_list(F.regexp_replace("text", r"\.", " , ,"))
    return _table(spark, sf_dir, "documents").select(
        "doc_id", F.size(listed).cast("bigint").alias("n_entries"), F.md5(F.array_join(listed, "|")).alias("digest")
    )


def nonblank_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = F.when(F.col("doc_id") % 3 == 0, F.regexp_replace("text", r"[^ \n]", " ")).otherwise(F.col("text"))
    return _table(spark, sf_dir, "documents").select("doc_id", text.has_text(shown).alias("has_text"))


def blank_line_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread = F.concat(F.lit("\n "), F.replace("text", F.lit(". "), F.lit("\n\n\n\n")), F.lit("  \n"))
    tidy = text.collapse_blank_lines(spread)
    return _table(spark, sf_dir, "documents").select(
        "doc_id", F.length(tidy).cast("bigint").alias("n_chars"), F.md5(tidy).alias("digest")
    )


# --- captures, redirects and the address guard ------------------------------------------


def html_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetch of every listed URL, and whether it answered with a page."""
    captured = fetch.unique_captures(_captures(spark, sf_dir, d.REPEATED_CAPTURES))
    wanted = d.derive(spark, sf_dir, d.SITE_PAGES).select("page_id", "url")
    found = fetch.lookup(wanted, captured)
    return found.select("page_id", fetch.is_html(F.col("status"), F.col("content_type")).alias("is_page"), F.md5("body").alias("digest"))


def guarded_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures that pass the address guard by scheme and host."""
    captured = _captures(spark, sf_dir, d.GUARDED_CAPTURES)
    return whole.drop_blocked(captured, d.derive(spark, sf_dir, d.DNS)).select("page_id", "url")


def redirect_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetch.resolve_redirects(_captures(spark, sf_dir, d.REDIRECT_CAPTURES)).withColumn("hops", F.col("hops").cast("bigint"))


def redirected_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a client gets by every key: pages under their own, and under those that redirect to them, by the key index."""
    captured = _captures(spark, sf_dir, d.REDIRECT_CAPTURES)
    redirects = fetch.final_keys(captured)
    answers = captured.filter(~fetch.is_redirect()).select(F.col("fetch_key").alias("final_key"), "status", F.md5("body").alias("digest"))
    asked = answers.select("final_key", F.col("final_key").alias("fetch_key")).unionByName(redirects)
    return asked.join(answers, "final_key").select("fetch_key", F.col("status").cast("bigint").alias("status"), "digest")


def public_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = d.derive(spark, sf_dir, d.ADDRESSES)
    return names.select("page_id", "host", "ip", addresses.is_public_address(F.col("ip")).alias("is_public"))


def url_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    url = (
        F.when(F.col("page_id") % 10 == 1, F.regexp_replace("url", "^https?", "ftp"))
        .when(F.col("page_id") % 10 == 2, F.lit("https:///nowhere"))
        .when(F.col("page_id") % 10 == 3, F.lit("http://10.1.2.3/x"))
        .when(F.col("page_id") % 10 == 4, F.lit("http://u@[2606:4700::1]:80/x"))
        .otherwise(F.col("url"))
    )
    return guard.guard_urls(pages.select("page_id", url.alias("url")), d.derive(spark, sf_dir, d.DNS))


# --- sitemaps and docs roots -------------------------------------------------------------


def _map_bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = d.derive(spark, sf_dir, d.MAP_SITES).select("root", "map_no").distinct()
    return sites.select(
        F.col("root").alias("crawl_id"),
        F.concat("root", F.when(F.col("map_no") % 2 == 0, F.lit("/docs/start")).otherwise(F.lit(""))).alias("url"),
        F.lit(None).cast("string").alias("path_prefix"),
        F.array().cast("array<string>").alias("include_paths"),
        F.when(F.col("map_no") % 2 == 1, F.array(F.lit("blog/a1*"))).otherwise(F.array().cast("array<string>")).alias("exclude_paths"),
    )


def _site_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_lineage(sitemaps.site_files(_captures(spark, sf_dir, d.SITEMAP_CAPTURES)))


def robots_sitemaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sitemaps.robots_entries(_map_bases(spark, sf_dir).select("crawl_id", "url"), _site_files(spark, sf_dir))
    return found.select("crawl_id", F.col("pos").cast("bigint").alias("pos"), "url")


def sitemap_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sitemaps.sitemap_candidates(_map_bases(spark, sf_dir).select("crawl_id", "url"), _site_files(spark, sf_dir))
    return found.select("crawl_id", "url", F.col("pos").cast("bigint").alias("pos"))


def sitemap_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = sitemaps.site_files(_captures(spark, sf_dir, d.SITEMAP_CAPTURES)).filter("pages is not null")
    return files.select(
        "fetch_key", F.size("children").cast("bigint").alias("n_children"), F.size("pages").cast("bigint").alias("n_pages"),
        F.array_join("pages", " ").alias("pages"),
    )


def sitemap_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sitemaps.find_sitemap_urls(_map_bases(spark, sf_dir).select("crawl_id", "url"), _site_files(spark, sf_dir))
    return found.select("crawl_id", *[F.col(c).cast("bigint").alias(c) for c in ("pos", "sub_pos", "loc_pos")], "url")


def sitemap_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    bases = scope.compile_globs(_map_bases(spark, sf_dir))
    found = sitemaps.sitemap_pages(bases, _site_files(spark, sf_dir))
    return found.select("crawl_id", "url")


def docs_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docsroot.find_docs_roots(d.derive(spark, sf_dir, d.ROOT_BASES), _captures(spark, sf_dir, d.ROOT_CAPTURES))


# --- traversal ---------------------------------------------------------------------------


def _starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts = d.derive(spark, sf_dir, d.SITE_STARTS).withColumns(
        {
            "include_paths": F.array().cast("array<string>"),
            "exclude_paths": F.when(F.col("excludes"), F.array(F.lit("docs/de/*"), F.lit("docs/es/p1*"))),
        }
    )
    return cut_lineage(scope.compile_globs(starts))


def _graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_lineage(frontier.link_graph(_captures(spark, sf_dir, d.SITE_CAPTURES)))


def bfs_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Followable links of every captured page of a site."""
    graph = frontier.link_graph(_captures(spark, sf_dir, d.SITE_CAPTURES))
    edges = frontier.link_edges(graph)
    nothing = F.lit(None).cast("string")
    inside = scope.in_scope(F.col("dst_url"), urls.netloc(F.col("src_url")), F.lit("/docs/"), nothing, nothing)
    return edges.filter(inside).select("src_url", "dst_url", "dst_key")


def bfs_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of breadth-first crawls of every site, capped and numbered."""
    starts = _starts(spark, sf_dir)
    log = whole.crawl_links(starts, _graph(spark, sf_dir))
    kept = progress.apply_caps(log, starts, budget_ms=2**53)
    return kept.select("crawl_id", F.col("depth").cast("bigint").alias("depth"), "url", "page_no")


def bfs_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every visit of crawls without a page cap, by level."""
    starts = _starts(spark, sf_dir).withColumn("max_pages", F.lit(2**31 - 1))
    log = frontier.traverse(starts, _graph(spark, sf_dir))
    digest = F.conv(F.substring(F.md5("url"), 1, 8), 16, 10).cast("bigint")
    return log.groupBy("crawl_id", F.col("depth").cast("bigint").alias("depth")).agg(
        F.count("*").alias("n_visits"), F.count_if("has_content").alias("n_pages"), F.min("url").alias("first_url"), F.max("url").alias("last_url"),
        F.sum(digest).alias("digest"),
    )


# --- content -----------------------------------------------------------------------------


def extracted_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "html")
    rows = content.extract_columns(pages, "html")
    return rows.select("page_id", "title", "description", F.length("content").cast("bigint").alias("n_chars"), F.md5("content").alias("digest"))


def page_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles and descriptions, with description tags planted in both attribute orders."""
    meta = (
        F.when(F.col("page_id") % 3 == 0, F.concat(F.lit('<meta name="description" content="About &quot;'), F.col("page_id").cast("string"), F.lit('&quot; &amp; more">')))
        .when(F.col("page_id") % 3 == 1, F.concat(F.lit("<META content='On "), F.col("page_id").cast("string"), F.lit("' property=og:description>")))
        .otherwise(F.lit('<meta name="keywords" content="none">'))
    )
    html = F.regexp_replace("html", "</head>", "")
    pages = _table(spark, sf_dir, "pages").select("page_id", F.concat(meta, html).alias("html"))
    return pages.select("page_id", content.page_title(F.col("html")).alias("title"), content.page_description(F.col("html")).alias("description"))


def parsed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested-markup extractor over all pages."""
    rows = markup.extract_parsed(_table(spark, sf_dir, "pages").select("page_id", "html"), "html")
    return rows.select("page_id", "title", "description", F.length("content").cast("bigint").alias("n_chars"), F.md5("content").alias("digest"))


def url_list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An explicit URL list per site, read in order up to the page limit."""
    listed = d.derive(spark, sf_dir, d.SITE_PAGES).select(F.col("site").alias("crawl_id"), F.col("idx").alias("pos"), "url")
    starts = _starts(spark, sf_dir)
    # Positions in a list are dense, so they cut it into slices by themselves.
    log = whole.extract_urls(listed, _graph(spark, sf_dir), ["pos"], slice_by=F.floor(F.col("pos") / 65536))
    kept = progress.apply_caps(log, starts, budget_ms=2**53)
    return kept.select("crawl_id", "page_no", "url", "t_ms")


# --- wikis -------------------------------------------------------------------------------


def _wiki_bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.derive(spark, sf_dir, d.WIKI_BASES)


def wiki_api(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wiki.derive_api(_wiki_bases(spark, sf_dir), wiki.advertised_endpoints(_captures(spark, sf_dir, d.WIKI_CAPTURES)))


def wiki_siteinfo(spark: SparkSession, sf_dir: str) -> DataFrame:
    apis = d.derive(spark, sf_dir, d.WIKI_SITES).select("api_url")
    return wiki.site_info(apis, _captures(spark, sf_dir, d.WIKI_SITEINFO))


def wiki_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wiki.detect_wikis(_wiki_bases(spark, sf_dir), _captures(spark, sf_dir, d.WIKI_CAPTURES))
    return wiki.with_server(found).select("crawl_id", "api_url", "server", "articlepath")


def wiki_reply_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wiki.rejected_replies(_captures(spark, sf_dir, d.WIKI_SITEINFO), "meta=siteinfo")


def wiki_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed titles by following continuations; incomplete lists give none."""
    sites = d.derive(spark, sf_dir, d.WIKI_SITES)
    bases = _wiki_bases(spark, sf_dir).select("crawl_id", "max_pages").join(
        sites.select(F.col("wiki").alias("crawl_id"), "api_url"), "crawl_id"
    )
    return wiki.list_titles(bases, _captures(spark, sf_dir, d.WIKI_LISTINGS))


def wiki_page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = d.derive(spark, sf_dir, d.WIKI_DOCS)
    server = F.concat(F.lit("https://"), "wiki", F.lit("//"))
    return docs.select(
        "doc_id",
        wikiurls.wiki_page_url(server, F.lit("/wiki/$1"), F.col("title")).alias("page_url"),
        wiki.article_request(F.col("api_url"), F.col("title")).alias("request_url"),
    )


def wiki_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered articles in either reply format."""
    found = wiki.article_html(_captures(spark, sf_dir, d.WIKI_ALL_ARTICLES))
    return found.select("fetch_key", F.length("html").cast("bigint").alias("n_chars"), F.md5("html").alias("digest"))


def wiki_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles of all wikis as markdown, scoped after the title limit."""
    captured = _captures(spark, sf_dir, d.WIKI_CAPTURES)
    sites = wiki.detect_wikis(_wiki_bases(spark, sf_dir), captured).join(
        _wiki_bases(spark, sf_dir).select("crawl_id", "max_pages"), "crawl_id"
    )
    scoped = cut_lineage(
        scope.compile_globs(
            sites.withColumns(
                {
                    "path_prefix": F.lit(None).cast("string"),
                    "include_paths": F.array().cast("array<string>"),
                    "exclude_paths": F.array(F.lit("*/sub"), F.lit("*EN_page_1*")),
                }
            )
        )
    )
    titles = cut_lineage(wiki.list_titles(scoped.select("crawl_id", "api_url", "max_pages"), captured))
    rows = wiki.wiki_pages(scoped, titles, captured).filter(text.has_text(F.col("content")))
    return rows.select("crawl_id", "title_no", "source_url", F.length("content").cast("bigint").alias("n_chars"), F.md5("content").alias("digest"))


# --- requests, routing, caps and progress ------------------------------------------------


def crawl_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable, _ = requests.parse_requests(d.derive(spark, sf_dir, d.SITE_REQUESTS))
    return usable.select(
        "crawl_id", "url", "discover", "path_prefix", "strategy", F.array_join("exclude_paths", "|").alias("excluded"),
        *[F.col(c).cast("bigint").alias(c) for c in ("max_pages", "max_depth", "max_concurrency", "request_delay_ms")],
    )


def request_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejects = requests.parse_requests(d.derive(spark, sf_dir, d.SITE_REQUESTS))
    return rejects


_ALL_CAPTURES = f"""
select url, status, content_type, body, location, elapsed_ms from ({d.SITE_CAPTURES}) s
union all select url, status, content_type, body, location, elapsed_ms from ({d.SITEMAP_CAPTURES}) m
union all select url, status, content_type, body, location, elapsed_ms from ({d.WIKI_CAPTURES}) w
"""
_ALL_REQUESTS = f"""
select crawl_id, url, discover, path_prefix, strategy, include_paths, exclude_paths, max_pages, max_depth, max_concurrency, request_delay_ms from ({d.SITE_REQUESTS}) s
union all select root, root || '/docs/x', null, null, null, null, null, 40, null, null, null from (select distinct root from ({d.MAP_SITES}) m) r
union all select crawl_id, url, null, null, 'auto', null, null, max_pages, null, null, null from ({d.WIKI_BASES}) w
"""


def route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Route of every request, rejects included."""
    parsed, _ = requests.parse_requests(d.derive(spark, sf_dir, _ALL_REQUESTS))
    parsed = cut_lineage(parsed)
    store = capture_store.store_captures(d.derive(spark, sf_dir, _ALL_CAPTURES), scratch_path(spark, "captures"), content.COLUMNS)
    facts = cut_lineage(store.facts())
    found = cut_lineage(sitemaps.sitemap_pages(parsed, facts))
    advertised = facts.filter("endpoint is not null")
    routed, rejects = router.route_requests(parsed, router.wiki_facts(parsed, advertised, facts), found)
    return routed.select("crawl_id", "route").unionByName(rejects.select("crawl_id", F.lit("rejected").alias("route")))


def _kept(spark: SparkSession, sf_dir: str, budget_ms: int = 60_000) -> tuple[DataFrame, DataFrame]:
    fetches = d.derive(spark, sf_dir, d.FETCH_LOG)
    limits = cut_lineage(fetches.select("crawl_id", "max_pages", "source_total").distinct())
    log = progress.page_log(
        fetches.select("crawl_id", "visit", "has_content", "elapsed_ms"), ["visit"], slice_by=F.floor(F.col("visit") / 65536)
    )
    return progress.apply_caps(log, limits, budget_ms), limits


def page_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = _kept(spark, sf_dir, 2**53)
    return kept.select("crawl_id", "visit", "page_no")


def time_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = _kept(spark, sf_dir)
    return kept.select("crawl_id", "visit", "page_no", "t_ms", "over_budget")


def crawl_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.crawl_summary(*_kept(spark, sf_dir))


def progress_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All progress messages, with slices short enough to be crossed many times."""
    kept, limits = _kept(spark, sf_dir)
    rows = progress.progress_table(cut_lineage(kept), limits, slice_rows=32)
    return rows.withColumn("seq", F.col("seq").cast("bigint"))


# --- sinks and streams -------------------------------------------------------------------


def _arrive(rows: DataFrame, location: str, by: Column, batches_: int) -> int:
    """Write ``rows`` as files that arrive in so many micro-batches, and say how many files make one.

    There are as many files as a shuffle has partitions, so the files of a batch give all cores work, and more do where the
    input, and with it that number, is larger.
    """
    spark = rows.sparkSession
    rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), by).write.parquet(location)
    return max(1, -(-len(spark.read.schema(rows.schema).parquet(location).inputFiles()) // batches_))


def page_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written by crawl and read back."""
    placed = d.derive(spark, sf_dir, d.SITE_PAGES).select(
        F.col("site").alias("crawl_id"), F.col("idx").alias("page_no"), F.col("url").alias("source_url"), "html"
    )
    pages = cut_lineage(content.extract_columns(placed, "html"))
    location = scratch_path(spark, "pages")
    # Twice, in two halves the second time: a rerun replaces the pages of its crawls and no others.
    first = F.pmod(F.xxhash64("crawl_id"), F.lit(2)) == 0
    tables.write_pages(pages, location)
    tables.write_pages(pages.filter(first), location)
    tables.write_pages(pages.filter(~first), location)
    read = tables.read_stored(spark, location)
    return read.select("crawl_id", "page_no", "source_url", "title", "description", F.md5("content").alias("digest"))


def progress_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All progress messages of all crawls, written twice."""
    location = scratch_path(spark, "progress")
    rows = cut_lineage(progress_snapshots(spark, sf_dir))
    tables.write_progress(rows, location)
    tables.write_progress(rows, location)
    return tables.read_stored(spark, location)


def stream_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures as arriving files, deduplicated by key and extracted as a stream."""
    location, output, state = (scratch_path(spark, n) for n in ("captures", "stream", "state"))
    captured = d.derive(spark, sf_dir, d.SITE_CAPTURES).withColumn("elapsed_ms", F.col("elapsed_ms").cast("bigint"))
    files = _arrive(captured, location, F.col("url"), 2)
    arriving = tables.stream_responses(spark, location, files_per_batch=files)
    page_streams.write_stream(page_streams.page_stream(arriving), output, state).awaitTermination()
    return spark.read.parquet(output).select("key", "title", F.md5("content").alias("digest"))


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The progress messages of all crawls, kept as streaming state."""
    location, output, state = (scratch_path(spark, n) for n in ("fetches", "messages", "state"))
    fetches = d.derive(spark, sf_dir, d.FETCH_LOG).select(
        "crawl_id", "visit", "has_content", "elapsed_ms", F.lit(False).alias("is_end"), "max_pages", "source_total"
    )
    ends = fetches.select("crawl_id", "max_pages", "source_total").distinct().select(
        "crawl_id", F.lit(2**53).alias("visit"), F.lit(False).alias("has_content"), F.lit(0).cast("bigint").alias("elapsed_ms"),
        F.lit(True).alias("is_end"), "max_pages", "source_total",
    )
    rows = fetches.unionByName(ends)
    # Files arrive in the order of visits; the stream stops and resumes from its state in between.
    for low, high in ((0, 8), (8, 40), (40, 2**54)):
        rows.filter((F.col("visit") >= low) & (F.col("visit") < high)).write.mode("append").parquet(location)
        arriving = spark.readStream.schema(progress_streams.FETCHES).parquet(location)
        messages = progress_streams.progress_stream(arriving, budget_ms=60_000, timer=False)
        page_streams.write_stream(messages, output, state).awaitTermination()
    return spark.read.parquet(output).withColumn("seq", F.col("seq").cast("bigint"))


def stream_crawl_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of all requests from captures that arrive as files, in no order and some of them twice under other spellings."""
    location, output, state = (scratch_path(spark, n) for n in ("captures", "stream", "state"))
    captured = d.derive(spark, sf_dir, d.ARRIVING_CAPTURES)
    timed = captured.withColumn("captured_at", F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("second") * 1_000_000)).drop("second")
    files = _arrive(timed, location, F.col("body"), 2)
    asked, _ = requests.parse_requests(d.derive(spark, sf_dir, d.SITE_REQUESTS))
    asked = cut_lineage(scope.compile_globs(asked))
    arriving = spark.readStream.schema(timed.schema).option("maxFilesPerTrigger", files).parquet(location)
    page_streams.store_crawl_pages(page_streams.crawl_pages(arriving, asked, "captured_at"), output, state).awaitTermination()
    found = page_streams.first_pages(batches.read_batches(spark, output))
    return found.select("crawl_id", "key", "source_url", "title", F.md5("content").alias("digest"))


def stream_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The capture of every key that counts, of captures and re-captures that arrive as files."""
    location, output, state = (scratch_path(spark, n) for n in ("captures", "settled", "state"))
    captured = d.derive(spark, sf_dir, d.REPEATED_CAPTURES).withColumn("elapsed_ms", F.col("elapsed_ms").cast("bigint"))
    files = _arrive(captured, location, F.xxhash64("body"), 3)
    arriving_captures.store_arriving(tables.stream_responses(spark, location, files_per_batch=files), output, state).awaitTermination()
    settled = arriving_captures.settled_captures(spark, output)
    return settled.select("fetch_key", "url", "elapsed_ms", F.md5("body").alias("digest"))


def stream_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closing rows of crawls whose fetches arrive in no order, counted by slices."""
    location, output, state = (scratch_path(spark, n) for n in ("fetches", "counts", "state"))
    fetches = d.derive(spark, sf_dir, d.FETCH_LOG).withColumn("arrived", F.lit("2024-01-01").cast("timestamp"))
    rows = fetches.withColumn("is_end", F.lit(False)).select(*[f.split()[0] for f in counts.ARRIVALS.split(", ")])
    files = _arrive(rows, location, F.xxhash64("visit"), 3)
    arriving = spark.readStream.schema(counts.ARRIVALS).option("maxFilesPerTrigger", files).parquet(location)
    counts.count_stream(arriving, output, state, visits_per_slice=16).awaitTermination()
    closed = counts.crawl_counts(spark, output, budget_ms=60_000)
    return closed.select("crawl_id", "completed", "total", "capped", "reason")


def ranked_fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact positions in groups of any size, by range slices."""
    fetches = d.derive(spark, sf_dir, d.FETCH_LOG).select("crawl_id", "elapsed_ms", "visit")
    return ranking.positions(fetches, ["crawl_id"], ["elapsed_ms", "visit"], "position")


def _harvest(spark: SparkSession, sf_dir: str) -> whole.Harvest:
    captured = f"{_ALL_CAPTURES} union all select url, status, content_type, body, location, elapsed_ms from ({d.MAP_PAGES}) p"
    return whole.harvest(d.derive(spark, sf_dir, _ALL_REQUESTS), d.derive(spark, sf_dir, captured), budget_ms=2**53)


def harvested_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole crawls of every site, sitemap and wiki: the pages of all routes in one table."""
    return _harvest(spark, sf_dir).pages.select("crawl_id", "page_no", "source_url", "title", F.md5("content").alias("digest"))


def harvested_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same crawls: pages, totals of their sources, why they ended and what sitemaps were left."""
    summary = _harvest(spark, sf_dir).summary
    return summary.select("crawl_id", "completed", "total", "capped", "reason", "unread_sitemaps")


QUERIES = {
    f.__name__: f
    for f in (
        page_links, url_parts, resolved_urls, decoded_entities, canonical_dedup, asset_filter, glob_filter, csv_parameters,
        nonblank_text, blank_line_collapse, html_responses, guarded_captures, redirect_chain, redirected_responses, public_addresses, url_guard,
        robots_sitemaps, sitemap_candidates, sitemap_files, sitemap_urls, sitemap_pages, docs_root, bfs_edges, bfs_crawl,
        bfs_visits, extracted_pages, page_metadata, parsed_pages, url_list_pages, wiki_api, wiki_siteinfo, wiki_detect,
        wiki_reply_gate, wiki_titles, wiki_page_urls, wiki_articles, wiki_pages, crawl_requests, request_rejects, route,
        page_cap, time_budget, crawl_summary, progress_snapshots, page_sink, progress_sink, stream_pages, stream_progress, stream_crawl_pages, stream_captures,
        stream_summary,
        ranked_fetches, harvested_pages, harvested_summary,
    )
}

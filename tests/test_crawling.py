"""Scope, redirects, guard, sitemaps, docs roots and traversal on small captures."""

import random
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from sitelode import schemas
from sitelode.operators import docsroot, fetch, frontier, guard, scope
from sitelode.plans import harvest as whole
from sitelode.plans import progress
from sitelode.sources import requests, sitemaps

from .conftest import page


def captured(spark, rows):
    return fetch.captures(spark.createDataFrame(rows, schemas.RESPONSES))


def starts(spark, *rows):
    """(crawl_id, url, prefix, exclude, max_pages, max_depth)"""
    made = spark.createDataFrame(
        rows, "crawl_id string, url string, path_prefix string, exclude_paths array<string>, max_pages int, max_depth int"
    ).withColumn("include_paths", F.array().cast("array<string>"))
    return scope.compile_globs(made)


def crawl(spark, rows, *start_rows):
    log = whole.crawl_links(starts(spark, *start_rows), frontier.link_graph(captured(spark, rows)))
    kept = progress.apply_caps(log, starts(spark, *start_rows), budget_ms=2**53)
    out = {}
    for r in kept.orderBy("crawl_id", "page_no").collect():
        out.setdefault(r.crawl_id, []).append(r.url)
    return out


DOCS = [
    page("https://park.test/map/", '<p>r</p><a href="/map/north/">a</a> <a href="/map/south/">b</a> <a href="/shop/">o</a>'),
    page("https://park.test/map/north/", '<p>a</p><a href="/map/north/peak/">deep</a>'),
    page("https://park.test/map/north/peak/", "<p>deep</p>"),
    page("https://park.test/map/south/", "<p>b</p>"),
    page("https://park.test/shop/", "<p>out</p>"),
]
ROOT = "https://park.test/map/"


def test_scope(values):
    nothing = F.lit(None).cast("string")
    inside = lambda c: scope.in_scope(c, F.lit("park.test"), F.lit("/map/"), nothing, nothing)
    assert values(inside, [
        "https://park.test/map/north/", "https://other.example/map/north/", "https://park.test/other/", "https://park.test/map/img.PNG",
        "https://park.test/map/file.pdf", "https://H.example/map/a", "https://park.test:80/map/a", "https://park.test/map/a?x=.pdf",
    ]) == [True, False, False, False, False, False, False, True]


def test_crawl_order_scope_caps_and_depth(spark):
    got = crawl(
        spark, DOCS,
        ("all", ROOT, "/map/", [], 50, 5), ("two", ROOT, "/map/", [], 2, 5), ("shallow", ROOT, "/map/", [], 50, 1),
        ("excluded", ROOT, "/map/", ["map/north/*"], 50, 5), ("none", "https://park.test/missing", "/", [], 50, 5),
    )
    a, b, deep = ROOT + "north/", ROOT + "south/", ROOT + "north/peak/"
    assert got == {"all": [ROOT, a, b, deep], "two": [ROOT, a], "shallow": [ROOT, a, b], "excluded": [ROOT, b]}


def test_slash_variant_is_visited_once_and_blocks_even_when_missing(spark):
    rows = [
        page(ROOT, '<p>r</p><a href="/map/a">1</a><a href="/map/north/">2</a><a href="/map/c">3</a><a href="/map/c/">4</a>'),
        page(ROOT + "a", "<p>a</p>"), page(ROOT + "a/", "<p>a again</p>"), page(ROOT + "c/", "<p>c</p>"),
    ]
    assert crawl(spark, rows, ("x", ROOT, "/map/", [], 50, 5)) == {"x": [ROOT, ROOT + "a"]}


def test_blank_pages_are_followed_but_not_emitted(spark):
    rows = [page(ROOT, '<a href="/map/a"></a>'), page(ROOT + "a", "<p>a</p>", content_type="text/HTML;x")]
    assert crawl(spark, rows, ("x", ROOT, "/map/", [], 50, 5)) == {"x": [ROOT + "a"]}


def level_by_level(pages, start, cap, deepest):
    """Pages in the order of levels, of parents within a level, and of links within a parent; a key counts once."""
    level, found, known = [start], [], set()
    for _ in range(deepest + 1):
        known |= {u.rstrip("/") for u in level}
        found += [u for u in level if pages.get(u, ((), False))[1]]
        links = [k for u in level for k in sorted({urljoin(u, h) for h in pages.get(u, ((), 0))[0]}) if k.startswith("https://g.example/")]
        first = {}
        for k in links:
            first.setdefault(k.rstrip("/"), k)
        level = [u for key, u in first.items() if key not in known]
    return found[:cap]


@pytest.mark.parametrize("seed", [1, 2])
def test_traversal_of_random_graphs_goes_level_by_level(spark, seed):
    rng = random.Random(seed)
    names = [f"/n{i}" + ("/" if i % 3 == 0 else "") for i in range(60)]
    pages, rows = {}, []
    for name in names:
        hrefs = ["/n0/"] + rng.sample(names, k=rng.randint(0, 4))
        hrefs += [h.rstrip("/") for h in hrefs if rng.random() < 0.2]
        shown = rng.random() < 0.8
        body = "".join(f'<a href="{h}"></a>' for h in hrefs) + ("<p>x</p>" if shown else "")
        if rng.random() < 0.9:
            pages["https://g.example" + name] = (hrefs, shown)
            rows.append(page("https://g.example" + name, body))
    wanted = [(f"{cap}-{depth}", "https://g.example/n0/", "/", [], cap, depth) for cap in (3, 17, 500) for depth in (1, 3, 9)]
    expected = {w[0]: level_by_level(pages, w[1], w[4], w[5]) for w in wanted}
    assert crawl(spark, rows, *wanted) == {k: v for k, v in expected.items() if v}


def test_redirects(spark):
    hop = lambda i, to: page(f"https://park.test/{i}", "", 302, location=to)
    rows = [hop(i, f"/{i + 1}") for i in range(7)] + [page("https://park.test/7", "end"), hop("lost", None), hop("loop", "/loop")]
    got = {r.fetch_key[18:]: (r.final_key[18:], r.hops, r.verdict) for r in fetch.resolve_redirects(captured(spark, rows)).collect()}
    assert got["2"] == ("7", 5, "ok") and got["6"] == ("7", 1, "ok")
    assert got["1"][2] == "too_many_redirects" and got["loop"][2] == "too_many_redirects" and "lost" not in got
    seen = {r.fetch_key[18:]: r.body for r in fetch.follow_redirects(captured(spark, rows)).collect()}
    assert seen == {"2": "end", "3": "end", "4": "end", "5": "end", "6": "end", "7": "end", "lost": ""}


def test_guard_checks_every_address_and_every_hop(spark):
    dns = spark.createDataFrame(
        [("ok.example", "8.8.8.8"), ("mixed.example", "8.8.8.8"), ("mixed.example", "10.0.0.1"), ("lan.example", "192.168.0.1")],
        schemas.DNS,
    )
    urls = ["https://OK.example/x", "http://mixed.example/", "ftp://ok.example/", "https:///x", "http://nowhere.example/",
            "http://169.254.169.254/latest", "http://[2606:4700::1]/"]
    got = guard.guard_urls(spark.createDataFrame([(u,) for u in urls], "url string"), dns)
    assert {r.url: r.verdict for r in got.collect()} == dict(zip(urls, [
        "ok", "non_public_address", "unsupported_scheme", "no_host", "unresolved_host", "non_public_address", "ok"]))
    rows = [page("https://ok.example/a", "", 301, location="http://lan.example/"), page("https://ok.example/b", "", 301, location="/c")]
    verdicts = {r.fetch_key[-1]: r.verdict for r in fetch.resolve_redirects(captured(spark, rows), dns).collect()}
    assert verdicts == {"a": "blocked", "b": "ok"}


def urlset(*locs):
    return "<?xml version='1.0'?><urlset>" + "".join(f"<url><loc> {u}\n</loc></url>" for u in locs) + "</urlset>"


def sitemap_of(spark, rows, base="https://park.test/map/"):
    found = sitemaps.find_sitemap_urls(
        spark.createDataFrame([("x", base)], "crawl_id string, url string"), sitemaps.site_files(captured(spark, rows))
    )
    return [r.url for r in found.orderBy("pos", "sub_pos", "loc_pos").collect()]


def test_sitemap_sources(spark):
    h = "https://park.test/"
    flat = page(h + "sitemap.xml", urlset(h + "a", h + "a", h + "b"), content_type="text/plain")
    assert sitemap_of(spark, [flat]) == [h + "a", h + "a", h + "b"]
    robots = page(h + "robots.txt", "User-agent: *\r\n sitemap:  https://park.test/c.xml\r\nSitemap: a b\r\n", content_type="text/plain")
    custom = page(h + "c.xml", urlset(h + "c"), content_type="application/xml")
    assert sitemap_of(spark, [flat, robots, custom]) == [h + "c"]
    assert sitemap_of(spark, [flat, robots, page(h + "c.xml", "<html>spa</html>")]) == [h + "a", h + "a", h + "b"]
    assert sitemap_of(spark, [page(h + "sitemap.xml", "<html>spa</html>")]) == []


def test_sitemap_index_rules(spark):
    h = "https://park.test/"
    index = page(h + "sitemap.xml", urlset(h + "dropped", *[f"{h}s{i}.XML" for i in range(52)]))
    subs = [page(f"{h}s{i}.XML", urlset(f"{h}p{i}?a=1&amp;b", h + "nested.xml")) for i in range(52) if i != 3]
    got = sitemap_of(spark, [index, *subs])
    # No pages of the index itself, no nested index, and fifty attempts, one of them in vain.
    assert got == [f"{h}p{i}?a=1&amp;b" for i in range(50) if i != 3]


def test_scope_is_applied_after_the_source_is_chosen(spark):
    raw = spark.createDataFrame(
        [("x", "https://park.test/map/", True, None, None, None, None, None, None, None, None),
         ("y", "https://park.test", True, "/blog/", None, None, "*/z", None, None, None, None)], schemas.CRAWL_REQUESTS)
    parsed, _ = requests.parse_requests(raw)
    h = "https://park.test/"
    rows = [page(h + "robots.txt", f"Sitemap: {h}c.xml"), page(h + "c.xml", urlset(h + "blog/a", h + "blog/z")),
            page(h + "sitemap.xml", urlset(h + "docs/a"))]
    got = sitemaps.sitemap_pages(parsed, sitemaps.site_files(captured(spark, rows))).collect()
    assert [(r.crawl_id, r.url) for r in got] == [("y", h + "blog/a")]


def test_docs_roots(spark):
    rows = [page(f"https://{n}.example{p}", "ok") for n, p in
            [("a", "/wiki/"), ("a", "/en/docs/"), ("spa", "/docs/"), ("spa", "/no-such-page-probe/")]]
    rows.append(page("https://a.example/docs/", "no", 404))
    bases = [("a", "https://a.example"), ("spa", "https://spa.example/"), ("deep", "https://a.example/x"), ("none", "https://n.example")]
    got = docsroot.find_docs_roots(spark.createDataFrame(bases, "crawl_id string, url string"), captured(spark, rows))
    assert {r.crawl_id: r.docs_root for r in got.collect()} == {
        "a": "https://a.example/en/docs/", "spa": "https://spa.example/", "deep": "https://a.example/x", "none": "https://n.example"}

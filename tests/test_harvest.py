"""Whole crawls, routing, sinks and the page stream."""

import json

import pytest

from sitelode import schemas
from sitelode.plans.harvest import harvest
from sitelode.plans.router import NotAWiki
from sitelode.sources import tables
from sitelode.streaming.pages import page_stream, write_stream

from .conftest import page

W = "https://w.example/w/api.php"


def api(query, body):
    return page(W + query, json.dumps(body), content_type="application/json")


RESPONSES = [
    page("https://h.example/docs/", '<p>root</p><a href="/docs/a/">a</a><a href="/docs/b">b</a><a href="/out/">o</a>'),
    page("https://h.example/docs/a/", "<p>a</p>"),
    page("https://h.example/docs/b", "", 301, location="https://evil.example/x"),
    page("https://evil.example/x", "<p>evil</p>"),
    page("https://s.example/robots.txt", "Sitemap: https://s.example/c.xml\n"),
    page("https://s.example/c.xml", "<?xml?><urlset>" + "".join(f"<loc>https://s.example/p{i}</loc>" for i in range(5)) + "</urlset>"),
    *[page(f"https://s.example/p{i}", f"<article><h1>P{i}</h1></article>") for i in range(1, 4)],
    page("https://s.example/p4", "", 302, location="/p1#x"),
    page("https://w.example/", '<link href="/w/api.php?action=rsd" rel="EditURI">'),
    api("?action=query&meta=siteinfo&siprop=general&format=json", {"query": {"general": {"generator": "MediaWiki 1", "articlepath": "/wiki/$1"}}}),
    api("?action=query&list=allpages&apnamespace=0&aplimit=50&format=json", {"query": {"allpages": [{"title": t} for t in ("Apt", "Pic.png", "Gone", "Skip/x")]}}),
    api("?action=parse&page=Apt&prop=text&formatversion=2&format=json", {"parse": {"text": "<p>apt <b>x</b></p>"}}),
    api("?action=parse&page=Pic.png&prop=text&formatversion=2&format=json", {"parse": {"text": {"*": "<h2>Pic</h2>"}}}),
    api("?action=parse&page=Skip%2Fx&prop=text&formatversion=2&format=json", {"parse": {"text": "skip"}}),
]
DNS = [(f"{n}.example", "8.8.8.8") for n in "hsw"] + [("evil.example", "127.0.0.1")]


def request(crawl_id, url, strategy=None, exclude=None, max_pages=None):
    return (crawl_id, url, None, None, strategy, None, exclude, max_pages, None, None, None)


REQUESTS = [
    request("bare", " https://h.example ", "odd"), request("links", "https://h.example/docs/", "HTML"),
    request("map", "https://s.example", max_pages=2), request("wiki", "https://w.example/", exclude="*/Skip/*"),
    request("blank", "  "), request("wrong", "https://h.example/docs/", "mediawiki"),
]


def run(spark, requests, **options):
    return harvest(
        spark.createDataFrame(requests, schemas.CRAWL_REQUESTS), spark.createDataFrame(RESPONSES, schemas.RESPONSES), **options
    )


def test_harvest_over_all_routes(spark, tmp_path):
    result = run(spark, REQUESTS, dns=spark.createDataFrame(DNS, schemas.DNS))
    tables.write_pages(result.pages, str(tmp_path / "pages"))
    read = tables.read_stored(spark, str(tmp_path / "pages"))
    got = [(r.crawl_id, r.page_no, r.source_url, r.title, r.content) for r in read.orderBy("crawl_id", "page_no").collect()]
    h, s, w = "https://h.example/docs/", "https://s.example/p", "https://w.example/wiki/"
    assert got == [
        ("bare", 1, h, "", "root\n\nabo"), ("bare", 2, h + "a/", "", "a"),
        ("links", 1, h, "", "root\n\nabo"), ("links", 2, h + "a/", "", "a"),
        ("map", 1, s + "1", "P1", "# P1"), ("map", 2, s + "2", "P2", "# P2"),
        ("wiki", 1, w + "Apt", "Apt", "apt **x**"), ("wiki", 2, w + "Pic.png", "Pic.png", "## Pic"),
    ]
    summary = {r.crawl_id: (r.completed, r.total, r.capped, r.reason) for r in result.summary.collect()}
    assert summary == {"bare": (2, 2, False, ""), "links": (2, 2, False, ""), "map": (2, 5, True, "max_pages"), "wiki": (2, 2, False, "")}
    rejects = {r.crawl_id: r.reason for r in result.rejects.collect()}
    assert rejects == {"blank": "url is required", "wrong": "no working wiki API"}
    last = {r.crawl_id: r.completed for r in result.progress.filter("status = 'completed'").collect()}
    assert last == {"bare": 2, "links": 2, "map": 2, "wiki": 2}


def test_redirected_pages_keep_the_requested_url(spark):
    pages = run(spark, [request("map", "https://s.example")]).pages.orderBy("page_no").collect()
    assert [(r.source_url[-2:], r.title) for r in pages] == [("p1", "P1"), ("p2", "P2"), ("p3", "P3"), ("p4", "P1")]


def test_explicit_wiki_on_another_site_raises_when_strict(spark):
    with pytest.raises(NotAWiki):
        run(spark, REQUESTS[-1:], strict=True)


def test_page_stream_equals_batch(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [page(f"https://x.example/{i}" + "/" * (i % 2), f"<p>text {i}</p>") for i in range(10)]
    rows += [page(f"HTTPS://X.example/{i}#again", f"<p>text {i}</p>") for i in range(10)] + [page("https://x.example/no", "<p> </p>"), page("https://x.example/404", "x", 404)]
    spark.createDataFrame(rows, schemas.RESPONSES).repartition(6).write.parquet(source)
    write_stream(page_stream(tables.stream_responses(spark, source, files_per_batch=2)), out, str(tmp_path / "state")).awaitTermination(90)
    got = sorted((r.key, r.content) for r in spark.read.parquet(out).collect())
    assert got == [(f"https://x.example/{i}", f"text {i}") for i in range(10)]

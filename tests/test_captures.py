"""Capture tables as they come: several captures of a URL, literal hosts, listing sizes, broken pages, sinks written twice."""

import json

import pytest
from pyspark.sql import functions as F
from sitelode import schemas
from sitelode.operators import content, fetch, guard, markup
from sitelode.plans import harvest as whole
from sitelode.sources import sitemaps, tables, wiki

from .conftest import page
from .test_harvest import request


def captured(spark, rows):
    return fetch.captures(spark.createDataFrame(rows, schemas.RESPONSES))


def test_one_capture_per_key(spark):
    rows = [page("https://q.example/x#b", "late"), page("https://q.example/x#a", "first"), page("https://q.example/y", "only")]
    rows += [page("https://q.example/z", "twin")] * 3
    got = {r.fetch_key[-1]: r.body for r in fetch.unique_captures(captured(spark, rows)).collect()}
    assert got == {"x": "first", "y": "only", "z": "twin"}
    timed = captured(spark, rows[:2]).withColumn("seen", F.when(F.col("body") == "late", F.lit("2024-02-01")).otherwise(F.lit("2024-01-01")).cast("timestamp"))
    assert [r.body for r in fetch.unique_captures(timed, "seen").collect()] == ["late"]
    assert fetch.unique_captures(captured(spark, [])).count() == 0


def test_guard_judges_literals_and_schemes(spark):
    urls = [
        "http://[::1]/a", "http://[fd12::9]:81/a", "http://me:pw@[2606:4700::7]/a", "ftp://good.example/a", "http://good.example:8080/a",
        "HTTPS://GOOD.example/b", "http://127.0.0.1/a", "http://inner.example/a", "http://unknown.example/a",
    ]
    names = spark.createDataFrame([("good.example", "9.9.9.9"), ("inner.example", "9.9.9.9"), ("inner.example", "::1")], schemas.DNS)
    kept = whole.drop_blocked(captured(spark, [page(u, "x") for u in urls]), names)
    assert {r.url for r in kept.collect()} == {urls[2], urls[4], urls[5]}
    pairs = spark.createDataFrame([("http", "::1"), ("ftp", "good.example"), ("https", "")], "s string, h string")
    verdicts = {r.h: r.verdict for r in guard.guard_hosts(pairs, names, F.col("s"), F.col("h")).collect()}
    assert verdicts == {"::1": "non_public_address", "good.example": "unsupported_scheme", "": "no_host"}


def test_repeated_captures_do_not_repeat_pages(spark):
    link = '<article>one</article><a href="/guide/two">x</a>'
    rows = [page("https://d.example/guide/", link), page("https://d.example/guide/#top", link + "again"), page("https://d.example/guide/two", "<p>two</p>")]
    run = whole.harvest(spark.createDataFrame([request("c", "https://d.example/guide/")], schemas.CRAWL_REQUESTS), spark.createDataFrame(rows * 2, schemas.RESPONSES))
    assert [(r.page_no, r.source_url[-3:]) for r in run.pages.orderBy("page_no").collect()] == [(1, "de/"), (2, "two")]
    assert run.summary.first().completed == 2


def test_broken_pages_are_rejects_and_take_no_number(spark):
    start = '<article>start</article><a href="/a">a</a><a href="/b">b</a>'
    rows = [page("https://e.example/", start), page("https://e.example/a", "<![broken <p>x"), page("https://e.example/b", "<p>b</p>")]
    run = whole.harvest(spark.createDataFrame([request("c", "https://e.example/")], schemas.CRAWL_REQUESTS), spark.createDataFrame(rows, schemas.RESPONSES), extractor=markup.PARSED)
    assert [(r.page_no, r.source_url[-1]) for r in run.pages.orderBy("page_no").collect()] == [(1, "/"), (2, "b")]
    assert [(r.url[-1], r.reason) for r in run.rejects.collect()] == [("a", "malformed markup")]


def test_the_fullest_listing_counts(spark):
    api = "https://k.example/w/api.php"

    def reply(limit, titles, more):
        body = {"query": {"allpages": [{"title": t} for t in titles]}}
        if more:
            body["continue"] = {"apcontinue": more, "continue": "-||"}
        return page(f"{api}?action=query&list=allpages&apnamespace=0&aplimit={limit}&format=json", json.dumps(body), content_type="application/json")

    rows = captured(spark, [reply(2, "AB", "C"), reply(500, "ABCD", None), reply(4, "ABCD", "E")])
    for limit, want in ((4, "ABCD"), (9, "ABCD"), (3, "ABC")):
        wikis = spark.createDataFrame([("c", api, limit)], "crawl_id string, api_url string, max_pages int")
        listed = wiki.list_titles(wikis, rows).orderBy("title_no").collect()
        assert [(r.title_no, r.title) for r in listed] == list(enumerate(want, 1))


def test_sub_sitemaps_past_the_cap_are_counted(spark):
    index = "<sitemapindex>" + "".join(f"<loc>https://n.example/s{i}.xml</loc>" for i in range(6)) + "</sitemapindex>"
    rows = [page("https://n.example/sitemap.xml", index, content_type="text/xml")]
    rows += [page(f"https://n.example/s{i}.xml", f"<urlset><loc>https://n.example/p{i}</loc></urlset>", content_type="text/xml") for i in range(6)]
    files = sitemaps.site_files(captured(spark, rows))
    base = spark.createDataFrame([("c", "https://n.example/")], "crawl_id string, url string")
    assert [sitemaps.find_sitemap_urls(base, files, n).count() for n in (4, None)] == [4, 6]
    assert [[r.unread for r in sitemaps.unread_sitemaps(base, files, n).collect()] for n in (4, 6, None)] == [[2], [], []]


def test_candidates_after_the_winner_leave_nothing_unread(spark):
    def index(n, name):
        return "<sitemapindex>" + "".join(f"<loc>https://n.example/{name}{i}.xml</loc>" for i in range(n)) + "</sitemapindex>"

    rows = [page("https://n.example/robots.txt", "Sitemap: https://n.example/a.xml\nSitemap: https://n.example/b.xml\n")]
    rows += [page("https://n.example/a.xml", index(3, "x"), content_type="text/xml"), page("https://n.example/b.xml", index(9, "y"), content_type="text/xml")]
    base = spark.createDataFrame([("c", "https://n.example/")], "crawl_id string, url string")
    yields = page("https://n.example/x1.xml", "<urlset><loc>https://n.example/p</loc></urlset>", content_type="text/xml")
    for more, unread in (([yields], []), ([], [8])):
        files = sitemaps.site_files(captured(spark, rows + more))
        assert [r.unread for r in sitemaps.unread_sitemaps(base, files, 4).collect()] == unread


PAGE = """<html><head><title>T</title></head><body><nav>menu<nav>inner</nav>tail</nav>
<article><header><h1>Head</h1></header><p>First</p><article>inside</article><p>after</p><header>logo</header></article>
<article><table><tr><td>Name</td><td>Value</td></tr></table><pre>if a:
    b = 1
</pre><p>if a < b then c > d</p></article><footer>foot</footer></body></html>"""


def test_documentation_keeps_its_layout(spark):
    rows = spark.createDataFrame([(PAGE,)], "body string")
    for extractor in (content.COLUMNS, markup.PARSED):
        text = extractor.read(rows).first().content
        assert text.startswith("# Head")
        assert "if a:\n    b = 1" in text and "if a < b then c > d" in text
        assert all(w in text for w in ("First", "inside", "after", "Name | Value"))
        assert not any(w in text for w in ("logo", "menu", "foot"))
        assert rows.select(extractor.status(F.col("body"))).first()[0] == "content"
    assert "tail" not in markup.PARSED.read(rows).first().content


def test_status_agrees_with_what_is_read(spark):
    bodies = ["", "<p> </p>", "<nav>x</nav>", "<p>x</p>", "<![broken", "<header>only</header>", "<h1></h1>", "<pre>\n</pre>", "<td></td><td></td>", None, "&nbsp;"]
    rows = spark.createDataFrame([(b,) for b in bodies], "body string")
    for extractor in (content.COLUMNS, markup.PARSED):
        both = extractor.read(rows.withColumn("s", extractor.status(F.col("body")))).select("s", "content").collect()
        assert all((r.s == "content") == bool(r.content.strip()) for r in both), both


def test_long_headers_do_not_overflow(spark):
    html = "<article><header>" + "<b>x</b>" * 20000 + "</header><p>kept</p></article>"
    rows = spark.createDataFrame([(html,)], "body string")
    assert rows.select(content.page_content(F.col("body"))).first()[0] == "kept"


def test_sinks_replace_crawls_and_no_others(spark, tmp_path):
    schema = "crawl_id string, page_no bigint, source_url string, title string, description string, content string"

    def pages(*crawls, text="x"):
        return spark.createDataFrame([(c, i, "u", "t", "", text) for c in crawls for i in range(3)], schema)

    place = str(tmp_path / "pages")
    tables.write_pages(pages("a", "b", "c"), place, buckets=2)
    tables.write_pages(pages("b", text="new"), place, buckets=2)
    gone = spark.createDataFrame([("c",)], "crawl_id string")
    tables.write_pages(pages("b").limit(0), place, crawls=gone, buckets=2)
    read = tables.read_stored(spark, place).groupBy("crawl_id", "content").count().collect()
    assert {tuple(r) for r in read} == {("a", "x", 3), ("b", "new", 3)}


def test_a_write_that_dies_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    schema = "crawl_id string, page_no bigint, source_url string, title string, description string, content string"
    place = str(tmp_path / "pages")
    rows = spark.createDataFrame([(c, 0, "u", "t", "", "old") for c in "abcdef"], schema)
    tables.write_pages(rows, place, buckets=3)
    before = sorted(map(tuple, tables.read_stored(spark, place).collect()))
    newer = rows.filter("crawl_id < 'd'").withColumn("content", F.lit("new"))

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(tables, "_commit", dies)
        with pytest.raises(RuntimeError):
            tables.write_pages(newer, place, buckets=3)
    assert sorted(map(tuple, tables.read_stored(spark, place).collect())) == before
    failing = newer.withColumn("content", F.raise_error(F.lit("broken row")).cast("string"))
    with pytest.raises(Exception, match="broken row"):
        tables.write_pages(failing, place, buckets=3)
    assert sorted(map(tuple, tables.read_stored(spark, place).collect())) == before
    for _ in range(2):
        tables.write_pages(newer, place, buckets=3)
        got = {r.crawl_id: r.content for r in tables.read_stored(spark, place).collect()}
        assert got == {c: "new" if c < "d" else "old" for c in "abcdef"}
    tables.write_pages(rows.limit(0), str(tmp_path / "empty"))
    assert tables.read_stored(spark, str(tmp_path / "empty")).count() == 0

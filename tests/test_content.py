"""Content, metadata and markdown of pages and wiki fragments."""

import json

from sitelode import schemas
from sitelode.operators import content, fetch, markup
from sitelode.sources import wiki

from .conftest import page

ARTICLE = """<!DOCTYPE html><html><head><meta charset="utf-8"><title>Start &amp; go — Docs</title>
<meta name="description" content="Documentation &mdash; and support."><style>p{}</style><script>var t="</p>";</script></head>
<body><nav><a href="/">Home</a></nav><main><article><!-- ad --><h1>Getting   started</h1><h2>Needs</h2><ul><li>One</li><li>Two <b>bold</b></li></ul>
<p>First &lt;p&gt;.</p><p>Second<br>line.</p><aside>side</aside></article></main><footer>&copy;</footer></body></html>"""


def test_page_columns(spark):
    row = content.extract_columns(spark.createDataFrame([(ARTICLE,)], "body string")).first()
    assert row.title == "Start & go — Docs"
    assert row.description == "Documentation — and support."
    assert row.content == "# Getting started\n\n## Needs\n\n- One\n- Two **bold**\n\nFirst <p>.\n\nSecond\nline."


def test_content_presence_agrees_with_content(values):
    bodies = [ARTICLE, "", None, "<p> </p>", "<p>&nbsp;</p>", "<script>x</script>", "<ul><li></ul>", "plain", "<body><nav>n</nav></body>",
              "&amp;", "<article></article><p>x</p>"]
    shown = values(content.page_content, bodies)
    assert values(content.has_content, bodies) == [bool(c and c.strip()) for c in shown]


def test_metadata_in_any_order_and_fallbacks(values):
    pages = ["<META content='On \"x\"' property=og:description><h1>Head <i>line</i></h1>", "<p>x</p>"]
    assert values(content.page_description, pages) == ['On "x"', ""]
    assert values(content.page_title, pages) == ["Head line", ""]


def test_parsed_extraction_keeps_code_and_nesting(spark):
    html = "<article><h1>T</h1><pre><code>a\n  b</code></pre><ol><li>x<ul><li>y</li></ul></li><li>z</li></ol><nav><div>n</div></nav></article>"
    row = markup.extract_parsed(spark.createDataFrame([(html,)], "body string")).first()
    assert row.content == "# T\n\n```\na\n  b\n```\n\n1. x\n  - y\n2. z"


def test_wiki_fragment_loses_its_furniture(spark):
    fragment = (
        '<section><h3>Rivers<i class="small mw-editsection">change</i></h3>'
        '<ul class="plain navbox"><li>gone<ul><li>gone too</li></ul></li></ul><div class="tocs">stay_here</div>'
        '<p>The <b>Oder</b> meets the <a href="/Warta">Warta</a><img src="map">.</p><span class="noprint">open<div class="metadata">t</div>'
        "</section><p>end</p>"
    )
    rows = markup.wiki_markdown(spark.createDataFrame([(fragment,), (None,)], "html string")).collect()
    assert rows[0].content == "### Rivers\n\nstay\\_here\n\nThe **Oder** meets the Warta.\n\nend"
    assert rows[1].content == "" and not rows[1].malformed


def test_wiki_tables(spark):
    html = "<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table>"
    assert markup.markdown_of(html, ()) == "| a | b |\n| --- | --- |\n| 1 | 2 |"


def listing(titles, token=None, following=None, base="https://w.example/api.php", status=200):
    url = base + "?action=query&list=allpages&apnamespace=0&aplimit=2&format=json" + (f"&apcontinue={token}&continue=-%7C%7C" if token else "")
    body = {"query": {"allpages": titles}}
    if following:
        body["continue"] = {"continue": "-||", "apcontinue": following}
    return page(url, json.dumps(body), status, "application/json")


def titles_of(spark, rows, *limits):
    wikis = spark.createDataFrame([(f"m{m}", "https://w.example/api.php", m) for m in limits], "crawl_id string, api_url string, max_pages int")
    captured = fetch.captures(spark.createDataFrame(rows, schemas.RESPONSES))
    out = {}
    for r in wiki.list_titles(wikis, captured).orderBy("crawl_id", "title_no").collect():
        out.setdefault(r.crawl_id, []).append(r.title)
    return out


def test_titles_follow_continuations(spark):
    batch = lambda *t: [{"title": x} for x in t]
    rows = [listing(batch("A", "B"), following="C"), listing([{"title": "C"}, {"ns": 0}], "C", "D"), listing(batch("D"), "D"),
            listing(batch("stray"), "Z")]
    assert titles_of(spark, rows, 1, 3, 50) == {"m1": ["A"], "m3": ["A", "B", "C"], "m50": ["A", "B", "C", "D"]}
    # A missing reply voids the list, unless enough titles came before it.
    assert titles_of(spark, rows[:1], 2, 3) == {"m2": ["A", "B"]}
    assert titles_of(spark, rows[1:], 3) == {}
    # An empty batch ends the list.
    assert titles_of(spark, [rows[0], listing([], "C", "D"), rows[2]], 50) == {"m50": ["A", "B"]}


def test_long_listings(spark):
    rows = [listing([{"title": f"t{i:03}"}], f"k{i}" if i else None, f"k{i + 1}" if i < 36 else None) for i in range(37)]
    assert titles_of(spark, rows, 30, 99) == {"m30": [f"t{i:03}" for i in range(30)], "m99": [f"t{i:03}" for i in range(37)]}


def test_endpoints_and_site_info(spark):
    info = "?action=query&meta=siteinfo&siprop=general&format=json"
    reply = lambda base, **general: page(base + info, json.dumps({"query": {"general": general}}), content_type="application/json")
    rows = [
        page("https://a.example/wiki/X", '<link rel=icon href="/i.ico"><LINK title=api href=/w/api.php?action=rsd rel = "edituri" >'),
        page("https://b.example", "<html></html>"),
        reply("https://a.example/w/api.php", generator="MediaWiki 9.1-dev", server="//a.example", articlepath="/wiki/$1"),
        reply("https://b.example/api.php", generator="OtherPress 6"),
        reply("https://c.example/x/api.php", generator="a mediawiki"),
        page("https://d.example/api.php" + info, "not json"),
    ]
    bases = [("a", "https://a.example/wiki/X"), ("b", "https://b.example"), ("c", "https://c.example/x/api.php/?q"), ("d", "https://d.example/")]
    frame = spark.createDataFrame(bases, "crawl_id string, url string")
    captured = fetch.captures(spark.createDataFrame(rows, schemas.RESPONSES))
    apis = {r.crawl_id: r.api_url for r in wiki.derive_api(frame, wiki.advertised_endpoints(captured)).collect()}
    assert apis == {"a": "https://a.example/w/api.php", "b": "https://b.example/api.php", "c": "https://c.example/x/api.php/", "d": "https://d.example/api.php"}
    found = wiki.with_server(wiki.detect_wikis(frame.replace("https://c.example/x/api.php/?q", "https://c.example/x/api.php?q"), captured))
    assert {r.crawl_id: (r.server, r.articlepath) for r in found.collect()} == {
        "a": ("https://a.example", "/wiki/$1"), "c": ("https://c.example", "/$1")}
    rejected = wiki.rejected_replies(captured, "meta=siteinfo").collect()
    assert [(r.url, r.reason) for r in rejected] == [("https://d.example/api.php" + info, "not json")]

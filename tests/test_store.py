"""The capture store: bodies scanned, shuffled and read once; redirects as an index; filters before shuffles."""

import re

import pytest
from pyspark.sql import functions as F

from sitelode import schemas
from sitelode.operators import bloom, content, fetch, markup
from sitelode.plans import harvest as whole
from sitelode.sources import captures as store
from sitelode.sources import wiki

from .conftest import page
from .test_harvest import DNS, REQUESTS, RESPONSES


def plan_of(df, capsys):
    df.explain("formatted")
    return capsys.readouterr().out


def moved(plan):
    """Columns that any exchange of a formatted plan carries."""
    details = re.findall(r"^\(\d+\) (?:\w*Exchange)[^\n]*\n(?:Input \[\d+\]: \[([^\]]*)\])", plan, flags=re.M)
    return [set(re.sub(r"#\d+L?", "", columns).split(", ")) for columns in details]


@pytest.fixture
def no_broadcasts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def responses(spark, tmp_path):
    spark.createDataFrame(RESPONSES, schemas.RESPONSES).write.parquet(str(tmp_path / "responses"))
    return spark.read.schema(schemas.RESPONSES).parquet(str(tmp_path / "responses"))


def test_bodies_are_scanned_and_shuffled_once(spark, responses, no_broadcasts, capsys):
    for extractor in (content.COLUMNS, markup.PARSED):
        plan = plan_of(store.read_captures(responses, extractor), capsys)
        assert len(re.findall(r"ReadSchema: struct<[^>]*\bbody:", plan)) == 1
        assert [("body" in columns) for columns in moved(plan)] == [True]
        assert plan.count("ArrowEvalPython") <= 2  # one node, and its line in the details


def test_stored_rows_stay_where_they_lie(spark, responses, no_broadcasts, tmp_path, capsys):
    kept = store.store_captures(responses, str(tmp_path / "store"), dns=spark.createDataFrame(DNS, schemas.DNS))
    asked = spark.createDataFrame([("c", "https://s.example/p4")], "crawl_id string, fetch_key string")
    heavy = {"content", "reply", "body", "refs", "links", "title"}
    for df in (kept.facts().select("fetch_key", "links", "body"), kept.contents(asked)):
        plan = plan_of(df, capsys)
        assert moved(plan) and not any(columns & heavy for columns in moved(plan)), moved(plan)
    wikis = spark.createDataFrame(
        [("w", "https://w.example/w/api.php", "", "/wiki/$1", None, None, None)],
        "crawl_id string, api_url string, server string, articlepath string, path_prefix string, include_regex string, exclude_regex string",
    )
    titles = spark.createDataFrame([("w", 1, "Apt"), ("w", 2, "None")], "crawl_id string, title_no long, title string")
    replies = kept.allowed.select("fetch_key", "status", F.col("reply").alias("body"), "elapsed_ms")
    found = wiki.wiki_pages(wikis, titles, replies, kept.redirects)
    assert not any(columns & {"body", "reply", "html"} for columns in moved(plan_of(found, capsys)))
    assert {r.title: r.content for r in found.collect()} == {"Apt": "apt **x**", "None": ""}
    assert [r.title for r in kept.contents(asked).collect()] == ["P1"]


def test_a_store_opens_in_another_job(spark, responses, tmp_path):
    first = store.store_captures(responses, str(tmp_path / "store"), buckets=3)
    again = store.open_store(spark, str(tmp_path / "store"))
    assert sorted(map(tuple, again.table.collect()), key=repr) == sorted(map(tuple, first.table.collect()), key=repr)
    assert sorted(r.fetch_key for r in again.facts().collect()) == sorted(r.fetch_key for r in first.facts().collect())
    assert {f.rsplit("_", 1)[1].split(".")[0] for f in again.table.inputFiles()} <= {"00000", "00001", "00002"}  # bucket numbers


def test_each_body_is_read_once(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    place = str(log)

    def counted(pages, body="body"):
        @F.pandas_udf("string")
        def note(bodies):
            import os
            import uuid

            with open(os.path.join(place, uuid.uuid4().hex), "w") as out:
                out.writelines(f"{b}\n" for b in bodies if b is not None)
            return bodies

        return markup.extract_parsed(pages.withColumn("_noted", note.asNondeterministic()(F.col(body))), "_noted").drop("_noted")

    extractor = content.Extractor(counted, markup.parsed_status)
    run = whole.harvest(
        spark.createDataFrame(REQUESTS, schemas.CRAWL_REQUESTS), spark.createDataFrame(RESPONSES * 3, schemas.RESPONSES), extractor=extractor
    )
    assert run.pages.count() == 10
    run.rejects.collect()
    read = [line for f in log.iterdir() for line in f.read_text().splitlines() if line]
    html = {r[0]: r[3] for r in RESPONSES if r[1] == 200 and r[2] == "text/html"}
    assert sorted(read) == sorted(line for body in html.values() for line in body.splitlines())


def test_redirects_are_an_index_not_copies(spark, tmp_path):
    big = "<title>Shared</title><a href='next'>n</a>" + "x" * 1000
    rows = [page("https://a.example/deep/target", big), page("https://b.example/robots.txt", "", 301, location="https://a.example/r.txt")]
    rows += [page("https://a.example/r.txt", "Sitemap: https://b.example/s.xml\n", content_type="text/plain")]
    rows += [page(f"https://a.example/to{i}", "", 302, location="/deep/target") for i in range(20)]
    for n in range(8):  # chains of 1 to 7 hops
        for hop in range(n):
            rows.append(page(f"https://c.example/{n}/{hop}", "", 302, location=str(hop + 1)))
        rows.append(page(f"https://c.example/{n}/{n}", f"end {n}"))
    rows += [page("https://d.example/x", "", 302, location="/y"), page("https://d.example/y", "", 302, location="/x"), page("https://d.example/self", "", 302, location="self")]
    kept = store.store_captures(spark.createDataFrame(rows, schemas.RESPONSES), str(tmp_path / "store"))
    assert kept.table.filter(F.col("title") == "Shared").count() == 1
    index = {r.fetch_key: r.final_key for r in kept.redirects.collect()}
    assert all(index[f"https://a.example/to{i}"] == "https://a.example/deep/target" for i in range(20))
    assert all(index.get(f"https://c.example/{n}/0") == (f"https://c.example/{n}/{n}" if n <= 5 else None) for n in range(1, 8))
    assert not any(k.startswith("https://d.example") for k in index)
    facts = {r.fetch_key: r for r in kept.facts().collect()}
    # Links of a redirecting URL are resolved against itself, and its robots file counts as its own.
    assert facts["https://a.example/to3"].links == ["https://a.example/next"]
    assert facts["https://a.example/deep/target"].links == ["https://a.example/deep/next"]
    assert facts["https://b.example/robots.txt"].named == ["https://b.example/s.xml"] and facts["https://a.example/r.txt"].named is None
    verdicts = {r.fetch_key: (r.hops, r.verdict) for r in fetch.resolve_redirects(kept.table).collect()}
    assert verdicts["https://d.example/x"] == (6, "too_many_redirects") == verdicts["https://d.example/self"]
    assert verdicts["https://c.example/7/0"] == (6, "too_many_redirects") and verdicts["https://c.example/7/2"] == (5, "ok")


def test_blocked_hosts_are_neither_pages_nor_targets(spark, tmp_path):
    rows = [page("https://evil.example/a", "x"), page("https://h.example/a", "", 301, location="https://evil.example/a"), page("https://h.example/b", "ok")]
    kept = store.store_captures(spark.createDataFrame(rows, schemas.RESPONSES), str(tmp_path / "s"), dns=spark.createDataFrame(DNS, schemas.DNS))
    assert [r.fetch_key for r in kept.facts().collect()] == ["https://h.example/b"]


def test_filters_pass_all_wanted_rows_and_few_others(spark, tmp_path, no_broadcasts, capsys):
    rows = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("fetch_key"), F.lit("body").alias("body"))
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    wanted = rows.filter("hash(fetch_key) % 40 = 0").select("fetch_key").unionByName(spark.createDataFrame([(None,), ("no",)], "fetch_key string"))
    want = {r[0] for r in wanted.collect()} - {None, "no"}
    passed = bloom.probable(rows, "fetch_key", wanted)
    got = {r.fetch_key for r in passed.collect()}
    assert want <= got and len(got) < len(want) + 60
    for words in (1, 8, 1 << 17):  # full to the brim, crowded, roomy
        joined = bloom.probable(rows, "fetch_key", wanted, words).join(wanted, "fetch_key")
        assert {r.fetch_key for r in joined.collect()} == want
    assert bloom.probable(rows, "fetch_key", wanted.limit(0)).count() == 0
    plan = plan_of(passed.join(wanted, "fetch_key"), capsys)
    assert plan.index("Subquery") > 0 and re.search(r"Filter[^\n]*\n[^\n]*Scan parquet|Scan parquet", plan)


def test_lookups_equal_plain_joins(spark):
    captured = fetch.captures(spark.createDataFrame([page(f"https://x.example/{i}#f", f"b{i}") for i in range(50)], schemas.RESPONSES))
    wanted = spark.createDataFrame([(i, f"https://x.example/{i}#other") for i in range(0, 100, 7)], "n int, url string")
    got = {r.n: r.body for r in fetch.lookup(wanted, captured).collect()}
    assert got == {i: f"b{i}" if i < 50 else None for i in range(0, 100, 7)}
    led = spark.createDataFrame([("https://x.example/98", "https://x.example/1")], "fetch_key string, final_key string")
    assert {r.n: r.body for r in fetch.lookup(wanted, captured, redirects=led).collect()}[98] == "b1"

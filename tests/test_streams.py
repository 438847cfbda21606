"""Streams against the same work on whole tables: any order, late rows, batches played again, a hot crawl."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sitelode import schemas
from sitelode.operators import content, fetch, scope
from sitelode.plans import progress
from sitelode.sources.requests import parse_requests
from sitelode.streaming import batches, captures, counts, pages

from .conftest import page
from .test_harvest import request
from .test_progress import CRAWLS

START = datetime(2024, 5, 1)


def visits(crawls):
    return [
        (c, i, shown, ms, False, cap, total, START + timedelta(seconds=i))
        for c, (rows, cap, total) in crawls.items()
        for i, (shown, ms) in enumerate(rows)
    ]


def whole(spark, rows, budget_ms):
    table = spark.createDataFrame(rows, counts.ARRIVALS)
    limits = table.select("crawl_id", "max_pages", "source_total").distinct()
    log = progress.page_log(table.select("crawl_id", "visit", "has_content", "elapsed_ms"), ["visit"])
    kept = progress.apply_caps(log, limits, budget_ms)
    return {r.crawl_id: tuple(r)[1:] for r in progress.crawl_summary(kept, limits).collect()}


def told(df):
    return {r.crawl_id: (r.completed, r.total, r.capped, r.reason) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_counts_do_not_depend_on_the_order_of_arrival(spark, tmp_path, seed):
    rng = random.Random(seed)
    crawls = dict(CRAWLS)
    crawls["hot"] = ([(rng.random() < 0.7, rng.choice([0, 1, 2])) for _ in range(4000)], 2500, 9999)
    # Only failed fetches pass the budget, and the next page comes slices later.
    crawls["fails"] = ([(True, 10)] * 3 + [(False, 6000)] * 40 + [(True, 1)] * 3, 50, None)
    rows = visits(crawls)
    want = whole(spark, rows, 10_000)
    rng.shuffle(rows)
    place, cuts = str(tmp_path / "counts"), [0, 7, len(rows) // 3, len(rows) - 5, len(rows)]
    for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
        batch = spark.createDataFrame(rows[a:b], counts.ARRIVALS)
        for _ in range(1 + n % 2):  # every other batch is played again
            counts.store_fetches(batch, n, place, visits_per_slice=16)
    got = counts.crawl_counts(spark, place, budget_ms=10_000)
    assert told(got) == want
    assert all(r.is_closed == (r.reason != "" or r.completed == crawls[r.crawl_id][1]) for r in got.collect())


def test_a_batch_is_reduced_to_slices_before_anything_is_kept(spark):
    hot = spark.createDataFrame(visits({"hot": ([(True, 3)] * 5000, 10**6, None)}), counts.ARRIVALS)
    rows = counts.slices(hot, visits_per_slice=500).collect()
    assert len(rows) == 10 and sum(r.pages for r in rows) == 5000 and {r.ms for r in rows} == {1500}


def test_the_deadline_is_set_at_the_start_of_a_crawl(spark, tmp_path):
    rows = visits({"silent": ([(True, 5)] * 3, 50, 9), "ended": ([(True, 5)] * 2, 50, 2)})
    place = str(tmp_path / "counts")
    counts.store_fetches(spark.createDataFrame(rows, counts.ARRIVALS), 0, place)
    counts.store_fetches(spark.createDataFrame([("ended", 2**53, False, 0, True, 50, 2, START)], counts.ARRIVALS), 1, place)
    late = [("silent", 3, True, 5, False, 50, 9, START + timedelta(seconds=9))]
    counts.store_fetches(spark.createDataFrame(late, counts.ARRIVALS), 2, place)

    def at(seconds):
        moment = F.lit(START + timedelta(seconds=seconds))
        return {r.crawl_id: tuple(r)[1:] for r in counts.crawl_counts(spark, place, 10_000, moment).collect()}

    assert at(9) == {"silent": (4, 4, False, "", False), "ended": (2, 2, False, "", True)}
    # Ten seconds after the first row, not after the last one.
    assert at(10) == {"silent": (4, 9, True, "time_budget", True), "ended": (2, 2, False, "", True)}


def test_a_count_stream_resumes(spark, tmp_path):
    rows = visits({c: CRAWLS[c] for c in ("cap_pages", "cap_time", "random1")})
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for part in (rows[::3], rows[1::3], rows[2::3]):
        spark.createDataFrame(part, counts.ARRIVALS).coalesce(1).write.mode("append").parquet(source)
        arriving = spark.readStream.schema(counts.ARRIVALS).parquet(source)
        counts.count_stream(arriving, out, state, visits_per_slice=8).awaitTermination(60)
    assert told(counts.crawl_counts(spark, out, 10_000)) == whole(spark, rows, 10_000)


def arrivals():
    rows = []
    for i in range(12):
        rows.append((*page(f"https://x.example/docs/{i}" + "/" * (i % 2), f"<p>one {i}</p>"), START + timedelta(hours=i)))
        rows.append((*page(f"HTTPS://x.example/docs/{i}#again", f"<p>two {i}</p>"), START + timedelta(hours=i + (i % 3) - 1)))
    rows += [(*page("https://x.example/docs/blank", "<p> </p>"), START), (*page("https://x.example/docs/blank#full", "<p>full</p>"), START + timedelta(days=1))]
    rows += [(*page("https://x.example/other/1", "<p>other</p>"), START), (*page("https://x.example/docs/404", "x", 404), START), (*page("https://y.example/docs/1", "<p>y</p>"), START)]
    # A period later the page counts anew.
    rows.append((*page("https://x.example/docs/0", "<p>later</p>"), START + timedelta(days=80)))
    return rows


def test_crawl_pages_keep_the_first_spelling_in_any_order(spark, tmp_path):
    asked = [request("all", "https://x.example/docs/"), request("some", "https://x.example/docs/start", exclude="docs/1*"), request("y", "https://y.example")]
    requests = scope.compile_globs(parse_requests(spark.createDataFrame(asked, schemas.CRAWL_REQUESTS))[0])
    schema = schemas.RESPONSES + ", captured_at timestamp"
    rows = arrivals()
    table = spark.createDataFrame(rows, schema)
    batch = pages.first_pages(pages.crawl_pages(table, requests, "captured_at"))
    want = sorted(map(tuple, batch.collect()))
    assert {r[0] for r in want} == {"all", "some", "y"} and len([r for r in want if r[0] == "all"]) == 14
    firsts = {r[1]: r[3] for r in want if r[0] == "all" and r[2].month < 7}
    assert firsts["https://x.example/docs/3"] == "HTTPS://x.example/docs/3#again"  # earlier
    assert firsts["https://x.example/docs/2"] == "https://x.example/docs/2"
    assert firsts["https://x.example/docs/4"] == "HTTPS://x.example/docs/4#again"  # same time, least URL
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        source, out, state = (str(tmp_path / f"{n}{seed}") for n in ("in", "out", "state"))
        spark.createDataFrame(rows, schema).repartition(5).write.parquet(source)
        arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(source)
        # The lateness covers the whole disorder of this source.
        stream = pages.crawl_pages(arriving, requests, "captured_at", lateness="90 days")
        pages.store_crawl_pages(stream, out, state).awaitTermination(120)
        assert sorted(map(tuple, pages.first_pages(batches.read_batches(spark, out)).collect())) == want


def test_a_batch_played_again_changes_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"r{i}") for i in range(20)], "n int, s string")
    place = str(tmp_path / "rows")
    for n in (0, 1, 1, 0, 2):
        batches.write_batch(rows.filter(F.col("n") % 3 == n), n, place)
    assert sorted(r.n for r in batches.read_batches(spark, place).collect()) == list(range(20))


def test_arriving_captures_settle_as_the_whole_table_does(spark, tmp_path):
    rng = random.Random(8)
    rows = [
        (*page(f"https://q.example/{rng.randrange(12)}#{rng.randrange(3)}", f"body {rng.randrange(4)}", elapsed_ms=rng.randrange(3)), START + timedelta(minutes=rng.randrange(5)))
        for _ in range(150)
    ]
    schema = schemas.RESPONSES + ", seen timestamp"
    want = sorted(map(tuple, fetch.unique_captures(fetch.captures(spark.createDataFrame(rows, schema)), "seen").collect()))
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.createDataFrame(rows, schema).repartition(6).write.parquet(source)
    arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    captures.store_arriving(arriving, out, state, "seen").awaitTermination(120)
    settled = captures.settled_captures(spark, out, "seen").select(*fetch.captures(spark.createDataFrame(rows[:1], schema)).columns)
    assert sorted(map(tuple, settled.collect())) == want


def test_a_stream_reads_a_page_once(spark):
    def read(rows, body="body"):
        found = rows.withColumns({"title": F.lit(""), "description": F.lit(""), "content": F.regexp_replace(body, "<costly>", "")})
        return found.withColumn("content_status", F.when(F.col("content") != "", F.lit("content")).otherwise(F.lit("blank")))

    rows = spark.createDataFrame([page("https://x.example/docs/1", "<costly>one"), page("https://x.example/docs/2", "<costly>")], schemas.RESPONSES)
    found = pages.page_stream(rows, content.Extractor(read, F.lit))
    assert [(r.key, r.content) for r in found.collect()] == [("https://x.example/docs/1", "one")]
    # Neither the filter nor the status of a page reads it again.
    assert found._jdf.queryExecution().optimizedPlan().toString().count("<costly>") == 1

"""Registered queries over small tables of the given schema."""

import pytest

from checks import catalog


@pytest.fixture
def placed(spark, tmp_path):
    """Pages of several sites, one of them with a third of all pages."""
    rows = [(n, f"https://h{n % 5}.example/{('en', 'de', 'fr')[n % 3]}/{n}{('', '/', '?x=1')[n % 3]}", f"<title>P{n}</title><body><p>text {n}</p></body>") for n in range(150)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    return str(tmp_path)


def test_the_progress_sink_holds_every_message(spark, placed):
    got = sorted(map(tuple, catalog.progress_sink(spark, placed).select("crawl_id", "seq", "completed", "total", "status", "capped", "reason").collect()))
    want = sorted(map(tuple, catalog.progress_snapshots(spark, placed).collect()))
    assert got == want
    crawls = {r[0] for r in got}
    assert {r[0] for r in got if r[4] == "completed"} == crawls and {r[0] for r in got if r[1] == 0} == crawls
    assert len(got) > 2 * len(crawls)  # snapshots between the first message and the last


def test_arriving_files_grow_with_the_partitions_of_a_shuffle(spark, placed, monkeypatch):
    seen, stream = [], catalog.tables.stream_responses

    def noted(session, location, files_per_batch):
        seen.append((len(session.read.parquet(location).inputFiles()), files_per_batch))
        return stream(session, location, files_per_batch=files_per_batch)

    monkeypatch.setattr(catalog.tables, "stream_responses", noted)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "10")
    try:
        got = catalog.stream_pages(spark, placed).count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    [(files, each)] = seen
    assert got > 50 and files == 10 and each == 5  # two micro-batches, each with work for five tasks

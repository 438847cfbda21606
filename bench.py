"""Seconds per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The given tables are single files, which one task would read. They are stored in as many
files as there are cores before the clock starts.
"""

from __future__ import annotations

import json
import os
import sys
import time

os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--driver-memory 16g pyspark-shell")

from checks.catalog import QUERIES  # noqa: E402
from sitelode.session import build_session, scratch_path  # noqa: E402

HEADLINES = (
    "page_links", "decoded_entities", "glob_filter", "extracted_pages", "parsed_pages", "redirect_chain", "url_guard",
    "sitemap_pages", "docs_root", "bfs_edges", "bfs_crawl", "wiki_titles", "wiki_pages", "url_list_pages", "time_budget",
    "progress_snapshots", "stream_pages", "guarded_captures", "bfs_visits", "harvested_pages",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    spark = build_session("bench", f"local[{cpus}]", shuffle_partitions=int(cpus) if cpus.isdigit() else None)
    spark.sparkContext.setLogLevel("ERROR")
    stored = scratch_path(spark, "bench")
    for table in ("pages", "documents"):
        given = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        given.repartition(spark.sparkContext.defaultParallelism).write.parquet(f"{stored}/{table}.parquet")
    # The first query of a session pays for starting up; this one is not counted.
    QUERIES["canonical_dedup"](spark, stored).collect()
    seconds = {}
    for name in names:
        start = time.time()
        # Every row and column is computed, and nothing is brought to the driver.
        QUERIES[name](spark, stored).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()

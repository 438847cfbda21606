"""Documentation root of bare domains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import path, site_root
from .fetch import is_html

# Paths probed in this order.
CANDIDATE_PATHS = ("/docs/", "/doc/", "/documentation/", "/en/docs/", "/manual/", "/wiki/")
# A path no real site answers; captures of it tell sites that answer everything.
CATCH_ALL_PROBE = "/no-such-page-probe/"


def find_docs_roots(bases: DataFrame, captured: DataFrame, catch_all_probe: str = CATCH_ALL_PROBE) -> DataFrame:
    """``(crawl_id, url, docs_root)``: the first candidate that answers with a page, else the URL itself.

    A URL with a path of its own is kept, and so is a site that answers any path.
    Only captures under a probed path are joined, and no bodies.
    """
    probes = [catch_all_probe, *CANDIDATE_PATHS]
    answering = captured.filter(
        is_html(F.col("status"), F.col("content_type")) & F.col("fetch_key").rlike("(?:" + "|".join(probes) + r")\z")
    ).select("fetch_key")
    bare = bases.filter(path(F.col("url")).isin("", "/"))
    answers = (
        bare.select(
            "crawl_id",
            site_root(F.col("url")).alias("root"),
            F.posexplode(F.array(*[F.lit(p) for p in probes])).alias("pos", "probe"),
        )
        .withColumn("fetch_key", F.concat("root", "probe"))
        .join(answering, "fetch_key", "left_semi")
    )
    # The catch-all probe sorts first, so winning with it means the site answers everything.
    first = answers.groupBy("crawl_id").agg(F.min(F.struct("pos", "fetch_key")).alias("first"))
    root = F.when(F.col("first.pos") > 0, F.col("first.fetch_key"))
    return bases.join(first, "crawl_id", "left").select("crawl_id", "url", F.coalesce(root, "url").alias("docs_root"))

"""Which route each crawl takes: wiki, sitemap or link traversal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.wiki import derive_api, is_wiki_generator, site_info


class NotAWiki(ValueError):
    """A request asked for a wiki crawl of a site that is none."""


def wiki_facts(requests: DataFrame, advertised: DataFrame, captured: DataFrame) -> DataFrame:
    """Endpoint and site info of every request that may take the wiki route.

    ``generator`` is null where the API gave no usable answer.
    """
    asked = requests.filter(F.col("strategy").isin("auto", "mediawiki")).select("crawl_id", "url")
    apis = derive_api(asked, advertised)
    known = site_info(apis.select("crawl_id", "api_url"), captured).drop("api_url")
    return apis.join(known, "crawl_id", "left").select("crawl_id", "api_url", "generator", "server", "articlepath")


def route_requests(
    requests: DataFrame, facts: DataFrame, sitemap: DataFrame, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Add ``route`` to each request and split off rejects ``(crawl_id, url, reason)``.

    ``sitemap`` is the scoped sitemap of all requests. An explicit wiki request on
    a site that is no wiki is rejected, or raised when ``strict``; ``auto`` falls
    back to html, and so does an unknown strategy.
    """
    with_pages = sitemap.groupBy("crawl_id").agg(F.count("*").alias("sitemap_total"))
    is_wiki = F.coalesce(is_wiki_generator(F.col("generator")), F.lit(False))
    explicit = F.col("strategy") == "mediawiki"
    routed = (
        requests.join(facts, "crawl_id", "left")
        .join(with_pages, "crawl_id", "left")
        .withColumn(
            "route",
            F.when(is_wiki & F.col("strategy").isin("auto", "mediawiki"), F.lit("wiki"))
            .when(explicit, F.lit("rejected"))
            .when(F.col("sitemap_total") > 0, F.lit("sitemap"))
            .otherwise(F.lit("links")),
        )
    )
    rejects = routed.filter("route = 'rejected'").select(
        "crawl_id",
        "url",
        F.when(F.col("generator").isNull(), F.lit("no working wiki API")).otherwise(F.lit("site is not a wiki")).alias("reason"),
    )
    if strict:
        first = rejects.first()
        if first is not None:
            raise NotAWiki(f"crawl {first.crawl_id}: {first.reason} at {first.url!r}")
    return routed.filter("route <> 'rejected'"), rejects

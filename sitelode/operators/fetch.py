"""Captured responses in the place of live fetching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.urls import resolve_url, without_fragment
from ..session import cut_lineage
from .bloom import probable
from .guard import guard_urls

# Fixed value: statuses that redirect when they carry a location.
REDIRECT_STATUSES = (301, 302, 303, 307, 308)
# Fixed value: redirects followed before a fetch is given up.
MAX_REDIRECTS = 5


def is_success(status: Column) -> Column:
    return F.coalesce(status.between(200, 299), F.lit(False))


def is_html(status: Column, content_type: Column) -> Column:
    """A successful response whose type names html."""
    return is_success(status) & F.coalesce(F.contains(F.lower(content_type), F.lit("html")), F.lit(False))


def captures(responses: DataFrame) -> DataFrame:
    """Responses with the key they are fetched by: the URL without its fragment."""
    return responses.withColumn("fetch_key", without_fragment(F.col("url")))


def unique_captures(captured: DataFrame, captured_at: str | None = None) -> DataFrame:
    """One capture per fetch key: the latest by ``captured_at``, if the table has such a column, else the first in order.

    The order is by URL, status, type, location, digest of the body and time taken, so it is
    total but for rows that are equal. Captures are scanned and shuffled once; each task sends on one
    capture of a key at most, so a URL that was captured very often is no hot key.
    """
    content = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("url", "status", "content_type", "location")]
    latest = [F.unix_micros(F.col(captured_at)).desc()] if captured_at else []
    order = Window.partitionBy("fetch_key").orderBy(*latest, *content, F.md5(F.coalesce("body", F.lit(""))), F.coalesce("elapsed_ms", F.lit(0)))
    return captured.withColumn("_nth", F.row_number().over(order)).filter("_nth = 1").drop("_nth")


def lookup(wanted: DataFrame, captured: DataFrame, url: str = "url", how: str = "left", redirects: DataFrame | None = None) -> DataFrame:
    """Join each wanted URL to its capture, adding status, content_type, body and elapsed_ms.

    Captures are tested against a filter of the wanted keys where they are read, so few others are shuffled. With
    ``redirects`` (``fetch_key, final_key``), a key that redirects is answered by its final page.
    """
    keyed = through_redirects(wanted.withColumn("fetch_key", without_fragment(F.col(url))), redirects)
    answer = captured.select("fetch_key", "status", "content_type", "body", "elapsed_ms")
    return keyed.join(probable(answer, "fetch_key", keyed), "fetch_key", how).drop("fetch_key")


def through_redirects(wanted: DataFrame, redirects: DataFrame | None) -> DataFrame:
    """``wanted`` with the ``fetch_key`` that answers: the final one, where ``redirects`` has it."""
    if redirects is None:
        return wanted
    led = wanted.join(redirects.select("fetch_key", "final_key"), "fetch_key", "left")
    return led.withColumn("fetch_key", F.coalesce("final_key", "fetch_key")).drop("final_key")


def is_redirect() -> Column:
    return F.coalesce(F.col("status").isin(*REDIRECT_STATUSES) & F.col("location").isNotNull(), F.lit(False))


def _then(first: DataFrame, second: DataFrame) -> DataFrame:
    """Jumps of ``first``, carried on by those of ``second`` from where they led, unless they were blocked."""
    onward = second.select(
        F.col("fetch_key").alias("final_key"), F.col("final_key").alias("next_key"), F.col("hops").alias("more"), F.col("blocked").alias("stop")
    )
    goes = F.col("next_key").isNotNull() & ~F.col("blocked")
    return first.join(onward, "final_key", "left").select(
        "fetch_key",
        F.when(goes, F.col("next_key")).otherwise(F.col("final_key")).alias("final_key"),
        F.when(goes, F.col("hops") + F.col("more")).otherwise(F.col("hops")).alias("hops"),
        (F.col("blocked") | (goes & F.col("stop"))).alias("blocked"),
    )


def resolve_redirects(captured: DataFrame, dns: DataFrame | None = None) -> DataFrame:
    """Follow every redirecting capture: ``(fetch_key, final_key, hops, verdict)``.

    Only redirecting rows take part, and without their bodies. ``verdict`` is
    ``ok``, ``too_many_redirects`` or ``blocked``; with ``dns``, the target of each
    hop must pass the address guard as well. Jumps double, so the longest chain takes as many joins as the limit
    has binary digits; a chain that runs in a circle is one that passes the limit.
    """
    hop = captured.filter(is_redirect()).select(
        "fetch_key", without_fragment(resolve_url(F.col("fetch_key"), F.col("location"))).alias("target")
    )
    if dns is not None:
        checked = guard_urls(hop.select(F.col("target").alias("url")).distinct(), dns)
        hop = hop.join(
            checked.select(F.col("url").alias("target"), F.col("verdict").alias("guard")), "target", "left"
        )
    else:
        hop = hop.withColumn("guard", F.lit("ok"))
    # Joined to itself several times over, and small: narrow columns of the redirecting rows.
    jump = cut_lineage(
        hop.select("fetch_key", F.col("target").alias("final_key"), F.lit(1).alias("hops"), (F.col("guard") != "ok").alias("blocked"))
    )
    walk, steps = None, MAX_REDIRECTS + 1
    while True:
        if steps % 2:
            walk = jump if walk is None else _then(walk, jump)
        steps //= 2
        if not steps:
            break
        jump = cut_lineage(_then(jump, jump))
    return walk.select(
        "fetch_key",
        "final_key",
        "hops",
        F.when(F.col("hops") > MAX_REDIRECTS, F.lit("too_many_redirects"))
        .when(F.col("blocked"), F.lit("blocked"))
        .otherwise(F.lit("ok"))
        .alias("verdict"),
    )


def final_keys(captured: DataFrame, dns: DataFrame | None = None) -> DataFrame:
    """The key index of redirects: ``(fetch_key, final_key)`` of every redirecting key that leads to an answer."""
    return cut_lineage(resolve_redirects(captured, dns).filter("verdict = 'ok'").select("fetch_key", "final_key"))


def follow_redirects(captured: DataFrame, dns: DataFrame | None = None) -> DataFrame:
    """Captures as a client sees them: redirecting URLs answer with their final page.

    The URL stays the requested one, and elapsed time is that of the final page. A page is copied for each
    URL that leads to it; jobs that can look pages up by :func:`final_keys` should.
    """
    plain = captured.filter(~is_redirect())
    redirected = (
        plain.withColumnRenamed("fetch_key", "final_key")
        .drop("url")
        .join(final_keys(captured, dns), "final_key")
        .withColumn("url", F.col("fetch_key"))
        .select(*plain.columns)
    )
    return plain.unionByName(redirected)

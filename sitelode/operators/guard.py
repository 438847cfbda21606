"""Address guard: which URLs may be fetched at all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.addresses import address_is_public, is_public_address
from ..functions.urls import host, scheme


def guard_urls(urls: DataFrame, dns: DataFrame) -> DataFrame:
    """Add ``verdict`` to ``urls(url)``: ``ok`` or the reason the URL is blocked."""
    return guard_hosts(urls, dns, scheme(F.col("url")), host(F.col("url")))


def guard_hosts(rows: DataFrame, dns: DataFrame, scheme_: Column, host_: Column) -> DataFrame:
    """Add ``verdict`` to any rows that give a scheme and a host, without brackets and in lower case.

    Names are judged first, one row per host, so the join to the rows meets a
    table without repeats however many addresses a name has.
    """
    names = dns.groupBy("host").agg(F.bool_and(is_public_address(F.col("ip"))).alias("all_public"))
    wanted = rows.select("*", scheme_.alias("_scheme"), host_.alias("_host")).withColumn(
        "_literal_public", address_is_public(F.col("_host"))
    )
    judged = wanted.join(names.withColumnRenamed("host", "_host"), "_host", "left").withColumn(
        "_public", F.coalesce("_literal_public", "all_public")
    )
    public = F.col("_public")
    return judged.select(
        *rows.columns,
        F.when(~F.col("_scheme").isin("http", "https"), F.lit("unsupported_scheme"))
        .when(F.col("_host") == "", F.lit("no_host"))
        .when(public.isNull(), F.lit("unresolved_host"))
        .when(~public, F.lit("non_public_address"))
        .otherwise(F.lit("ok"))
        .alias("verdict"),
    )

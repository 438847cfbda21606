"""Crawl requests with defaults, trims and clamps applied."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, csv_list
from ..operators.scope import compile_globs

# Defaults and limits of the request parameters.
DEFAULT_MAX_PAGES = 50
DEFAULT_MAX_DEPTH = 5
DEFAULT_CONCURRENCY = 5
CONCURRENCY_LIMIT = 16


def _or_default(name: str, default: int) -> Column:
    """Zero counts as absent."""
    return F.coalesce(F.nullif(F.col(name), F.lit(0)), F.lit(default)).cast("int")


def parse_requests(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split raw requests into usable ones and rejects ``(crawl_id, url, reason)``."""
    trimmed = raw.withColumn("url", blank_to_null(F.col("url")))
    rejects = trimmed.filter("url is null").select("crawl_id", "url", F.lit("url is required").alias("reason"))
    usable = trimmed.filter("url is not null").select(
        "crawl_id",
        "url",
        F.coalesce("discover", F.lit(True)).alias("discover"),
        blank_to_null(F.col("path_prefix")).alias("path_prefix"),
        F.lower(F.coalesce(F.nullif("strategy", F.lit("")), F.lit("auto"))).alias("strategy"),
        csv_list(F.col("include_paths")).alias("include_paths"),
        csv_list(F.col("exclude_paths")).alias("exclude_paths"),
        _or_default("max_pages", DEFAULT_MAX_PAGES).alias("max_pages"),
        _or_default("max_depth", DEFAULT_MAX_DEPTH).alias("max_depth"),
        F.least(F.greatest(_or_default("max_concurrency", DEFAULT_CONCURRENCY), F.lit(1)), F.lit(CONCURRENCY_LIMIT)).alias(
            "max_concurrency"
        ),
        F.greatest(F.coalesce("request_delay_ms", F.lit(0)), F.lit(0)).alias("request_delay_ms"),
    )
    return compile_globs(usable), rejects

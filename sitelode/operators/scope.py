"""Which URLs a crawl may visit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.globs import glob_list_regex, matches_regex
from ..functions.urls import netloc, path

# Fixed value: file types that are never pages.
ASSET_TYPES = "png|jpe?g|gif|svg|css|js|ico|woff2?|ttf|zip|tar|gz|pdf|xml|json"


def is_asset(url_path: Column) -> Column:
    """True for a path that ends in an asset file extension."""
    return url_path.rlike(rf"(?i)\.(?:{ASSET_TYPES})\z")


def in_scope(
    url: Column,
    host: Column,
    path_prefix: Column,
    include_regex: Column,
    exclude_regex: Column,
    skip_assets: bool = True,
) -> Column:
    """Same host, under the prefix, not an asset, not excluded, and included when a list is given.

    The host must be equal as written, port and case included. A null or empty
    prefix or pattern does not restrict. Everything is built in, so the predicate
    can move below joins.
    """
    url_path = path(url)
    inside = F.coalesce(path_prefix, F.lit("")) == ""
    allowed = (netloc(url) == host) & (inside | url_path.startswith(path_prefix))
    if skip_assets:
        allowed = allowed & ~is_asset(url_path)
    return (
        allowed
        & ~matches_regex(url_path, exclude_regex)
        & (include_regex.isNull() | matches_regex(url_path, include_regex))
    )


def compile_globs(requests: DataFrame) -> DataFrame:
    """Add the compiled form of both pattern lists to each request."""
    return requests.withColumns(
        {
            "include_regex": glob_list_regex(F.col("include_paths")),
            "exclude_regex": glob_list_regex(F.col("exclude_paths")),
        }
    )

"""Addresses of wiki pages and of wiki API requests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def form_encode(text: Column) -> Column:
    """Query-string encoding: blank to ``+``, only letters, digits and ``_.-~`` kept."""
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def percent_encode_path(text: Column) -> Column:
    """Path encoding that keeps ``/`` and ``:``."""
    encoded = F.replace(form_encode(text), F.lit("+"), F.lit("%20"))
    return F.replace(F.replace(encoded, F.lit("%2F"), F.lit("/")), F.lit("%3A"), F.lit(":"))


def wiki_page_url(server: Column, articlepath: Column, title: Column) -> Column:
    encoded = percent_encode_path(F.replace(title, F.lit(" "), F.lit("_")))
    return F.concat(F.regexp_replace(server, r"/+\z", ""), F.replace(articlepath, F.lit("$1"), encoded))


def api_request(api_url: Column, params: dict[str, Column | str | int]) -> Column:
    """URL of one API call; it serves as the join key to the captured reply."""
    pairs = []
    for name, value in params.items():
        encoded = form_encode(value) if isinstance(value, Column) else F.lit(str(value))
        pairs += [F.lit(f"&{name}=" if pairs else f"{name}="), encoded]
    separator = F.when(F.contains(api_url, F.lit("?")), F.lit("&")).otherwise(F.lit("?"))
    return F.concat(api_url, separator, *pairs)

"""Links of a page as one sorted array of distinct absolute URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let
from .entities import decode_entities
from .text import SPACE, strip
from .urls import reference_parts, resolve_parts

# href="..." and href='...' up to a closing quote or '#', or a bare href=...
_HREF = rf"""(?i)href=(?:["'][^"'#]+|[^"'{SPACE}>#]+)"""


def raw_hrefs(html: Column) -> Column:
    """Distinct attribute values in page order, not yet decoded."""
    found = F.regexp_extract_all(html, F.lit(_HREF), F.lit(0))
    return F.array_distinct(F.transform(found, lambda m: F.regexp_replace(m, r"""^.{5}["']?""", "")))


def is_http(url: Column) -> Column:
    return url.startswith("http://") | url.startswith("https://")


def link_references(html: Column) -> Column:
    """Distinct references of ``html``, decoded but not yet resolved: what a page says, wherever it was fetched from."""
    return F.filter(F.transform(raw_hrefs(html), lambda h: strip(decode_entities(h))), lambda h: h != "")


def resolve_references(references: Column, base_url: Column) -> Column:
    """Distinct http(s) URLs of ``references`` in code-point order, resolved against ``base_url``."""
    base, split = reference_parts(base_url), F.transform(references, reference_parts)
    links = let(base, lambda b: F.transform(split, lambda r: resolve_parts(b, r)))
    return F.array_sort(F.array_distinct(F.filter(links, lambda u: u.isNotNull() & is_http(u))))


def extract_links(html: Column, base_url: Column) -> Column:
    """Distinct http(s) links of ``html`` in code-point order, resolved against ``base_url``."""
    return resolve_references(link_references(html), base_url)


# The patterns of a sitemap entry and of a robots line that names a sitemap.
_LOC = rf"(?i)<loc>[{SPACE}]*([^<{SPACE}]+)[{SPACE}]*</loc>"
_SITEMAP_LINE = rf"(?imd)^[{SPACE}]*sitemap:[{SPACE}]*([^{SPACE}]+)[{SPACE}]*$"


def sitemap_locs(xml: Column) -> Column:
    """``<loc>`` values in file order, duplicates kept, entities left as they are."""
    return F.regexp_extract_all(xml, F.lit(_LOC), F.lit(1))


def named_sitemaps(robots: Column) -> Column:
    """Sitemap URLs named in a robots.txt body, in order."""
    return F.regexp_extract_all(robots, F.lit(_SITEMAP_LINE), F.lit(1))

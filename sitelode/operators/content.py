"""Main content, title and description of HTML pages with built-in expressions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binding import let
from ..functions.entities import decode_entities
from ..functions.text import has_text, strip

# Elements dropped whole, wherever they stand and inside the main region.
DROPPED_EVERYWHERE = ("script", "style", "noscript", "template", "svg")
DROPPED_IN_REGION = ("nav", "header", "footer", "aside", "form", "button")
# A tag, and not any "<" of the text.
_TAG = "<[A-Za-z/!?][^>]*>"
# Elements that hold the main content, best first.
REGIONS = ("article", "main", "body")
_BLOCKS = "p|div|section|article|main|ul|ol|dl|dt|dd|table|tr|blockquote|pre|figure|figcaption|details|summary"


def _drop(html: Column, names: tuple[str, ...], also: str = "") -> Column:
    """Remove elements of all given names in one pass."""
    return F.regexp_replace(html, rf"(?is)<({'|'.join(names)})\b[^>]*>.*?</\1\s*>{also}", "")


def main_region(html: Column) -> Column:
    """Inner HTML from the first to the last article, else main, else body element, else the whole text.

    A header stays where it holds a heading. Patterns cannot follow nesting of elements that are
    dropped; ``extract_parsed`` does.
    """

    def region(clean: Column) -> Column:
        found = [
            let(
                F.regexp_extract(clean, rf"(?is)<{name}\b[^>]*>(.*)</{name}\s*>", 1),
                lambda inner: F.when(inner != "", inner),
            )
            for name in REGIONS
        ]
        return F.coalesce(*found, clean)

    clean = _drop(html, DROPPED_EVERYWHERE, "|<!--.*?-->")
    kept = _drop(let(clean, region), tuple(n for n in DROPPED_IN_REGION if n != "header"))
    return F.regexp_replace(kept, r"(?is)<header\b[^>]*>[^<]*+(?:<(?!h[1-6]\b|/header\b)[^<]*+)*+</header\s*>", "")


def to_markdown(region: Column) -> Column:
    """Headings, list items, emphasis, table cells, code blocks and paragraphs as markdown; all other tags go."""
    parts = F.split(region, r"(?i)(?=<pre\b)|(?<=</pre>)")
    written = F.transform(parts, lambda p: F.when(p.rlike(r"(?i)\A<pre\b"), _code_block(p)).otherwise(_flow(p)))
    return strip(F.array_join(written, ""))


def _code_block(pre: Column) -> Column:
    code = decode_entities(F.regexp_replace(pre, _TAG, ""))
    return F.concat(F.lit("\n\n```\n"), F.regexp_replace(code, r"\A[\r\n]+|\s+\z", ""), F.lit("\n```\n\n"))


def _flow(region: Column) -> Column:
    text = F.regexp_replace(region, r"[ \t\r\n\f]{2,}|[\t\r\n\f]", " ")
    text = F.regexp_replace(text, r"(?i)<h([1-6])\b[^>]*>", "\n\n<#$1>")
    for level in range(1, 7):
        text = F.replace(text, F.lit(f"<#{level}>"), F.lit("#" * level + " "))
    text = F.regexp_replace(text, r"(?i)<li\b[^>]*>", "\n- ")
    text = F.regexp_replace(text, r"(?i)<br\b[^>]*>", "\n")
    text = F.regexp_replace(text, r"(?i)<(?:b|strong)\b[^>]*>([^<]*)</(?:b|strong)\s*>", "**$1**")
    text = F.regexp_replace(text, r"(?i)</t[dh]\s*>\s*(?=<t[dh]\b)", " | ")
    text = F.regexp_replace(text, rf"(?i)</?(?:{_BLOCKS})\b[^>]*>|</h[1-6]\s*>", "\n\n")
    text = decode_entities(F.regexp_replace(text, _TAG, ""))
    text = F.regexp_replace(text, r" *\n *(?:\n *)+", "\n\n")
    return F.regexp_replace(text, r" +\n *|\n +", "\n")


def page_content(html: Column) -> Column:
    return to_markdown(main_region(html))


def has_content(html: Column) -> Column:
    """Whether ``page_content`` is non-blank, without building it."""


    def shows(region: Column) -> Column:
        # A list item or heading leaves its mark even when empty.
        marked = region.rlike(r"(?i)<(?:li|h[1-6]|pre)\b[^>]*>|</t[dh]\s*>\s*<t[dh]\b")
        return marked | let(F.regexp_replace(region, _TAG, ""), visible)

    def visible(plain: Column) -> Column:
        # Text before the first reference settles most pages without decoding.
        return has_text(F.substring_index(plain, "&", 1)) | has_text(decode_entities(plain))

    return F.coalesce(let(main_region(html), shows), F.lit(False))


def _element_text(html: Column, name: str) -> Column:
    inner = F.regexp_extract(html, rf"(?is)<{name}\b[^>]*>(.*?)</{name}\s*>", 1)
    plain = F.regexp_replace(F.regexp_replace(inner, r"<[^>]*>", ""), r"[ \t\r\n\f]+", " ")
    return let(strip(decode_entities(plain)), lambda t: F.when(t != "", t))


def page_title(html: Column) -> Column:
    """Text of the title element, else of the first top heading, else empty."""
    return F.coalesce(_element_text(html, "title"), _element_text(html, "h1"), F.lit(""))


def tag_attribute(tag: Column, name: str) -> Column:
    """Value of one attribute of a tag, wherever it stands; empty when absent."""
    quoted = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return F.concat(*[F.regexp_extract(tag, quoted, i) for i in (1, 2, 3)])


def page_description(html: Column) -> Column:
    """Content of the description meta tag (plain or Open Graph), else empty."""

    def named(metas: Column, attribute: str, value: str) -> Column:
        tag = F.try_element_at(F.filter(metas, lambda m: F.lower(tag_attribute(m, attribute)) == value), F.lit(1))
        content = let(tag, lambda t: strip(decode_entities(tag_attribute(t, "content"))))
        return let(content, lambda c: F.when(c != "", c))

    def best(metas: Column) -> Column:
        return F.coalesce(named(metas, "name", "description"), named(metas, "property", "og:description"), F.lit(""))

    # Tags that cannot be either one are sorted out while they are collected.
    tags = F.regexp_extract_all(html, F.lit(r"(?i)<meta\b[^>]*description[^>]*>"), F.lit(0))
    return let(tags, best)


def extract_columns(pages: DataFrame, body: str = "body") -> DataFrame:
    """Add ``title``, ``description``, ``content`` (none of them null) and ``content_status``."""
    html = F.col(body)
    read = pages.withColumns(
        {"title": page_title(html), "description": page_description(html), "content": F.coalesce(page_content(html), F.lit(""))}
    )
    return read.withColumn("content_status", F.when(F.col("content") != "", F.lit("content")).otherwise(F.lit("blank")))


@dataclass(frozen=True)
class Extractor:
    """How pages are read.

    ``read`` adds, in one reading of a ``body``, ``title``, ``description``, ``content`` and ``content_status``: ``content``,
    ``blank`` or ``malformed``; only pages of the first kind are counted. ``status`` gives the same status alone, for
    jobs that never need the content.
    """

    read: Callable[[DataFrame], DataFrame]
    status: Callable[[Column], Column]


def column_status(html: Column) -> Column:
    return F.when(has_content(html), F.lit("content")).otherwise(F.lit("blank"))


COLUMNS = Extractor(extract_columns, column_status)

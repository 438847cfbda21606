"""Markdown from nested markup, where removing elements needs their nesting.

Built-in patterns cannot follow nesting, so these steps run the standard
library's tokenizer over Arrow batches. The table is partitioned by Spark and
each row is converted on its own.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .content import DROPPED_EVERYWHERE, DROPPED_IN_REGION, REGIONS, Extractor, page_description, page_title

# Fixed value: classes that mark page furniture in wiki articles, matched as whole tokens.
NOISE_CLASSES = (
    "mw-editsection", "infobox", "navbox", "metadata", "noprint",
    "mw-empty-elt", "toc", "mw-jump-link", "printfooter",
)
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_HEADINGS = {f"h{n}" for n in range(1, 7)}
_BLOCKS = ("p", "div", "section", "article", "main", "dl", "figure")
_EMPHASIS = {"b": "**", "strong": "**", "i": "*", "em": "*", "code": "`", "del": "~~", "s": "~~"}
_OPENERS = {
    **{f"h{n}": "\n\n" + "#" * n + " " for n in range(1, 7)}, **_EMPHASIS, **dict.fromkeys(_BLOCKS, "\n\n"),
    "br": "  \n", "hr": "\n\n---\n\n", "blockquote": "\n\n> ", "dt": "\n", "dd": "\n: ",
}
_CLOSERS = {
    **{f"h{n}": "\n\n" for n in range(1, 7)}, **_EMPHASIS, **dict.fromkeys(_BLOCKS, "\n\n"),
    "blockquote": "\n\n", "td": " |", "th": " |",
}


# Patterns are tried only where plain searches, which are much faster, say that something can match.
_SPACES = re.compile(r"[ \t\r\n\f]+")
_BLANK_BEFORE_BREAK = re.compile(r"(?<=\S)[ \t](?=\n)")
_BLANK_LINE = re.compile(r"^[ \t]+$", flags=re.M)
_BLANK_AFTER_BREAK = re.compile(r"\n (?=[^ \n])")
_BREAKS = re.compile(r"\n{3,}")


class _Markdown(HTMLParser):
    """Collects markdown, skipping dropped elements together with everything inside them."""

    def __init__(self, dropped_tags: tuple[str, ...], dropped_classes: tuple[str, ...], bullets: str, escape: bool, regions: tuple[str, ...]):
        super().__init__(convert_charrefs=True)
        # Where the outermost elements of each region begin and end in the output; the last may be open.
        self.regions: dict[str, list[list[int]]] = {name: [] for name in regions}
        self.depth = dict.fromkeys(regions, 0)
        self.headers: list[list] = []  # open headers: where they begin, and whether they hold a heading
        self.dropped_tags, self.dropped_classes = set(dropped_tags), set(dropped_classes)
        self.bullets, self.escape = bullets, escape
        self.out: list[str] = []
        self.open: list[tuple[str, bool]] = []  # open elements and whether each is dropped
        self.skipping = 0  # dropped elements among them
        self.lists: list[int | None] = []  # next number of each open list, None for bullets
        self.cells: list[int] = []  # cells of the first row of each open table, 0 once it is closed
        self.pre = self.code = 0

    def updatepos(self, i: int, j: int) -> int:
        """Lines are not counted; no message names one."""
        return j

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        classes = set((dict(attrs).get("class") or "").split())
        drop = tag in self.dropped_tags or bool(classes & self.dropped_classes)
        if tag not in _VOID:
            self.open.append((tag, drop))
            self.skipping += drop
        if self.skipping or drop:
            return
        if tag in self.depth:
            if not self.depth[tag]:
                self.regions[tag].append([len(self.out), -1])
            self.depth[tag] += 1
        if tag == "header":
            self.headers.append([len(self.out), False])
        elif tag in _HEADINGS:
            for header in self.headers:
                header[1] = True
        if tag in ("ul", "ol"):
            self.lists.append(1 if tag == "ol" else None)
            self.out.append("" if len(self.lists) > 1 else "\n\n")
        elif tag == "li":
            depth = max(len(self.lists) - 1, 0)
            number = self.lists[-1] if self.lists else None
            mark = f"{number}." if number else self.bullets[depth % len(self.bullets)]
            self.out.append("\n" + "  " * depth + mark + " ")
            if number:
                self.lists[-1] = number + 1
        elif tag == "table":
            self.cells.append(-1)
            self.out.append("\n\n")
        elif tag == "tr":
            if self.cells and self.cells[-1] < 0:
                self.cells[-1] = 1
            self.out.append("\n|")
        elif tag in ("td", "th"):
            if self.cells and self.cells[-1] > 0:
                self.cells[-1] += 1
            self.out.append(" ")
        elif tag == "pre":
            self.pre += 1
            self.out.append("\n\n```\n")
        elif not (self.pre and tag == "code"):
            self.code += tag == "code"
            self.out.append(_OPENERS.get(tag, ""))

    def handle_endtag(self, tag: str) -> None:
        was_skipping = self.skipping
        if any(name == tag for name, _ in self.open):
            closed = None
            while closed != tag:
                closed, dropped = self.open.pop()
                self.skipping -= dropped
        if was_skipping:
            return
        if self.depth.get(tag):
            self.depth[tag] -= 1
            if not self.depth[tag]:
                self.out.append("\n\n")
                self.regions[tag][-1][1] = len(self.out)
                return
        if tag == "header" and self.headers and self.regions:
            begin, holds_heading = self.headers.pop()
            if not holds_heading:
                # Page furniture. What it said goes, but places of regions stay valid.
                self.out[begin:] = [""] * (len(self.out) - begin)
        if tag in ("ul", "ol") and self.lists:
            self.lists.pop()
            self.out.append("" if self.lists else "\n\n")
        elif tag == "tr" and self.cells and self.cells[-1] > 0:
            # The first row is the header, and a separator follows it.
            self.out.append("\n|" + " --- |" * (self.cells[-1] - 1))
            self.cells[-1] = 0
        elif tag == "table" and self.cells:
            self.cells.pop()
            self.out.append("\n\n")
        elif tag == "pre" and self.pre:
            self.pre -= 1
            self.out.append("\n```\n\n")
        elif not (self.pre and tag == "code"):
            self.code -= tag == "code" and self.code > 0
            self.out.append(_CLOSERS.get(tag, ""))

    def handle_data(self, data: str) -> None:
        if self.skipping:
            return
        if not self.pre:
            if "  " in data or "\n" in data or "\t" in data or "\r" in data or "\f" in data:
                data = _SPACES.sub(" ", data)
        if self.escape and not (self.pre or self.code):
            data = data.replace("*", r"\*").replace("_", r"\_")
        self.out.append(data)

    def text(self) -> str:
        """All of the output, or the first kind of region that says something."""
        for spans in self.regions.values():
            inside = "".join("".join(self.out[a : b if b >= 0 else None]) for a, b in spans)
            if inside.strip():
                return self._tidy(inside)
        return self._tidy("".join(self.out))

    @staticmethod
    def _tidy(text: str) -> str:
        if " \n" in text or "\t\n" in text:
            text = _BLANK_BEFORE_BREAK.sub("", text)
        if text[:1] in (" ", "\t") or "\n " in text or "\n\t" in text:
            text = _BLANK_AFTER_BREAK.sub("\n", _BLANK_LINE.sub("", text))
        if "\n\n\n" in text:
            text = _BREAKS.sub("\n\n", text)
        return text.strip()


def markdown_of(
    html: str | None,
    dropped_tags: tuple[str, ...],
    dropped_classes: tuple[str, ...] = (),
    bullets: str = "-",
    escape: bool = False,
    regions: tuple[str, ...] = (),
) -> str:
    parser = _Markdown(dropped_tags, dropped_classes, bullets, escape, regions)
    parser.feed(html or "")
    parser.close()
    return parser.text()


def _reading(html: Column, *rules) -> Column:
    """A column of ``text`` and ``status`` (``content``, ``blank`` or ``malformed``) from one reading of each row's markup.

    Only the markup travels to Python, not the rest of the row. The function counts as nondeterministic, so that
    no plan runs it once for a filter and again for a result.
    """

    def one(markup: str | None) -> tuple[str, str]:
        try:
            text = markdown_of(markup, *rules)
        except (AssertionError, ValueError):  # the tokenizer's errors on broken declarations
            return "", "malformed"
        return text, "content" if text.strip() else "blank"

    @F.arrow_udf("struct<text:string,status:string>")
    def read(column: pa.Array) -> pa.Array:
        done = [one(markup) for markup in column.to_pylist()]
        parts = (pa.array([d[i] for d in done], pa.string()) for i in (0, 1))
        return pa.StructArray.from_arrays(list(parts), ["text", "status"])

    return read.asNondeterministic()(html)


_ARTICLE_RULES = (("style", "script"), NOISE_CLASSES, "*+-", True)
_PAGE_RULES = (
    (*DROPPED_EVERYWHERE, *(n for n in DROPPED_IN_REGION if n != "header"), "head", "title"), (), "-", False, REGIONS,
)


def wiki_markdown(articles: DataFrame, html: str = "html", out: str = "content") -> DataFrame:
    """Wiki article fragments as markdown ``out`` in the place of ``html``: furniture removed, link and image markup flattened.

    ``malformed`` marks articles that could not be read; their markdown is empty.
    """
    read = articles.withColumn("_read", _reading(F.col(html), *_ARTICLE_RULES)).drop(html)
    return read.withColumns({out: F.col("_read.text"), "malformed": F.col("_read.status") == "malformed"}).drop("_read")


def extract_parsed(pages: DataFrame, body: str = "body") -> DataFrame:
    """The nested-markup variant of ``extract_columns``: regions and dropped elements by nesting, code and lists kept.

    Every article of a page counts. A header stays where it holds a heading. Malformed pages have empty content.
    """
    html = F.col(body)
    read = pages.withColumns({"title": page_title(html), "description": page_description(html), "_read": _reading(html, *_PAGE_RULES)})
    return read.withColumns({"content": F.col("_read.text"), "content_status": F.col("_read.status")}).drop("_read")


def parsed_status(html: Column) -> Column:
    """Whether ``extract_parsed`` finds content, by the same reading."""
    return _reading(html, *_PAGE_RULES)["status"]


PARSED = Extractor(extract_parsed, parsed_status)

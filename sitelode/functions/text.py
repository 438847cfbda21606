"""Whitespace helpers that agree with Python's notion of blank text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters str.strip() removes, as a Java character-class body.
SPACE = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


# Fixed value: the same characters one by one.
SPACE_CHARACTERS = (
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Trim Unicode whitespace on both ends. Only the ends are looked at, unlike with a pattern."""
    return F.btrim(text, F.lit(SPACE_CHARACTERS))


def has_text(text: Column) -> Column:
    """True when the text holds anything but whitespace; null counts as blank."""
    return F.coalesce(text.rlike(rf"[^{SPACE}]"), F.lit(False))


def blank_to_null(text: Column) -> Column:
    return F.nullif(strip(text), F.lit(""))


def csv_list(text: Column) -> Column:
    """Split a comma-separated parameter into trimmed, non-blank entries."""
    entries = F.transform(F.split(F.coalesce(text, F.lit("")), ","), strip)
    return F.filter(entries, lambda e: e != "")


def collapse_blank_lines(text: Column) -> Column:
    """At most one blank line in a row, and none at the ends."""
    return strip(F.regexp_replace(text, r"\n{3,}", "\n\n"))

"""Shell-style globs compiled to one Java pattern per pattern list.

The list is compiled once per crawl request, not once per URL, and matched with
``regexp_instr`` because that keeps the last compiled pattern between rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

_TOKENS = r"\[!?\]?[^\]]*\]|[\s\S]"
_CLASS_ITEMS = r"[\s\S]-[\s\S]|[\s\S]"
_PUNCTUATION = r"([\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f])"


def _escape(ch: Column) -> Column:
    return F.regexp_replace(ch, _PUNCTUATION, r"\\$1")


def _class_item(item: Column) -> Column:
    low, high = F.substring(item, 1, 1), F.substring(item, 3, 1)
    return (
        F.when(F.length(item) != 3, _escape(item))
        .when(low > high, F.lit(""))  # an empty range matches nothing
        .otherwise(F.concat(_escape(low), F.lit("-"), _escape(high)))
    )


def _character_class(token: Column) -> Column:
    negated = token.startswith("[!")
    body = F.regexp_replace(token, r"^\[!?|\]\z", "")
    items = F.regexp_extract_all(body, F.lit(_CLASS_ITEMS), F.lit(0))
    inside = F.array_join(F.transform(items, _class_item), "")
    return (
        F.when((inside == "") & negated, F.lit("."))
        .when(inside == "", F.lit("(?!)"))
        .otherwise(F.concat(F.when(negated, F.lit("[^")).otherwise(F.lit("[")), inside, F.lit("]")))
    )


def glob_to_regex(pattern: Column) -> Column:
    """Unanchored Java pattern for one glob; ``*`` also crosses slashes."""
    tokens = F.regexp_extract_all(pattern, F.lit(_TOKENS), F.lit(0))
    return F.array_join(
        F.transform(
            tokens,
            lambda t: F.when(t == "*", F.lit(".*"))
            .when(t == "?", F.lit("."))
            .when(F.length(t) > 1, _character_class(t))
            .otherwise(_escape(t)),
        ),
        "",
    )


def glob_list_regex(patterns: Column) -> Column:
    """One anchored pattern for a whole list, or null when the list has no usable entry.

    Each entry matches the path itself or the path as a directory.
    """
    cleaned = F.filter(
        F.transform(patterns, lambda p: F.regexp_replace(strip(p), "^/+", "")), lambda p: p != ""
    )
    both = F.transform(
        cleaned,
        lambda p: F.concat(
            glob_to_regex(p), F.lit("|"), glob_to_regex(F.concat(F.regexp_replace(p, r"/+\z", ""), F.lit("/*")))
        ),
    )
    return F.when(
        F.size(cleaned) > 0, F.concat(F.lit("(?s)^(?:"), F.array_join(both, "|"), F.lit(r")\z"))
    )


def matches_regex(url_path: Column, regex: Column) -> Column:
    """True when the path, less its leading slashes, matches; false for a null pattern."""
    relative = F.regexp_replace(url_path, "^/+", "")
    return F.coalesce(F.regexp_instr(relative, regex) > 0, F.lit(False))


def path_matches(url_path: Column, patterns: Column) -> Column:
    return matches_regex(url_path, glob_list_regex(patterns))

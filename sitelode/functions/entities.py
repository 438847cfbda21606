"""HTML character references decoded with built-in expressions.

One left-to-right pass, so ``&amp;lt;`` becomes ``&lt;``. Names come from the
standard library's table; legacy names also decode without their semicolon.
"""

from __future__ import annotations

import json
from functools import lru_cache
from html import unescape
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let

_PIECES = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)|[^&]+|&"
# Code points whose reference stands for some other character (Windows-1252 habits).
_REMAPPED = (0x0, 0xD, *range(0x80, 0xA0))


@lru_cache(maxsize=1)
def _named_json() -> str:
    # Map lookup scans its keys, so the names are grouped by their first two letters.
    by_head: dict[str, dict[str, str]] = {}
    for name, value in html5.items():
        by_head.setdefault(name[:2], {})[name] = value
    return json.dumps(by_head)


def _constant(text: str, ddl: str) -> Column:
    """A map constant from one literal, folded by the optimizer."""
    return F.from_json(F.lit(text), ddl)


def _named(token: Column) -> Column:
    legacy = {n: v for n, v in html5.items() if not n.endswith(";")}
    name = F.substr(token, F.lit(2))
    table = _constant(_named_json(), "map<string,map<string,string>>")
    whole = F.try_element_at(F.try_element_at(table, F.substring(name, 1, 2)), name)
    longest_first = "|".join(sorted(legacy, key=len, reverse=True))
    head = F.regexp_extract(name, f"^(?:{longest_first})", 0)
    legacy_values = _constant(json.dumps(legacy), "map<string,string>")
    tail = F.substr(name, F.length(head) + 1)
    partial = F.when(head != "", F.concat(F.try_element_at(legacy_values, head), tail))
    return (
        F.when(token == "&amp;", F.lit("&"))
        .when(token == "&lt;", F.lit("<"))
        .when(token == "&gt;", F.lit(">"))
        .when(token == "&quot;", F.lit('"'))
        .otherwise(F.coalesce(whole, partial, token))
    )


def _numeric(token: Column) -> Column:
    hexadecimal = token.rlike("^&#[xX]")
    digits = F.regexp_replace(token, "^&#[xX]?0*|;$", "")
    # Anything longer than nine digits is beyond the last code point anyway.
    digits = F.when(F.length(digits) > 9, F.lit("110000000")).otherwise(F.concat(F.lit("0"), digits))
    point = F.when(hexadecimal, F.conv(digits, 16, 10).cast("bigint")).otherwise(digits.cast("bigint"))
    return let(point, _character)


def _character(point: Column) -> Column:
    remapped = _constant(json.dumps({p: unescape(f"&#{p};") for p in _REMAPPED}), "map<string,string>")
    dropped = (
        point.between(0x1, 0x8)
        | (point == 0xB)
        | point.between(0xE, 0x1F)
        | (point == 0x7F)
        | point.between(0xFDD0, 0xFDEF)
        | ((point % 0x10000) >= 0xFFFE)
    )
    return (
        F.when((point > 0x10FFFF) | point.between(0xD800, 0xDFFF), F.lit("\ufffd"))
        .when(point.isin(*_REMAPPED), F.try_element_at(remapped, point.cast("string")))
        .when(dropped, F.lit(""))
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32"))
    )


def decode_entities(text: Column) -> Column:
    """Decode every character reference in ``text``; text without ``&`` passes through."""

    def piece(t: Column) -> Column:
        return (
            F.when(t.startswith("&#") & (F.length(t) > 2), _numeric(t))
            .when(t.startswith("&") & (F.length(t) > 1), _named(t))
            .otherwise(t)
        )

    def decoded(t: Column) -> Column:
        return F.array_join(F.transform(F.regexp_extract_all(t, F.lit(_PIECES), F.lit(0)), piece), "")

    # The text is often the end of a long chain of replacements, which must run once only.
    return let(text, lambda t: F.when(F.contains(t, F.lit("&")), decoded(t)).otherwise(t))

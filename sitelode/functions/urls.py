"""URL columns: splitting, resolving, canonical keys, roots and prefixes.

``parse_url`` rejects many URLs found in real pages (spaces, ``|``), so URLs
are split with anchored patterns that accept any text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"
_AFTER_SCHEME = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?"
_AFTER_NETLOC = _AFTER_SCHEME + r"(?://[^/?#]*)?"


def _clean(url: Column) -> Column:
    """Drop leading controls and embedded line breaks, as browsers do."""
    return F.regexp_replace(url, r"^[\x00-\x20]+|[\t\r\n]", "")


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(_clean(url), _SCHEME, 1))


def netloc(url: Column) -> Column:
    return F.regexp_extract(_clean(url), _AFTER_SCHEME + r"//([^/?#]*)", 1)


def _path_and_params(url: Column) -> Column:
    return F.regexp_extract(_clean(url), _AFTER_NETLOC + r"([^?#]*)", 1)


def _path_of(whole: Column) -> Column:
    return F.regexp_extract(whole, r"(?s)^((?:.*/)?[^/;]*)", 1)


def _params_of(whole: Column) -> Column:
    return F.regexp_extract(whole, r"(?s)^(?:.*/)?[^/;]*;([^/]*)\z", 1)


def path(url: Column) -> Column:
    """Path without the ``;parameters`` of its last segment."""
    return _path_of(_path_and_params(url))


def query(url: Column) -> Column:
    return F.regexp_extract(_clean(url), _AFTER_NETLOC + r"[^?#]*\?([^#]*)", 1)


def host(url: Column) -> Column:
    """Host name in lower case, without credentials, brackets or port."""
    bare = F.regexp_replace(netloc(url), r"^.*@", "")
    bracketed = F.regexp_extract(bare, r"^\[([^\]]*)\]", 1)
    return F.lower(F.when(bracketed != "", bracketed).otherwise(F.regexp_replace(bare, r":.*\z", "")))


def without_fragment(url: Column) -> Column:
    return F.substring_index(url, "#", 1)


def site_root(url: Column) -> Column:
    """``scheme://netloc`` with no trailing slash."""
    return F.concat(scheme(url), F.lit("://"), netloc(url))


def default_prefix(url: Column) -> Column:
    """Directory of the URL: its path up to and including the last slash."""
    directory = F.regexp_replace(path(url), r"[^/]*\z", "")
    return F.when(directory == "", F.lit("/")).otherwise(directory)


def _assemble(scheme_: Column, netloc_: Column, path_: Column, params_: Column, query_: Column) -> Column:
    rooted = F.when((path_ != "") & ~path_.startswith("/"), F.concat(F.lit("/"), path_)).otherwise(path_)
    return F.concat(
        scheme_,
        F.lit("://"),
        netloc_,
        rooted,
        F.when(params_ != "", F.concat(F.lit(";"), params_)).otherwise(F.lit("")),
        F.when(query_ != "", F.concat(F.lit("?"), query_)).otherwise(F.lit("")),
    )


def canonical_url(url: Column) -> Column:
    """Dedup key: lower-case scheme and host, no fragment, no trailing slashes, root kept as ``/``."""
    whole = _path_and_params(url)
    trimmed = F.regexp_replace(_path_of(whole), r"/+\z", "")
    key_path = F.when(trimmed == "", F.lit("/")).otherwise(trimmed)
    return _assemble(scheme(url), F.lower(netloc(url)), key_path, _params_of(whole), query(url))


def _drop_dot_segments(joined: Column) -> Column:
    kept = F.aggregate(
        F.split(joined, "/"),
        F.array().cast("array<string>"),
        lambda acc, seg: F.when(seg == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(seg == ".", acc)
        .otherwise(F.array_append(acc, seg)),
    )
    ended_on_dots = joined.rlike(r"(?:^|/)\.\.?\z")
    text = F.array_join(F.when(ended_on_dots, F.array_append(kept, F.lit(""))).otherwise(kept), "/")
    return F.when(text == "", F.lit("/")).otherwise(text)


def reference_parts(ref: Column) -> Column:
    """Struct of everything ``resolve`` needs from one reference."""
    whole = _path_and_params(ref)
    return F.struct(
        ref.alias("raw"),
        scheme(ref).alias("scheme"),
        netloc(ref).alias("netloc"),
        _path_of(whole).alias("path"),
        _params_of(whole).alias("params"),
        query(ref).alias("query"),
    )


def resolve_parts(base: Column, ref: Column) -> Column:
    """Resolve one split reference against one split base; the fragment is dropped.

    A netloc with an unpaired bracket cannot be a host, so it resolves to null.
    """
    directory = F.regexp_replace(base["path"], r"[^/]*\z", "")
    joined = F.when(ref["path"].startswith("/"), ref["path"]).otherwise(
        F.regexp_replace(F.concat(directory, F.lit("/"), ref["path"]), "/+", "/")
    )
    merged = let(
        joined, lambda j: F.when(j.rlike(r"(?:^|/)\.\.?(?:/|\z)"), _drop_dot_segments(j)).otherwise(j)
    )
    same_document = (ref["path"] == "") & (ref["params"] == "")
    broken = F.contains(ref["netloc"], F.lit("[")) != F.contains(ref["netloc"], F.lit("]"))
    return (
        F.when(broken, F.lit(None).cast("string"))
        .when((ref["scheme"] != "") & (ref["scheme"] != base["scheme"]), without_fragment(ref["raw"]))
        .when(
            ref["netloc"] != "",
            _assemble(base["scheme"], ref["netloc"], ref["path"], ref["params"], ref["query"]),
        )
        .when(
            same_document,
            _assemble(
                base["scheme"],
                base["netloc"],
                base["path"],
                base["params"],
                F.when(ref["query"] != "", ref["query"]).otherwise(base["query"]),
            ),
        )
        .otherwise(let(merged, lambda m: _assemble(base["scheme"], base["netloc"], m, ref["params"], ref["query"])))
    )


def resolve_url(base: Column, ref: Column) -> Column:
    """Absolute URL of ``ref`` seen from the http(s) page ``base``."""
    resolved = let(
        reference_parts(base), lambda b: let(reference_parts(ref), lambda r: resolve_parts(b, r))
    )
    return F.when(ref == "", base).otherwise(resolved)

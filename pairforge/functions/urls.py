"""Video and page address expressions, and like counts in page text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairforge import constants as K


def _first_group(col: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(col, pattern, 1), F.lit(""))


def video_id(url: Column) -> Column:
    embedded = F.contains(url, F.lit("embed"))
    return F.when(embedded, _first_group(url, K.RX_EMBED)).otherwise(
        _first_group(url, K.RX_PLAIN_VIDEO)
    )


def watch_url(url: Column) -> Column:
    embed = _first_group(url, K.RX_EMBED_ANY)
    return F.coalesce(F.concat(F.lit(K.WATCH_PREFIX), embed), url)


def embed_id(url: Column) -> Column:
    last_part = F.element_at(F.split(url, "/"), -1)
    inside = F.contains(url, F.lit(K.EMBED_MARK))
    return F.when(inside, F.split_part(last_part, F.lit("?"), F.lit(1))).otherwise(F.lit(""))


def like_count(html: Column) -> Column:
    """First pattern that hits, in the fixed order; unreadable pages give 0."""
    hit = F.coalesce(*[_first_group(html, pattern) for pattern in K.RX_LIKES])
    return F.coalesce(F.replace(hit, F.lit(","), F.lit("")).try_cast("bigint"), F.lit(0).cast("bigint"))


def _without_dot_segments(path: Column) -> Column:
    """``/a/./b/../c`` -> ``/a/c``; a trailing dot segment leaves a slash."""
    segments = F.split(path, "/")
    kept = F.aggregate(
        F.slice(segments, F.lit(2), F.size(segments)),
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.array_append(done, part)),
    )
    ends_open = F.rlike(path, F.lit(r"/\.\.?$"))
    closed = F.when(ends_open & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.lit("/"), F.array_join(kept, "/"), closed)


def absolute_url(base: Column, ref: Column) -> Column:
    """Resolve ``ref`` against ``base`` (scheme-, root- and path-relative forms)."""
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    site = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)", 1)
    page = F.regexp_replace(base, r"[?#].*$", "")
    folder = F.regexp_extract(page, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]+(/.*/|/)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    rooted = F.when(F.startswith(ref, F.lit("/")), ref).otherwise(F.concat(folder, ref))
    path = F.regexp_extract(rooted, r"^([^?#]*)", 1)
    tail = F.substring(rooted, F.length(path) + 1, F.length(rooted))
    return (
        F.when(ref == "", base)
        .when(F.rlike(ref, F.lit(r"^[a-zA-Z][a-zA-Z0-9+.-]*:")), ref)
        .when(F.startswith(ref, F.lit("//")), F.concat(scheme, ref))
        .when(F.startswith(ref, F.lit("#")), F.concat(F.regexp_replace(base, r"#.*$", ""), ref))
        .when(F.startswith(ref, F.lit("?")), F.concat(page, ref))
        .otherwise(F.concat(site, _without_dot_segments(path), tail))
    )

"""Identities: digests, document ids, content-addressed paths and partial dates."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import filled


def json_text(c: Column) -> Column:
    """A string as JSON text: control characters as lower-case escapes, all else as it is."""
    inner = F.to_json(F.array(F.coalesce(c, F.lit(""))))
    text = F.substr(inner, F.lit(2), F.length(inner) - 2)
    # The engine writes hexadecimal escapes in capitals.
    for code in (*range(0x08), 0x0B, *range(0x0E, 0x20)):
        big, small = f"\\u{code:04X}", f"\\u{code:04x}"
        if big != small:
            text = F.replace(text, F.lit(big), F.lit(small))
    return text


def date_text(year: Column, month: Column, day: Column) -> Column:
    """A partial date as sortable text; absent parts are zeros and a year isn't padded."""
    two = lambda c: F.lpad(F.coalesce(c, F.lit(0)).cast("string"), 2, "0")
    own = F.when(F.coalesce(year, F.lit(0)) == 0, F.lit("0000")).otherwise(year.cast("string"))
    return F.concat_ws("-", own, two(month), two(day))


def article_id(title: Column, dates: Column, is_range: Column, authors: Column, file_id: Column) -> Column:
    """Ten hex digits from title, sorted date texts, the range flag, sorted authors and the file's id."""
    listed = lambda c: F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(c), json_text), ","), F.lit("]"))
    empty = F.array().cast("array<string>")
    value = F.concat_ws(
        ",",
        json_text(title),
        listed(F.coalesce(dates, empty)),
        F.coalesce(is_range, F.lit(False)).cast("string"),
        listed(F.coalesce(authors, empty)),
        json_text(file_id),
    )
    return F.left(F.md5(F.concat(F.lit("["), value, F.lit("]"))), F.lit(10))


def document_id(archive: Column, article: Column, publication: Column) -> Column:
    """archive:length of the article id:article id:publication id."""
    return F.concat_ws(":", archive.cast("string"), F.length(article).cast("string"), article, publication)


def source_key(repository: Column, number: Column) -> Column:
    return F.concat(repository, F.lit("#"), number.cast("string"))


def patch_path(article: Column, publication: Column) -> Column:
    return F.concat(F.lit("["), article, F.lit("]["), publication, F.lit("].ts"))


def patch_ids(path: Column) -> Column:
    """(article, publication) of a patch path, with or without an archive folder; null parts if it is none."""
    pattern = r"\A(?:archives\d+/)?\[([^\]\[]+)\]\[([^\]\[]+)\]\.ts\z"
    part = lambda i: F.nullif(F.regexp_extract(path, pattern, i), F.lit(""))
    return F.struct(part(1).alias("article"), part(2).alias("publication"))


def url_suffix(url: Column) -> Column:
    """The lower-case extension of a URL's path, with its dot; empty if it has none."""
    last = F.regexp_extract(F.regexp_replace(url, r"[?#].*\z", ""), r"([^/]*)\z", 1)
    return F.lower(F.regexp_extract(last, r".(\.[^.]+)\z", 1))


def content_path(archive: Column, digest: Column, url: Column) -> Column:
    """Where content of this digest is kept: archives<id>/<first two digits>/<digest><suffix>."""
    suffix = filled(url_suffix(url), F.lit(".bin"))
    return F.concat(F.lit("archives"), archive.cast("string"), F.lit("/"), F.left(digest, F.lit(2)), F.lit("/"), digest, suffix)


def batch_digest(keys: Column) -> Column:
    """Ten hex digits of a list of keys."""
    return F.left(F.sha2(F.array_join(keys, ","), 256), F.lit(10))


def generation_id(*digests: Column) -> Column:
    """The first sixteen digits of each digest, joined by dashes."""
    return F.concat_ws("-", *(F.left(d, F.lit(16)) for d in digests))


def article_id_of(article: dict) -> str:
    """``article_id`` of a plain value, for texts that are read outside of columns."""
    dates = sorted(f"{d.get('year') or '0000'}-{d.get('month') or 0:02d}-{d.get('day') or 0:02d}" for d in article.get("dates") or [])
    value = [article.get("title"), dates, bool(article.get("is_range_date")), sorted(article.get("authors") or []), article.get("file_id") or ""]
    return hashlib.md5(json.dumps(value, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()[:10]

"""String columns with full Unicode rules: Spark's regular expressions are ASCII by default."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def filled(c: Column, other: Column | None = None) -> Column:
    """``c``, or ``other`` (the empty string) where it is null or empty."""
    return F.coalesce(F.nullif(c, F.lit("")), other if other is not None else F.lit(""))


def differs(a: Column, b: Column) -> Column:
    """Inequality in which null is a value."""
    return ~a.eqNullSafe(b)


def full_match(c: Column, pattern: str) -> Column:
    """Whether the whole of ``c`` matches; ``pattern`` may begin with inline flags."""
    flags = ""
    if pattern.startswith("(?") and pattern[2].isalpha():
        flags, pattern = pattern[: pattern.index(")") + 1], pattern[pattern.index(")") + 1 :]
    return c.rlike(rf"{flags}\A(?:{pattern})\z")


def quoted_path(c: Column) -> Column:
    """Percent-encoded for a URL path; slashes stay."""
    out = F.url_encode(c)
    for code, char in (("%2F", "/"), ("+", "%20"), ("%7E", "~"), ("*", "%2A")):
        out = F.replace(out, F.lit(code), F.lit(char))
    return out


def utf16_length(c: Column) -> Column:
    """Length in UTF-16 code units."""
    return F.length(c) + F.regexp_count(c, F.lit(r"[\x{10000}-\x{10FFFF}]"))


def excerpt(c: Column, most: int = 160) -> Column:
    """White space collapsed to single blanks, stripped, and cut."""
    return F.left(strip(F.regexp_replace(c, r"(?U)[\s\x1c-\x1f]+", " ")), F.lit(most))


def count_of(c: Column, piece: str) -> Column:
    """Occurrences of a literal that don't overlap."""
    return ((F.length(c) - F.length(F.replace(c, F.lit(piece), F.lit("")))) / len(piece)).cast("int")


def natural_key(c: Column, width: int = 20) -> Column:
    """A sort key in which digit runs compare as numbers and letters without case: runs are padded to ``width``."""
    runs = F.regexp_extract_all(F.lower(c), F.lit(r"[0-9]+|[^0-9]+"), F.lit(0))
    digits = lambda r: F.regexp_replace(r, r"\A0+(?=[0-9])", "")
    padded = lambda r: F.concat(F.repeat(F.lit("0"), F.greatest(F.lit(width) - F.length(digits(r)), F.lit(0))), digits(r))
    return F.transform(runs, lambda r: F.when(r.rlike(r"\A[0-9]"), padded(r)).otherwise(r))


def page_number(path: Column) -> Column:
    """The number at the end of a page file's name, by which pages are sorted; null without one."""
    return F.regexp_extract(path, r"-([0-9]+)(?:\.[^./]*)?\z", 1).try_cast("int")


def marker_encode(c: Column) -> Column:
    """URL-safe base64 without padding."""
    return F.rtrim(F.translate(F.base64(F.encode(c, "UTF-8")), "+/\r\n", "-_"), F.lit("="))


def marker_decode(c: Column) -> Column:
    """The text of ``marker_encode``; null where it isn't one."""
    plain = F.translate(c, "-_", "+/")
    padded = F.concat(plain, F.repeat(F.lit("="), F.pmod(-F.length(plain), F.lit(4))))
    data = F.try_to_binary(padded, F.lit("base64"))
    return F.when(F.is_valid_utf8(data.cast("string")), data.cast("string"))


def longest_run(c: Column, char: str) -> Column:
    """Length of the longest run of one character."""
    runs = F.regexp_extract_all(c, F.lit(f"[{char}]+"), F.lit(0))
    return F.coalesce(F.array_max(F.transform(runs, F.length)), F.lit(0))


def chunks(c: Column, size: int) -> Column:
    """Pieces of ``size`` characters: structs of part (from 1), parts and text; one empty piece for the empty text."""
    parts = F.greatest(F.ceil(F.length(c) / size), F.lit(1)).cast("int")
    return F.transform(
        F.sequence(F.lit(1), parts),
        lambda i: F.struct(i.alias("part"), parts.alias("parts"), F.substr(c, (i - 1) * size + 1, F.lit(size)).alias("text")),
    )


def numbered(comments: Column) -> Column:
    """Each comment behind its number in footnote brackets."""
    return F.transform(comments, lambda t, i: F.concat(F.lit("〔"), (i + 1).cast("string"), F.lit("〕"), F.coalesce(t, F.lit(""))))


def full_text(parts: Column, comments: Column) -> Column:
    """Paragraphs, then a blank line and the numbered comments."""
    body = F.array_join(parts, "\n")
    return F.when(F.size(comments) > 0, F.concat(body, F.lit("\n\n"), F.array_join(numbered(comments), "\n"))).otherwise(body)


def with_pivots(text: Column, pivots: Column) -> Column:
    """``text`` with footnote marks put in: ``pivots`` is an array of (offset, index), in code points."""
    last_first = F.array_sort(
        F.transform(pivots, lambda p, i: F.struct((-p["offset"]).alias("offset"), i.alias("at"), p["index"].alias("index")))
    )
    put = lambda s, p: F.concat(
        F.substr(s, F.lit(1), -p["offset"]), F.lit("〔"), p["index"].cast("string"), F.lit("〕"), F.substr(s, -p["offset"] + 1)
    )
    return F.aggregate(last_first, text, put)

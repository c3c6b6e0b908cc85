"""Cleaning of articles: texts, authors, archive rules, and how readable a text is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.text import strip
from ..functions.udfs import MOJIBAKE_SIGNS, clean_authors_udf, cleaned, split_authors_udf, unescaped
from .audit import has_content


def html_text(c: Column, terminated: bool = False) -> Column:
    """Without tags, with entities resolved, stripped.

    With ``terminated``, only entities that end in a semicolon: a name cut off at a tag
    runs into what follows the tag and would be taken for an old name without one.
    """
    return strip(unescaped(F.regexp_replace(c, "(?s)<[^>]*>", ""), terminated))


def clean_articles(articles: DataFrame, archive_col: str = "archive_id") -> DataFrame:
    """Articles of the archives that are cleaned, cleaned; others as they are; rows that the archive's rules drop, gone.

    ``articles`` has archive_id, title, description, comments, parts and authors.
    Arrays are cleaned as one text joined by a sign that the cleaning leaves alone, so
    each column crosses to Python once.
    """
    archive = F.col(archive_col)
    selected = archive.isin(*rules.CLEANED_ARCHIVES)
    each = lambda c: F.when(selected, cleaned(c)).otherwise(c)
    out = articles.withColumns({"title": each(F.col("title")), "description": each(F.col("description"))})
    out = _cleaned_list(out, "comments", selected)
    texts = out.withColumn("__texts", F.transform("parts", lambda p: p["text"]))
    texts = _cleaned_list(texts, "__texts", selected)
    parts = F.transform(F.arrays_zip("parts", "__texts"), lambda z: F.struct(z["parts"]["type"].alias("type"), z["__texts"].alias("text")))
    out = texts.withColumn("parts", parts).drop("__texts")
    authors = split_authors_udf(clean_authors_udf("authors"), archive)
    out = out.withColumn("authors", F.when(selected, authors).otherwise(F.col("authors")))
    article = F.struct("description", "comments", "parts")
    whole = F.to_json(F.struct("title", "description", "comments", "parts", "authors"))
    corrupt = (archive == rules.NO_REPLACEMENT) & F.contains(whole, F.lit("�"))
    empty = archive.isin(*rules.NO_EMPTY_CONTENT) & ~has_content(article)
    return out.where(~(corrupt | empty))


def _cleaned_list(df: DataFrame, column: str, selected: Column) -> DataFrame:
    from pyspark.sql import types as T

    from ..functions.udfs import clean_text, mapped

    each = mapped(lambda xs: [None if x is None else clean_text(x) for x in xs], T.ArrayType(T.StringType()))
    return df.withColumn(column, F.when(selected, each(column)).otherwise(F.col(column)))


def article_text(a: Column) -> Column:
    """Description, parts and comments, one a line; empty ones left out."""
    lines = F.concat(
        F.array(a["description"]),
        F.coalesce(F.transform(a["parts"], lambda p: p["text"]), F.array().cast("array<string>")),
        F.coalesce(a["comments"], F.array().cast("array<string>")),
    )
    return F.array_join(F.filter(lines, lambda x: F.coalesce(x, F.lit("")) != ""), "\n")


def quality_score(c: Column) -> Column:
    """How readable a text looks in its first 20,000 characters, from counts of character classes; null or empty: -1,000,000."""
    head = F.left(c, F.lit(20_000))
    n = lambda p: F.regexp_count(head, F.lit(p))
    score = (
        n(r"[一-鿿぀-ヿ가-힯]") * 4
        + n(r"[\x20-\x7e]") * 0.15
        - n("�") * 30
        - n(r"[\x00-\x08\x0b\x0c\x0e-\x1f]") * 20
        - n(rf"[Ѐ-ӿ{MOJIBAKE_SIGNS}]") * 6
    )
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit(-1_000_000.0)).otherwise(score.cast("double"))


def probably_mojibake(c: Column) -> Column:
    """No CJK characters and twenty Cyrillic or telling ones in the first 4,000 characters.

    A sign that is both Cyrillic and telling counts twice.
    """
    head = F.left(c, F.lit(4000))
    n = lambda p: F.regexp_count(head, F.lit(p))
    return (n("[一-鿿]") == 0) & (n("[Ѐ-ӿ]") + n(f"[{MOJIBAKE_SIGNS}]") >= 20)


def needs_rewrite(data: Column) -> Column:
    """A stored text that is neither a pointer nor readable UTF-8."""
    pointer = F.startswith(data, F.encode(F.lit("version https://git-lfs"), "UTF-8"))
    text = data.cast("string")
    return ~pointer & (~F.is_valid_utf8(text) | probably_mojibake(text))

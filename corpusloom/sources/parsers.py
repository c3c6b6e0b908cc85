"""Source formats: marked text, HTML pages, digests of several articles, JSON."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip
from ..functions.udfs import unescaped

#: The fields of marked text.
MARKS = {"title": "BT/标题", "subtitle": "FT/副题", "authors": "ZZ/作者", "date": "RQ/日期"}


def _marked(c: Column, name: str, inner: str = ".*?") -> Column:
    mark = MARKS[name]
    return F.regexp_extract(c, f"(?s)〖{mark}〗({inner})〖-{mark}〗", 1)


def _has(c: Column, name: str) -> Column:
    return c.rlike(f"(?s)〖{MARKS[name]}〗.*?〖-{MARKS[name]}〗")


def marked_article(c: Column) -> Column:
    """Title (with subtitle), authors and date of marked text; null without title or date."""
    date = _marked(c, "date", r"\d{8}")
    part = lambda a, n: F.substr(date, F.lit(a), F.lit(n)).try_cast("int")
    article = F.struct(
        F.concat(_marked(c, "title"), _marked(c, "subtitle")).alias("title"),
        F.when(_has(c, "authors"), F.split(_marked(c, "authors"), " ", -1)).otherwise(F.array().cast("array<string>")).alias("authors"),
        F.struct(part(1, 4).alias("year"), part(5, 2).alias("month"), part(7, 2).alias("day")).alias("date"),
    )
    return F.when(_has(c, "title") & (date != ""), article)


def joined_titles(c: Column) -> Column:
    """Title, authors and date of a JSON record whose title comes in three pieces."""
    raw = F.from_json(c, "struct<ytitle:string,mtitle:string,ftitle:string,authors:array<string>,date:array<struct<year:int,month:int,day:int>>>")
    return F.struct(
        F.concat(*(F.coalesce(raw[k], F.lit("")) for k in ("ytitle", "mtitle", "ftitle"))).alias("title"),
        F.coalesce(raw["authors"], F.array().cast("array<string>")).alias("authors"),
        raw["date"].alias("dates"),
    )


def dashed_date(c: Column) -> Column:
    """A partial date from ``Y-M-D``, where 0 and missing parts are none."""
    part = lambda i: F.nullif(F.get(F.split(c, "-"), F.lit(i)).try_cast("int"), F.lit(0))
    return F.struct(F.get(F.split(c, "-"), F.lit(0)).try_cast("int").alias("year"), part(1).alias("month"), part(2).alias("day"))


def _node_text(c: Column) -> Column:
    return strip(unescaped(F.regexp_replace(c, "(?s)<[^>]*>", "")))


def page_article(pages: DataFrame, html_col: str) -> DataFrame:
    """Add title, author and date of an article page: first h3, first strong, and the date in the info box; ``error`` without them."""
    node = lambda tag: F.regexp_extract(html_col, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1)
    info = F.regexp_extract(html_col, r"""(?is)<div\b[^>]*class=(['"])[^'"]*\binfo\b[^'"]*\1[^>]*>(.*?)</div\s*>""", 2)
    date = F.regexp_extract(info, r"\d{4}-\d{2}-\d{2}", 0)
    known = F.col(html_col).rlike(r"(?is)<h3\b[^>]*>.*?</h3\s*>") & (date != "")
    return pages.withColumns(
        {"title": _node_text(node("h3")), "author": _node_text(node("strong")), "date": dashed_date(date), "error": F.when(~known, "identity is missing")}
    )


def json_articles(c: Column) -> Column:
    """The articles of a JSON source: a list, or one object by itself."""
    kind = "array<struct<title:string,authors:array<string>,dates:array<struct<year:int,month:int,day:int>>>>"
    listed = F.when(F.startswith(F.ltrim(c), F.lit("[")), c).otherwise(F.concat(F.lit("["), c, F.lit("]")))
    return F.coalesce(F.from_json(listed, kind), F.array().cast(kind))


def config_value(c: Column, name: str) -> Column:
    """The quoted value of a field in a configuration text; empty if there is none."""
    return F.regexp_extract(c, rf"""['"]?\b{name}\b['"]?\s*:\s*(['"])([^'"]+)\1""", 2)


def config_path(c: Column) -> Column:
    """The source path of a configuration, without slashes around it; null if it is absolute or steps up."""
    path = config_value(c, "path")
    good = (strip(path) != "") & ~F.startswith(path, F.lit("/")) & ~F.array_contains(F.split(path, "/"), "..")
    return F.when(good, F.btrim(path, F.lit("/")))


def appended_patch(c: Column, patch: Column) -> Column:
    """A patch list with one more patch before its last bracket."""
    head = F.rtrim(F.regexp_replace(c, r"(?s)\][^\]]*\z", ""), F.lit(" \n"))
    tail = F.regexp_extract(c, r"(?s)\]([^\]]*)\z", 1)
    comma = F.when(head.rlike(r"[\[,]\z"), "").otherwise(",")
    return F.concat(head, comma, F.lit("\n"), patch, F.lit("\n]"), tail)


#: Fixed values of the digest format: marks, and three titles that the format garbles.
OPEN, CLOSE, DOT, BACK = "~{", "~}", "·", "back to TOC"
GARBLED = {
    "端思潮》一书的电子": "文化大革命和它的异端思潮（连载之一）",
    "初所撰写的对文革的反思〈": "我心中的文革",
    "·杨道远·": "武汉地区文革初期的“五十天”（上）——《武汉地区文革纪实》选载",
}
SERIAL = "杂志上连载"
LONGEST_AUTHOR, LONGEST_TITLE = 10, 50


def _quoted(text: str) -> Iterator[str]:
    """The marked stretches of a text, without notes in brackets."""
    for piece in re.findall(r"~\{(.*?)~\}", text, re.S):
        if not piece.strip().startswith(("【", "〖")):
            yield piece.strip()


def _segment(text: str) -> tuple[int, str, list[str]] | None:
    plain = DOT + CLOSE not in text
    kind = int(plain and bool(re.search(rf"\n +{DOT}", text)))
    if plain:
        stop = "</a>" if BACK not in text and "</a>" in text else "\n\n"
        head = text[: max(0, text.find(stop))]
    else:
        head = re.split(rf"~\{{[ 　]*{DOT}", text, maxsplit=1)[0]
    rest = text[len(head) :]
    title = head.split("</a>", 1)[0].partition(">")[2].strip() if kind else "".join(_quoted(head))
    if title.startswith(SERIAL):
        return None
    for start, better in GARBLED.items():
        if title.startswith(start):
            rest = text[text.find(start) :] if start.startswith(DOT) else rest
            title = better
            break
    low, high = rest.find(DOT) + 1, rest.find(DOT + ("\n" if kind else CLOSE))
    line = rest[low:high].strip() if 0 < low <= high else ""
    authors = [a for a in (re.sub("[ 　]", "", x) for x in line.split(DOT)) if a]
    if not title or len(title) > LONGEST_TITLE or any(len(a) >= LONGEST_AUTHOR for a in authors):
        return None
    return kind, title, authors


def digest_articles(content: str) -> Iterator[tuple[int, int, str, list[str]]]:
    """(segment, kind, title, authors) of the articles of a digest page."""
    for i, raw in enumerate(content.split("<a name")[1:], 1):
        text = raw.replace("\r\n", "\n").replace(f"{BACK}</a>\n\n", f"{BACK}</a>\n").replace("　", " ").replace("\t", " ")
        if not text.startswith("=T") and (found := _segment(text)):
            yield (i, *found)


def digest_rows(pages: DataFrame, content_col: str, keep: list[str]) -> DataFrame:
    """One row for each article of digest pages: the kept columns, segment, kind, title and authors."""

    def run(frames):
        import pandas as pd

        for frame in frames:
            rows = []
            for values in frame.itertuples(index=False):
                row = dict(zip(frame.columns, values, strict=True))
                rows += [[*(row[k] for k in keep), *found] for found in digest_articles(row[content_col] or "")]
            yield pd.DataFrame(rows, columns=[*keep, "segment", "kind", "title", "authors"])

    schema = T.StructType([pages.schema[k] for k in keep])
    schema = schema.add("segment", T.IntegerType()).add("kind", T.IntegerType()).add("title", T.StringType()).add("authors", T.ArrayType(T.StringType()))
    return pages.select(*dict.fromkeys([*keep, content_col])).mapInPandas(run, schema)

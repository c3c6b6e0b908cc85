"""How changes and values are shown: escaped, fenced, one line each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import longest_run

#: Signs with a meaning in markup, names of metadata fields, title prefixes.
SIGNS = "`*_[]()#+-!|~"
LABELS = {
    "title": "标题", "authors": "作者", "dates": "日期", "tags": "标签",
    "name": "来源名称", "author": "来源作者", "type": "来源类型", "files": "来源文件",
}
TITLE_PREFIX = r"\A(?:校订审核：|校订\s*)+"
EMPTY = "（空）"


def markdown_value(c: Column) -> Column:
    """A value that markup leaves alone, on one line."""
    text = F.replace(F.coalesce(c, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(sign), F.lit(entity))
    escaped = F.regexp_replace(text, r"([`*_\[\]()#+\-!|~])", r"\\$1")
    return F.regexp_replace(escaped, r"\r\n|\r|\n", "<br>")


def fenced(c: Column) -> Column:
    """A text block in a fence longer than any run of backticks in it."""
    fence = F.repeat(F.lit("`"), F.greatest(F.lit(3), longest_run(c, "`") + 1))
    return F.concat(fence, F.lit("text\n"), F.coalesce(c, F.lit("")), F.lit("\n"), fence)


def clean_title(c: Column) -> Column:
    """A title without repeated prefixes, 100 characters at most."""
    return F.left(F.regexp_replace(c, TITLE_PREFIX, ""), F.lit(100))


def field_label(c: Column) -> Column:
    names = reduce(lambda w, kv: w.when(c == kv[0], kv[1]), [*LABELS.items()][1:], F.when(c == "title", LABELS["title"]))
    return names.otherwise(c)


def tag_text(tag: Column) -> Column:
    """A tag's name with its type in brackets."""
    kind = F.coalesce(tag["type"], F.lit(""))
    return F.concat(F.coalesce(tag["name"], F.lit("")), F.when(kind != "", F.concat(F.lit("（"), kind, F.lit("）"))).otherwise(""))


def shown_list(items: Column) -> Column:
    """Items below each other, or the sign for none."""
    return F.when(F.size(items) > 0, F.array_join(F.transform(items, markdown_value), "<br>")).otherwise(EMPTY)


def list_line(label: Column, removed: Column, added: Column) -> Column:
    """One line of what a list lost and gained; null for neither."""
    marked = lambda items, a, word: F.when(
        F.size(items) > 0,
        F.concat(F.lit(word + " "), F.array_join(F.transform(items, lambda x: F.concat(F.lit(a), markdown_value(x), F.lit(a))), "、")),
    )
    parts = F.concat_ws("；", marked(removed, "~~", "删除"), marked(added, "**", "新增"))
    return F.when(parts != "", F.concat(F.lit("- "), label, F.lit("："), parts))


def change_line(change: Column) -> Column:
    """One line for a change row; metadata lists have ``list_line``."""
    place = F.coalesce(change["index"].cast("string"), F.lit(""))
    kind = change["kind"]
    arrow = lambda a, b: F.concat(markdown_value(change[a]), F.lit(" → "), markdown_value(change[b]))
    label = F.concat(F.when(kind == "part", "段落 ").otherwise("注释 "), place)
    edit = (
        F.when(change["delete"], F.concat(label, F.lit("（删除）："), markdown_value(change["original"])))
        .when(change["text"].isNotNull(), F.concat(label, F.when(change["insert"], "后").otherwise("前"), F.lit("插入："), markdown_value(change["text"])))
        .otherwise(F.concat(label, F.lit("："), arrow("original", "edited")))
    )
    line = (
        F.when(kind.isin("part", "comment"), edit)
        .when(kind == "part_type", F.concat(F.lit("段落 "), place, F.lit("：类型 "), arrow("old", "new")))
        .when(kind == "new_comment", F.concat(F.lit("新增注释 "), place, F.lit("："), markdown_value(change["text"])))
        .when(kind == "description", F.concat(F.lit("描述："), arrow("original", "edited")))
        .otherwise(F.concat(field_label(change["field"]), F.lit("："), arrow("old", "new")))
    )
    return F.concat(F.lit("- "), line)


def comparison_row(field: Column, old: Column, new: Column) -> Column:
    """A table row of a metadata field before and after; null where nothing changed."""
    show = lambda c: F.when(F.coalesce(c, F.lit("")) != "", markdown_value(c)).otherwise(EMPTY)
    row = F.concat(F.lit("| "), field_label(field), F.lit(" | "), show(old), F.lit(" | "), show(new), F.lit(" |"))
    return F.when(~old.eqNullSafe(new), row)

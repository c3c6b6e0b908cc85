"""Audit of article collections: rules to findings, findings to counts and samples.

A finding is (issue, path, field, sample).  A rule reports a document once.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates, rules
from ..functions.identity import document_id
from ..functions.text import count_of, excerpt, full_match, strip
from ..functions.udfs import walk_strings_udf

FINDING = "struct<issue:string,field:string,sample:string>"
ARTICLE = (
    "title string, description string, comments array<string>, parts array<struct<type:string,text:string>>, authors array<string>, "
    "dates array<struct<year:int,month:int,day:int>>, is_range_date boolean, file_id string"
)


def finding(issue: str, field: Column, sample: Column) -> Column:
    return F.struct(F.lit(issue).alias("issue"), field.cast("string").alias("field"), excerpt(sample.cast("string")).alias("sample"))


def _when(condition: Column, found: Column) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), found)


def around(text: Column, pattern: str, margin: int = 70) -> Column:
    """The first match with up to ``margin`` characters on both sides."""
    at = F.regexp_instr(text, F.lit(pattern))
    size = F.length(F.regexp_substr(text, F.lit(pattern)))
    first = F.greatest(at - margin, F.lit(1))
    return F.substr(text, first, at + size + margin - first)


def first_where(items: Column, condition: Callable[[Column], Column]) -> Column:
    """The first item for which the condition holds; null if none."""
    return F.get(F.filter(items, lambda x: F.coalesce(condition(x), F.lit(False))), F.lit(0))


def text_findings(strings: Column) -> Column:
    """Findings of the text rules over an array of (field, text): at most one for each rule, of the first text that has it."""
    found = []
    for issue, pattern in rules.TEXT_RULES.items():
        java = rules.java(pattern)
        first = first_where(strings, lambda s: s["text"].rlike(java))
        found.append(F.when(first.isNotNull(), finding(issue, first["field"], around(first["text"], java))))
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def _balanced(a: Column, pair: str) -> Column:
    return count_of(a, pair[0]) == count_of(a, pair[1])


def author_rules(a: Column) -> dict[str, Column]:
    """Each author rule as a condition on one name."""
    has = lambda *signs: reduce(Column.__or__, [F.contains(a, F.lit(s)) for s in signs])
    size = F.length(a)
    out = {
        "author_image_placeholder": full_match(a, rules.java(rules.AUTHOR_IMAGE)),
        "unbalanced_author_parenthesis": ~(_balanced(a, "()") & _balanced(a, "（）")),
        "square_bracket_author": has(*"[]［］"),
        "angle_bracket_author": has(*"<>"),
        "wrapped_author": full_match(a, "(?U)" + rules.AUTHOR_WRAPPED),
    }
    out |= {issue: a.rlike(rules.java(pattern)) for issue, pattern in rules.AUTHOR_RULES.items()}
    return out | {
        "unbalanced_author_delimiter": ~reduce(Column.__and__, [_balanced(a, p) for p in rules.AUDIT_PAIRS]),
        "very_long_author": size > rules.AUTHOR_LIMIT,
        "author_ascii_question": has("?"),
        "author_odd_edge": a.rlike(rules.java(rules.AUTHOR_ODD_EDGE)),
        "author_sentence_punctuation": (size >= rules.SENTENCE_LENGTH) & a.rlike(rules.AUTHOR_SENTENCE),
        "author_prose_cue": (size >= rules.PROSE_LENGTH) & a.rlike(rules.AUTHOR_PROSE),
        "author_many_slashes": count_of(a, "/") >= rules.MANY_SLASHES,
        "author_review_length": (size > rules.AUTHOR_REVIEW) & (size <= rules.AUTHOR_LIMIT) & ~a.isin(*rules.REVIEWED_LONG_AUTHORS),
    }


def author_findings(authors: Column) -> Column:
    """Findings of an array of names: at most one for each rule, with the place of the first name that breaks it."""
    placed = F.transform(authors, lambda a, i: F.struct(i.alias("i"), a.alias("a")))
    found = []
    for issue in author_rules(F.lit("")):
        first = first_where(placed, lambda x: author_rules(x["a"])[issue])
        found.append(F.when(first.isNotNull(), finding(issue, F.concat(F.lit("$.authors["), first["i"].cast("string"), F.lit("]")), first["a"])))
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def date_findings(values: Column) -> Column:
    """Findings of an array of partial dates."""
    placed = F.transform(values, lambda d, i: F.struct(i.alias("i"), d.alias("d")))
    conditions = {
        "non_four_digit_year": lambda d: dates.odd_year(d["year"]),
        "invalid_date": lambda d: ~F.coalesce(dates.valid_date(d["year"], d["month"], d["day"]), F.lit(False)),
    }
    found = []
    for issue, bad in conditions.items():
        first = first_where(placed, lambda x: bad(x["d"]))
        where = F.concat(F.lit("$.dates["), first["i"].cast("string"), F.lit("]"))
        found.append(F.when(first.isNotNull(), finding(issue, where, F.to_json(first["d"]))))
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def has_content(a: Column) -> Column:
    """Whether an article has any text: description, a comment or a part."""
    some = lambda c: strip(F.coalesce(c, F.lit(""))) != ""
    any_of = lambda c, f: F.coalesce(F.exists(c, f), F.lit(False))
    return some(a["description"]) | any_of(a["comments"], some) | any_of(a["parts"], lambda p: some(p["text"]))


def article_findings(articles: DataFrame, json_col: str = "content") -> DataFrame:
    """Add ``found``: all findings of an article given as JSON text."""
    kind = lambda c: F.coalesce(F.schema_of_variant(c), F.lit("VOID"))
    raw = F.try_parse_json(json_col)
    df = articles.withColumn("__v", raw).withColumn("__a", F.from_json(json_col, ARTICLE)).withColumn("__s", walk_strings_udf(json_col))
    is_object = F.startswith(kind(F.col("__v")), F.lit("OBJECT"))
    authors, when = F.try_variant_get("__v", "$.authors", "variant"), F.try_variant_get("__v", "$.dates", "variant")
    listed = lambda c: F.startswith(kind(c), F.lit("ARRAY"))
    none = F.array().cast(f"array<{FINDING}>")
    null = F.lit(None).cast("string")
    title = strip(F.coalesce(F.col("__a.title"), F.lit("")))
    own = F.filter(
        F.array(
            _when(title == "", finding("empty_title", null, F.lit(""))),
            _when(~has_content(F.col("__a")), finding("empty_content", null, F.lit(""))),
            _when(~listed(authors) & ~kind(authors).isin("VOID"), finding("authors_not_list", F.lit("$.authors"), F.to_json(authors))),
            _when(~listed(when) & ~kind(when).isin("VOID"), finding("dates_not_list", F.lit("$.dates"), F.to_json(when))),
        ),
        lambda x: x.isNotNull(),
    )
    every = F.concat(
        text_findings(F.col("__s")),
        own,
        F.when(listed(authors), author_findings(F.filter("__a.authors", lambda x: x.isNotNull()))).otherwise(none),
        F.when(listed(when), date_findings(F.col("__a.dates"))).otherwise(none),
    )
    found = F.when(is_object, every).otherwise(F.array(finding("article_not_object", null, F.lit(""))))
    return df.withColumn("found", found).drop("__v", "__a", "__s")


def parse_archives(text: str, last: int = 31) -> list[int]:
    """``all``, or numbers and ranges between commas, from 0 to ``last``."""
    if text == "all":
        return list(range(last + 1))
    picked: set[int] = set()
    for piece in text.split(","):
        low, dash, high = piece.partition("-")
        picked |= set(range(int(low), int(high if dash else low) + 1))
    if not picked or not picked <= set(range(last + 1)):
        raise ValueError(f"archives must be all or numbers from 0 through {last}")
    return sorted(picked)


def finding_counts(found: DataFrame, by: list[str]) -> DataFrame:
    """Findings of each issue, for each group and (with null group columns) over all."""
    return found.rollup("issue", *by).agg(F.count(F.lit(1)).alias("n")).where("issue is not null")


def finding_samples(found: DataFrame, by: list[str], order: list[str], k: int = 5) -> DataFrame:
    """The first ``k`` findings of each issue in each group; the limit is the feature."""
    place = F.row_number().over(Window.partitionBy(*by, "issue").orderBy(*order))
    return found.withColumn("place", place.cast("bigint")).where(F.col("place") <= k)


def document_totals(docs: DataFrame, by: list[str], id_col: str = "doc_id") -> DataFrame:
    """Documents, distinct ids and those overwritten by an equal id, in each group."""
    n = F.count(F.lit(1))
    per_id = docs.groupBy(*by, id_col).agg(n.alias("__n"))
    return per_id.groupBy(*by).agg(
        F.sum("__n").alias("indexed"), n.alias("unique_ids"), (F.sum("__n") - n).alias("overwritten")
    )


def duplicate_ids(docs: DataFrame, id_cols: list[str], path_col: str) -> DataFrame:
    """Ids that several paths share, with these paths in order."""
    found = docs.groupBy(*id_cols).agg(F.array_sort(F.collect_set(path_col)).alias("paths"))
    return found.where(F.size("paths") > 1)


def orphans(articles: DataFrame, owners: DataFrame, on: list[str]) -> DataFrame:
    """Articles under a root without an owner."""
    return articles.join(owners.select(*on).distinct(), on, "left_anti")


def multiple_owners(owners: DataFrame, on: list[str], id_col: str) -> DataFrame:
    """Roots with more than one owner, with the owners in order."""
    return owners.groupBy(*on).agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(id_col)).alias("ids")).where("n > 1")


def audit_members(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Findings and totals of archive members (archive_id, member_order, path, content; content null: unreadable).

    By suffix and depth a member is publication metadata, an article or its tags.
    """
    parts = F.split("path", "/")
    suffix = F.regexp_extract("path", r"[^/](\.[^./]+)$", 1)
    kinds = (
        F.when((suffix == ".metadata") & (F.size(parts) == 3), "metadata")
        .when((suffix == ".json") & (F.size(parts) >= 4), "article")
        .when((suffix == ".tags") & (F.size(parts) >= 4), "tags")
    )
    stem = F.regexp_replace(F.element_at(parts, -1), r"\.[^.]+$", "")
    df = members.select("archive_id", "member_order", "path", "content", kinds.alias("kind"), stem.alias("stem"), F.slice(parts, 1, 2).alias("root"))
    df = df.where("kind is not null").withColumn("v", F.try_parse_json("content"))
    null = F.lit(None).cast("string")
    broken = F.when(F.col("content").isNull(), F.array(finding("unreadable_file", null, F.lit("")))).when(
        F.col("v").isNull(), F.array(finding("invalid_json", null, F.lit("")))
    )
    shape = F.schema_of_variant("v")
    read = article_findings(df.where("kind = 'article'")).withColumn("found", F.coalesce(broken, "found"))
    other = df.where("kind <> 'article'").withColumn("s", walk_strings_udf("content"))
    wrong = F.when((F.col("kind") == "metadata") & ~F.startswith(shape, F.lit("OBJECT")), F.array(finding("metadata_not_object", null, F.lit("")))).when(
        (F.col("kind") == "tags") & ~F.startswith(shape, F.lit("ARRAY")),
        F.concat(text_findings(F.col("s")), F.array(finding("tags_not_list", null, F.lit("")))),
    )
    rest = other.withColumn("found", F.coalesce(broken, wrong, text_findings(F.col("s"))))
    keys = ["archive_id", "member_order", "path"]
    per_member = read.select(*keys, F.explode("found").alias("f")).unionByName(rest.select(*keys, F.explode("found").alias("f")))

    good = df.where("v is not null")
    articles = good.where("kind = 'article'").select(*keys, "root", "stem")
    owners = good.where((F.col("kind") == "metadata") & F.startswith(shape, F.lit("OBJECT"))).select("archive_id", "member_order", "root", F.col("stem").alias("publication"))
    lone = orphans(articles, owners, ["archive_id", "root"]).select(*keys, finding("orphan_article", null, F.lit("")).alias("f"))
    shared = owners.groupBy("archive_id", "root").agg(F.array_sort(F.collect_list(F.struct("member_order", "publication"))).alias("o")).where(F.size("o") > 1)
    shared = shared.select(
        "archive_id", F.col("o")[0]["member_order"].alias("member_order"), F.array_join("root", "/").alias("path"),
        finding("multiple_metadata", null, F.array_join(F.transform("o", lambda x: x["publication"]), ",")).alias("f"),
    )
    docs = articles.join(owners.drop("member_order"), ["archive_id", "root"]).withColumn("doc_id", document_id(F.col("archive_id"), F.col("stem"), F.col("publication")))
    twice = duplicate_ids(docs, ["archive_id", "doc_id"], "path").select(
        "archive_id", F.lit(None).cast("bigint").alias("member_order"), F.element_at("paths", -1).alias("path"),
        finding("duplicate_doc_id", F.lit("doc_id"), F.concat_ws(": ", "doc_id", F.array_join("paths", ", "))).alias("f"),
    )
    every = reduce(DataFrame.unionByName, [per_member, lone, shared, twice])
    found = every.select("archive_id", "member_order", "f.issue", "path", "f.field", "f.sample")
    files = df.groupBy("archive_id").agg(
        F.count_if(F.col("kind") == "tags").alias("tag_files"),
        F.count_if((F.col("kind") == "article") & F.col("v").isNotNull()).alias("article_files"),
        F.count_if((F.col("kind") == "metadata") & F.coalesce(F.startswith(shape, F.lit("OBJECT")), F.lit(False))).alias("metadata_files"),
    )
    totals = files.join(document_totals(docs, ["archive_id"]), "archive_id", "left").na.fill(0)
    return found, totals

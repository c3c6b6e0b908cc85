"""Registered queries of archives: audit, cleaning, source formats and their rewriters, patches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identity, patches, udfs
from ..functions import text as tx
from ..operators import audit, clean
from ..sources import literals, parsers, rewriters
from .base import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _pick(place: Column, *values) -> Column:
    return F.get(F.array(*(v if isinstance(v, Column) else F.lit(v) for v in values)), place.cast("int"))


# Audit ---------------------------------------------------------------------------------


def _members(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as a member of one of four archives: a tenth are publications, the rest articles, some of them broken."""
    k = F.col("doc_id")
    publication = k % 10 == 0
    folder = F.concat(F.lit("p/"), k % 20)
    path = F.when(publication, F.concat(folder, F.lit("/"), k, F.lit(".metadata"))).otherwise(F.concat(folder, F.lit("/x/"), k, F.lit(".json")))
    article = F.to_json(
        F.struct(
            F.when(k % 9 == 0, " ").otherwise("t").alias("title"),
            F.array(F.struct(F.lit("paragraph").alias("type"), F.concat(F.lit("text "), "n_chars", F.when(k % 11 == 0, "<br/>").otherwise("")).alias("text"))).alias("parts"),
            F.array(F.when(k % 7 == 0, "na?me").otherwise("name")).alias("authors"),
            F.array(F.struct(F.when(k % 8 == 0, 13).otherwise(12).alias("month"))).alias("dates"),
        )
    )
    content = (
        F.when(publication, F.when(k % 70 == 0, "{").when(k % 30 == 0, "[]").otherwise('{"files":[]}'))
        .when(k % 50 == 1, "broken")
        .when(k % 50 != 2, article)
    )
    return table(spark, sf, "documents").select((k % 4).alias("archive_id"), k.alias("member_order"), path.alias("path"), content.alias("content"))


_MEMBERS = """
WITH m AS (SELECT doc_id, doc_id % 4 AS archive_id, doc_id % 20 AS root, doc_id % 10 = 0 AS publication FROM documents),
owners AS (SELECT archive_id, root, doc_id FROM m WHERE publication AND doc_id % 70 > 0 AND doc_id % 30 > 0),
articles AS (SELECT * FROM m WHERE NOT publication AND doc_id % 50 NOT IN (1, 2)),
f AS (
  SELECT archive_id, 'unreadable_file' AS issue FROM m WHERE NOT publication AND doc_id % 50 = 2
  UNION ALL SELECT archive_id, 'invalid_json' FROM m WHERE (NOT publication AND doc_id % 50 = 1) OR (publication AND doc_id % 70 = 0)
  UNION ALL SELECT archive_id, 'metadata_not_object' FROM m WHERE publication AND doc_id % 30 = 0 AND doc_id % 70 > 0
  UNION ALL SELECT archive_id, 'empty_title' FROM articles WHERE doc_id % 9 = 0
  UNION ALL SELECT archive_id, 'author_ascii_question' FROM articles WHERE doc_id % 7 = 0
  UNION ALL SELECT archive_id, 'invalid_date' FROM articles WHERE doc_id % 8 = 0
  UNION ALL SELECT archive_id, 'html_tag' FROM articles WHERE doc_id % 11 = 0
  UNION ALL SELECT archive_id, 'orphan_article' FROM articles a WHERE NOT EXISTS (SELECT 1 FROM owners o WHERE o.archive_id = a.archive_id AND o.root = a.root)
  UNION ALL SELECT archive_id, 'multiple_metadata' FROM owners GROUP BY archive_id, root HAVING count(*) > 1)
"""


@query(_MEMBERS + "SELECT issue, archive_id, count(*) AS n FROM f GROUP BY GROUPING SETS ((issue, archive_id), (issue))")
def archive_findings(spark: SparkSession, sf: str) -> DataFrame:
    found, _ = audit.audit_members(_members(spark, sf))
    return audit.finding_counts(found, ["archive_id"])


@query(
    _MEMBERS
    + """, d AS (SELECT a.archive_id, a.doc_id, o.doc_id AS publication FROM articles a JOIN owners o ON a.archive_id = o.archive_id AND a.root = o.root),
files AS (SELECT archive_id, count(*) FILTER (NOT publication AND doc_id % 50 NOT IN (1, 2)) AS article_files,
  count(*) FILTER (publication AND doc_id % 70 > 0 AND doc_id % 30 > 0) AS metadata_files FROM m GROUP BY 1),
t AS (SELECT archive_id, count(*) AS indexed, count(DISTINCT (doc_id, publication)) AS unique_ids FROM d GROUP BY 1)
SELECT archive_id, 0 AS tag_files, article_files, metadata_files, coalesce(indexed, 0) AS indexed, coalesce(unique_ids, 0) AS unique_ids,
  coalesce(indexed - unique_ids, 0) AS overwritten FROM files LEFT JOIN t USING (archive_id)"""
)
def archive_totals(spark: SparkSession, sf: str) -> DataFrame:
    return audit.audit_members(_members(spark, sf))[1]


# Cleaning ------------------------------------------------------------------------------

_ARCHIVES = (9, 24, 10, 12, 5)


@query(
    """WITH a AS (SELECT c_custkey, [9, 24, 10, 12, 5][c_custkey % 5 + 1] AS archive_id, c_custkey % 5 = 4 AS as_is, c_name AS n, c_mktsegment AS m, c_custkey % 7 = 0 AS bare, c_custkey % 11 = 0 AS odd FROM customer)
SELECT c_custkey, CASE WHEN as_is THEN n || '&amp;amp;<b>' ELSE n || '&' END AS title,
  CASE WHEN bare THEN '' WHEN as_is THEN '<i>' || n || '</i>' ELSE n END || CASE WHEN odd THEN chr(65533) ELSE '' END AS text,
  CASE WHEN as_is THEN '[' || n || '];' || m || '/x；y' WHEN archive_id = 9 THEN n || ';' || m || ';x;y' WHEN archive_id = 24 THEN n || ';' || m || ';x；y' ELSE n || ';' || m || '/x；y' END AS authors
FROM a WHERE NOT (archive_id = 24 AND odd) AND NOT (archive_id IN (10, 20, 24) AND bare AND NOT odd)"""
)
def cleaned_articles(spark: SparkSession, sf: str) -> DataFrame:
    """Articles of five archives: texts, names, names joined by signs, and the rows that an archive's rules drop."""
    k = F.col("c_custkey")
    archive = _pick(k % 5, *_ARCHIVES)
    text = F.concat(F.when(k % 7 == 0, "").otherwise(F.concat(F.lit("<i>"), "c_name", F.lit("</i>"))), F.when(k % 11 == 0, "�").otherwise(""))
    articles = table(spark, sf, "customer").select(
        "c_custkey", archive.alias("archive_id"), F.concat("c_name", F.lit("&amp;amp;<b>")).alias("title"), F.lit("").alias("description"),
        F.array().cast("array<string>").alias("comments"), F.array(F.struct(F.lit("p").alias("type"), text.alias("text"))).alias("parts"),
        F.array(F.concat(F.lit("["), "c_name", F.lit("]")), F.concat("c_mktsegment", F.lit("/x；y"))).alias("authors"),
    )
    out = clean.clean_articles(articles)
    return out.select("c_custkey", "title", F.col("parts")[0]["text"].alias("text"), F.array_join("authors", ";").alias("authors"))


@query(
    """SELECT c_custkey, c_custkey % 3 = 0 AS has_content, CASE WHEN c_custkey % 3 = 0 THEN c_name || chr(10) ELSE '' END || '  ' || chr(10) || ' ' AS text FROM customer"""
)
def article_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Whether an article says anything, and its whole text."""
    articles = table(spark, sf, "customer").select(
        "c_custkey",
        F.struct(
            F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).alias("description"), F.array(F.lit(" ")).alias("comments"),
            F.array(F.struct(F.lit("p").alias("type"), F.lit("  ").alias("text"))).alias("parts"),
        ).alias("a"),
    )
    return articles.select("c_custkey", audit.has_content(F.col("a")).alias("has_content"), clean.article_text(F.col("a")).alias("text"))


@query("SELECT p_partkey, p_partkey % 4 IN (1, 2) AS rewrite FROM part")
def rewrite_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Stored texts: pointers and readable ones stay, broken bytes and wrongly decoded ones don't."""
    data = _pick(
        F.col("p_partkey") % 4, F.encode(F.lit("version https://git-lfs.github.com/spec/v1"), "UTF-8"), F.concat(F.encode("p_name", "UTF-8"), F.unhex(F.lit("FF"))),
        F.encode(F.concat("p_name", F.repeat(F.lit("Ж"), F.lit(20))), "UTF-8"), F.encode("p_name", "UTF-8"),
    )
    return table(spark, sf, "part").select("p_partkey", clean.needs_rewrite(data).alias("rewrite"))


@query("SELECT c_custkey, c_name AS text, CASE WHEN c_custkey % 2 = 0 THEN 'utf-16' ELSE 'utf-8' END AS encoding FROM customer")
def decoded_names(spark: SparkSession, sf: str) -> DataFrame:
    """Encoded bytes with and without a byte order mark."""
    data = F.when(F.col("c_custkey") % 2 == 0, F.encode("c_name", "UTF-16")).otherwise(F.encode("c_name", "UTF-8"))
    return table(spark, sf, "customer").select("c_custkey", udfs.decode_text_udf(data).alias("d")).select("c_custkey", "d.text", "d.encoding")


# Source formats ------------------------------------------------------------------------

_MARKED = """
WITH t AS (SELECT c_custkey, c_custkey % 3 AS k, c_name, c_mktsegment, 1000 + c_nationkey AS y FROM customer)
"""


def _marked(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey") % 3
    text = F.concat(
        F.lit("〖BT/标题〗"), "c_name", F.lit("〖-BT/标题〗\n"), F.when(k == 0, "〖FT/副题〗!〖-FT/副题〗").otherwise(""),
        F.when(k == 1, F.concat(F.lit("〖ZZ/作者〗a "), "c_mktsegment", F.lit("〖-ZZ/作者〗"))).otherwise(""), F.lit("〖RQ/日期〗"), F.col("c_nationkey") + 1000, F.lit("0203〖-RQ/日期〗"),
    )
    return table(spark, sf, "customer").select("c_custkey", text.alias("text"))


@query(_MARKED + "SELECT c_custkey, c_name || CASE WHEN k = 0 THEN '!' ELSE '' END AS title, CASE WHEN k = 1 THEN 'a,' || c_mktsegment ELSE '' END AS authors, y || '-2-3' AS date FROM t")
def marked_articles(spark: SparkSession, sf: str) -> DataFrame:
    got = parsers.marked_article(F.col("text"))
    date = F.concat_ws("-", got["date"]["year"], got["date"]["month"], got["date"]["day"])
    return _marked(spark, sf).select("c_custkey", got["title"].alias("title"), F.array_join(got["authors"], ",").alias("authors"), date.alias("date"))


@query(
    _MARKED
    + """SELECT c_custkey, '〖BT/标题〗' || c_name || '〖-BT/标题〗' || CASE WHEN k = 1 THEN '' ELSE chr(10) || '〖ZZ/作者〗b c〖-ZZ/作者〗' END || chr(10)
  || CASE WHEN k = 0 THEN '〖FT/副题〗!〖-FT/副题〗' WHEN k = 1 THEN '〖ZZ/作者〗b c〖-ZZ/作者〗' ELSE '' END || '〖RQ/日期〗' || y || '0203〖-RQ/日期〗' AS content, 'b,c' AS authors FROM t"""
)
def marked_rewrites(spark: SparkSession, sf: str) -> DataFrame:
    """New authors written into marked texts, and read again."""
    out = _marked(spark, sf).select("c_custkey", rewriters.rewritten_udf("text", F.lit("marked"), F.lit('{"authors":["b","c"]}'), F.lit(0), F.lit(0))["content"].alias("content"))
    return out.select("c_custkey", "content", F.array_join(parsers.marked_article(F.col("content"))["authors"], ",").alias("authors"))


_PAGES = """
WITH t AS (SELECT c_custkey, c_custkey % 4 = 0 AS undated, c_name, c_mktsegment, '<p><h3 class="t">' AS a, '</h3 ><strong>' AS b FROM customer)
"""


def _article_pages(spark: SparkSession, sf: str) -> DataFrame:
    date = F.when(F.col("c_custkey") % 4 == 0, "soon").otherwise("2001-02-00")
    html = F.concat(F.lit('<p><h3 class="t">'), "c_name", F.lit(" &amp; <i>x</i></h3 ><strong>"), "c_mktsegment", F.lit("</strong><div id=q class='a info b'>on "), date, F.lit("</div>2002-03-04"))
    return table(spark, sf, "customer").select("c_custkey", html.alias("html"))


@query(_PAGES + "SELECT c_custkey, c_name || ' & x' AS title, c_mktsegment AS author, CASE WHEN NOT undated THEN 2001 END AS year, CASE WHEN NOT undated THEN 2 END AS month, CAST(NULL AS INTEGER) AS day, undated AS failed FROM t")
def article_pages(spark: SparkSession, sf: str) -> DataFrame:
    out = parsers.page_article(_article_pages(spark, sf), "html")
    return out.select("c_custkey", "title", "author", "date.year", "date.month", "date.day", F.col("error").isNotNull().alias("failed"))


@query(
    _PAGES
    + """SELECT c_custkey, CASE WHEN NOT undated THEN a || 'n &lt; m' || b || 'y</strong><div id=q class=''a info b''>on 1999-12-31</div>2002-03-04' END AS content,
  CASE WHEN undated THEN 'date was not found' END AS error FROM t"""
)
def page_rewrites(spark: SparkSession, sf: str) -> DataFrame:
    fields = F.lit('{"title":"n < m","authors":["y"],"dates":[{"year":1999,"month":12,"day":31}]}')
    return _article_pages(spark, sf).select("c_custkey", rewriters.rewritten_udf("html", F.lit("page"), fields, F.lit(0), F.lit(0)).alias("r")).select("c_custkey", "r.content", "r.error")


_DIGESTS = """
WITH t AS (SELECT c_custkey, c_name, c_mktsegment, unnest([1, 2, 3]) AS segment FROM customer)
"""


def _digests(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of three segments: an author line in running text, one in marks, and one whose author is too long."""
    first = F.concat(F.lit('<a name="1">'), "c_name", F.lit("</a>\n\n  ·甲·乙·\ntext\n"))
    second = F.concat(F.lit('<a name="2">~{'), "c_mktsegment", F.lit("~}\n~{·丙·~}\ntext\n"))
    third = F.lit('<a name="3">T</a>\n\n  ·ABCDEFGHIJKL·\ntext\n')
    return table(spark, sf, "customer").select("c_custkey", F.concat(F.lit("head\n"), first, second, third).alias("content"))


@query(_DIGESTS + "SELECT c_custkey, CAST(segment AS INTEGER) AS segment, CASE segment WHEN 1 THEN 1 ELSE 0 END AS kind, CASE segment WHEN 1 THEN c_name ELSE c_mktsegment END AS title, CASE segment WHEN 1 THEN '甲,乙' ELSE '丙' END AS authors FROM t WHERE segment < 3")
def digest_articles(spark: SparkSession, sf: str) -> DataFrame:
    return parsers.digest_rows(_digests(spark, sf), "content", ["c_custkey"]).withColumn("authors", F.array_join("authors", ","))


@query(_DIGESTS + "SELECT c_custkey, CAST(segment AS INTEGER) AS segment, CASE segment WHEN 1 THEN '甲,乙' ELSE '丁,戊' END AS authors FROM t WHERE segment < 3")
def digest_rewrites(spark: SparkSession, sf: str) -> DataFrame:
    """New authors written into the second segment of each page, and all segments read again."""
    pages = _digests(spark, sf).withColumn("content", rewriters.rewritten_udf("content", F.lit("digest"), F.lit('{"authors":["丁","戊"]}'), F.lit(2), F.lit(0))["content"])
    return parsers.digest_rows(pages, "content", ["c_custkey"]).select("c_custkey", "segment", F.array_join("authors", ",").alias("authors"))


@query(
    """SELECT c_custkey, 'x' || c_name || 'z' AS joined, 'a' AS joined_authors, CASE WHEN c_custkey % 2 = 0 THEN c_name || ',b' ELSE c_name END AS titles,
  1970 AS year, CASE WHEN c_custkey % 2 = 0 THEN 5 END AS month FROM customer"""
)
def json_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Records with titles in three pieces, single objects and lists, and dashed dates."""
    even = F.col("c_custkey") % 2 == 0
    pieces = F.to_json(F.struct(F.lit("x").alias("ytitle"), F.col("c_name").alias("mtitle"), F.lit("z").alias("ftitle"), F.array(F.lit("a")).alias("authors")))
    one = F.to_json(F.struct(F.col("c_name").alias("title")))
    listed = F.when(even, F.concat(F.lit(" ["), one, F.lit(',{"title":"b"}]'))).otherwise(one)
    joined, date = parsers.joined_titles(pieces), parsers.dashed_date(F.when(even, "1970-05-00").otherwise("1970-0"))
    return table(spark, sf, "customer").select(
        "c_custkey", joined["title"].alias("joined"), F.array_join(joined["authors"], ",").alias("joined_authors"),
        F.array_join(F.transform(parsers.json_articles(listed), lambda a: a["title"]), ",").alias("titles"), date["year"].alias("year"), date["month"].alias("month"),
    )


@query(
    """SELECT c_custkey, '[{"title":"a"},{"title":"' || c_name || '"}]' AS listed, '{"title":"t","creator":["' || c_name || '"]}' AS described, '{"a":1,"authors":["' || c_name || '"]}' AS record, 'unsupported fields' AS refused FROM customer"""
)
def json_rewrites(spark: SparkSession, sf: str) -> DataFrame:
    """New fields written into JSON sources; what a source can't hold is refused."""
    name = F.to_json(F.struct(F.array("c_name").alias("authors")))
    new = lambda text, form, fields, place=0: rewriters.rewritten_udf(F.lit(text), F.lit(form), fields, F.lit(place), F.lit(0))
    return table(spark, sf, "customer").select(
        "c_custkey", new('[{"title":"a"},{"title":"b"}]', "listed", F.to_json(F.struct(F.col("c_name").alias("title"))), 1)["content"].alias("listed"),
        new('{"title":"t"}', "described", name)["content"].alias("described"), new('{"a":1}', "record", name)["content"].alias("record"),
        new("{}", "titled_record", F.lit('{"dates":[]}'))["error"].alias("refused"),
    )


def _configs(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat(
        F.lit("export default {\n  entity: { name: 'n', 'path': '/"), "c_mktsegment", F.lit("/x/' }, // {\n  parser_option: {\n    articles: [\n      { title: \""), "c_name",
        F.lit('", authors: [\'b\'], page_start: 1, page_end: 2 },\n    ],\n  },\n};\n'),
    )
    return table(spark, sf, "customer").select("c_custkey", "c_name", text.alias("text"))


@query("SELECT c_custkey, 'n' AS name, CAST(NULL AS VARCHAR) AS path FROM customer")
def config_fields(spark: SparkSession, sf: str) -> DataFrame:
    return _configs(spark, sf).select("c_custkey", parsers.config_value(F.col("text"), "name").alias("name"), parsers.config_path(F.col("text")).alias("path"))


@query(
    r"""WITH t AS (SELECT c_custkey, c_name, c_mktsegment AS m, c_custkey % 3 = 0 AS unknown FROM customer)
SELECT c_custkey, CASE WHEN NOT unknown THEN 'export default {' || chr(10) || '  entity: { name: "' || c_name || '", ''path'': ''/' || m || '/x/'' }, // {' || chr(10)
  || '  parser_option: {' || chr(10) || '    articles: [' || chr(10) || '      { title: "new", authors: [''b''], page_start: 1, page_end: 2 },' || chr(10) || '    ],' || chr(10) || '  },' || chr(10) || '};' || chr(10) END AS content,
  CASE WHEN NOT unknown THEN left(md5('["new",[],false,["b"],""]'), 10) END AS article_id, CASE WHEN unknown THEN 'expected one article' END AS error FROM t"""
)
def config_edits(spark: SparkSession, sf: str) -> DataFrame:
    """Fields of an article and of the source changed inside object literals; the rest of the text stays."""
    none = F.array().cast("array<string>")
    own = identity.article_id(F.col("c_name"), none, F.lit(False), F.array(F.lit("b")), F.lit(""))
    metadata = F.struct(F.struct(F.lit("new").alias("title")).alias("article"), F.struct(F.col("c_name").alias("name")).alias("source"))
    request = F.to_json(F.struct(F.when(F.col("c_custkey") % 3 == 0, "other").otherwise(own).alias("article_id"), metadata.alias("metadata")))
    return _configs(spark, sf).select("c_custkey", literals.edited_udf("text", request).alias("e")).select("c_custkey", "e.content", "e.article_id", "e.error")


@query("""SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'x = [' WHEN 1 THEN 'x = [a,' ELSE 'x = [a]; y = [b,' END || chr(10) || c_name || chr(10) || '];' AS text FROM customer""")
def patch_lists(spark: SparkSession, sf: str) -> DataFrame:
    text = _pick(F.col("c_custkey") % 3, "x = [ \n];", "x = [a\n];", "x = [a]; y = [b,\n];")
    return table(spark, sf, "customer").select("c_custkey", parsers.appended_patch(text, F.col("c_name")).alias("text"))


# Patches -------------------------------------------------------------------------------


def _patched(spark: SparkSession, sf: str) -> DataFrame:
    """Articles of two parts and a comment, with a patch that changes one, drops one, and adds a comment."""
    n = F.col("c_name")
    part = lambda c, k: F.struct(F.lit(k).alias("type"), c.alias("text"))
    pivot = F.array(F.struct(F.lit(0).alias("part_idx"), F.lit(1).alias("offset"), F.lit(1).alias("index")))
    article = F.to_json(
        F.struct(n.alias("title"), F.array(part(F.concat(F.lit("甲"), n), "p"), part(F.lit("gone"), "p")).alias("parts"), F.array(F.lit("c")).alias("comments"), pivot.alias("comment_pivots"))
    )
    op = lambda **k: F.struct(*(v.alias(name) for name, v in k.items()))
    parts = F.concat(
        F.lit('{"version":2,"parts":{"0":'), F.to_json(op(diff=F.concat(F.lit("=4\t-"), F.length(n), F.lit("\t+%E4%B9%99")), type=F.lit("t"))),
        F.lit(',"1":{"delete":true,"insertAfter":[{"text":"'), n, F.lit('","type":"p"}]}},"comments":{},"newComments":["d"]}'),
    )
    metadata = F.to_json(F.struct(F.struct(n.alias("title"), F.array(F.lit("z")).alias("authors")).alias("article")))
    return table(spark, sf, "customer").select("c_custkey", "c_name", article.alias("article"), parts.alias("patch"), metadata.alias("metadata"))


@query("SELECT c_custkey, '甲〔1〕乙' || chr(10) || c_name || chr(10) || chr(10) || '〔1〕c' || chr(10) || '〔2〕d' AS text FROM customer")
def patched_texts(spark: SparkSession, sf: str) -> DataFrame:
    return _patched(spark, sf).select("c_custkey", patches.article_fulltext_udf("article", "patch").alias("text"))


@query(
    """SELECT c_custkey, unnest(['part||1|甲〔1〕' || c_name || '|甲〔1〕乙|', 'part_type|1|"p"|"t"', 'part|2|gone|deleted', 'part|2|' || c_name || '|inserted', 'new_comment|2|d', 'metadata|authors||["z"]']) AS line FROM customer"""
)
def patch_changes(spark: SparkSession, sf: str) -> DataFrame:
    """What a patch and new metadata change, a row each; fields that stay the same make none."""
    rows = _patched(spark, sf).select("c_custkey", F.explode(patches.article_changes_udf("article", "patch", "metadata")).alias("c"))
    kind, index = F.col("c.kind"), F.col("c.index").cast("string")
    line = (
        F.when(F.col("c.edited").isNotNull(), F.concat_ws("|", kind, F.lit(""), index, F.col("c.original"), F.col("c.edited"), F.lit("")))
        .when(F.col("c.delete"), F.concat_ws("|", kind, index, F.col("c.original"), F.lit("deleted")))
        .when(F.col("c.insert"), F.concat_ws("|", kind, index, F.col("c.text"), F.lit("inserted")))
        .when(kind == "new_comment", F.concat_ws("|", kind, index, F.col("c.text")))
        .when(kind == "metadata", F.concat_ws("|", kind, F.col("c.field"), F.coalesce("c.old", F.lit("")), F.col("c.new")))
        .otherwise(F.concat_ws("|", kind, index, F.col("c.old"), F.col("c.new")))
    )
    return rows.select("c_custkey", line.alias("line"))


@query(
    """SELECT c_custkey, '{"authors": ["z"]}' AS changed, '{"version": 2, "parts": {"0": {"insertBefore": [{"text": "' || c_name || '", "type": "paragraph"}, {"text": "x", "type": "paragraph"}], "delete": true}, "1": {"delete": true}}, "comments": {}}' AS replacement, 5 + length(c_name) AS cost FROM customer"""
)
def patch_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Metadata that really changes, a patch made from free text, and the cost of a delta."""
    current = F.to_json(F.struct(F.col("c_name").alias("title")))
    new = F.to_json(F.struct(F.col("c_name").alias("title"), F.array(F.lit("z")).alias("authors")))
    return table(spark, sf, "customer").select(
        "c_custkey", patches.changed_metadata_udf(current, new).alias("changed"), patches.replacement_patch_udf(F.lit(2), F.concat("c_name", F.lit("\n \n x"))).alias("replacement"),
        udfs.diff_cost_udf(F.concat(F.lit("=3\t-"), F.length("c_name") + 3, F.lit("\t+%E4%B9%99+"))).alias("cost"),
    )


@query(
    """SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'not a patch of version 2' WHEN 2 THEN 'index is invalid' WHEN 3 THEN 'a deleted part can''t be changed' ELSE 'no changes' END AS error,
  p_partkey % 5 = 0 AND p_size * 10 <= 500 AS allowed FROM part"""
)
def patch_policy(spark: SparkSession, sf: str) -> DataFrame:
    """What is wrong with patches, and which of them may be merged unseen."""
    shape = lambda parts, version=2: F.concat(F.lit(f'{{"version":{version},"parts":{{'), parts, F.lit('},"comments":{}}'))
    good = F.concat(F.lit('"0":{"diff":"-'), "p_size", F.lit('0"}'))
    patch = _pick(
        F.col("p_partkey") % 5, shape(good), shape(F.lit('"0":{"diff":"-5001"}'), 1), shape(F.lit('"01":{"diff":"-5001"}')), shape(F.lit('"0":{"delete":true,"diff":"-5001"}')), shape(F.lit("")),
    )
    return table(spark, sf, "part").select(
        "p_partkey", patches.patch_error_udf(patch).alias("error"), patches.auto_merge_udf(F.lit("proofread"), patch, F.lit(None).cast("string")).alias("allowed")
    )


@query(
    """SELECT c_custkey, 'a〔1〕' || c_name || '〔2〕' AS marked, '@@ -1,3 +1,3 @@' || chr(10) || ' a' || chr(10) || '-' || c_name || chr(10) || '+b' || chr(10) || ' c' AS diff,
  left(sha256('{"a": "' || c_name || '", "b": [1, 2]}'), 12) AS correction, '$.a=' || c_name || ';$.b[1].c=x' AS strings,
  CASE c_custkey % 3 WHEN 0 THEN c_name || ',2' WHEN 1 THEN c_name END AS listed, 'y' || c_name || 'xx' AS replaced FROM customer"""
)
def text_tools(spark: SparkSession, sf: str) -> DataFrame:
    """Footnote marks, a diff of lines, the digest of a request, the strings of a JSON text, lists written as text, the first occurrence replaced."""
    n = F.col("c_name")
    pivots = F.array(F.struct((F.length(n) + 1).alias("offset"), F.lit(2).alias("index")), F.struct(F.lit(1).alias("offset"), F.lit(1).alias("index")))
    value = F.to_json(F.struct(n.alias("a"), F.array(F.lit("1").cast("int"), F.lit(2)).alias("b")))
    walked = F.concat(F.lit('{"a":"'), n, F.lit('","b":[1,{"c":"x"}]}'))
    listed = _pick(F.col("c_custkey") % 3, F.concat(F.lit('["'), n, F.lit('",2]')), F.concat(F.lit("['"), n, F.lit("']")), n)
    strings = F.transform(udfs.walk_strings_udf(walked), lambda s: F.concat_ws("=", s["field"], s["text"]))
    diff = udfs.unified_diff_udf(F.concat(F.lit("a\n"), n, F.lit("\nc")), F.lit("a\nb\nc"))
    return table(spark, sf, "customer").select(
        "c_custkey", tx.with_pivots(F.concat(F.lit("a"), n), pivots).alias("marked"), diff.alias("diff"), udfs.correction_id_udf(value).alias("correction"),
        F.array_join(strings, ";").alias("strings"), F.array_join(udfs.literal_list_udf(listed), ",").alias("listed"), udfs.first_replaced_udf(F.concat(F.lit("x"), n, F.lit("xx")), F.lit("x"), F.lit("y")).alias("replaced"),
    )


@query(
    """SELECT p_partkey, outcome, content FROM (SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN 'merged' WHEN 1 THEN 'conflict' WHEN 2 THEN 'taken' WHEN 3 THEN 'added' WHEN 4 THEN 'deleted' WHEN 5 THEN 'missing' WHEN 6 THEN 'no_change' ELSE 'merged' END AS outcome,
  CASE p_partkey % 8 WHEN 0 THEN 'A' || chr(10) || 'b' || chr(10) || 'c' || chr(10) || p_name WHEN 2 THEN p_name WHEN 3 THEN p_name WHEN 7 THEN p_type || chr(10) || 'x' || chr(10) || 'y' || chr(10) || p_name || chr(10) END AS content FROM part)"""
)
def three_way_merge(spark: SparkSession, sf: str) -> DataFrame:
    k, n, null = F.col("p_partkey") % 8, F.col("p_name"), F.lit(None).cast("string")
    base = _pick(k, F.lit("a\nb\nc\nd"), F.lit("a"), F.lit("a"), null, n, F.lit("a"), null, F.concat("p_type", F.lit("\nq\nx\ny\n")))
    current = _pick(k, F.lit("A\nb\nc\nd"), F.lit("b"), F.lit("a"), null, n, null, n, F.concat("p_type", F.lit("\nx\ny\n")))
    changed = _pick(k, F.concat(F.lit("a\nb\nc\n"), n), F.lit("c"), n, n, null, n, null, F.concat("p_type", F.lit("\nq\nx\ny\n"), n, F.lit("\n")))
    return table(spark, sf, "part").select("p_partkey", udfs.merge3_udf(base, current, changed).alias("m")).select("p_partkey", "m.outcome", "m.content")

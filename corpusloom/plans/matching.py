"""Registered queries of matching, requests, rendering and the rest of the review operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rendering, udfs
from ..functions import text as tx
from ..operators import audit, catalog, manifest, matching, requests, review
from ..sources import payload, state
from .base import page_records, table
from .catalog import with_records

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query(
    r"""SELECT item_id, replace(replace(replace(replace(regexp_replace(replace(replace(replace(replace(text, '\', '\\'), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'),
  '([`*_\[\]()#+\-!|~])', '\\\1', 'g'), chr(13) || chr(10), '<br>'), chr(13), '<br>'), chr(10), '<br>'), '', '') AS shown,
  CASE WHEN ticks THEN '`````text' || chr(10) || text || chr(10) || '`````' ELSE '```text' || chr(10) || text || chr(10) || '```' END AS fenced
  FROM (SELECT item_id, CASE WHEN item_id % 3 = 0 THEN '```' || text || '````' ELSE replace(text, '`', '') END AS text, item_id % 3 = 0 AS ticks FROM benchmark)"""
)
def markdown_values(spark: SparkSession, sf: str) -> DataFrame:
    ticked = F.concat(F.lit("```"), "text", F.lit("````"))
    items = table(spark, sf, "benchmark").withColumn("text", F.when(F.col("item_id") % 3 == 0, ticked).otherwise(F.replace("text", F.lit("`"), F.lit(""))))
    return items.select("item_id", rendering.markdown_value(F.col("text")).alias("shown"), rendering.fenced(F.col("text")).alias("fenced"))


@query("SELECT c_custkey, left(c_mktsegment || ' ' || c_name, 100) AS title FROM customer")
def title_cleanup(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.concat(F.lit("校订审核：校订 "), "c_mktsegment", F.lit(" "), "c_name")
    return table(spark, sf, "customer").select("c_custkey", rendering.clean_title(raw).alias("title"))


_CROPS = """
WITH c AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN [l_discount, l_tax, 0, 0] ELSE [0.1, 0, l_discount, 0] END AS t FROM lineitem)
"""


@query(
    _CROPS
    + """SELECT l_orderkey, l_linenumber, CAST(t[3] * 1000 AS DECIMAL(18, 6))::DOUBLE // 1 AS l, CAST(t[1] * 500 AS DECIMAL(18, 6))::DOUBLE // 1 AS t FROM c WHERE t[1] > 0 OR t[2] > 0 OR t[3] > 0 OR t[4] > 0"""
)
def effective_crops(spark: SparkSession, sf: str) -> DataFrame:
    zero = F.lit(0.0)
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.struct(F.array(F.lit(0.1), zero, "l_discount", zero).alias("content_thresholds")).alias("ocr"),
        F.when(F.col("l_linenumber") % 2 == 0, F.create_map(F.col("l_linenumber").cast("string"), F.struct(F.array("l_discount", "l_tax", zero, zero).alias("content_thresholds")))).alias("exceptions"),
    )
    crops = lines.withColumn("c", requests.effective_crop(F.col("ocr"), F.col("exceptions"), F.col("l_linenumber"))).where("c is not null")
    cut = F.transform("c", lambda x: F.round(x, 8))
    box = requests.crop_box(cut, F.lit(1000), F.lit(500))
    return crops.select("l_orderkey", "l_linenumber", box["left"].cast("double").alias("l"), box["top"].cast("double").alias("t"))


@query(
    """SELECT n_nationkey, n_name, CASE WHEN n_nationkey % 3 = 0 THEN 'p' || n_nationkey || '-2' WHEN n_nationkey % 3 = 1 THEN 'f' || n_nationkey END AS image,
  n_nationkey % 3 = 2 AS failed FROM nation"""
)
def page_images(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation")
    key, kind = F.col("n_nationkey"), F.col("n_nationkey") % 3
    url = F.concat(F.lit("u"), key)
    previews = F.array(F.concat(F.lit("p"), key, F.lit("-1")), F.concat(F.lit("p"), key, F.lit("-2")))
    files = nation.where(kind < 2).select(
        url.alias("url"), F.concat(F.lit("f"), key).alias("path"), F.when(kind == 0, previews).otherwise(F.array().cast("array<string>")).alias("previews")
    )
    pages = nation.select("n_nationkey", "n_name", F.array(url).alias("files"), F.when(kind == 0, 2).otherwise(1).alias("page"))
    out = requests.page_images(pages, files)
    return out.select("n_nationkey", "n_name", "image", F.col("error").isNotNull().alias("failed"))


@query(
    """SELECT o_orderkey AS request, CASE WHEN min(l_linenumber) <> 1 OR count(DISTINCT l_linenumber) < max(l_linenumber) THEN 'pages left out' END AS error
FROM orders JOIN (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) ON o_orderkey = l_orderkey GROUP BY o_orderkey"""
)
def request_errors(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    ends = lines.groupBy("l_orderkey").agg(F.max("l_linenumber").alias("source_end"))
    null = lambda kind: F.lit(None).cast(kind)
    articles = lines.join(ends, "l_orderkey").select(
        F.col("l_orderkey").alias("request"), F.lit(1).alias("source_start"), "source_end",
        F.concat(F.lit("t"), "l_linenumber").alias("title"), null("array<string>").alias("authors"), null("array<struct<year:int,month:int,day:int>>").alias("dates"),
        F.lit(False).alias("is_range_date"), F.col("l_linenumber").alias("page_start"), F.col("l_linenumber").alias("page_end"), F.lit("c").alias("content"),
        F.lit(1).alias("base_part_count"), null("struct<content_thresholds:array<double>>").alias("ocr"), null("map<string,struct<content_thresholds:array<double>>>").alias("ocr_exceptions"),
    )
    return requests.request_errors(articles)


@query(
    """WITH m AS (SELECT '[' || p_brand || '][' || p_partkey || '].ts' AS path, p_name AS blob, p_partkey, p_brand FROM part),
u AS (SELECT '[' || p_brand || '][' || p_partkey || '].ts' AS path, CASE WHEN p_partkey % 6 = 0 THEN p_name || '!' ELSE p_name END AS blob FROM part WHERE p_partkey % 10 > 0)
SELECT m.path, m.blob, u.blob AS upstream_blob, p_brand AS article_id, CAST(p_partkey AS VARCHAR) AS publication_id,
  '7:' || length(p_brand) || ':' || p_brand || ':' || p_partkey AS doc_id FROM m LEFT JOIN u USING (path) WHERE m.blob IS DISTINCT FROM u.blob"""
)
def tree_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part")
    path = F.concat(F.lit("["), "p_brand", F.lit("]["), "p_partkey", F.lit("].ts")).alias("path")
    changed = F.when(F.col("p_partkey") % 6 == 0, F.concat("p_name", F.lit("!"))).otherwise(F.col("p_name"))
    upstream = parts.where("p_partkey % 10 > 0").select(path, changed.alias("blob"))
    return matching.tree_conflicts(parts.select(path, F.col("p_name").alias("blob")), upstream, F.lit(7))


@query(
    """WITH r AS (SELECT p_brand AS id, p_type AS a, p_size AS b, min(p_partkey) AS record, count(*) AS n FROM part GROUP BY ALL),
i AS (SELECT p_brand AS id, min(p_partkey) AS record, count(*) AS n FROM part WHERE p_partkey % 40 = 0 GROUP BY 1),
f AS (SELECT p_type AS a, p_size AS b, min(p_partkey) AS record, count(*) AS n FROM part WHERE p_partkey % 40 = 0 GROUP BY 1, 2)
SELECT p_partkey, CASE WHEN i.n = 1 THEN i.record WHEN i.n IS NULL AND f.n = 1 THEN f.record END AS record FROM part LEFT JOIN i ON p_brand = i.id LEFT JOIN f ON p_type = a AND p_size = b"""
)
def identified_records(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    records = parts.where("p_partkey % 40 = 0").withColumnRenamed("p_partkey", "record")
    return matching.identified(parts, records, "p_brand", ["p_type", "p_size"]).select("p_partkey", "record")


@query(
    """SELECT c_custkey AS article_id, CASE WHEN c_custkey % 8 = 3 THEN c_custkey - 3 WHEN c_custkey % 8 = 2 THEN c_custkey - 2 WHEN c_custkey % 8 = 1 THEN c_custkey - 1 ELSE c_custkey END AS source_id FROM customer"""
)
def override_chains(spark: SparkSession, sf: str) -> DataFrame:
    ids = table(spark, sf, "customer").select(F.lit("p").alias("publication_id"), F.col("c_custkey").alias("article_id"))
    chain = ids.where("article_id % 8 between 1 and 3").select("publication_id", (F.col("article_id") - 1).alias("article_id"), F.col("article_id").alias("new_article_id"))
    return matching.original_ids(ids, chain).select("article_id", "source_id")


@query(
    """WITH p AS (SELECT p_partkey AS a, p_name AS content FROM part), c AS (SELECT a - 1 AS a, content FROM p WHERE a % 5 = 1)
SELECT a AS article_id, content FROM c UNION ALL SELECT a, content FROM p WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.a = p.a)"""
)
def copied_patches(spark: SparkSession, sf: str) -> DataFrame:
    patches = table(spark, sf, "part").select(F.lit("p").alias("publication_id"), F.col("p_partkey").alias("article_id"), F.col("p_name").alias("content"))
    overrides = patches.where("article_id % 5 = 1").select("publication_id", (F.col("article_id") - 1).alias("article_id"), F.col("article_id").alias("new_article_id"))
    return matching.copied_patches(patches, overrides).select("article_id", "content")


@query(
    """SELECT coalesce(r.p_partkey, l.p_partkey) AS name, coalesce(r.p_name, l.p_name) AS content, coalesce(r.p_name <> l.p_name, FALSE) AS clash
FROM (SELECT p_partkey, p_name FROM part WHERE p_partkey % 3 > 0) r FULL JOIN (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN p_type ELSE p_name END AS p_name FROM part WHERE p_partkey % 2 > 0) l USING (p_partkey)"""
)
def merged_layout(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part")
    root = parts.where("p_partkey % 3 > 0").select(F.col("p_partkey").alias("name"), F.col("p_name").alias("content"))
    legacy = parts.where("p_partkey % 2 > 0").select(
        F.col("p_partkey").alias("name"), F.when(F.col("p_partkey") % 7 == 0, F.col("p_type")).otherwise(F.col("p_name")).alias("content")
    )
    return matching.merged_layout(root, legacy).select("name", "content", F.col("error").isNotNull().alias("clash"))


@query(
    """SELECT item_id AS query, left(text, 30) AS title, (SELECT count(*) FROM benchmark b WHERE contains(b.text, left(a.text, 30))) AS n FROM benchmark a"""
)
def search_candidates(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "benchmark")
    queries = items.select(F.col("item_id").alias("query"), F.left("text", F.lit(30)).alias("title"))
    texts = items.select(F.col("item_id").cast("string").alias("path"), "text")
    return matching.candidates(queries, texts).select("query", "title", F.coalesce(F.size("paths"), F.lit(0)).cast("bigint").alias("n"))


@query("SELECT o_custkey, count(*) AS n_pulls, bool_and(o_orderstatus IN ('F', 'O')) AS all_resolved FROM orders GROUP BY o_custkey")
def resolved_issues(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    state_of = F.when(F.col("o_orderstatus") == "O", "closed").otherwise("open")
    pulls = orders.select("o_orderkey", (F.col("o_orderstatus") == "F").alias("merged"), state_of.alias("state"))
    return review.all_resolved(orders.select("o_custkey", "o_orderkey"), pulls, ["o_custkey"], ["o_orderkey"])


@query(
    """SELECT CAST(o_custkey % 20 AS VARCHAR) AS repo, o_orderkey AS number, o_custkey AS issue FROM orders"""
)
def tracker_issues(spark: SparkSession, sf: str) -> DataFrame:
    link = F.struct((F.col("o_custkey") % 20).cast("string").alias("repo"), F.col("o_orderkey").alias("number"), F.lit("u").alias("url"))
    issues = table(spark, sf, "orders").groupBy("o_custkey").agg(F.to_json(F.collect_list(link)).alias("json"))
    bodies = issues.select(F.col("o_custkey").alias("issue"), F.col("o_custkey").alias("position"), F.concat(F.lit("x\n<!-- proofreading-prs:"), "json", F.lit(" -->\ny")).alias("body"))
    return review.first_tracker(bodies)


@query(
    """SELECT c_nationkey AS number, max(c_custkey) AS issue FROM customer GROUP BY 1"""
)
def marker_issues(spark: SparkSession, sf: str) -> DataFrame:
    body = F.concat(F.lit('<!-- conflict:{"archive_id":'), "c_nationkey", F.lit("} -->"))
    issues = table(spark, sf, "customer").select(F.col("c_custkey").alias("issue"), F.col("c_custkey").alias("position"), body.alias("body"))
    return review.marker_issue(issues, "conflict", "struct<archive_id:int>", "archive_id").withColumnRenamed("archive_id", "number")


@query("SELECT c_custkey AS marker FROM customer WHERE c_custkey % 4 > 0")
def missing_markers(spark: SparkSession, sf: str) -> DataFrame:
    markers = table(spark, sf, "customer").select(F.col("c_custkey").alias("marker"))
    return review.missing_markers(markers.union(markers), markers.where("marker % 4 = 0"))


@query(
    """SELECT n_nationkey AS branch FROM nation WHERE n_nationkey % 2 = 0 AND n_nationkey % 3 = 0 AND n_nationkey % 5 > 0"""
)
def unmanaged_branches(spark: SparkSession, sf: str) -> DataFrame:
    branch = table(spark, sf, "nation").select(F.col("n_nationkey").alias("branch"))
    return review.unmanaged(branch.where("branch % 2 = 0"), branch.where("branch % 3 = 0"), branch.where("branch % 5 = 0"), ["branch"])


@query("SELECT n_nationkey AS branch FROM nation WHERE n_nationkey % 2 = 0 AND n_nationkey % 3 > 0")
def only_in_mirror(spark: SparkSession, sf: str) -> DataFrame:
    branch = table(spark, sf, "nation").select(F.col("n_nationkey").alias("branch"))
    return review.only_in(branch.where("branch % 2 = 0"), branch.where("branch % 3 = 0"), ["branch"])


@query("SELECT l_orderkey, l_linenumber, count(*) AS matches FROM lineitem GROUP BY 1, 2")
def exactly_one(spark: SparkSession, sf: str) -> DataFrame:
    out = manifest.exactly_one(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])
    return out.select("l_orderkey", "l_linenumber", "matches").distinct()


@query(
    """SELECT p_partkey, CASE WHEN p_size <= 20 THEN p_size ELSE 20 END AS width, CASE WHEN p_size <= 20 THEN p_size // 2 + 1 ELSE CAST(round_even((p_size // 2 + 1) * 20.0 / p_size, 0) AS INTEGER) END AS height,
  least(CAST(floor(p_size / 2.0) AS INTEGER), 10) AS pause, greatest(200, least(5000, (40000 // p_size) // 2)) AS shown FROM part"""
)
def limits(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size")
    image = manifest.scaled(size, F.floor(size / 2).cast("int") + 1, 20)
    return table(spark, sf, "part").select(
        "p_partkey", image["width"].alias("width"), image["height"].alias("height"),
        manifest.pace_seconds(size, 120, 10).alias("pause"), manifest.adaptive_limit(size).alias("shown"),
    )


@query("SELECT c_custkey, 'https://x.example/d/' || c_mktsegment || '/resolve/main/a%20' || c_custkey || '.txt' AS url FROM customer")
def file_urls(spark: SparkSession, sf: str) -> DataFrame:
    path = F.concat(F.lit("a "), "c_custkey", F.lit(".txt"))
    return table(spark, sf, "customer").select("c_custkey", matching.file_url("https://x.example/d/", F.col("c_mktsegment"), path).alias("url"))


@query(
    """SELECT p_partkey, starts_with(p_name, 'red') AS pdf, octet_length(encode(p_name)) AS bytes FROM part"""
)
def magic_bytes(spark: SparkSession, sf: str) -> DataFrame:
    data = F.encode(F.when(F.startswith("p_name", F.lit("red")), F.concat(F.lit("%PDF-"), "p_name")).otherwise(F.col("p_name")), "UTF-8")
    return table(spark, sf, "part").select("p_partkey", requests.looks_like_pdf(data).alias("pdf"), F.octet_length("p_name").cast("bigint").alias("bytes"))


@query()
def decoded_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts as bytes, decoded by the best of the encodings."""
    docs = table(spark, sf, "documents").where("text <> ''").select("doc_id", udfs.decode_text_udf(F.encode("text", "UTF-8")).alias("d"))
    return docs.select("doc_id", F.sha2("d.text", 256).alias("sha256"), F.col("d.encoding").alias("encoding"))


@query(
    """SELECT c_custkey, '- 段落 ' || c_nationkey || '：' || replace(c_name, '#', '\\#') || ' → x' AS line, '| 标题 | （空） | ' || replace(c_name, '#', '\\#') || ' |' AS row FROM customer"""
)
def change_lines(spark: SparkSession, sf: str) -> DataFrame:
    null = F.lit(None).cast("string")
    change = F.struct(
        F.lit("part").alias("kind"), F.col("c_nationkey").alias("index"), F.col("c_name").alias("original"), F.lit("x").alias("edited"), F.lit(None).cast("boolean").alias("delete"),
        F.lit(None).cast("boolean").alias("insert"), null.alias("text"), null.alias("field"), null.alias("old"), null.alias("new"),
    )
    return table(spark, sf, "customer").select(
        "c_custkey", rendering.change_line(change).alias("line"), rendering.comparison_row(F.lit("title"), F.lit(""), F.col("c_name")).alias("row")
    )


#: One name for each author rule, and the rules that it breaks.
_NAMES = (
    ("IMG = q7", "author_image_placeholder,author_ocr_residue"),
    ("Lee (ed", "unbalanced_author_delimiter,unbalanced_author_parenthesis"),
    ("Board [2]", "square_bracket_author"),
    ("x > y", "angle_bracket_author,unbalanced_author_delimiter"),
    (" (Nobody) ", "wrapped_author"),
    ("z〗z", "author_ocr_residue"),
    ("?somebody", "author_ascii_question,author_placeholder"),
    ("━━ continued", "author_title_prefix"),
    ("1901年春天起草", "author_date_statement"),
    ("7", "author_pure_noise"),
    ("「Half", "unbalanced_author_delimiter"),
    ("y" * 81, "very_long_author"),
    ("who? me", "author_ascii_question"),
    ("。Dot", "author_odd_edge"),
    ("abcdefghijk；z", "author_sentence_punctuation"),
    ("本文" + "z" * 16, "author_prose_cue"),
    ("k/l/m/n", "author_many_slashes"),
    ("w" * 41, "author_review_length"),
    ("Plain Name", ""),
)


@query("SELECT c_custkey, [" + ", ".join(f"'{issues}'" for _, issues in _NAMES) + f"][c_custkey % {len(_NAMES)} + 1] AS issues, CASE WHEN c_custkey % {len(_NAMES)} < {len(_NAMES) - 1} THEN '$.authors[1]' END AS field FROM customer")
def author_findings(spark: SparkSession, sf: str) -> DataFrame:
    """Names that break each of the rules, behind one that breaks none."""
    name = F.get(F.array(*(F.lit(n) for n, _ in _NAMES)), (F.col("c_custkey") % len(_NAMES)).cast("int"))
    customers = table(spark, sf, "customer").select("c_custkey", F.array(F.col("c_name"), name).alias("authors"))
    found = customers.select("c_custkey", audit.author_findings(F.col("authors")).alias("f"))
    issues = F.array_join(F.array_sort(F.transform("f", lambda f: f["issue"])), ",")
    return found.select("c_custkey", issues.alias("issues"), F.array_max(F.transform("f", lambda f: f["field"])).alias("field"))


@query(
    """SELECT doc_id, greatest(1, (length(text) + 999) // 1000) AS n_segments, CASE WHEN length(text) > 64000 THEN 'too many segments' WHEN doc_id % 7 = 0 THEN 'wrong digest' END AS error FROM documents"""
)
def segmented_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Texts cut into segments and put together again; too many segments, or a wrong digest, are errors."""
    docs = table(spark, sf, "documents")
    cut = docs.select(F.col("doc_id").alias("request"), F.explode(tx.chunks(F.col("text"), 1000)).alias("c"))
    segments = cut.select("request", F.col("c.part").alias("position"), F.col("c.text").alias("chunk"))
    headers = docs.select(F.col("doc_id").alias("request"), F.length("text").alias("length"), F.when(F.col("doc_id") % 7 != 0, F.sha2("text", 256)).otherwise("").alias("sha256"))
    joined = state.joined_segments(segments, headers).join(segments.groupBy("request").agg(F.count(F.lit(1)).alias("n_segments")), "request")
    return joined.select(F.col("request").alias("doc_id"), "n_segments", "error")


@query(with_records("SELECT record_id, repo, file, extension, size FROM records"))
def short_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Records as JSON under short keys, read back under long ones."""
    records = page_records(spark, sf)
    short = payload.shorten(records.select("record_id", *payload.SHORT))
    listed = short.select("record_id", F.to_json(F.array(F.struct(*payload.SHORT.values()))).alias("value"))
    parsed = listed.withColumn("x", F.from_json("value", payload._LISTED)[0])
    return parsed.select("record_id", F.col("x.r").alias("repo"), F.col("x.f").alias("file"), F.col("x.e").alias("extension"), F.col("x.s").alias("size"))


@query("SELECT source, count(*) AS n, FALSE AS failed FROM documents WHERE source IN ('src0', 'src1') GROUP BY source UNION ALL SELECT 'none', 0, TRUE")
def source_counts(spark: SparkSession, sf: str) -> DataFrame:
    out = state.source_counts(table(spark, sf, "documents"), ["src0", "src1", "none"])
    return out.select("source", "n", F.col("error").isNotNull().alias("failed"))


@query(with_records("SELECT count(*) AS n, count(DISTINCT repo) AS repos, sum(size)::BIGINT AS bytes FROM records"))
def catalog_totals(spark: SparkSession, sf: str) -> DataFrame:
    tree = catalog.path_rollup(page_records(spark, sf)).where("depth = 0")
    sizes = page_records(spark, sf).agg(F.sum("size").alias("bytes"))
    return tree.agg(F.sum("n_files").alias("n"), F.count(F.lit(1)).alias("repos")).crossJoin(F.broadcast(sizes))  # one row each

"""Registered queries of review states, requests, landed listings and whole workflows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates, identity, retries
from ..functions import text as tx
from ..operators import catalog, manifest, matching, review
from ..sources import members, state
from . import composites
from .base import PAGE_RECORDS, page_records, table

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


def with_records(sql: str) -> str:
    return f"WITH {PAGE_RECORDS} {sql}"


# Decisions on rows ---------------------------------------------------------------------


@query(
    """WITH t AS (SELECT c_custkey AS k, c_name AS n FROM customer)
SELECT k, CASE WHEN k % 3 = 0 AND k % 2 = 0 THEN 'existing file reported as added' WHEN k % 3 > 0 AND k % 2 = 1 THEN 'base file is missing' WHEN k % 3 < 2 AND k % 5 > 0 THEN 'changed file is missing'
    WHEN k % 3 = 2 AND k % 5 = 0 THEN 'existing file reported as removed' END AS change,
  CASE WHEN k % 4 = 0 THEN 'absent' WHEN k % 3 = 0 THEN 'deleted' WHEN k % 2 = 0 THEN 'unchanged' ELSE 'reset' END AS dropped,
  k % 2 = 0 AND k % 3 = 0 AS own, k % 4 < 3 AND k % 2 = 0 AS deletable, '[' || n || '].ts' AS bare,
  CASE WHEN k % 5 = 0 THEN 'empty' WHEN k > 1000 THEN 'too large' END AS size_error, k % 2 = 0 OR k % 7 > 4 AS differs,
  CASE k % 5 WHEN 0 THEN 'o/r' WHEN 1 THEN 'a/b' END AS repository, k % 3 = 0 AS allowed, k % 4 < 3 AS permitted,
  CASE k % 4 WHEN 0 THEN 'approve' WHEN 1 THEN 'reject' WHEN 2 THEN 'revert' END AS verdict FROM t"""
)
def row_decisions(spark: SparkSession, sf: str) -> DataFrame:
    """Checks of single rows: file changes, drops, branches, sizes, revisions, claims, actors, commands."""
    k = F.col("c_custkey")
    even = k % 2 == 0
    none = F.lit(None).cast("string")
    current = F.when(k % 4 != 0, F.lit("a"))
    upstream = F.when(k % 3 != 0, F.when(even, "a").otherwise("b"))
    versions = table(spark, sf, "customer").withColumns(
        {"main": F.when(even, "x"), "old_main": none, "config": F.lit("c"), "old_config": F.lit("c"), "cache": k % 7, "old_cache": F.when(k % 7 > 4, F.lit(0)).otherwise(k % 7)}
    )
    return versions.select(
        k.alias("k"), manifest.change_error(_pick(k % 3, "added", "modified", "removed"), even, k % 5 == 0).alias("change"),
        manifest.drop_outcome(current, upstream).alias("dropped"),
        matching.last_commit_is_own(F.when(even, "bot"), F.when(k % 3 == 0, "update: x").otherwise("x"), "bot", "update").alias("own"),
        matching.deletable_branch(_pick(k % 4, "proofread/x", "proofread-upstream-1", "revert-12-x", "main"), F.when(even, "me").otherwise("you"), "me").alias("deletable"),
        review.without_archive(F.concat(F.lit("archives7/["), "c_name", F.lit("].ts"))).alias("bare"),
        review.size_error(F.when(k % 5 != 0, k), 1000).alias("size_error"), manifest.any_differs(["main", "config", "cache"]).alias("differs"),
        review.claim_repository(_pick(k % 5, "o/r", "", "", "", ""), _pick(k % 5, "https://x.example/q/q/pull/1", "https://x.example/a/b/pull/12", "https://x.example/a/b", "", None)).alias("repository"),
        review.authorized(_pick(k % 3, "ann", "bob", "cy"), ["ann"], none).alias("allowed"),
        review.authorized(F.lit("x"), [], _pick(k % 4, "admin", "maintain", "push", None)).alias("permitted"),
        review.verdict(_pick(k % 4, " /proofread-approve", "/Proofread-Reject no", "/proofread-revert", "/proofread-approve it")).alias("verdict"),
    )


@query(
    """SELECT p_partkey, 'x,y' AS unexpected, 'a,x' AS restricted, '1,' || p_partkey || ',4' AS merged, CASE WHEN p_size <= 20 THEN 'true,false,true' WHEN p_size <= 25 THEN 'true,false,false' ELSE 'false,false,true' END AS fits,
  CASE WHEN p_size % 3 = 0 THEN '校订' WHEN p_size % 3 = 1 THEN '正文段落 ' || p_size || ' 处,描述' ELSE '正文段落 ' || p_size || ' 处,注释,' || p_brand END AS summary,
  left(sha256(p_brand || ',' || p_partkey), 10) AS batch, left(sha256(p_name), 16) || '-' || left(md5(p_name), 16) AS generation FROM part"""
)
def field_tools(spark: SparkSession, sf: str) -> DataFrame:
    """Maps against allowed keys, sections that fit a limit, the lines of a summary, digests of keys and generations."""
    size = F.col("p_size")
    m = F.create_map(F.lit("y"), F.lit("1"), F.lit("a"), F.lit("2"), F.lit("x"), F.lit("3"))
    other = F.create_map(F.lit("a"), F.col("p_partkey").cast("string"), F.lit("z"), F.lit("4"))
    both = manifest.merged_map(manifest.restricted(m, ["a", "y"]), other)
    sections = F.array(F.repeat(F.lit("s"), size), F.repeat(F.lit("s"), F.lit(100)), F.lit("end"))
    kind = size % 3
    fields = F.when(kind == 2, F.array("p_brand"))
    return table(spark, sf, "part").select(
        "p_partkey", F.array_join(manifest.unexpected_keys(m, ["a"]), ",").alias("unexpected"), F.array_join(F.array_sort(F.map_keys(manifest.restricted(m, ["a", "x", "q"]))), ",").alias("restricted"),
        F.concat_ws(",", both["y"], both["a"], both["z"]).alias("merged"), F.array_join(manifest.fitting(sections, F.lit(10), 37), ",").alias("fits"),
        F.array_join(review.change_summary(F.when(kind == 0, 0).otherwise(size), F.when(kind == 2, 1).otherwise(0), kind == 1, fields), ",").alias("summary"),
        identity.batch_digest(F.array(F.col("p_brand"), F.col("p_partkey").cast("string"))).alias("batch"), identity.generation_id(F.sha2("p_name", 256), F.md5("p_name")).alias("generation"),
    )


@query(
    """SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS local_date, CAST(least(30.0, 2 * pow(2, user_id % 6)) AS DOUBLE) AS wait,
  CASE user_id % 4 WHEN 0 THEN 7 WHEN 1 THEN 60 WHEN 2 THEN 1 ELSE CAST(least(60, 5 * pow(2, greatest(user_id % 6 - 1, 0))) AS INTEGER) END AS delay, user_id % 3 = 0 AND user_id % 6 <= 2 AS again FROM events"""
)
def retry_delays(spark: SparkSession, sf: str) -> DataFrame:
    """Local dates, and how long failed requests wait: as the header says in seconds or as a date, else doubled each time."""
    u = F.col("user_id")
    now = F.lit("2024-05-06 07:08:09+00:00").cast("timestamp")
    header = _pick(u % 4, " 7 ", "Mon, 06 May 2024 09:00:00 GMT", "Mon, 06 May 2024 07:00:00 GMT", "later")
    return table(spark, sf, "events").select(
        "event_id", dates.local_date(F.col("ts")).alias("local_date"), retries.backoff(u % 6, 2, 30).alias("wait"),
        retries.retry_delay(header, now, u % 6, 5, 60).alias("delay"), retries.worth_retrying(_pick(u % 3, 503, 404, None), u % 6, 2).alias("again"),
    )


@query(
    """SELECT c_custkey, c_name || chr(10) || 'b' AS section, CAST(c_custkey % 40 AS INTEGER) AS page, 'x' AS body, '[{"a":1,"b":2}]' AS removed, '[3]' AS added,
  '{"archive_id":1,"repository":"r","old_ocr_cache":"a","new_ocr_cache":"b","mirror_ocr_patch":"c","upstream_ocr_patch":"d","articles":[{"path":"' || c_name || '","article_id":"i","publication_id":"p","doc_id":"d"}]}' AS compact FROM customer"""
)
def body_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Sections of bodies, page numbers, request fields, lists compared by their canonical JSON, compacted conflicts."""
    n = F.col("c_name")
    body = F.concat(F.lit("a\n## 修改内容\n"), n, F.lit("\nb\n## next\nc"))
    request = F.parse_json(F.when(F.col("c_custkey") % 2 == 0, '{"body":{"field":"x"},"field":"y"}').otherwise('{"field":"x"}'))
    found = manifest.list_diff(F.array(F.lit('{"b":2,"a":1}'), F.lit('{"c":[1, 2]}')), F.array(F.lit('{"c":[1,2]}'), F.lit("3")), manifest.canonical)
    article = F.struct(n.alias("path"), F.lit("i").alias("article_id"), F.lit("p").alias("publication_id"), F.lit("d").alias("doc_id"), F.lit("long").alias("content"))
    conflict = F.struct(
        F.lit(1).alias("archive_id"), F.lit("r").alias("repository"), F.lit("a").alias("old_ocr_cache"), F.lit("b").alias("new_ocr_cache"), F.lit("c").alias("mirror_ocr_patch"),
        F.lit("d").alias("upstream_ocr_patch"), F.lit("e").alias("other"), F.array(article).alias("articles"),
    )
    listed = lambda c: F.concat(F.lit("["), F.array_join(F.transform(c, manifest.canonical), ","), F.lit("]"))
    return table(spark, sf, "customer").select(
        "c_custkey", review.section(body, "修改内容").alias("section"), tx.page_number(F.concat(F.lit("a/page-"), F.col("c_custkey") % 40, F.lit(".jpg"))).alias("page"),
        state.body_field(request, "field").cast("string").alias("body"), listed(found["removed"]).alias("removed"), listed(found["added"]).alias("added"),
        F.to_json(review.compact_conflict(conflict)).alias("compact"),
    )


# Pulls and issues ----------------------------------------------------------------------


@query(
    """WITH p AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN 'Revert x' ELSE 'x' END AS title FROM orders),
k AS (SELECT CAST(c_custkey AS VARCHAR) AS number FROM customer)
SELECT k.number, (SELECT min(o_orderkey) FROM p WHERE title = 'Revert x' AND starts_with(CAST(o_custkey AS VARCHAR), k.number)) AS pull FROM k"""
)
def existing_reverts(spark: SparkSession, sf: str) -> DataFrame:
    """For each number the first revert that mentions it, or a longer number that begins so."""
    k = F.col("o_orderkey")
    pulls = table(spark, sf, "orders").select(
        k.alias("pull"), k.alias("position"), F.when(k % 3 == 0, "Revert x").otherwise("x").alias("title"), F.concat(F.lit("see #"), "o_custkey", F.lit(".")).alias("body")
    )
    return review.existing_reverts(pulls, table(spark, sf, "customer").select(F.col("c_custkey").alias("number")))


@query(
    """SELECT o_custkey, min(o_orderkey) AS newest, bool_and(o_orderstatus = 'F') AS closed, max(CASE WHEN o_custkey % 32 IN (3, 4) AND o_orderstatus <> 'F' THEN 1 ELSE 0 END) AS to_close FROM orders GROUP BY o_custkey"""
)
def issue_states(spark: SparkSession, sf: str) -> DataFrame:
    """The newest issue of each customer, whether all its pulls are closed, and open issues of the selected archives."""
    orders = table(spark, sf, "orders")
    newest = review.newest(orders.select("o_custkey", F.col("o_orderkey").alias("newest")), ["o_custkey"], "newest")
    branch = F.concat(F.lit("tmp/"), "o_custkey")
    state_of = F.when(F.col("o_orderstatus") == "F", "closed").otherwise("open")
    pulls = orders.select("o_custkey", branch.alias("branch"), state_of.alias("state"))
    closed = review.closed_temporaries(pulls.select("branch").distinct(), pulls, ["branch"], "^tmp/").select("branch", F.lit(True).alias("closed"))
    body = F.concat(F.lit('<!-- conflict:{"archive_id":'), F.col("o_custkey") % 32, F.lit("} -->"))
    issues = review.issues_to_close(orders.select("o_custkey", body.alias("body"), state_of.alias("state")), [3, 4])
    marked = issues.select("o_custkey").distinct().withColumn("to_close", F.lit(1))
    out = newest.withColumn("branch", branch).join(closed, "branch", "left").join(marked, "o_custkey", "left")
    return out.select("o_custkey", "newest", F.coalesce("closed", F.lit(False)).alias("closed"), F.coalesce("to_close", F.lit(0)).alias("to_close"))


@query("SELECT CAST(c_nationkey AS INTEGER) AS archive_id, 'm' || c_nationkey AS main, 'c' AS config, CAST(NULL AS VARCHAR) AS ocr_cache, 'p' AS ocr_patch, 'h' AS helper, '2' AS patch_layout FROM customer GROUP BY 1, 2")
def input_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    revisions = table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("archive_id"), F.concat(F.lit("m"), "c_nationkey").alias("main"), F.lit("c").alias("config"), F.lit(None).cast("string").alias("ocr_cache"), F.lit("p").alias("ocr_patch")
    )
    return review.input_snapshot(revisions.distinct(), "h")


# Landed listings -----------------------------------------------------------------------


@query(
    """WITH t AS (SELECT p_brand AS repo, 'a/' || p_partkey || '.ts' AS path FROM part WHERE p_partkey % 5 > 0 AND p_brand <> 'Brand#1' UNION ALL SELECT p_brand, 'c/' || p_partkey FROM part WHERE p_brand = 'Brand#1')
SELECT repo, count(*) AS n, min(path) AS first, max(path) AS last FROM t GROUP BY repo"""
)
def whole_trees(spark: SparkSession, sf: str) -> DataFrame:
    """Tree listings, one of which is cut short and comes from its clone."""
    parts = table(spark, sf, "part")
    k = F.col("p_partkey")
    listing = parts.select(
        F.col("p_brand").alias("repo"), F.concat(F.lit("a/"), k, F.lit(".ts")).alias("path"), F.when(k % 5 == 0, "tree").otherwise("blob").alias("type"), (F.col("p_brand") == "Brand#1").alias("truncated")
    )
    clones = parts.select(F.col("p_brand").alias("repo"), F.concat(F.lit("c/"), k).alias("path"))
    return state.whole_tree(listing, clones).groupBy("repo").agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("first"), F.max("path").alias("last"))


@query(
    """SELECT 'g/' || p_size || '/' || p_partkey || CASE WHEN p_partkey % 3 = 0 THEN '.ts' ELSE '.txt' END AS path, p_partkey % 3 = 0 AS patch, NOT (p_size % 4 = 0) AS stale, p_partkey % 3 > 0 AS text FROM part"""
)
def tree_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files of a listing: patches, objects of generations that nobody retains, texts at a depth."""
    parts = table(spark, sf, "part")
    path = F.concat(F.lit("g/"), "p_size", F.lit("/"), "p_partkey", F.when(F.col("p_partkey") % 3 == 0, ".ts").otherwise(".txt"))
    tree = parts.select(F.lit("mirror").alias("side"), path.alias("path"), F.lit("blob").alias("type"), F.lit("b").alias("blob"), F.lit(False).alias("truncated"))
    patch = state.tree_blobs(tree).select("path", F.lit(True).alias("patch"))
    retained = parts.where("p_size % 4 = 0").select(F.concat(F.lit("g/"), "p_size", F.lit("/")).alias("prefix"))
    stale = state.stale_objects(tree.withColumn("type", F.lit("file")), "g", retained).withColumn("stale", F.lit(True))
    known = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    return tree.join(patch, "path", "left").join(stale, "path", "left").select("path", known("patch"), known("stale"), members.at_depth(F.col("path"), 3, ".txt").alias("text"))


@query(
    """SELECT DISTINCT page_id % 32 AS archive_id, url FROM pages WHERE url LIKE 'http://%' OR url LIKE 'https://%'"""
)
def publication_urls(spark: SparkSession, sf: str) -> DataFrame:
    """The web addresses in publication metadata, each once for its archive."""
    content = F.to_json(F.struct(F.array(F.concat(F.lit(" "), "url"), F.lit("local.pdf"), F.col("url")).alias("files")))
    return state.publication_urls(table(spark, sf, "pages").select((F.col("page_id") % 32).alias("archive_id"), content.alias("content")))


@query(
    """SELECT page_id, url, CAST(page_id % 32 AS INTEGER) AS archive_id, md5(html) AS sha256, CAST(length(html) AS BIGINT) AS bytes, CASE WHEN page_id % 2 = 0 THEN 'p-1,p-2' ELSE '' END AS previews, CASE WHEN page_id % 2 = 0 THEN 'v1' END AS profile FROM pages"""
)
def manifest_entries(spark: SparkSession, sf: str) -> DataFrame:
    preview = F.when(F.col("page_id") % 2 == 0, F.struct(F.lit(2).alias("count"), F.array(F.lit("p-1"), F.lit("p-2")).alias("paths"), F.lit("v1").alias("profile")))
    entry = F.struct((F.col("page_id") % 32).alias("archive_id"), F.md5("html").alias("sha256"), F.length("html").alias("bytes"), preview.alias("page_previews"))
    value = F.to_json(F.struct(F.lit(1).alias("version"), F.create_map(F.col("url"), entry).alias("files")))
    texts = table(spark, sf, "pages").select("page_id", value.alias("value"))
    rows = state.manifest_rows(texts, keep=["page_id"]).withColumn("previews", F.array_join("previews", ","))
    return rows.select("page_id", "url", "archive_id", "sha256", "bytes", "previews", "profile")


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN n_name WHEN n_nationkey % 3 = 1 THEN 'fallback' END AS text FROM nation")
def pinned_texts(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("n_nationkey") % 3
    preferred = F.when(k == 0, F.encode("n_name", "UTF-8")).when(k == 2, F.unhex(F.lit("FF")))
    return table(spark, sf, "nation").select("n_nationkey", state.pinned_text(preferred, F.encode(F.lit("fallback"), "UTF-8")).alias("text"))


@query("SELECT p_brand AS repo, p_partkey % 7 > 0 AS unchanged FROM (SELECT p_brand, min(p_partkey) AS p_partkey FROM part GROUP BY 1)")
def tree_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Whether a generated tree is the present one; one file differs, or is lacking, where it isn't."""
    parts = table(spark, sf, "part")
    first = parts.groupBy("p_brand").agg(F.min("p_partkey").alias("first"))
    generated = parts.select(F.col("p_brand").alias("repo"), F.col("p_partkey").cast("string").alias("path"), F.col("p_name").alias("blob"))
    odd = (F.col("p_partkey") == F.col("first")) & (F.col("first") % 7 == 0)
    present = parts.join(first, "p_brand").where(~(odd & (F.col("first") % 2 == 0)))
    current = present.select(F.col("p_brand").alias("repo"), F.col("p_partkey").cast("string").alias("path"), F.when(odd, "x").otherwise(F.col("p_name")).alias("blob"))
    return manifest.trees_equal(generated, current, "repo")


@query(
    """SELECT CASE WHEN p_partkey % 10 = 0 THEN 'n/' || p_partkey ELSE 'f/' || p_partkey END AS path, CASE WHEN p_partkey % 5 = 0 AND p_partkey % 15 > 0 THEN p_type ELSE p_name END AS content,
  CASE WHEN p_partkey % 10 = 0 THEN 'f/' || p_partkey END AS old_path, CASE WHEN p_partkey % 10 = 1 THEN 'target exists' END AS error FROM part
UNION ALL SELECT 'f/none', NULL, NULL, 'file is missing'"""
)
def upserted_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files written and moved by changes; a target that exists and a file that doesn't are errors."""
    parts = table(spark, sf, "part")
    k = F.col("p_partkey")
    path = lambda folder, key=k: F.concat(F.lit(folder + "/"), key)
    files = parts.select(path("f").alias("path"), F.col("p_name").alias("content"))
    taken = F.when(k % 10 == 0, path("n")).when(k % 10 == 1, path("f", k + 1)).otherwise(path("f"))
    changes = parts.where("p_partkey % 5 < 2 and p_partkey % 10 <> 6").select(path("f").alias("path"), taken.alias("new_path"), F.when((k % 5 == 0) & (k % 15 > 0), F.col("p_type")).alias("content"))
    missing = spark.range(1).select(F.lit("f/none").alias("path"), F.lit("f/none").alias("new_path"), F.lit("x").alias("content"))
    return manifest.upserted(files, changes.unionByName(missing))


@query(
    with_records(
        """, RECURSIVE_ROWS AS (SELECT repo, record_id, path, octet_length(encode(path)) AS size, row_number() OVER (PARTITION BY repo ORDER BY record_id) AS n FROM records),
b AS (SELECT repo, record_id, path, n, 0 AS batch, size + 3 AS total FROM RECURSIVE_ROWS WHERE n = 1
  UNION ALL SELECT r.repo, r.record_id, r.path, r.n, CASE WHEN b.total + 30 + r.size + 5 < 80 THEN b.batch ELSE b.batch + 1 END,
    CASE WHEN b.total + 30 + r.size + 5 < 80 THEN b.total + r.size + 3 ELSE r.size + 3 END FROM b JOIN RECURSIVE_ROWS r ON r.repo = b.repo AND r.n = b.n + 1)
SELECT repo, record_id, path, CAST(batch AS INTEGER) AS batch FROM b"""
    ).replace("WITH", "WITH RECURSIVE", 1)
)
def byte_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Greedy batches of every repo's paths under a byte budget."""
    return manifest.packed_rows(page_records(spark, sf), "repo", "record_id", "path", 80)


# Workflows -----------------------------------------------------------------------------


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return page_records(spark, sf).select("record_id", "repo", F.concat(F.lit("./"), "path").alias("line"))


@query(
    with_records(
        """, d AS (SELECT repo, folder, unnest(range(0, len(folder) + 1)) AS depth FROM records)
SELECT 'tree' AS name, (SELECT count(*) FROM (SELECT DISTINCT repo, folder[1:depth] FROM d)) AS n UNION ALL SELECT 'repos', (SELECT count(DISTINCT repo) FROM records)
UNION ALL SELECT 'folders', (SELECT count(DISTINCT folder) FROM records) UNION ALL SELECT 'fact', (SELECT count(*) FROM records)
UNION ALL SELECT 'sized', (SELECT count(*) FROM records WHERE record_id % 3 = 0) UNION ALL SELECT 'browser_folders', (SELECT count(*) FROM (SELECT DISTINCT repo, folder[1:depth] FROM d WHERE depth < len(folder)))
UNION ALL SELECT 'browser_files', (SELECT count(*) FROM (SELECT DISTINCT repo, folder FROM records))"""
    )
)
def catalog_build(spark: SparkSession, sf: str) -> DataFrame:
    """The whole catalog of listing lines with sizes of some lines; the rows of each of its frames."""
    sizes = page_records(spark, sf).where("record_id % 3 = 0").select("record_id", "repo", "path", F.lit(7).cast("bigint").alias("size"))
    out = composites.build_catalog(_lines(spark, sf), sizes)
    out["sized"] = out.pop("records").where("size = 7")
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, df in out.items()]
    return reduce(DataFrame.unionByName, counts)


@query(
    with_records(
        """, w AS (SELECT DISTINCT record_id, unnest(regexp_extract_all(lower(file || ' ' || array_to_string(folder, '/')), '[a-z0-9]+')) AS term FROM records)
SELECT term, count(*) AS doc_freq, string_agg(CAST(record_id AS VARCHAR), ',' ORDER BY record_id) AS postings FROM w GROUP BY term"""
    )
)
def synced_words(spark: SparkSession, sf: str) -> DataFrame:
    """The word index that a synchronisation of the records comes to."""
    stems = page_records(spark, sf).select(F.lit("none").alias("stem"))
    return composites.sync_indexes(page_records(spark, sf), stems)["words"].withColumn("postings", F.array_join("postings", ","))


@query(
    """WITH p AS (SELECT c_nationkey AS archive_id, c_custkey AS article_id, CASE WHEN c_custkey % 9 = 0 THEN 'new' ELSE c_name END AS title FROM customer WHERE c_nationkey % 3 = 0)
SELECT archive_id, article_id, title, archive_id % 2 = 0 AS held FROM p"""
)
def rebuilt_archives(spark: SparkSession, sf: str) -> DataFrame:
    """Articles of the archives whose revisions changed, overridden; archives with conflicts are held back."""
    customers = table(spark, sf, "customer")
    key = F.col("c_nationkey")
    rev = lambda change: customers.select(
        key.alias("archive_id"), change.alias("main"), F.lit("c").alias("config"), F.lit(None).cast("string").alias("ocr_cache"), F.lit("p").alias("ocr_patch")
    ).distinct()
    articles = customers.select(
        key.alias("archive_id"), F.lit("p").alias("publication_id"), F.col("c_custkey").cast("string").alias("article_id"), F.concat(F.lit("#"), "c_name").alias("title"), F.lit("d").alias("description"),
        F.array().cast("array<string>").alias("comments"), F.array(F.struct(F.lit("p").alias("type"), F.lit("t").alias("text"))).alias("parts"), F.array(F.lit("n")).alias("authors"),
    ).withColumn("title", F.substring("title", 2, 100))
    overrides = customers.where("c_custkey % 9 = 0 and c_nationkey % 3 = 0").select(
        F.lit("p").alias("publication_id"), F.col("c_custkey").cast("string").alias("article_id"), F.lit(None).cast("string").alias("new_article_id"), F.lit("new").alias("title"), F.lit(None).cast("array<string>").alias("authors")
    )
    mirror = customers.where("c_nationkey % 6 = 0").select(key.alias("archive_id"), F.lit("[a][b].ts").alias("path"), F.lit("x").alias("blob")).distinct()
    old = F.when(key % 3 == 0, "old").otherwise("m")
    out = composites.rebuild_archives(rev(F.lit("m")), rev(old), articles, overrides, mirror, mirror.withColumn("blob", F.lit("y")))
    return out["articles"].select("archive_id", F.col("article_id").cast("bigint").alias("article_id"), "title", "held")


@query(
    """SELECT url, min(page_id % 32) AS archive_id, count(*) AS n, max(octet_length(encode(html))) AS bytes FROM pages p WHERE page_id % 4 > 0 AND NOT EXISTS (SELECT 1 FROM pages q WHERE q.url = p.url AND q.page_id % 4 = 0) GROUP BY url"""
)
def mirror_plans(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    urls = pages.where("page_id % 4 > 0").select((F.col("page_id") % 32).alias("archive_id"), "url")
    plan = composites.mirror_plan(urls, pages.select("url", F.encode("html", "UTF-8").alias("content")), pages.where("page_id % 4 = 0").select("url"))
    return plan.groupBy("url", "archive_id").agg(F.count(F.lit(1)).alias("n"), F.max("bytes").alias("bytes"))


@query(
    """SELECT p_partkey, 'pdf-linearize' AS kind FROM part WHERE p_partkey % 3 = 0 AND p_partkey % 2 = 0 UNION ALL SELECT p_partkey, 'webp-lossless' FROM part WHERE p_partkey % 3 = 1 AND p_partkey % 2 = 0 UNION ALL SELECT p_partkey, 'swept' FROM part WHERE p_partkey % 2 = 0 AND p_partkey % 3 < 2"""
)
def optimize_plans(spark: SparkSession, sf: str) -> DataFrame:
    """Files that are processed, and paths that nothing refers to once they are."""
    parts = table(spark, sf, "part")
    k = F.col("p_partkey")
    files = parts.select(
        "p_partkey", F.concat(F.lit("https://x.example/"), k, _pick(k % 3, ".pdf", ".PNG", ".txt")).alias("url"), ((k % 2 == 1) | (k % 3 == 2)).alias("optimized"),
        F.lit(2000).alias("webp_max_dimension"), F.lit("v1").alias("profile"), F.concat(F.lit("a/"), k).alias("path"), F.array().cast("array<string>").alias("previews"),
    )
    todo = composites.optimize_plan(files)
    after = files.join(todo.select("p_partkey", F.concat("path", F.lit("-new")).alias("new")), "p_partkey", "left").withColumn("path", F.coalesce("new", "path"))
    swept = composites.swept_paths(files, after).select(F.substring_index("path", "/", -1).cast("bigint").alias("p_partkey"), F.lit("swept").alias("kind"))
    return todo.select("p_partkey", F.col("transformation.kind").alias("kind")).unionByName(swept)


@query(
    """SELECT CAST(o_custkey % 20 AS VARCHAR) AS repo, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 9 > 0 GROUP BY 1"""
)
def upstream_plans(spark: SparkSession, sf: str) -> DataFrame:
    """Corrections to publish upstream, without those known or claimed."""
    repo, k = (F.col("o_custkey") % 20).cast("string"), F.col("o_orderkey")
    pulls = table(spark, sf, "orders").select(
        repo.alias("repo"), k.alias("number"), F.when(F.col("o_orderstatus") != "P", "2020").alias("merged_at"), F.lit("proofread/x").alias("head_ref"), repo.alias("head_repo"), F.lit("main").alias("base_ref")
    )
    key = identity.source_key(F.col("repo"), F.col("number")).alias("key")
    known = lambda parity: pulls.where(f"number % 18 = {parity}").select(key)
    out = composites.upstream_batches(pulls, known(0), known(9), known(0))["groups"]
    return out.groupBy("repo").agg(F.sum(F.size("numbers")).cast("bigint").alias("n"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 1 THEN 'rewritten' WHEN n_nationkey % 3 = 2 THEN 'existing' ELSE 'written' END AS status, FALSE AS large FROM nation WHERE n_nationkey % 5 > 0")
def text_states(spark: SparkSession, sf: str) -> DataFrame:
    """What becomes of decoded texts; pointers are left out."""
    k = F.col("n_nationkey")
    path = k.cast("string").alias("path")
    nation = table(spark, sf, "nation")
    files = nation.select(path, F.when(k % 5 == 0, F.encode(F.lit("version https://git-lfs.x"), "UTF-8")).otherwise(F.encode("n_name", "UTF-8")).alias("content"))
    existing = nation.where(k % 3 > 0).select(path, F.when(k % 3 == 1, F.unhex(F.lit("FFFF"))).otherwise(F.encode("n_name", "UTF-8")).alias("content"))
    return composites.publish_texts(files, existing).select(F.col("path").cast("int").alias("n_nationkey"), "status", "large")


@query(
    """SELECT n_regionkey, n_nationkey, p AS page, CASE WHEN p = 2 THEN '0.5' ELSE '0.1' END AS top, 'i' || n_nationkey || '-' || p AS image FROM nation, (SELECT unnest([1, 2, 3]) AS p)"""
)
def crop_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """Crops of a request's pages with the images that they are cut from."""
    nation = table(spark, sf, "nation")
    key = F.col("n_nationkey")
    thresholds = lambda top: F.struct(F.array(F.lit(top), F.lit(0.0), F.lit(0.0), F.lit(0.0)).alias("content_thresholds"))
    articles = nation.select(
        key.alias("request"), F.col("n_regionkey").alias("article"), F.lit(1).alias("page_start"), F.lit(3).alias("page_end"), thresholds(0.1).alias("ocr"), F.create_map(F.lit("2"), thresholds(0.5)).alias("ocr_exceptions")
    )
    url = F.concat(F.lit("u"), key)
    mirror = nation.select(url.alias("url"), F.lit("whole").alias("path"), F.transform(F.sequence(F.lit(1), F.lit(3)), lambda p: F.concat(F.lit("i"), key, F.lit("-"), p)).alias("previews"))
    out = composites.review_crops(articles, nation.select(key.alias("request"), F.array(url).alias("files")), mirror)
    return out.select(F.col("article").alias("n_regionkey"), F.col("request").alias("n_nationkey"), "page", F.col("thresholds")[0].cast("string").alias("top"), "image")


@query(
    """SELECT c_nationkey AS archive_id, FALSE AS baseline, 't' || c_nationkey AS tree FROM customer WHERE c_nationkey % 4 = 0 GROUP BY 1"""
)
def revision_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Archives whose tree is another than the state says."""
    key = F.col("c_nationkey")
    current = table(spark, sf, "customer").select(key.alias("archive_id"), F.concat(F.lit("t"), key).alias("tree")).distinct()
    previous = current.withColumn("tree", F.when(F.col("archive_id") % 4 == 0, "old").otherwise(F.col("tree")))
    return composites.revision_check(current, previous)


@query(
    """WITH t AS (SELECT p_partkey AS k, p_name AS n, p_size * 10 AS cost FROM part)
SELECT k, CASE WHEN k % 6 = 0 THEN 'archive_id must be between 0 and 31' WHEN k % 6 = 1 THEN 'unknown kind' WHEN k % 6 = 2 THEN 'not a patch of version 2' END AS error,
  CASE WHEN k % 6 > 2 THEN cost <= 500 END AS auto_merge, CASE WHEN k % 6 > 2 THEN '- 段落 1：甲' || n || ' → 甲' END AS lines, CASE WHEN k % 6 > 2 THEN '[a' || k || '][p].ts' END AS path FROM t"""
)
def submissions(spark: SparkSession, sf: str) -> DataFrame:
    """Corrections from request to file: what is wrong with them, whether they may be merged unseen, what they change."""
    k, n = F.col("p_partkey"), F.col("p_name")
    kind = k % 6
    # The text is padded so that the delta's cost is ten times the part's size.
    article = F.to_json(F.struct(F.array(F.struct(F.lit("p").alias("type"), F.concat(F.lit("甲"), n).alias("text"))).alias("parts")))
    short = F.concat(F.lit("=1\t-"), F.length(n))
    patch = F.concat(F.lit('{"version":'), F.when(kind == 2, "1").otherwise("2"), F.lit(',"parts":{"0":{"diff":"'), F.replace(short, F.lit("\t"), F.lit("\\t")), F.lit('"}},"comments":{}}'))
    request = F.struct(
        F.when(kind == 0, 32).otherwise(5).alias("archive_id"), F.when(kind == 1, "other").otherwise("proofread").alias("kind"), F.concat(F.lit("a"), k).alias("article_id"), F.lit("p").alias("publication_id"),
        patch.alias("patch"), F.lit(None).cast("string").alias("metadata"), article.alias("article"),
    )
    out = composites.submitted(table(spark, sf, "part").select(k.alias("k"), (F.col("p_size") * 10 <= 500).alias("cheap"), F.length(n).alias("cost"), request.alias("request")))
    allowed = F.when(F.col("auto_merge").isNotNull(), (F.col("auto_merge") == (F.col("cost") <= 500)) & F.col("cheap"))
    return out.select("k", "error", allowed.alias("auto_merge"), F.array_join("lines", "\n").alias("lines"), "path")


@query(
    """WITH n AS (SELECT c_nationkey AS archive_id, c_nationkey % 3 > 0 AS same FROM customer GROUP BY 1)
SELECT archive_id FROM n WHERE NOT same AND archive_id % 2 = 0"""
)
def unpropagated_revisions(spark: SparkSession, sf: str) -> DataFrame:
    """Archives whose new revision isn't served yet; asked again until only those that stay behind are left."""
    key = F.col("c_nationkey")
    expected = table(spark, sf, "customer").select(key.alias("archive_id"), F.lit("new").alias("commit")).distinct()
    lagging = lambda tries: expected.withColumn(
        "commit", F.when((F.col("archive_id") % 3 > 0) | ((F.col("archive_id") % 2 > 0) & F.lit(tries > 0)), "new").otherwise("old")
    )
    tries = iter(range(2))
    out: list[DataFrame] = []

    def pending() -> list:
        out.append(retries.unpropagated(expected, lagging(next(tries)), "archive_id", "commit"))
        return [] if len(out) > 1 else [out[0]]

    retries.wait_until_empty(pending, 60, 0)
    return out[-1]


@query(
    with_records(
        """, d AS (SELECT DISTINCT repo, folder[1:depth] AS folder FROM (SELECT repo, folder, unnest(range(1, len(folder) + 1)) AS depth FROM records))
SELECT repo, array_to_string(folder, '/') AS path, row_number() OVER (PARTITION BY repo ORDER BY len(folder) DESC, array_to_string(folder, '/')) AS place FROM d"""
    )
)
def folder_removals(spark: SparkSession, sf: str) -> DataFrame:
    """The folders of each repo in the order in which they can be removed: the deepest first."""
    folders = catalog.path_rollup(page_records(spark, sf)).where("depth > 0").select("repo", "path")
    place = F.row_number().over(Window.partitionBy("repo").orderBy(*manifest.deepest_first(F.col("path"))))
    return folders.withColumn("place", place)

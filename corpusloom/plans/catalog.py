"""Registered queries of the catalog and index operators, with their SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import catalog, index
from ..sources import listing, payload
from .base import PAGE_RECORDS, page_records, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its oracle."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def with_records(sql: str) -> str:
    return f"WITH {PAGE_RECORDS} {sql}"


@query(
    with_records(
        """, p AS (SELECT repo, folder, unnest(range(0, len(folder) + 1)) AS depth FROM records)
SELECT repo, array_to_string(folder[1:depth], '/') AS path, CAST(depth AS BIGINT) AS depth,
       count(*) AS n_files, bool_or(len(folder) = depth) AS has_direct
FROM p GROUP BY 1, 2, 3"""
    )
)
def path_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.path_rollup(page_records(spark, sf)).withColumn("depth", F.col("depth").cast("bigint"))


@query(
    with_records(
        """, p AS (SELECT repo, folder, unnest(range(0, len(folder) + 1)) AS depth FROM records),
n AS (SELECT repo, folder[1:depth] AS f, depth, count(*) AS n_files, bool_or(len(folder) = depth) AS has_direct FROM p GROUP BY 1, 2, 3),
c AS (SELECT repo, f[1:depth - 1] AS f, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1, 2, 3)
SELECT n.repo, array_to_string(n.f, '/') AS path,
  CASE WHEN n.depth > 0 THEN array_to_string(n.f[1:n.depth - 1], '/') END AS parent_path,
  CASE WHEN n.depth > 0 THEN n.f[-1] ELSE n.repo END AS name, n.depth, n_files, has_direct,
  coalesce(n_children, 0) AS n_children, n_children IS NOT NULL AS has_children,
  n_children IS NOT NULL AND has_direct AND n.depth > 0 AS show_self
FROM n LEFT JOIN c ON n.repo = c.repo AND n.f = c.f AND n.depth = c.depth"""
    )
)
def folder_tree(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.folder_tree(page_records(spark, sf))


@query(with_records("SELECT record_id, repo, path, file, extension, array_to_string(folder, '|') AS folder FROM records"))
def record_parse(spark: SparkSession, sf: str) -> DataFrame:
    return page_records(spark, sf).select("record_id", "repo", "path", "file", "extension", F.array_join("folder", "|").alias("folder"))


@query(
    with_records(
        """SELECT record_id, array_to_string(list_filter(folder, lambda p: p <> '') || [CASE WHEN extension <> '' THEN file || '.' || extension ELSE file END], '/') AS rebuilt,
  array_to_string(list_filter(folder, lambda p: p <> '') || [file], '/') AS stem FROM records"""
    )
)
def path_stem(spark: SparkSession, sf: str) -> DataFrame:
    rebuilt = listing.relative_path(F.col("folder"), F.col("file"), F.col("extension"))
    return page_records(spark, sf).select("record_id", rebuilt.alias("rebuilt"), listing.stem_of(rebuilt).alias("stem"))


@query(
    """SELECT key, row_number() OVER (ORDER BY first_seen, key) - 1 AS key_id, first_seen
FROM (SELECT source AS key, min(doc_id) AS first_seen FROM documents GROUP BY source)"""
)
def dict_encode(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.dictionary(table(spark, sf, "documents"), F.col("source"), "doc_id")


@query(
    with_records(
        """, d AS (SELECT folder, row_number() OVER (ORDER BY min(record_id)) - 1 AS folder_id FROM records GROUP BY folder),
r AS (SELECT repo, row_number() OVER (ORDER BY min(record_id)) - 1 AS repo_id FROM records GROUP BY repo)
SELECT record_id, repo_id, folder_id, file, extension FROM records JOIN d USING (folder) JOIN r USING (repo)"""
    )
)
def dict_encode_folders(spark: SparkSession, sf: str) -> DataFrame:
    records = page_records(spark, sf)
    out = catalog.encode(catalog.encode(records, F.col("folder"), "record_id", "folder_id"), F.col("repo"), "record_id", "repo_id")
    return out.select("record_id", "repo_id", "folder_id", "file", "extension")


@query("SELECT source AS repo, count(*) AS n FROM documents WHERE source <> '' GROUP BY source")
def sidebar_counts(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.sidebar_counts(table(spark, sf, "documents"), "source")


@query(
    """SELECT source, doc_id, place, total FROM (
  SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS place, count(*) OVER (PARTITION BY source) AS total FROM documents)
WHERE place <= 100"""
)
def first_page_by_source(spark: SparkSession, sf: str) -> DataFrame:
    """The prebuilt first page of 100 rows of each repo: the limit is the feature."""
    return catalog.first_page(table(spark, sf, "documents").select("source", "doc_id"), "doc_id", ["source"])


@query(
    """SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS place, (SELECT count(*) FROM documents) AS total
FROM documents ORDER BY doc_id LIMIT 100"""
)
def first_page(spark: SparkSession, sf: str) -> DataFrame:
    """The prebuilt first page of 100 rows over all repos: the limit is the feature."""
    return catalog.first_page(table(spark, sf, "documents").select("doc_id"), "doc_id")


@query(
    """SELECT d.doc_id, d.source, l.size FROM documents d
LEFT JOIN (SELECT doc_id, min(quality * 100 + toxic) AS size FROM labels WHERE quality * 100 + toxic > 0 GROUP BY doc_id) l USING (doc_id)"""
)
def size_left_join(spark: SparkSession, sf: str) -> DataFrame:
    sizes = table(spark, sf, "labels").select("doc_id", F.expr("quality * 100 + toxic").alias("size"))
    return catalog.with_sizes(table(spark, sf, "documents").select("doc_id", "source"), sizes, ["doc_id"])


@query("SELECT count(*) AS n, count(size) AS n_filled FROM (SELECT doc_id, max(quality) AS size FROM labels GROUP BY doc_id) RIGHT JOIN documents USING (doc_id)")
def filled_sizes(spark: SparkSession, sf: str) -> DataFrame:
    sizes = table(spark, sf, "labels").select("doc_id", (F.col("quality") + 1).alias("size"))
    sized = catalog.with_sizes(table(spark, sf, "documents").select("doc_id"), sizes, ["doc_id"])
    return sized.agg(F.count(F.lit(1)).alias("n"), F.count("size").alias("n_filled"))


@query(
    with_records(
        """, t AS (SELECT DISTINCT array_to_string(folder || [file], '/') AS stem FROM records WHERE extension = 'html')
SELECT record_id, path, stem IS NOT NULL AS has_txt FROM records LEFT JOIN t ON array_to_string(folder || [file], '/') = stem"""
    )
)
def has_txt_flag(spark: SparkSession, sf: str) -> DataFrame:
    records = page_records(spark, sf)
    stem = listing.stem_of(F.col("path"))
    texts = records.where("extension = 'html'").select(stem.alias("stem"))
    return catalog.flag_present(records, texts, stem, "stem", "has_txt").select("record_id", "path", "has_txt")


@query(
    with_records(
        """, t AS (SELECT repo, folder, depth, count(*) AS n FROM
  (SELECT repo, folder[1:depth] AS folder, depth FROM (SELECT repo, folder, unnest(range(1, len(folder) + 1)) AS depth FROM records)) GROUP BY ALL)
SELECT repo, array_to_string(folder[1:depth - 1], '/') AS path,
  string_agg(folder[-1] || ':' || n, ',' ORDER BY folder[-1]) AS folders FROM t GROUP BY 1, 2"""
    )
)
def browser_folders(spark: SparkSession, sf: str) -> DataFrame:
    out = catalog.browser_folders(page_records(spark, sf))
    shown = F.transform("folders", lambda x: F.concat_ws(":", x["name"], x["n_files"]))
    return out.select("repo", "path", F.array_join(shown, ",").alias("folders"))


@query(
    with_records(
        """SELECT repo, array_to_string(folder, '/') AS path,
  string_agg(file || ':' || extension || ':' || size, ',' ORDER BY file, record_id) AS files FROM records GROUP BY 1, 2"""
    )
)
def browser_files(spark: SparkSession, sf: str) -> DataFrame:
    out = catalog.browser_files(page_records(spark, sf))
    shown = F.transform("files", lambda x: F.concat_ws(":", x["file"], x["extension"], x["size"]))
    return out.select("repo", "path", F.array_join(shown, ",").alias("files"))


@query(
    """SELECT o_orderkey, l.l_linenumber, l.l_partkey FROM orders LEFT JOIN (
  SELECT * FROM (SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS n FROM lineitem) WHERE n = 1) l
  ON o_orderkey = l.l_orderkey"""
)
def first_match(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey")
    lines = lines.withColumn("order", F.struct("l_linenumber", "l_partkey"))
    return catalog.first_match(table(spark, sf, "orders").select("o_orderkey"), lines, ["o_orderkey"], "order").drop("order")


@query(with_records("SELECT record_id, lower(file) AS file_text, lower(repo) AS repo_text, lower(array_to_string(folder, '/')) AS folder_text FROM records"))
def search_fields(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.search_fields(page_records(spark, sf))


@query(with_records("SELECT record_id, repo, array_to_string(folder, '|') AS folder, file, extension, size, has_txt FROM records"))
def payload_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Records through the dictionary-encoded payload and back."""
    records = page_records(spark, sf)
    parts = payload.encode_tables(records)
    decoded = payload.decode_tables(*parts)
    return decoded.select("record_id", "repo", F.array_join("folder", "|").alias("folder"), "file", "extension", "size", "has_txt")


_GRAMS = """WITH g AS (SELECT DISTINCT item_id, substr(lower(text), i, {n}) AS term FROM
  (SELECT item_id, text, unnest(range(1, length(text) - {n} + 2)) AS i FROM benchmark))
SELECT term, count(*) AS doc_freq, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS postings FROM g GROUP BY term"""


def _grams(spark: SparkSession, sf: str, n: int) -> DataFrame:
    out = index.postings(table(spark, sf, "benchmark"), index.field_ngrams([F.lower("text")], n), "item_id")
    return out.withColumn("postings", F.array_join("postings", ","))


@query(_GRAMS.format(n=2))
def ngram2_postings(spark: SparkSession, sf: str) -> DataFrame:
    return _grams(spark, sf, 2)


@query(_GRAMS.format(n=3))
def ngram3_postings(spark: SparkSession, sf: str) -> DataFrame:
    return _grams(spark, sf, 3)


@query(
    """WITH w AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM documents)
SELECT term, count(*) AS doc_freq, min(doc_id) AS first_id, max(doc_id) AS last_id, CAST(sum(doc_id) AS BIGINT) AS id_sum FROM w GROUP BY term"""
)
def word_postings(spark: SparkSession, sf: str) -> DataFrame:
    rows = index.posting_rows(table(spark, sf, "documents"), index.plain_words(F.col("text")), "doc_id")
    return rows.groupBy("term").agg(
        F.count(F.lit(1)).alias("doc_freq"), F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.sum("id").alias("id_sum")
    )


@query(
    """WITH g AS (SELECT DISTINCT item_id, substr(text, i, 2) AS term FROM (SELECT item_id, text, unnest(range(1, length(text))) AS i FROM benchmark))
SELECT term, item_id AS id, item_id - lag(item_id, 1, 0) OVER (PARTITION BY term ORDER BY item_id) AS gap FROM g"""
)
def posting_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return index.posting_gaps(index.posting_rows(table(spark, sf, "benchmark"), index.ngrams(F.col("text"), 2), "item_id"))


@query(
    """WITH b AS (SELECT item_id // 4096 AS block, sha256(string_agg(text || chr(0), '' ORDER BY item_id)) AS d, count(*) AS n FROM benchmark GROUP BY 1)
SELECT sha256(string_agg(d, '' ORDER BY block)) AS digest, CAST(sum(n) AS BIGINT) AS n_rows FROM b"""
)
def fields_digest(spark: SparkSession, sf: str) -> DataFrame:
    return index.rows_digest(table(spark, sf, "benchmark"), "item_id", ["text"])


@query(
    """WITH k AS (SELECT p_partkey, p_name, lpad(CAST(p_size AS VARCHAR), 20, '0') AS s FROM part)
SELECT p_partkey, row_number() OVER (ORDER BY lower(p_name) || ' ' || s, p_partkey) AS place FROM k"""
)
def natural_sort(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_size").alias("name"))
    ranked = names.withColumn("key", F.array_join(tx.natural_key(F.col("name")), ""))
    return catalog.dense_number(ranked.withColumn("zero", F.lit(0)), ["zero", "key", "p_partkey"], "place").select(
        "p_partkey", (F.col("place") + 1).alias("place")
    )


@query("SELECT name FROM (SELECT DISTINCT p_name AS name FROM part UNION SELECT DISTINCT '.' || p_name FROM part) WHERE name NOT LIKE '.%' AND name <> 'red widget'")
def excluded_names(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "part").select(F.col("p_name").alias("name"))
    every = names.union(names.select(F.concat(F.lit("."), "name"))).distinct()
    return every.where(~payload.excluded(F.col("name"), ("red widget",)))

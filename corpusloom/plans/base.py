"""Shared frames of the registered queries, and their SQL twins."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import listing


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, "^https?://([^/?#]+)", 1)


def url_path(url: Column) -> Column:
    """The path of a URL without its leading slash."""
    return F.regexp_extract(url, "^https?://[^/?#]+/?([^?#]*)", 1)


def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as catalog records: the host is the repo, the URL's path the listing line, the page's length its size."""
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("record_id"), url_host(F.col("url")).alias("repo"), url_path(F.col("url")).alias("line"), F.length("html").cast("bigint").alias("size")
    )
    return listing.parse_listing(pages).select(
        "record_id", "repo", "path", "file", "extension", "folder", "size", F.lit(False).alias("has_txt")
    )


#: The same records in SQL; folder is a list.
PAGE_RECORDS = r"""
lines AS (
  SELECT page_id AS record_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS repo,
         regexp_extract(url, '^https?://[^/?#]+/?([^?#]*)', 1) AS raw, CAST(length(html) AS BIGINT) AS size FROM pages),
paths AS (
  SELECT *, CASE WHEN trim(raw) LIKE './%' THEN substr(trim(raw), 3) WHEN trim(raw) LIKE '/%' THEN substr(trim(raw), 2) ELSE trim(raw) END AS path
  FROM lines
  WHERE trim(raw) <> '' AND trim(raw) NOT LIKE '#%' AND trim(raw) NOT LIKE 'version https://git-lfs%'
    AND trim(raw) NOT LIKE 'oid sha256:%' AND trim(raw) NOT LIKE 'size %'),
names AS (
  SELECT *, string_split(path, '/')[-1] AS name, list_slice(string_split(path, '/'), 1, len(string_split(path, '/')) - 1) AS folder
  FROM paths WHERE path <> ''),
records AS (
  SELECT record_id, repo, path, folder, size, FALSE AS has_txt,
    CASE WHEN dotted THEN regexp_extract(name, '^(.*)\.[^.]*$', 1) ELSE name END AS file,
    CASE WHEN dotted THEN regexp_extract(name, '\.([^.]*)$', 1) ELSE '' END AS extension
  FROM (SELECT *, CASE WHEN name LIKE '.%' THEN length(name) - length(replace(name, '.', '')) >= 2
                       ELSE contains(name, '.') END AS dotted FROM names))
"""


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors share, for queries that write files and read them again; it goes with the session."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.gettempdir()
    path = f"{root.rstrip('/')}/corpusloom-files-{uuid.uuid4().hex}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(where)
    fs.deleteOnExit(where)
    return path

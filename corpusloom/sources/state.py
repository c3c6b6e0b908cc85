"""State and event files: JSON snapshots, segmented payloads, manifests."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def read_state(spark: SparkSession, path: str, schema: str, version: int | None = None, required: bool = False) -> DataFrame | None:
    """A JSON state file as rows of ``schema``.

    A missing or unreadable file is an empty frame, or None with ``required`` (the
    caller must set up a first state); another version is an error.
    """
    empty = spark.createDataFrame([], schema)
    if not _exists(spark, path):
        return None if required else empty
    kind = T.StructType.fromDDL(schema)
    kind = kind.add("_corrupt_record", T.StringType()) if "_corrupt_record" not in kind.names else kind
    rows = spark.read.schema(kind).option("multiLine", "true").option("mode", "PERMISSIVE").json(path)
    rows = rows.where("_corrupt_record is null").drop("_corrupt_record")
    if version is not None and not rows.where(F.col("version") != version).isEmpty():
        raise ValueError(f"{path} has another version than {version}")
    return rows


def manifest_rows(texts: DataFrame, text_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """One row per url of a manifest's JSON: url, archive_id, path, sha256, bytes, optimized, webp_max_dimension, previews, profile.

    The columns ``keep`` of ``texts`` come before them: of several manifests they tell which one a row is from.
    """
    entry = "struct<archive_id:int,path:string,sha256:string,bytes:bigint,optimized:boolean,webp_max_dimension:int,page_previews:struct<count:int,paths:array<string>,profile:string>>"
    files = F.from_json(text_col, f"struct<version:int,files:map<string,{entry}>>")["files"]
    kept = keep or []
    return texts.select(*kept, F.explode(files).alias("url", "e")).select(
        *kept, "url", "e.archive_id", "e.path", "e.sha256", "e.bytes", "e.optimized", "e.webp_max_dimension",
        F.coalesce("e.page_previews.paths", F.array().cast("array<string>")).alias("previews"), F.col("e.page_previews.profile").alias("profile"),
    )


def publication_urls(members: DataFrame) -> DataFrame:
    """(archive_id, url) of the web addresses in publication metadata (archive_id, content), each once."""
    files = F.from_json("content", "struct<files:array<string>>")["files"]
    urls = members.select("archive_id", F.explode(F.transform(files, lambda u: F.trim(u))).alias("url"))
    return urls.where(F.col("url").rlike("^https?://")).distinct()


def source_counts(records: DataFrame, sources: list[str]) -> DataFrame:
    """Records of each expected source; one without any is an error row."""
    known = records.sparkSession.createDataFrame([(s,) for s in sources], "source string")
    counts = records.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    out = known.join(counts, "source", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return out.withColumn("error", F.when(F.col("n") == 0, "source has no records"))


def joined_segments(segments: DataFrame, headers: DataFrame, most_chars: int = 2_000_000, most_blobs: int = 64) -> DataFrame:
    """Payloads put together from (request, position, chunk), checked against (request, length, sha256).

    ``payload`` is null and ``error`` says why when something is off.
    """
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("position", "chunk"))), lambda s: s["chunk"])
    whole = segments.groupBy("request").agg(ordered.alias("chunks")).withColumn("payload", F.array_join("chunks", ""))
    joined = headers.join(whole, "request", "left")
    error = (
        F.when(F.col("chunks").isNull(), "no segments")
        .when(F.size("chunks") > most_blobs, "too many segments")
        .when(F.length("payload") > most_chars, "too long")
        .when(F.length("payload") != F.col("length"), "wrong length")
        .when(F.sha2("payload", 256) != F.col("sha256"), "wrong digest")
    )
    return joined.withColumn("error", error).select("request", F.when(F.col("error").isNull(), F.col("payload")).alias("payload"), "error")


def body_field(row: Column, name: str) -> Column:
    """A field of a request's body, else of its root; a null in the body counts."""
    body = F.try_variant_get(row, f"$.body.{name}", "variant")
    return F.coalesce(body, F.try_variant_get(row, f"$.{name}", "variant"))


def tree_blobs(tree: DataFrame, suffix: str = ".ts") -> DataFrame:
    """(side, path, blob) of a tree listing's files with this suffix.

    A listing that says it is ``truncated`` (a column, where there is one) can't be compared:
    that is an error when the rows are read.
    """
    if "truncated" in tree.columns:
        whole = F.when(F.col("truncated"), F.raise_error(F.concat(F.lit("truncated listing: "), F.col("side").cast("string")))).otherwise(F.lit(True))
        tree = tree.where(whole.cast("boolean"))
    return tree.where((F.col("type") == "blob") & F.endswith("path", F.lit(suffix))).select("side", "path", "blob")


def whole_tree(listing: DataFrame, clones: DataFrame, by: str = "repo") -> DataFrame:
    """(repo, path) of all files: from the listing (repo, path, type, truncated), or from the clone (repo, path) where that is cut short."""
    cut = listing.groupBy(by).agg(F.bool_or("truncated").alias("__cut"))
    listed = listing.where(F.col("type") == "blob").join(cut.where("not __cut"), by, "left_semi").select(by, "path")
    return listed.unionByName(clones.select(by, "path").join(cut.where("__cut"), by, "left_semi"))


def stale_objects(tree: DataFrame, prefix: str, retained: DataFrame) -> DataFrame:
    """Files of a bucket's listing (path, type) below a prefix that lie under none of the retained folders (prefix)."""
    from ..operators.manifest import outside_prefixes

    files = tree.where((F.col("type") == "file") & F.startswith("path", F.lit(prefix.rstrip("/") + "/"))).select("path")
    return outside_prefixes(files, retained, len(prefix.rstrip("/").split("/")) + 1)


def pinned_text(preferred: Column, fallback: Column) -> Column:
    """The preferred bytes, else the fallback, as text; null unless it is non-empty valid UTF-8."""
    text = F.coalesce(preferred, fallback).cast("string")
    return F.when(F.is_valid_utf8(text) & (F.length(text) > 0), text)


def load_small_json(text: str, default):
    """A small JSON value of the driver, or ``default`` when it can't be read."""
    try:
        return json.loads(text)
    except ValueError:
        return default

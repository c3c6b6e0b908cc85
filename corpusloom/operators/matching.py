"""Finding the one record that is meant: by identity, with fallbacks, through chains of overrides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import document_id, patch_ids
from ..functions.text import differs

#: Widths of the pieces that a title is searched by when the whole isn't found.
WIDTHS = (16, 12, 8, 4, 2)
MOST_CANDIDATES = 100


def tree_conflicts(mirror: DataFrame, upstream: DataFrame, archive: Column) -> DataFrame:
    """Files (path, blob) of the mirror that upstream lacks or has otherwise, with the ids their names hold; files of upstream alone aren't reported."""
    other = upstream.select("path", F.col("blob").alias("upstream_blob"))
    ids = patch_ids(F.col("path"))
    found = mirror.join(other, "path", "left").where(differs(F.col("blob"), F.col("upstream_blob"))).withColumn("ids", ids)
    doc = F.when(F.col("ids.article").isNotNull() & F.col("ids.publication").isNotNull(), document_id(archive, F.col("ids.article"), F.col("ids.publication")))
    return found.select("path", "blob", "upstream_blob", F.col("ids.article").alias("article_id"), F.col("ids.publication").alias("publication_id"), doc.alias("doc_id"))


def identified(wanted: DataFrame, records: DataFrame, id_col: str, fallback: list[str]) -> DataFrame:
    """Each wanted row with its record: by id, else by the fallback columns where these are unique; ``record`` is null and ``error`` says why otherwise."""
    by_id = records.select(F.col(id_col), F.col("record").alias("__a")).groupBy(id_col).agg(F.min("__a").alias("__a"), F.count(F.lit(1)).alias("__n"))
    by_rest = records.groupBy(*fallback).agg(F.min("record").alias("__b"), F.count(F.lit(1)).alias("__m"))
    joined = wanted.join(by_id, id_col, "left").join(by_rest, fallback, "left")
    record = F.when(F.col("__n") == 1, F.col("__a")).when(F.col("__n").isNull() & (F.col("__m") == 1), F.col("__b"))
    error = F.when(F.col("record").isNull(), F.when(F.greatest("__n", "__m") > 1, "ambiguous").otherwise("missing"))
    return joined.withColumn("record", record).withColumn("error", error).drop("__a", "__b", "__n", "__m")


def original_ids(current: DataFrame, overrides: DataFrame, most: int = 4) -> DataFrame:
    """Follow overrides (publication_id, article_id, new_article_id) back from current ids to the source's.

    At most ``most`` steps; an id with more than one override is an error, and so is a
    chain that goes on after the last step.
    """
    step = overrides.groupBy("publication_id", F.col("new_article_id").alias("source_id")).agg(F.min("article_id").alias("__old"), F.count(F.lit(1)).alias("__n"))
    out = current.withColumns({"source_id": F.col("article_id"), "error": F.lit(None).cast("string")})
    for _ in range(most):
        out = out.join(step, ["publication_id", "source_id"], "left").withColumn("error", F.coalesce("error", F.when(F.col("__n") > 1, "several overrides")))
        known = F.when(F.col("error").isNull(), F.coalesce("__old", "source_id")).otherwise(F.col("source_id"))
        out = out.withColumn("source_id", known).drop("__old", "__n")
    left = out.join(step.drop("__n"), ["publication_id", "source_id"], "left")
    return left.withColumn("error", F.coalesce("error", F.when(F.col("__old").isNotNull(), "too many steps"))).drop("__old")


def copied_patches(patches: DataFrame, overrides: DataFrame) -> DataFrame:
    """Patches (publication_id, article_id, content) with those of new ids copied onto the old ids that overrides name."""
    new = patches.select("publication_id", F.col("article_id").alias("new_article_id"), "content")
    copies = overrides.select("publication_id", "article_id", "new_article_id").join(new, ["publication_id", "new_article_id"]).select("publication_id", "article_id", "content")
    kept = patches.join(copies.select("publication_id", "article_id"), ["publication_id", "article_id"], "left_anti")
    return kept.select("publication_id", "article_id", "content").unionByName(copies)


def merged_layout(root: DataFrame, legacy: DataFrame) -> DataFrame:
    """Files (name, content) of both layouts; ``error`` where a name has two contents."""
    old = legacy.select("name", F.col("content").alias("__old"))
    joined = root.join(old, "name", "full")
    clash = F.col("content").isNotNull() & F.col("__old").isNotNull() & (F.col("content") != F.col("__old"))
    return joined.select("name", F.coalesce("content", "__old").alias("content"), F.when(clash, "contents differ").alias("error"))


def search_pieces(title: Column) -> Column:
    """What a title is searched by: the whole, then pieces of falling width from its start, middle and end."""
    pieces = [title]
    for w in WIDTHS:
        fits = F.length(title) >= w
        middle = F.floor((F.length(title) - w) / 2).cast("int") + 1
        pieces += [F.when(fits, F.substr(title, at, F.lit(w))) for at in (F.lit(1), middle, F.length(title) - w + 1)]
    return F.array_distinct(F.filter(F.array(*pieces), lambda p: p.isNotNull() & (p != "")))


def candidates(queries: DataFrame, texts: DataFrame, n: int = 2) -> DataFrame:
    """Texts (path, text) that contain each query (query, title); ``error`` for none or more than ``MOST_CANDIDATES``.

    A title's rarest n-gram picks the texts to look at, through their n-gram index, so no
    query meets every text.
    """
    from .index import ngrams

    grams = texts.select("path", F.explode(F.array_distinct(ngrams(F.col("text"), n))).alias("gram"))
    frequency = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    own = queries.select("query", "title", F.explode(F.array_distinct(ngrams(F.col("title"), n))).alias("gram")).join(frequency, "gram", "left")
    rarest = own.groupBy("query", "title").agg(F.min_by("gram", F.struct(F.coalesce("df", F.lit(0)).alias("df"), "gram")).alias("gram"))
    hits = rarest.join(grams, "gram").join(texts, "path").where(F.contains("text", F.col("title"))).select("query", "path")
    counted = hits.groupBy("query").agg(F.array_sort(F.collect_list("path")).alias("paths"))
    out = queries.join(counted, "query", "left")
    size = F.coalesce(F.size("paths"), F.lit(0))
    return out.withColumn("error", F.when(size == 0, "not found").when(size > MOST_CANDIDATES, "too many"))


def last_commit_is_own(author: Column, message: Column, bot: str, start: str) -> Column:
    """Whether a repository's last commit is the bot's own update, so nothing has to be done."""
    return F.coalesce((author == bot) & F.startswith(message, F.lit(start)), F.lit(False))


def deletable_branch(branch: Column, owner: Column, expected: str) -> Column:
    """Whether a branch may be deleted: one of the managed kinds, of the same owner."""
    return F.coalesce(branch.rlike(r"\A(?:proofread/|proofread-upstream-|revert-[0-9]+-)") & (owner == expected), F.lit(False))


def file_url(base: str, repo: Column, path: Column) -> Column:
    """The address of a record's file."""
    from ..functions.text import quoted_path

    return F.concat(F.lit(base.rstrip("/") + "/"), repo, F.lit("/resolve/main/"), quoted_path(path))

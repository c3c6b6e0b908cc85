"""Manifests and snapshots: what changed, what is pending, what may go."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.identity import url_suffix
from ..functions.text import differs

#: Suffixes that are transformed, and how.
RASTER, LOSSLESS, PDF = (".jpg", ".jpeg", ".png", ".bmp", ".tif", ".tiff"), (".png", ".bmp"), ".pdf"


def snapshot_diff(new: DataFrame, old: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows of ``new`` whose columns differ from ``old`` or that are new; keys that vanished aren't reported."""
    before = old.select(*keys, *(F.col(c).alias(f"old_{c}") for c in columns), F.lit(True).alias("__known"))
    joined = new.join(before, keys, "left")
    changed = reduce(Column.__or__, [differs(F.col(c), F.col(f"old_{c}")) for c in columns], F.col("__known").isNull())
    return joined.where(changed).drop("__known")


def any_differs(columns: list[str], left: str = "", right: str = "old_") -> Column:
    """Whether any of the columns differs between its two versions, null being a value."""
    return reduce(Column.__or__, [differs(F.col(left + c), F.col(right + c)) for c in columns])


def pending(wanted: DataFrame, manifest: DataFrame, key: str, owner: str | None = None) -> DataFrame:
    """Wanted keys that no manifest row has; with ``owner``, each key once, for its smallest owner."""
    own = wanted if owner is None else wanted.groupBy(key).agg(F.min(owner).alias(owner))
    return own.join(manifest.select(key), key, "left_anti")


def referenced_paths(manifest: DataFrame) -> DataFrame:
    """Paths that a manifest (path, previews) refers to."""
    return manifest.select("path").union(manifest.select(F.explode("previews"))).distinct()


def mark_and_sweep(old: DataFrame, new: DataFrame) -> DataFrame:
    """Paths that the old manifest refers to and the new one doesn't any more."""
    return referenced_paths(old).join(referenced_paths(new), "path", "left_anti")


def outside_prefixes(files: DataFrame, prefixes: DataFrame, depth: int, path_col: str = "path") -> DataFrame:
    """Files under none of the retained prefixes, which are paths of ``depth`` parts: an equality join, not a scan of pairs."""
    own = F.substring_index(F.col(path_col), "/", depth)
    keep = prefixes.select(F.rtrim("prefix", F.lit("/")).alias("__prefix")).distinct()
    return files.join(keep, own == F.col("__prefix"), "left_anti")


def transformation(url: Column, quality: int = 80) -> Column:
    """What is done to a file by its suffix: a struct of the new suffix and the kind, or null."""
    suffix = url_suffix(url)
    of = lambda s, k: F.struct(F.lit(s).alias("suffix"), F.lit(k).alias("kind"))
    return (
        F.when(suffix == PDF, of(".pdf", "pdf-linearize"))
        .when(suffix.isin(*LOSSLESS), of(".webp", "webp-lossless"))
        .when(suffix.isin(*RASTER), of(".webp", f"webp-q{quality}"))
    )


def needs_processing(url: Column, optimized: Column, dimension: Column, profile: Column, again: bool, limit: int, current: str) -> Column:
    """Whether a manifest row must be processed (again): not yet optimized, a raster image at another size limit, or a document whose previews have another profile."""
    suffix = url_suffix(url)
    first = ~F.coalesce(optimized, F.lit(False))
    raster = suffix.isin(*RASTER) & F.lit(again)
    return first | F.when(raster, differs(dimension, F.lit(limit))).otherwise((suffix == PDF) & differs(profile, F.lit(current)))


def branch_action(upstream: Column, mirror: Column, relation: Column) -> Column:
    """What to do with a mirrored branch; ``relation`` is how the mirror stands to upstream, null where they can't be compared."""
    return (
        F.when(upstream.isNull() | (upstream == ""), "skip")
        .when(mirror.isNull(), "create")
        .when(mirror == upstream, "keep")
        .when(relation.isin("ahead", "identical"), "keep")
        .when(relation.isNull() | (relation == "behind"), "fast_forward")
        .otherwise("error")
    )


def change_error(status: Column, in_base: Column, in_head: Column) -> Column:
    """Why a reported file change can't be, or null: added, modified and removed against presence on both sides."""
    return (
        F.when((status == "added") & in_base, "existing file reported as added")
        .when(status.isin("modified", "removed") & ~in_base, "base file is missing")
        .when(status.isin("added", "modified") & ~in_head, "changed file is missing")
        .when((status == "removed") & in_head, "existing file reported as removed")
    )


def drop_outcome(current: Column, upstream: Column) -> Column:
    """What dropping a local file comes to: it is absent, only local, as upstream already, or set back."""
    return (
        F.when(current.isNull(), "absent").when(upstream.isNull(), "deleted").when(current == upstream, "unchanged").otherwise("reset")
    )


def exactly_one(df: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``matches``, the rows of each key, and ``error`` where it isn't one."""
    own = {k: f"__{k}" for k in keys}
    counts = df.groupBy(*(F.col(k).alias(v) for k, v in own.items())).agg(F.count(F.lit(1)).alias("matches"))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(v)) for k, v in own.items()])
    out = df.join(counts, same).drop(*own.values())
    return out.withColumn("error", F.when(F.col("matches") != 1, F.concat(F.col("matches").cast("string"), F.lit(" matches"))))


def merge_overrides(articles: DataFrame, overrides: DataFrame, columns: list[str]) -> DataFrame:
    """Apply overrides (publication_id, article_id, new_article_id and replacing columns, null: keep).

    Returns the articles with their new ids; ``error`` names an override whose target is
    missing, ambiguous or already taken.  Unmatched overrides come out as error rows.
    """
    key = ["publication_id", "article_id"]
    new = overrides.select(*key, "new_article_id", *(F.col(c).alias(f"__{c}") for c in columns), F.lit(True).alias("__o"))
    taken = articles.select("publication_id", F.col("article_id").alias("new_article_id"), F.lit(True).alias("__taken")).distinct()
    new = new.join(taken, ["publication_id", "new_article_id"], "left")
    # An override is ambiguous with several articles or several overrides of one id.
    several = lambda df, name: df.groupBy(*key).agg(F.count(F.lit(1)).alias(name))
    merged = articles.withColumn("__a", F.lit(True)).join(new, key, "full")
    merged = merged.join(several(articles, "__m"), key, "left").join(several(overrides, "__k"), key, "left").withColumn("__n", F.greatest("__m", "__k"))
    moved = F.coalesce(F.col("new_article_id") != F.col("article_id"), F.lit(False))
    error = (
        F.when(F.col("__a").isNull(), "article is missing")
        .when(F.col("__o").isNotNull() & (F.col("__n") > 1), "article is ambiguous")
        .when(moved & F.col("__taken"), "target exists")
    )
    values = [F.coalesce(f"__{c}", c).alias(c) for c in columns]
    others = [c for c in articles.columns if c not in (*key, *columns)]
    return merged.withColumn("error", error).select(
        "publication_id", F.coalesce("new_article_id", "article_id").alias("article_id"), F.when(moved, F.col("article_id")).alias("old_article_id"),
        *values, *others, "error",
    )


def page_coverage(sources: DataFrame, articles: DataFrame, on: list[str]) -> DataFrame:
    """For each source (page_start, page_end): whether the articles' ranges lie inside it and together cover it."""
    pages = articles.select(*on, F.explode(F.sequence("page_start", "page_end")).alias("page"))
    counted = pages.groupBy(*on).agg(F.count_distinct("page").alias("covered"), F.min("page").alias("low"), F.max("page").alias("high"))
    return sources.join(counted, on, "left").select(
        *on,
        F.coalesce((F.col("low") >= F.col("page_start")) & (F.col("high") <= F.col("page_end")), F.lit(True)).alias("inside"),
        (F.coalesce("covered", F.lit(0)) == F.col("page_end") - F.col("page_start") + 1).alias("covers"),
    )


def canonical(value: Column) -> Column:
    """A JSON text in its canonical form: keys in order, no blanks; other text stays."""
    return F.coalesce(F.to_json(F.try_parse_json(value)), value)


def list_diff(old: Column, new: Column, key: Callable[[Column], Column] = lambda x: x) -> Column:
    """Removed and added items of two lists, compared by ``key`` (for JSON texts: ``canonical``); repeats and order stay."""
    lacking = lambda a, b: F.filter(a, lambda x: ~F.array_contains(F.transform(b, key), key(x)))
    return F.struct(lacking(old, new).alias("removed"), lacking(new, old).alias("added"))


def same_set(a: Column, b: Column) -> Column:
    return (F.size(F.array_except(a, b)) == 0) & (F.size(F.array_except(b, a)) == 0)


def unexpected_keys(m: Column, allowed: list[str]) -> Column:
    """Keys of a map that aren't allowed, in order."""
    return F.array_sort(F.array_except(F.map_keys(m), F.array(*(F.lit(k) for k in allowed))))


def restricted(m: Column, allowed: list[str]) -> Column:
    """A map with only the allowed keys."""
    return F.map_filter(m, lambda k, v: k.isin(*allowed))


def merged_map(a: Column, b: Column) -> Column:
    """Both maps' entries; those of ``b`` win."""
    kept = F.map_filter(a, lambda k, v: ~F.map_contains_key(b, k))
    return F.map_concat(kept, b)


def pace_seconds(n: Column, per_minute: float, most: int) -> Column:
    """Seconds to wait after ``n`` objects at a rate."""
    return F.least((n / F.lit(per_minute / 60)).cast("int"), F.lit(most))


def scaled(width: Column, height: Column, most: int) -> Column:
    """Size of an image scaled down to ``most`` on its longer side; halves go to even."""
    long = F.greatest(width, height)
    side = lambda c: F.greatest(F.bround(c * F.lit(float(most)) / long), F.lit(1)).cast("int")
    small = long <= most
    return F.struct(F.when(small, width).otherwise(side(width)).alias("width"), F.when(small, height).otherwise(side(height)).alias("height"))


def adaptive_limit(n: Column) -> Column:
    """Characters that each of ``n`` conflicts may show on one side."""
    return F.greatest(F.lit(200), F.least(F.lit(5000), F.floor(F.floor(F.lit(40_000) / F.greatest(n, F.lit(1))) / 2).cast("int")))


def packed(items: Column, most: int, overhead: int = 30, own: int = 3, last: int = 5) -> Column:
    """Greedy packing of a sequence by bytes: the batch number of each item.

    An item joins the open batch while the batch's bytes, a fixed ``overhead``, its own
    bytes and ``last`` stay below ``most``; else it opens a new one, and is alone in it
    when it is too long for any.  The fold is sequential, so it stays within one row.
    """
    zero = F.struct(F.lit(0).alias("batch"), F.lit(0).alias("bytes"), F.lit(0).alias("n"), F.array().cast("array<int>").alias("out"))

    def step(s: Column, item: Column) -> Column:
        size = F.octet_length(item)
        fits = (s["n"] == 0) | (s["bytes"] + overhead + size + last < most)
        batch = F.when(fits, s["batch"]).otherwise(s["batch"] + 1)
        return F.struct(
            batch.alias("batch"), F.when(fits, s["bytes"] + size + own).otherwise(size + own).alias("bytes"),
            F.when(fits, s["n"] + 1).otherwise(F.lit(1)).alias("n"), F.concat(s["out"], F.array(batch)).alias("out"),
        )

    return F.aggregate(items, zero, step, lambda s: s["out"])


def packed_rows(df: DataFrame, by: str, order: str, item: str, most: int, overhead: int = 30, own: int = 3, last: int = 5) -> DataFrame:
    """``packed`` for sequences of any length: ``batch`` of each row, in one pass over a group's rows as they stream by."""
    dealt = df.select(by, order, item, F.octet_length(item).alias("__bytes")).repartition(by).sortWithinPartitions(by, order)
    schema = T.StructType([*(df.schema[c] for c in (by, order, item)), T.StructField("batch", T.IntegerType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, first, batch, total = None, True, 0, 0
        for frame in frames:
            batches = []
            for group, size in zip(frame[by], frame["__bytes"], strict=True):
                if first or group != at:
                    at, first, batch, total = group, False, 0, 0
                elif total + overhead + size + last >= most:
                    batch, total = batch + 1, 0
                total += size + own
                batches.append(batch)
            yield frame[[by, order, item]].assign(batch=batches)

    return dealt.mapInPandas(run, schema)


def trees_equal(generated: DataFrame, current: DataFrame, by: str = "archive_id") -> DataFrame:
    """For each archive whether both trees (archive_id, path, blob) are the same, so that nothing has to be committed."""
    both = generated.select(by, "path", F.col("blob").alias("__new"), F.lit(1).alias("__a")).join(
        current.select(by, "path", F.col("blob").alias("__old"), F.lit(1).alias("__b")), [by, "path"], "full"
    )
    same = F.col("__a").isNotNull() & F.col("__b").isNotNull() & F.col("__new").eqNullSafe(F.col("__old"))
    return both.groupBy(by).agg(F.bool_and(same).alias("unchanged"))


def upserted(files: DataFrame, changes: DataFrame) -> DataFrame:
    """Files (path, content) after changes (path, new_path, content, null: as it is): written, and moved where the key changed.

    ``error`` says what can't be done: nothing stands at the path, or something does at
    the new one.  Such files stay as they are.
    """
    new = changes.select("path", "new_path", F.col("content").alias("__content"))
    taken = files.select(F.col("path").alias("new_path"), F.lit(True).alias("__taken"))
    joined = files.withColumn("__there", F.lit(True)).join(new.join(taken, "new_path", "left"), "path", "full")
    moves = F.coalesce(F.col("new_path") != F.col("path"), F.lit(False))
    error = F.when(F.col("__there").isNull(), "file is missing").when(moves & F.col("__taken"), "target exists")
    good = error.isNull()
    return joined.select(
        F.when(good, F.coalesce("new_path", "path")).otherwise(F.col("path")).alias("path"),
        F.when(good, F.coalesce("__content", "content")).otherwise(F.col("content")).alias("content"),
        F.when(good & moves, F.col("path")).alias("old_path"),
        error.alias("error"),
    )


def deepest_first(path: Column) -> list[Column]:
    """Sort columns that put folders before those that hold them."""
    return [F.size(F.split(path, "/")).desc(), path]


def fitting(sections: Column, start: Column, most: int, gap: int = 2) -> Column:
    """Which sections fit a body of ``most`` characters, in order; one that doesn't is passed over and later ones may still fit."""
    zero = F.struct(start.cast("int").alias("size"), F.array().cast("array<boolean>").alias("out"))

    def step(s: Column, text: Column) -> Column:
        fits = s["size"] + F.length(text) + gap <= most
        return F.struct(F.when(fits, s["size"] + F.length(text) + gap).otherwise(s["size"]).alias("size"), F.concat(s["out"], F.array(fits)).alias("out"))

    return F.aggregate(sections, zero, step, lambda s: s["out"])

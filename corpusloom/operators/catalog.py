"""Catalog operators: dense ids, path roll-ups, flags, pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one task may number by itself; beyond, ids come from counts of ranges.
ONE_TASK_ROWS = 1_000_000


def dense_number(df: DataFrame, order: list[str], name: str, one_task_rows: int = ONE_TASK_ROWS) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... in ``order``, whose first column must be numeric.

    A small frame is numbered in one window.  A larger one is cut at quantiles of the
    first order column; ranges are counted, their starts summed up (as many rows as
    ranges) and rows numbered inside their own range.
    """
    n = df.count()
    if n <= one_task_rows:
        return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("bigint") - 1)
    parts = -(-n // one_task_rows) * 2
    cuts = sorted(set(df.approxQuantile(order[0], [i / parts for i in range(1, parts)], 0.25 / parts)))
    bounds = F.array(*(F.lit(float(c)) for c in cuts))
    dealt = df.withColumn("__range", F.size(F.filter(bounds, lambda b: b < F.col(order[0]).cast("double"))))
    counts = dealt.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("__range"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    own = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    # One row per range, so the broadcast side is as small as the number of cuts.
    ranked = dealt.withColumn("__own", own).join(F.broadcast(starts), "__range")
    return ranked.withColumn(name, (F.col("__start") + F.col("__own") - 1).cast("bigint")).drop("__range", "__own", "__start")


def dictionary(df: DataFrame, key: Column, order_col: str, key_name: str = "key", id_name: str = "key_id") -> DataFrame:
    """The distinct keys with dense ids in the order they are first seen; ``first_seen`` is that place."""
    firsts = df.groupBy(key.alias(key_name)).agg(F.min(order_col).alias("first_seen"))
    return dense_number(firsts, ["first_seen", key_name], id_name)


def encode(df: DataFrame, key: Column, order_col: str, id_name: str) -> DataFrame:
    """``df`` with the dictionary id of ``key``."""
    dims = dictionary(df, key, order_col, "__key", id_name).drop("first_seen")
    return df.join(dims, key.eqNullSafe(F.col("__key")), "left").drop("__key")


def path_rollup(records: DataFrame, repo_col: str = "repo", folder_col: str = "folder") -> DataFrame:
    """Each folder prefix of each repo (the root is depth 0, the empty path): files below it and whether it has files itself."""
    depth = F.explode(F.sequence(F.lit(0), F.size(folder_col))).alias("depth")
    prefixes = records.select(F.col(repo_col).alias("repo"), F.col(folder_col).alias("folder"), depth)
    return prefixes.groupBy("repo", F.array_join(F.slice("folder", 1, F.col("depth")), "/").alias("path"), "depth").agg(
        F.count(F.lit(1)).alias("n_files"), F.bool_or(F.size("folder") == F.col("depth")).alias("has_direct")
    )


def folder_tree(records: DataFrame, repo_col: str = "repo", folder_col: str = "folder") -> DataFrame:
    """The roll-up with parent path, own name, whether a folder has children, and whether it needs a row of its own for direct files."""
    nodes = path_rollup(records, repo_col, folder_col)
    own = F.split("path", "/")
    nodes = nodes.withColumn("parent_path", F.when(F.col("depth") > 0, F.array_join(F.slice(own, 1, F.col("depth") - 1), "/"))).withColumn(
        "name", F.when(F.col("depth") > 0, F.element_at(own, -1)).otherwise(F.substring_index("repo", "/", -1))
    )
    children = nodes.where("depth > 0").groupBy(F.col("repo").alias("r"), F.col("parent_path").alias("p"), F.col("depth").alias("d")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    joined = nodes.join(children, (nodes["repo"] == children["r"]) & (nodes["path"] == children["p"]) & (nodes["depth"] + 1 == children["d"]), "left")
    has = F.col("n_children").isNotNull()
    return joined.select(
        "repo", "path", "parent_path", "name", "depth", "n_files", "has_direct",
        F.coalesce("n_children", F.lit(0)).alias("n_children"), has.alias("has_children"), (has & F.col("has_direct") & (F.col("path") != "")).alias("show_self"),
    )


def browser_folders(records: DataFrame, repo_col: str = "repo", folder_col: str = "folder") -> DataFrame:
    """For each folder that has some, its sub-folders by name with their counts: an array in name order."""
    tree = folder_tree(records, repo_col, folder_col).where("depth > 0")
    return tree.groupBy("repo", F.col("parent_path").alias("path")).agg(
        F.array_sort(F.collect_list(F.struct("name", "n_files"))).alias("folders")
    )


def browser_files(records: DataFrame, repo_col: str = "repo", folder_col: str = "folder", order_col: str = "record_id") -> DataFrame:
    """For each folder with files, its files in (name, order): an array of file, extension, has_txt, size."""
    item = F.struct(F.col("file"), F.col(order_col).alias("order"), F.col("extension"), F.col("has_txt"), F.col("size"))
    return records.groupBy(F.col(repo_col).alias("repo"), F.array_join(folder_col, "/").alias("path")).agg(
        F.transform(
            F.array_sort(F.collect_list(item)),
            lambda x: F.struct(x["file"].alias("file"), x["extension"].alias("extension"), x["has_txt"].alias("has_txt"), x["size"].alias("size")),
        ).alias("files")
    )


def with_sizes(records: DataFrame, sizes: DataFrame, keys: list[str], size_col: str = "size") -> DataFrame:
    """Records with their size by key; a size of 0 is as good as none, and the first of repeated sizes counts."""
    found = sizes.where(F.col(size_col) > 0).groupBy(*keys).agg(F.min(size_col).alias(size_col))
    return records.drop(size_col).join(found, keys, "left")


def flag_present(records: DataFrame, present: DataFrame, key: Column, present_col: str, flag: str) -> DataFrame:
    """Set ``flag`` where the key is present; it is never taken back where it was set before."""
    known = present.select(F.col(present_col).alias("__present")).distinct()
    before = F.coalesce(F.col(flag), F.lit(False)) if flag in records.columns else F.lit(False)
    out = records.join(known, key == F.col("__present"), "left")
    return out.withColumn(flag, before | F.col("__present").isNotNull()).drop("__present")


def first_match(left: DataFrame, right: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """Left join to the first of the right rows of each key."""
    rest = [c for c in right.columns if c not in keys]
    first = right.groupBy(*keys).agg(F.min_by(F.struct(*rest), order_col).alias("__first"))
    return left.join(first.select(*keys, "__first.*"), keys, "left")


def first_page(records: DataFrame, order_col: str, by: list[str] | None = None, page: int = 100) -> DataFrame:
    """The first ``page`` rows (of each group), with ``place`` from 1 and ``total`` of the group.

    Totals are aggregated on their own, so that the ranking can stop at the page before the shuffle.
    """
    by = by or []
    if not by:
        top = records.orderBy(order_col).limit(page).withColumn("place", F.row_number().over(Window.orderBy(order_col)).cast("bigint"))
        return top.crossJoin(F.broadcast(records.agg(F.count(F.lit(1)).alias("total"))))  # one row
    place = F.row_number().over(Window.partitionBy(*by).orderBy(order_col))
    top = records.withColumn("place", place.cast("bigint")).where(F.col("place") <= page)
    return top.join(records.groupBy(*by).agg(F.count(F.lit(1)).alias("total")), by)


def sidebar_counts(records: DataFrame, repo_col: str = "repo") -> DataFrame:
    """Records per repo, without the empty one."""
    return records.where(F.col(repo_col) != "").groupBy(F.col(repo_col).alias("repo")).agg(F.count(F.lit(1)).alias("n"))


def search_fields(records: DataFrame) -> DataFrame:
    """file, repo and folder texts in lower case, as searches compare them."""
    return records.select(
        "record_id",
        F.lower("file").alias("file_text"),
        F.lower("repo").alias("repo_text"),
        F.lower(F.array_join("folder", "/")).alias("folder_text"),
    )

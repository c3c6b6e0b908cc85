"""Site-relative line deduplication.

For every host, the pages containing a line are divided by the host's pages; lines above
``max_ratio`` are boilerplate and are dropped from that host's pages.  A line must stand
on two pages (``min_pages``): what one page alone says is no boilerplate.  Lines are split at line feeds and compared without blanks, tabs and
carriage returns at their ends; a page counts a line once; blank lines are kept.

A line travels as its 64-bit hash, never as text.  A host's boilerplate can hold no more
lines than an average page of the host has, divided by ``max_ratio``; it is one array per
host, broadcast when its written size is small, else joined on the host.

Defined results: a null text has no lines and stays null, an empty one has one blank line;
a null host is a host of its own; repeated rows are pages each; a text is read whole, however
long; an empty table gives an empty table; input columns named as output columns give way
to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, drop_table, durable

MAX_RATIO, MIN_PAGES = 0.1, 2
_ENDS = " \t\r"


def _key(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(_ENDS)))


def _blank(line: Column) -> Column:
    return F.btrim(line, F.lit(_ENDS)) == ""


def boilerplate(
    pages: DataFrame, host_col: str, text_col: str, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES
) -> tuple[DataFrame, str]:
    """``host`` and the array ``drop`` of hashes of its boilerplate lines, as a durable table; hosts without any are left out."""
    host = F.col(host_col).alias("host")
    # Totals ride along as the key of an empty line, so the pages are read and shuffled once.
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    keys = F.array_distinct(F.transform(F.filter(lines, lambda x: ~_blank(x)), _key))
    total = F.array(F.struct(F.lit(True).alias("page"), F.lit(0).cast("bigint").alias("key")))
    each = F.concat(total, F.transform(keys, lambda k: F.struct(F.lit(False).alias("page"), k.alias("key"))))
    counts, counts_at = durable(
        pages.select(host, F.explode(each).alias("x"))
        .groupBy("host", "x")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("x.page") | (F.col("n") >= min_pages))
    )
    totals, totals_at = durable(counts.where("x.page").select(F.col("host").alias("of"), F.col("n").alias("pages")))
    found = (
        counts.where("not x.page")
        .join(broadcast_if_small(totals, totals_at), F.col("host").eqNullSafe(F.col("of")))
        .where(F.col("n") / F.col("pages") > max_ratio)
        .groupBy("host")
        .agg(F.collect_list("x.key").alias("drop"))
    )
    out = durable(found)
    drop_table(pages.sparkSession, counts_at, totals_at)
    return out


def dedup_lines(
    pages: DataFrame,
    host_col: str = "source",
    text_col: str = "text",
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
    counts: bool = True,
) -> DataFrame:
    """``pages`` with boilerplate lines gone from ``text_col``; ``counts`` adds n_lines and n_dropped."""
    found, at = boilerplate(pages, host_col, text_col, max_ratio, min_pages)
    found = broadcast_if_small(found, at).select(F.col("host").alias("__host"), F.col("drop").alias("__drop"))
    # Only lines that may go are cut; all other pages pass unchanged.
    joined = pages.join(found, F.col(host_col).eqNullSafe(F.col("__host")), "left")
    joined = joined.withColumn("__lines", F.split(F.col(text_col), "\n", -1)).withColumn(
        "__kept",
        F.when(
            F.col("__drop").isNotNull(),
            F.filter("__lines", lambda x: _blank(x) | ~F.array_contains(F.col("__drop"), _key(x))),
        ).otherwise(F.col("__lines")),
    )
    out = joined.withColumn(text_col, F.array_join("__kept", "\n"))
    if counts:
        size = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("bigint")
        out = out.withColumn("n_lines", F.when(F.col("__lines").isNull(), 0).otherwise(size("__lines"))).withColumn(
            "n_dropped", F.when(F.col("__lines").isNull(), 0).otherwise(size("__lines") - size("__kept"))
        )
    return out.drop("__host", "__drop", "__lines", "__kept")

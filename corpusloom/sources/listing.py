"""File listings: one path per line, parsed into catalog records with columns only.

A record is (repo, record_id, file, extension, folder, size, has_txt).  ``record_id`` is the
order of the lines; it is data, so it comes from the file's own line numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import strip

#: Beginnings of lines that aren't paths (pointers of large files).
POINTER_LINES = ("version https://git-lfs", "oid sha256:", "size ")


def read_listing(spark: SparkSession, path: str, repo: str) -> DataFrame:
    """(repo, line_no, line) of a listing file.

    The file is split like any other: lines are numbered inside the blocks that they are read
    from, and blocks by the lines of those before them (as many rows as blocks).
    """
    block = F.struct("_metadata.file_path", "_metadata.file_block_start").alias("block")
    raw = spark.read.option("lineSep", "\n").text(path).select(block, F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = raw.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    starts = starts.select("block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    own = F.row_number().over(Window.partitionBy("block").orderBy("at"))
    # One row per block, so the broadcast side is as small as the number of blocks.
    numbered = raw.withColumn("own", own).join(F.broadcast(starts), "block")
    return numbered.select(F.lit(repo).alias("repo"), (F.col("start") + F.col("own") - 1).cast("bigint").alias("line_no"), "line")


#: A name with something before its last dot: what stands before and after that dot.
_DOTTED = r"(?s)\A(.+)\.([^.]*)\z"
#: A stripped line that is a path, without one leading "./" or "/".
_PATH = r"(?s)\A(?!#|" + "|".join(POINTER_LINES) + r")(?:\./|/)?(.+)\z"


def extension_of(name: Column) -> Column:
    """What follows the last dot, if the name doesn't begin with its only dot."""
    return F.regexp_extract(name, _DOTTED, 2)


def base_of(name: Column) -> Column:
    """The name without its extension and that dot."""
    return F.regexp_replace(name, _DOTTED, "$1")


def clean_path(line: Column) -> Column:
    """The path of a listing line, or null for comments, pointers and blank lines."""
    return F.nullif(F.regexp_extract(strip(line), _PATH, 1), F.lit(""))


def parse_listing(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Add path, file, extension and folder; lines that aren't paths go."""
    parts = F.split("path", "/")
    name = F.element_at(parts, -1)
    return (
        lines.withColumn("path", clean_path(F.col(line_col)))
        .where(F.col("path").isNotNull())
        .withColumns({"file": base_of(name), "extension": extension_of(name), "folder": F.slice(parts, 1, F.size(parts) - 1)})
    )


def relative_path(folder: Column, file: Column, extension: Column) -> Column:
    """The path of a record: empty folder parts collapse, an absolute part starts over."""
    name = F.when(extension != "", F.concat(file, F.lit("."), extension)).otherwise(file)
    joined = F.concat_ws("/", F.filter(folder, lambda p: p != ""), F.array(name))
    return F.regexp_replace(joined, r"\A.*/(?=/)", "")


def stem_of(path: Column) -> Column:
    """A path without the extension of its last part; leading dots are no extension."""
    return F.regexp_replace(path, r"(?<=[^/.])\.[^/.]*\z|(?<=[^/.]\.)\.[^/.]*\z", "")


def rank_lines(lines: DataFrame, order: list[str], name: str = "record_id") -> DataFrame:
    """Dense record ids from 0 in ``order`` (see ``operators.catalog.dense_number``)."""
    from ..operators.catalog import dense_number

    return dense_number(lines, order, name)

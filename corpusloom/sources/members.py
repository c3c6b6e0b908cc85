"""Members of compressed archives as rows, read where the archive is, never unpacked to disk."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator
from pathlib import PurePosixPath

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def member_path(name: str) -> str | None:
    """The path below the archive's own top folder; None for members outside of it."""
    path = PurePosixPath(name)
    parts = path.parts[1:]
    return None if path.is_absolute() or not parts or ".." in path.parts else "/".join(parts)


def unsafe_member(name: str, is_link: bool) -> bool:
    """Absolute paths, parent steps and links must not be unpacked."""
    path = PurePosixPath(name)
    return is_link or path.is_absolute() or ".." in path.parts


def tar_members(data: bytes, strip: bool = True) -> Iterator[tuple[int, str, bytes]]:
    """(order, path, content) of the regular files of a tar archive, compressed or not."""
    with tarfile.open(fileobj=io.BytesIO(data), mode="r:*") as archive:
        for order, member in enumerate(archive):
            path = member_path(member.name) if strip else member.name
            if member.isfile() and path is not None:
                yield order, path, archive.extractfile(member).read()


def read_archives(spark: SparkSession, path: str, batch: int = 500) -> DataFrame:
    """archive (its file), member_order, path and content (text; null if it isn't UTF-8) of all archives under ``path``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, data in zip(frame["path"], frame["content"], strict=True):
                rows = []
                for order, member, content in tar_members(data):
                    try:
                        text = content.decode("utf-8")
                    except UnicodeDecodeError:
                        text = None
                    rows.append((name, order, member, text))
                    if len(rows) >= batch:
                        yield pd.DataFrame(rows, columns=["archive", "member_order", "path", "content"])
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=["archive", "member_order", "path", "content"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(run, "archive string, member_order bigint, path string, content string")


def at_depth(path: Column, depth: int, suffix: str) -> Column:
    """Whether a path has so many parts and this suffix: what a pattern of stars and slashes matches."""
    return (F.size(F.split(path, "/")) == depth) & F.endswith(path, F.lit(suffix)) & ~F.startswith(F.element_at(F.split(path, "/"), -1), F.lit("."))


def scan_stems(spark: SparkSession, folder: str, suffix: str = ".txt") -> DataFrame:
    """The paths of files with this suffix below ``folder``, without it; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").load(folder)
    root = folder.rstrip("/")
    below = F.substring_index("path", root + "/", -1)
    return files.select(F.substr(below, F.lit(1), F.length(below) - len(suffix)).alias("stem"))

"""Database files as rows: whether each is sound, and how many rows its tables have.

A file is opened in memory where it is read, so nothing is unpacked to disk; it has to fit
a task.
"""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT = "path string, integrity string, setting string, counts map<string,bigint>"


def inspected(data: bytes, tables: list[str], setting: str | None = None) -> tuple[str, str | None, dict[str, int]]:
    """(integrity, value of a setting of the table ``metadata``, rows of each table); a table that is missing has no count."""
    connection = sqlite3.connect(":memory:")
    try:
        connection.deserialize(data)
        integrity = connection.execute("PRAGMA integrity_check").fetchone()[0]
        names = {n for (n,) in connection.execute("SELECT name FROM sqlite_master")}
        value = None
        if setting is not None and "metadata" in names:
            value = connection.execute("SELECT value FROM metadata WHERE key = ?", (setting,)).fetchone()
        counts = {t: connection.execute(f'SELECT count(*) FROM "{t}"').fetchone()[0] for t in tables if t in names}
        return integrity, value[0] if value else None, counts
    except sqlite3.DatabaseError as error:
        return str(error), None, {}
    finally:
        connection.close()


def inspect_databases(files: DataFrame, tables: list[str], setting: str | None = None) -> DataFrame:
    """One row of ``REPORT`` for each database file (path, content)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(path, *inspected(bytes(data), tables, setting)) for path, data in zip(frame["path"], frame["content"], strict=True)]
            yield pd.DataFrame(rows, columns=["path", "integrity", "setting", "counts"])

    return files.select("path", "content").mapInPandas(run, REPORT)


def database_errors(reports: DataFrame, expected: DataFrame, setting: str, equal: list[str], some: list[str]) -> DataFrame:
    """``reports`` with the first thing wrong, or null: against (path, documents) expected, tables of that many rows and tables that must not be empty."""
    joined = reports.join(expected, "path", "left")
    count = lambda t: F.coalesce(F.try_element_at("counts", F.lit(t)), F.lit(0))
    wrong = F.when(F.col("integrity") != "ok", F.concat(F.lit("integrity: "), "integrity")).when(
        ~F.col("setting").eqNullSafe(F.lit(setting)), F.lit("unexpected setting")
    )
    for t in equal:
        wrong = wrong.when(~count(t).eqNullSafe(F.col("documents")), F.lit(f"unexpected rows in {t}"))
    for t in some:
        wrong = wrong.when(count(t) <= 0, F.lit(f"{t} is empty"))
    return joined.withColumn("error", wrong)

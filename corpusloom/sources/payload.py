"""The dictionary-encoded search payload: two dimensions and a fact table, and its JSON form.

As JSON it is ``{"v": 2, "rp": [...], "fd": [[...], ...], "rc": [[repo, file, ext, folder, size, 0/1], ...]}``;
a plain list of records with long or short keys is accepted too.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.catalog import dense_number, dictionary

#: Short keys of a record's fields.
SHORT = {"repo": "r", "file": "f", "extension": "e", "folder": "d", "size": "s", "has_txt": "t"}

RECORD = T.StructType(
    [
        T.StructField("record_id", T.LongType()),
        T.StructField("repo", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("extension", T.StringType()),
        T.StructField("folder", T.ArrayType(T.StringType())),
        T.StructField("size", T.LongType()),
        T.StructField("has_txt", T.BooleanType()),
    ]
)


def excluded(name: Column, names: tuple[str, ...] = ()) -> Column:
    """Hidden names and those of a fixed set."""
    return F.startswith(name, F.lit(".")) | name.isin(*names) if names else F.startswith(name, F.lit("."))


def encode_tables(records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(repo_id, repo), (folder_id, folder) and the fact table with ids in place of names; ids in order of first sight."""
    repos = dictionary(records, F.col("repo"), "record_id", "repo", "repo_id").drop("first_seen")
    folders = dictionary(records, F.col("folder"), "record_id", "folder", "folder_id").drop("first_seen")
    fact = records.join(repos, "repo", "left").join(folders, "folder", "left")
    return repos, folders, fact.select("record_id", "repo_id", "file", "extension", "folder_id", "size", "has_txt")


def decode_tables(repos: DataFrame, folders: DataFrame, fact: DataFrame) -> DataFrame:
    """Records again; an unknown repo id gives the empty name, an unknown folder id no folders."""
    return fact.join(repos, "repo_id", "left").join(folders, "folder_id", "left").select(
        "record_id", F.coalesce("repo", F.lit("")).alias("repo"), "file", "extension",
        F.coalesce("folder", F.array().cast("array<string>")).alias("folder"), "size", F.coalesce("has_txt", F.lit(False)).alias("has_txt"),
    )


def encode_json(records: DataFrame) -> str:
    """The payload's JSON: it is one file, so its size is that of what a browser loads."""
    repos, folders, fact = encode_tables(records)
    rows = fact.orderBy("record_id").select(
        "repo_id", F.coalesce("file", F.lit("")), F.coalesce("extension", F.lit("")), "folder_id", "size", F.col("has_txt").cast("int")
    )
    payload = {
        "v": 2,
        "rp": [r["repo"] for r in repos.orderBy("repo_id").toLocalIterator()],
        "fd": [r["folder"] for r in folders.orderBy("folder_id").toLocalIterator()],
        "rc": [["" if v is None else v for v in r] for r in rows.toLocalIterator()],
    }
    return json.dumps(payload, ensure_ascii=False, separators=(",", ":"))


_ENCODED = "struct<v:int,rp:array<string>,fd:array<array<string>>,rc:array<array<string>>>"


def decode_json(spark: SparkSession, texts: DataFrame, text_col: str = "value") -> DataFrame:
    """Records of encoded payloads, one JSON text per row; rows shorter than six values are skipped."""
    data = texts.select(F.from_json(text_col, _ENCODED).alias("p")).where("p.rc is not null")
    rows = data.select("p.rp", "p.fd", F.posexplode("p.rc").alias("record_id", "r")).where(F.size("r") >= 6)
    known = lambda array, i, default: F.coalesce(F.when(i >= 0, F.get(array, i)), default)
    number = lambda i: F.coalesce(F.expr(f"try_cast(r[{i}] as int)"), F.lit(-1))
    return rows.select(
        F.col("record_id").cast("bigint").alias("record_id"),
        known(F.col("rp"), number(0), F.lit("")).alias("repo"),
        F.col("r")[1].alias("file"),
        F.col("r")[2].alias("extension"),
        known(F.col("fd"), number(3), F.array().cast("array<string>")).alias("folder"),
        F.expr("try_cast(r[4] as bigint)").alias("size"),
        (F.coalesce(F.col("r")[5], F.lit("")).isin("1", "true")).alias("has_txt"),
    )


_LISTED = "array<struct<repo:string,r:string,file:string,f:string,extension:string,e:string,folder:array<string>,d:array<string>,size:bigint,s:bigint,has_txt:boolean,t:boolean>>"


def decode_list(texts: DataFrame, text_col: str = "value") -> DataFrame:
    """Records of plain lists, with long or short keys."""
    rows = texts.select(F.posexplode(F.from_json(text_col, _LISTED)).alias("record_id", "x"))
    pick = lambda long: F.coalesce(F.col(f"x.{long}"), F.col(f"x.{SHORT[long]}"))
    return rows.select(F.col("record_id").cast("bigint"), *(pick(k).alias(k) for k in SHORT))


def shorten(records: DataFrame) -> DataFrame:
    """Records under their short keys."""
    return records.withColumnsRenamed(SHORT)


def trim_columns(records: DataFrame) -> DataFrame:
    """The six columns of a result row, with defaults."""
    return records.select(
        F.coalesce("repo", F.lit("")).alias("repo"), F.coalesce("file", F.lit("")).alias("file"), F.coalesce("extension", F.lit("")).alias("extension"),
        F.coalesce("folder", F.array().cast("array<string>")).alias("folder"), "size", F.coalesce("has_txt", F.lit(False)).alias("has_txt"),
    )


def normalized_entry(entry: Column) -> Column:
    """A browser entry under long or short keys, with empty lists for what is missing."""
    none = F.array().cast("array<string>")
    return F.struct(
        F.coalesce(entry["folders"], entry["d"], none).alias("folders"), F.coalesce(entry["files"], entry["f"], none).alias("files")
    )


__all__ = ["RECORD", "SHORT", "decode_json", "decode_list", "decode_tables", "dense_number", "encode_json", "encode_tables", "excluded", "normalized_entry", "shorten", "trim_columns"]

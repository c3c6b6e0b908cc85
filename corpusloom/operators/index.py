"""Inverted indexes: n-grams and words to ascending lists of record ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A word of Latin letters and digits; a character of the CJK ranges.
WORD, CJK = "[a-z0-9]+", r"[㐀-䶿一-鿿]"


def ngrams(text: Column, n: int) -> Column:
    """All runs of ``n`` characters; none if the text is shorter."""
    none = F.array().cast("array<string>")
    return F.when(
        F.length(text) >= n, F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.substr(text, i, F.lit(n)))
    ).otherwise(none)


def field_ngrams(fields: list[Column], n: int) -> Column:
    """The distinct n-grams of several fields; none reaches across two."""
    return F.array_distinct(F.flatten(F.array(*(ngrams(f, n) for f in fields))))


def plain_words(text: Column) -> Column:
    """Words of Latin letters and digits, and every CJK character.

    Segmenting CJK text by dictionary is left to a tokenizer of the caller.
    """
    low = F.lower(text)
    return F.array_distinct(
        F.concat(F.regexp_extract_all(low, F.lit(WORD), F.lit(0)), F.regexp_extract_all(low, F.lit(CJK), F.lit(0)))
    )


def postings(df: DataFrame, terms: Column, id_col: str) -> DataFrame:
    """term, doc_freq and the ascending array of ids.

    Each record counts a term once.  One array per term is the form of the index; use
    ``posting_rows`` where a term's list would not fit a row.
    """
    rows = df.select(F.explode(F.array_distinct(terms)).alias("term"), F.col(id_col).alias("id"))
    return rows.groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq"), F.array_sort(F.collect_list("id")).alias("postings"))


def posting_rows(df: DataFrame, terms: Column, id_col: str) -> DataFrame:
    """The index as (term, id) rows."""
    return df.select(F.explode(F.array_distinct(terms)).alias("term"), F.col(id_col).alias("id"))


def posting_gaps(rows: DataFrame) -> DataFrame:
    """Each posting with its distance from the one before; the first one's is its id."""
    before = F.lag("id", 1, 0).over(Window.partitionBy("term").orderBy("id"))
    return rows.withColumn("gap", F.col("id") - before)


def word_postings(df: DataFrame, text: Column, id_col: str, tokenizer: Callable[[Column], Column] = plain_words) -> DataFrame:
    """The word index under a tokenizer: a function from a text column to an array of words."""
    return postings(df, tokenizer(text), id_col)


def rows_digest(df: DataFrame, id_col: str, fields: list[str], block: int = 4096) -> DataFrame:
    """One digest of all rows in id order: blocks of rows are digested apart, then their digests in order."""
    line = F.concat_ws("", *(F.concat(F.coalesce(F.col(f), F.lit("")), F.lit("\0")) for f in fields))
    blocks = df.groupBy(F.floor(F.col(id_col) / block).alias("block")).agg(
        F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(id_col).alias("id"), line.alias("line")))), lambda r: r["line"]), ""), 256).alias("d"),
        F.count(F.lit(1)).alias("n"),
    )
    return blocks.agg(
        F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "d"))), lambda r: r["d"]), ""), 256).alias("digest"),
        F.sum("n").alias("n_rows"),
    )

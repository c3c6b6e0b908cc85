"""The corpus pipeline: documents through the stages below, each written and read again.

Every stage takes any columns beside doc_id, text, source and n_chars and (the last one
apart) returns the columns it got; an empty table gives an empty table, and texts of any
length are read whole.  What nulls, empty texts, ties and repeated rows come to stands with
each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import bpe, linededup, minhash, mixing, toxicity
from corpusloom.llm.common import broadcast_if_small, drop_table, durable
from corpusloom.llm.queries import id_hash, vocabulary_path

#: Documents at or above this score of toxicity are rejected.
REJECT = 0.3
#: Pieces that a tokenizing worker keeps: the stages share their workers' memory.
REMEMBER = 150_000


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models, fitted on the table's labels, don't reject.

    A null or empty text holds no evidence and stays; a repeated row is judged like its
    first; a null doc_id has no label but is judged too; without labels nothing is
    rejected, and with labels of one class all or nothing.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = toxicity.score_toxicity(docs, labels, id_hash(4) != 2, score_col="__toxicity")
    return scored.where(F.col("__toxicity") < REJECT).select(*docs.columns)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of their source; n_chars follows the text.

    A null text stays null and a null source is a source of its own; a repeated row counts
    as a page; a document whose lines are all boilerplate stays, with an empty text.
    """
    out = linededup.dedup_lines(docs, counts=False)
    return out.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest doc_id.

    A document without words (or with a null text) is in no group and stays.  Rows that share
    a doc_id, or have none, are told apart by their texts and come after all others in
    their group; of rows with one id and one text, one stays.  Texts are read whole.
    """
    rows = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("__rows"))
    shared, shared_at = durable(rows.where("__rows > 1 or doc_id is null").select(F.col("doc_id").alias("__id")))
    if shared.isEmpty():
        groups = minhash.near_duplicates(docs)
        kept, at = durable(groups.where("kept").select("doc_id"))
        out = docs.join(broadcast_if_small(kept, at), "doc_id", "left_semi")
    else:
        own = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
        marked = docs.join(broadcast_if_small(shared.withColumn("__shared", F.lit(True)), shared_at), F.col("doc_id").eqNullSafe(F.col("__id")), "left")
        marked = marked.withColumn("__node", F.when(F.col("__shared"), own).otherwise(F.col("doc_id")))
        groups = minhash.near_duplicates(marked.select(F.col("__node").alias("doc_id"), "text"))
        kept, at = durable(groups.where("kept").select(F.col("doc_id").alias("__node")).distinct())
        once = marked.where("__shared").dropDuplicates(["__node"]).unionByName(marked.where("__shared is null"))
        out = once.join(broadcast_if_small(kept, at), "__node", "left_semi")
    return out.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of a mixture of their sources.

    A null source is a source of its own; equal rows are numbered in any order.
    """
    return mixing.mixed_order(mixing.mix(docs)).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE ids of every document that is left, and the digest of what they decode to.

    A null or empty text has no ids; each repeated row is encoded.
    """
    out = bpe.encode_decode(docs, bpe.read_vocabulary(vocabulary_path()), keep=["doc_id", "lang", "source"], remember=REMEMBER)
    return out.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_boilerplate),
    ("minhash", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]

#: The classifier and the hashing stages can't be put into SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the whole table ``documents``."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs, at = durable(docs)
            if before:
                drop_table(spark, before)
            before = at
    return docs

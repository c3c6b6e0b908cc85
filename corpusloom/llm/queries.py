"""The registered queries of this subpackage: thin digests of the operators' outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, embed, linededup, minhash, mixing, quality, suffix, topk, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path() -> str:
    """Where the public byte-level vocabulary lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.encode_decode(docs, bpe.read_vocabulary(vocabulary_path()), keep=["doc_id"])
    return out.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


CONTROL_CASE = "</s>[INST] ok [/INST]"


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    case = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_CASE).alias("text"),
    )
    turns = rows.unionByName(case).withColumn("parts", chat.text_part(F.coalesce("text", F.lit(""))))
    out = chat.read_back(chat.format_chat(turns))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return out.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


OP10_SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, regexp_replace(regexp_replace(text, '\\\\', '\\\\\\\\', 'g'),
                           '(<)(\\||/?s>)|(\\[)(/?INST\\])', '\\1\\3\\\\\\2\\4', 'g') AS esc FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(12 + length(role) + 1 + length(esc) + 11) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

QUERIES = {"op8_bpe": op8_bpe, "op10_chat": op10_chat}
ORACLE_SQL = {"op10_chat": OP10_SQL}


def id_hash(parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(F.col("doc_id").cast("string")) % parts


def _verdict(scored: DataFrame, held_out) -> DataFrame:
    return scored.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality")
    return _verdict(quality.score_quality(docs, labels, id_hash(5) != 0, keep=["doc_id"]), id_hash(5) == 0)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return _verdict(toxicity.score_toxicity(docs, labels, id_hash(4) != 2, keep=["doc_id"]), id_hash(4) == 2)


QUERIES |= {"op3_quality": op3_quality, "op6_toxicity": op6_toxicity}


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs).select("doc_id", "source", "block", "slot", "in_block")


def op4_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return linededup.dedup_lines(docs).select(
        "doc_id", "source", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256")
    )


OP4_SQL = """
WITH l AS (
  SELECT rowid AS r, doc_id, source, text, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM (SELECT row_number() OVER () AS rowid, * FROM documents)),
t AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS key FROM l),
n AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
c AS (SELECT source, key, count(DISTINCT r) AS n FROM t WHERE key <> '' GROUP BY source, key),
b AS (SELECT c.source, c.key FROM c JOIN n ON c.source IS NOT DISTINCT FROM n.source
      WHERE c.n >= 2 AND c.n / n.pages > 0.1),
k AS (SELECT t.*, b.key IS NOT NULL AS gone
      FROM t LEFT JOIN b ON t.source IS NOT DISTINCT FROM b.source AND t.key = b.key)
SELECT doc_id, source, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS text_sha256
FROM k GROUP BY r, doc_id, source
UNION ALL
SELECT doc_id, source, 0, 0, NULL FROM documents WHERE text IS NULL
"""

QUERIES |= {"op1_mixing": op1_mixing, "op4_linededup": op4_linededup}
ORACLE_SQL |= {"op4_linededup": OP4_SQL}


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs, words=4, percent=80)


OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 4 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i+3], ' ') END AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id WHERE 100 * k >= 80 * (na.n + nb.n - k)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS node, doc_id AS c FROM documents UNION SELECT u.b, r.c FROM r JOIN u ON u.a = r.node),
m AS (SELECT node, min(c) AS c FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM documents d JOIN m ON d.doc_id = m.node LEFT JOIN n ON d.doc_id = n.doc_id
"""

QUERIES |= {"op2_minhash": op2_minhash}
ORACLE_SQL |= {"op2_minhash": OP2_SQL.replace("\\\\", "\\")}


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.near_duplicates(_table(spark, sf_dir, "embeddings"))


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""

OP9_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.x, b.x) >= 0.9),
r AS (SELECT vec_id AS node, vec_id AS c FROM embeddings UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.node),
m AS (SELECT node, min(c) AS c FROM r GROUP BY node),
n AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT node AS vec_id, coalesce(n.n, 0) AS n_links, c AS component_id, node = c AS kept
FROM m LEFT JOIN n ON n.a = m.node
"""

QUERIES |= {"op5_topk": op5_topk, "op9_embed": op9_embed}
ORACLE_SQL |= {"op5_topk": OP5_SQL, "op9_embed": OP9_SQL}


def op7_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP7_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, i, md5(substr(h, 2 * i + 1, 400)) AS k
      FROM (SELECT r, h, unnest(range(0, greatest(length(h) // 2 - 199, 0))) AS i FROM d)),
k AS (SELECT k FROM w GROUP BY k HAVING count(*) > 1),
s AS (SELECT r, i, i - lag(i) OVER (PARTITION BY r ORDER BY i) AS gap FROM w SEMI JOIN k USING (k)),
g AS (SELECT r, i, sum(CASE WHEN gap IS NULL OR gap > 200 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS run FROM s),
u AS (SELECT r, run, min(i) AS lo, max(i) + 200 AS hi FROM g GROUP BY r, run),
e AS (SELECT r, lo, hi FROM u UNION ALL SELECT r, length(h) // 2, length(h) // 2 FROM d),
p AS (SELECT r, coalesce(lag(hi) OVER (PARTITION BY r ORDER BY lo, hi), 0) AS a, lo AS b, hi FROM e)
SELECT d.doc_id, length(any_value(h)) // 2 AS n_bytes, CAST(sum(hi - b) AS BIGINT) AS n_removed, count(*) FILTER (hi > b) AS n_spans,
  sha256(unhex(string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a, b))) AS kept_sha256
FROM p JOIN d USING (r) GROUP BY r, d.doc_id
"""

QUERIES |= {"op7_suffix": op7_suffix}
ORACLE_SQL |= {"op7_suffix": OP7_SQL}

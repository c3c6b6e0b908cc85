"""Document quality by a factorisation machine.

Features: hashed lower-cased words (relative frequency), structure statistics of the
text, and metadata taken from it (its size).  The machine has a weight and a vector of
``RANK`` numbers per feature; the sum over all pairs of features is

    1/2 * sum_f ((sum_i v_if x_i)^2 - sum_i (v_if x_i)^2),

so scoring is linear in the number of features present.  It is fitted by AdaGrad on at
most ``SAMPLE_ROWS`` labelled rows, those with the smallest hash of the id; scoring is
one map over all rows.

Defined results: null and empty texts have the statistics of an empty text and a score
like any other; without labels of both kinds every score is the share of label 1 (0.5
without any); repeated document rows are scored each; of repeated labels the smallest
counts; texts are read whole, however long; an input column named as the score gives way to
it; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_text

#: Hashed words; their number bounds a row's features and the model.
BUCKETS = 1 << 14
RANK = 8
#: Labelled rows, at most, that the machine is fitted on.
SAMPLE_ROWS = 6_000
EPOCHS = 6
STATS = 18

_UPPER, _LOWER, _DIGIT, _MARK, _WIDE = (np.zeros(256, bool) for _ in range(5))
_UPPER[65:91] = _LOWER[97:123] = _DIGIT[48:58] = True
_WIDE[128:] = True
for _c in range(33, 127):
    _MARK[_c] = not chr(_c).isalnum()


class _Words(dict):
    """The bucket of each word; forgets all when large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = got = zlib.crc32(word) % BUCKETS
        return got


def features(text: str | None, words: _Words) -> tuple[np.ndarray, np.ndarray]:
    """Indexes and values: words first, then statistics from ``BUCKETS`` on."""
    data = (text or "").encode("utf-8", "replace")
    tokens = data.lower().split()
    n, size = len(tokens), len(data)
    ids = np.fromiter(map(words.__getitem__, tokens), np.int64, n)
    seen, counts = np.unique(ids, return_counts=True)
    hist = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = hist / max(size, 1)
    part = share[share > 0]
    lines = data.split(b"\n")
    pairs = ids[1:] * BUCKETS + ids[:-1]
    stats = np.array(
        [
            1.0,
            min(1.0, np.log1p(n) / 12),
            min(1.0, np.log1p(size) / 16),
            len(seen) / max(n, 1),
            counts.max() / n if n else 0.0,
            float((ids[1:] == ids[:-1]).mean()) if n > 1 else 0.0,
            len(np.unique(pairs)) / len(pairs) if n > 1 else 0.0,
            share[_UPPER].sum(),
            share[_LOWER].sum(),
            share[_DIGIT].sum() * 4,
            share[_MARK].sum() * 4,
            share[ord("!")] * 8,
            share[_WIDE].sum(),
            share[32] * 3,
            min(1.0, share[10] * 40),
            float(-(part * np.log2(part)).sum()) / 8 if size else 0.0,
            min(1.0, size / max(n, 1) / 20),
            len(set(lines)) / len(lines),
        ]
    )
    return np.concatenate([seen, BUCKETS + np.arange(STATS)]), np.concatenate([counts / max(n, 1), stats])


class Machine:
    """A factorisation machine with a logistic output."""

    def __init__(self, w: np.ndarray, v: np.ndarray):
        self.w, self.v = w, v

    def raw(self, index: np.ndarray, value: np.ndarray) -> float:
        part = self.v[index] * value[:, None]
        total = part.sum(0)
        return float(self.w[index] @ value + 0.5 * (total @ total - (part * part).sum()))

    @classmethod
    def fit(cls, rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, seed: int = 7) -> Machine:
        rng = np.random.default_rng(seed)
        size = BUCKETS + STATS
        w, v = np.zeros(size), rng.normal(0, 0.05, (size, RANK))
        gw, gv = np.full(size, 1e-2), np.full((size, RANK), 1e-2)
        rate, decay = 0.1, 1e-4
        own = cls(w, v)
        for _ in range(EPOCHS):
            for i in rng.permutation(len(rows)):
                index, value = rows[i][0], rows[i][1].astype(np.float64)
                part = v[index] * value[:, None]
                total = part.sum(0)
                z = w[index] @ value + 0.5 * (total @ total - (part * part).sum())
                d = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[i]
                dw = d * value + decay * w[index]
                dv = d * value[:, None] * (total - part) + decay * v[index]
                gw[index] += dw * dw
                gv[index] += dv * dv
                w[index] -= rate * dw / np.sqrt(gw[index])
                v[index] -= rate * dv / np.sqrt(gv[index])
        return own


def _views(lists: pa.ChunkedArray) -> list[np.ndarray]:
    """The rows of a column of lists as slices of its numbers, without a copy of them as Python values."""
    column = lists.combine_chunks()
    numbers, ends = column.values.to_numpy(), column.offsets.to_numpy()
    return [numbers[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def score_quality(
    docs: DataFrame, labels: DataFrame, train: Column, keep: list[str] | None = None, score_col: str = "score"
) -> DataFrame:
    """Add ``score_col`` (0 to 1, higher: quality 1 likelier) to ``docs`` (doc_id, text and others).

    ``labels`` has doc_id and quality; ``train`` is a condition on doc_id that says which
    labels may be learned from.
    """
    spark = docs.sparkSession
    keep = [c for c in (keep if keep is not None else docs.columns) if c != score_col]
    marks = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & train)
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(SAMPLE_ROWS)
    )
    fields = [T.StructField("index", T.ArrayType(T.IntegerType(), False)), T.StructField("value", T.ArrayType(T.FloatType(), False))]

    def features_of():
        words = _Words()

        def work(texts: list) -> list:
            got = [features(t, words) for t in texts]
            return [[i.astype(np.int32) for i, _ in got], [x.astype(np.float32) for _, x in got]]

        return work

    # The sample is bounded, so it may be broadcast; texts stay where they are.
    sample = docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id").select("doc_id", "quality", "text")
    got = map_text(sample, "text", fields, features_of, keep=["doc_id", "quality"]).toArrow().sort_by("doc_id")
    y = got["quality"].to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        return docs.select(*keep).withColumn(score_col, F.lit(float(y.mean()) if len(y) else 0.5))
    rows = list(zip(_views(got["index"]), _views(got["value"]), strict=True))
    machine = spark.sparkContext.broadcast(Machine.fit(rows, y))

    def score():
        words, own = _Words(), machine.value

        def work(texts: list) -> list:
            z = np.array([own.raw(*features(t, words)) for t in texts])
            return [1 / (1 + np.exp(-np.clip(z, -30, 30)))]

        return work

    return map_text(docs, "text", [T.StructField(score_col, T.DoubleType())], score, keep=keep)

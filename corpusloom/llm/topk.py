"""Exact top-k search by inner product with no-random-access aggregation.

Components become integers, floor(scale * x).  The candidates are cut into blocks; each
block has one list per component, sorted by value.  For a query, component d contributes
q_d * x_d, so its list is read from the large end when q_d > 0 and from the small end when
q_d < 0 (not at all when it is 0).  The lists are read in step.  What has been read of a
vector, with the values at the lists' fronts for the rest, bounds its score from above, and
with their last values from below.  As long as the fronts together reach the k-th lower
bound, no vector can be left out, so bounds are first taken where they fall below it; then
in growing steps, over the vectors that are left only.  Reading stops when a few are left,
or all lists are read; their scores are then resolved.

The first block gives each query a lower bound of its k-th score, with which all other
blocks begin: most of a block is then left out at its first bounds.  Queries stream through
the task that holds a block of candidates; each pair of blocks gives at most k rows a
query, and a window limit, applied before the shuffle, keeps k.

Defined results: vectors that are null or empty, or hold null or non-finite components,
take no part; vectors of other lengths than the query are no candidates of it; rows that
repeat a vec_id are vectors each, only the query's own row is no candidate, and each query
row has its own result rows; null ids take no part; ties go to the smaller vec_id; fewer
candidates than k are all returned; vectors of any length are read whole; input columns
beside the two named ones only serve ``is_query``, whatever their names; an empty table gives
an empty table.  Scores must stay below 2^53 in size, so that double precision is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, drop_table, durable

#: Rows of a block of candidates, and of queries that meet it in one task.
BLOCK, QUERIES = 8192, 1 << 16
#: Vectors left over whose scores are resolved outright.
FEW = 64
#: Depths to which the lists are read before bounds are taken, as shares of them; then the rest is resolved.
DEPTHS = (0.25, 0.5, 0.625, 0.75, 0.875, 0.9375)
#: Queries that are bounded together.
BATCH = 256


class Lists:
    """The sorted lists of a block of candidates."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, x: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.copies, self.x = ids[by_id], copies[by_id], x[by_id]
        self.columns = np.ascontiguousarray(self.x.T.astype(np.float64))
        self.sorted = np.sort(self.columns, axis=1)

    def best(self, query_ids: list[int], queries: np.ndarray, k: int, least: np.ndarray) -> list[list[tuple[int, int]]]:
        """For each query the k best (vec_id, score) of at least ``least``, without its own row; ties to the smaller id."""
        own = [self._own(i, q) for i, q in zip(query_ids, queries, strict=True)]
        every = self._reaching(queries.astype(np.float64), own, k, least.astype(np.float64))
        return [self._resolved(q, mine, left, k, low) for q, mine, left, low in zip(queries, own, every, least, strict=True)]

    def _own(self, query_id: int, q: np.ndarray) -> int:
        """The place of the query's own row; -1 if it isn't here."""
        lo, hi = np.searchsorted(self.ids, [query_id, query_id + 1])
        same = np.flatnonzero((self.x[lo:hi] == q).all(1))
        return int(lo + same[0]) if len(same) else -1

    def _resolved(self, q: np.ndarray, own: int, left: np.ndarray, k: int, least: float) -> list[tuple[int, int]]:
        """The final scores of the vectors that are left, the k best of them."""
        copies = self.copies[left] - (left == own)
        score = self.x[left] @ q
        good = (copies > 0) & (score >= least)
        left, copies, score = left[good], copies[good], score[good]
        out: list[tuple[int, int]] = []
        for b in np.lexsort((self.ids[left], -score))[:k]:
            out += [(int(self.ids[left[b]]), int(score[b]))] * int(min(copies[b], k - len(out)))
        return out[:k]

    def _reaching(self, queries: np.ndarray, own: list[int], k: int, least: np.ndarray) -> list[np.ndarray]:
        """For each query the vectors that may be among its k best and reach ``least``, when reading stops."""
        size = len(self.ids)
        left = [np.arange(size)] * len(queries)
        if size <= max(k, FEW):
            return left
        # Of a list that is read from the large end nothing unread is above its front, and the other way round.
        down, up = np.maximum(queries, 0), np.minimum(queries, 0)
        open_, least = np.arange(len(queries)), least.copy()
        for share in DEPTHS:
            to = max(1, int(size * share))
            top, bottom = self.sorted[:, size - to, None], self.sorted[:, to - 1, None]
            unknown = least == -np.inf
            fronts = (down @ top + up @ bottom)[:, 0]
            now = open_[(fronts < least)[open_] | (unknown[open_] & (share >= 0.5))]
            if not len(now):
                continue
            high = down[now] @ np.maximum(self.columns, top) + up[now] @ np.minimum(self.columns, bottom)
            bound = np.flatnonzero(unknown[now])
            if len(bound):
                read_down = np.where(self.columns >= top, self.columns, self.sorted[:, :1])
                read_up = np.where(self.columns <= bottom, self.columns, self.sorted[:, -1:])
                under = down[now[bound]] @ read_down + up[now[bound]] @ read_up
                for row, r in zip(under, bound, strict=True):
                    if own[now[r]] >= 0:
                        row[own[now[r]]] = -np.inf
                    least[now[r]] = np.partition(row, size - k)[size - k]
            for row, r in zip(high, now, strict=True):
                left[r] = np.flatnonzero(row >= least[r])
            # A bound that the block found for itself is found anew, and better, at the next depth.
            least[now[bound]] = np.where([len(left[r]) <= FEW for r in now[bound]], least[now[bound]], -np.inf)
            settled = {int(r) for r in now if len(left[r]) <= max(k, FEW)}
            open_ = np.array([r for r in open_ if r not in settled], np.int64)
            if not len(open_):
                break
        return left


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` best vectors for each row for which ``is_query`` holds."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(v, lambda x: F.floor(x * scale))
    own = (
        vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite)
        .select(F.col(id_col).cast("bigint").alias("id"), whole.alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
        .groupBy("id", "v")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("asks").cast("bigint")).alias("asks"))
    )
    # Rows that share an id are told apart by a 64-bit hash of their vectors.
    rows, at = durable(own.withColumns({"size": F.size("v"), "mark": F.xxhash64("v")}))
    n, n_asked = rows.count(), rows.where("asks > 0").count()
    blocks, parts = max(1, -(-n // BLOCK)), max(1, -(-n_asked // QUERIES))
    rows = rows.withColumn("c", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    asked = rows.where("asks > 0").withColumn("q", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(parts)).cast("int")).drop("c")

    def searched(candidates: DataFrame, queries: DataFrame) -> DataFrame:
        """The k best of each block of ``candidates`` for ``queries`` (with c and least)."""
        sides = [
            candidates.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumns(
                {"kind": F.lit(0), "least": F.lit(None).cast("bigint")}
            ),
            queries.withColumn("kind", F.lit(1)),
        ]
        both = sides[0].unionByName(sides[1], allowMissingColumns=True).select("size", "c", "q", "kind", "id", "v", "n", "mark", "least")
        dealt = both.repartition("size", "c", "q").sortWithinPartitions("size", "c", "q", "kind")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, lists = None, None
            ids: list = []
            copies: list = []
            data: list = []
            asked: list = []

            def answered() -> pa.RecordBatch:
                out: tuple[list, list, list, list] = ([], [], [], [])
                names, marks, vectors, least = zip(*asked, strict=True) if asked else ((), (), (), ())
                if asked:
                    low = np.array([-np.inf if x is None else x for x in least])
                    for name, mark, found in zip(names, marks, lists.best(list(names), np.stack(vectors), k, low), strict=True):
                        for vec, score in found:
                            for column, value in zip(out, (name, mark, vec, score), strict=True):
                                column.append(value)
                asked.clear()
                return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["query_id", "mark", "vec_id", "score"])

            for batch in batches:
                for size, c, q, kind, name, vector, n, mark, low in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                    if at != (size, c, q):
                        if asked:
                            yield answered()
                        at, ids, copies, data, lists = (size, c, q), [], [], [], None
                    x = np.array(vector, np.int64)
                    if kind == 0:
                        ids.append(name)
                        copies.append(n)
                        data.append(x)
                        continue
                    if lists is None:
                        lists = Lists(np.array(ids, np.int64), np.array(copies, np.int64), np.stack(data) if data else np.zeros((0, size), np.int64))
                        ids, copies, data = [], [], []
                    asked.append((name, mark, x, low))
                    if len(asked) >= BATCH:
                        yield answered()
            if asked:
                yield answered()

        return arrow_map(dealt, run, "query_id bigint, mark bigint, vec_id bigint, score bigint")

    # The block that a query meets first is block 0, for all queries: what it finds there bounds its k-th score.
    first, first_at = durable(searched(rows.where("c = 0"), asked.withColumns({"c": F.lit(0), "least": F.lit(None).cast("bigint")})))
    bound = first.groupBy(F.col("query_id").alias("id"), "mark").agg(F.count(F.lit(1)).alias("found"), F.min("score").alias("least"))
    bound = bound.select("id", "mark", F.when(F.col("found") >= k, F.col("least")).alias("least"))
    found = first
    if blocks > 1:
        others = asked.join(bound, ["id", "mark"], "left").withColumn("c", F.explode(F.sequence(F.lit(1), F.lit(blocks - 1))))
        found = first.unionByName(searched(rows.where("c > 0"), others.select(*rows.columns, "q", "least")))
    rank = F.row_number().over(Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id"))
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= k)
    copies = asked.select(F.col("id").alias("query_id"), "mark", F.explode(F.sequence(F.lit(1), F.col("asks"))).alias("copy"))
    out, _ = durable(ranked.join(copies, ["query_id", "mark"]).select("query_id", "rank", "vec_id", "score"))
    drop_table(vectors.sparkSession, at, first_at)
    return out

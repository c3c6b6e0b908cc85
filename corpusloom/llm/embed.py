"""Embedding near-duplicates by counting collisions in sorted one-dimensional projections.

1. Parts.  Vectors are dealt to parts by the signs of ``signs`` random projections, several
   times over (``copies``) with other projections, so that a pair at the threshold meets in
   a part of some copy.  Parts hold about ``PART`` vectors, and the copies a vector needs
   grow with the logarithm of the rows; a vector travels once a copy, not once an order.
2. Collisions.  Inside a part there are ``orders`` orders: each sorts the vectors by one
   projection inside the cells that ``k`` further projections cut by their signs.  A
   vector's window in an order is its own cell, ``HALF`` times the standard deviation of the
   difference of a pair at the threshold to either side of its own value.  For each vector
   its collisions with every other one in its windows are counted.
3. Pairs with at least ``COLLISIONS`` collisions are verified by cosine in double precision.
   ``copies`` and ``orders`` are the least at which a pair at the threshold is met, and
   counted, with probability ``RECALL`` each.
4. A pair is verified only in the first copy in which it meets, which both vectors can tell
   for themselves, so no pair ever leaves its task: a task gives each vector its number of
   links and one link of a spanning forest.  Connected components join the forests.

Equal vectors are one class beforehand.  Large parts are cut into blocks and block meets
block, so a task holds two blocks at most.

Defined results: vectors that are null, zero or hold null or non-finite components link
with nothing (and are not equal to each other); vectors of different length link with
nothing; rows that repeat a vec_id are rows each; a null id links with nothing, has a null
component and is kept; vectors of any length are read whole; input columns beside the two
named ones are ignored, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import acos, ceil, comb, erf, log, log2, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, arrow_map, components, drop_table, durable, table_bytes

THRESHOLD = 0.9
RECALL, COLLISIONS, HALF, CELL_ROWS = 0.995, 2, 2.0, 50
#: Vectors of a part, about: at least, and at most.
PART = (2048, 16_384)
#: Rows of a part that are compared with each other at a time.
BLOCK = 20_000
#: Collisions counted at a time, and pairs verified at a time.
_COUNTED, _VERIFIED = 1 << 21, 1 << 15


def sign_rate(cosine: float, k: int) -> float:
    """Probability that a pair of this cosine has the same ``k`` signs."""
    return (1 - acos(max(-1.0, min(1.0, cosine))) / pi) ** k


def collision_rate(cosine: float, k: int, half: float) -> float:
    """Probability that a pair of this cosine collides in one order; ``half`` is the window's half width."""
    return sign_rate(cosine, k) * erf(half / sqrt(max(2 - 2 * cosine, 1e-12)) / sqrt(2))


def parts_for(rows: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """Signs of a part and copies for so many rows."""
    part = min(PART[1], max(PART[0], rows // 8))
    signs = max(0, round(log2(max(rows, 1) / part)))
    if not signs:
        return 0, 1
    return signs, max(1, ceil(log(1 - recall) / log(1 - sign_rate(threshold, signs))))


def orders_for(rows: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int, float]:
    """Signs of a cell, number of orders and half width of a window for a part of so many rows."""
    k = max(2, round(log2(max(rows, 1) / CELL_ROWS))) if rows > CELL_ROWS else 2
    half = HALF * sqrt(2 - 2 * threshold)
    p = collision_rate(threshold, k, half)
    orders = COLLISIONS
    while sum(comb(orders, i) * p**i * (1 - p) ** (orders - i) for i in range(COLLISIONS)) > 1 - recall:
        orders += 1
    return k, orders, half


@cache
def directions(size: int, count: int, seed: int) -> np.ndarray:
    """Gaussian directions, drawn once by a worker."""
    return np.random.default_rng([size, seed]).normal(size=(size, count))


def parts_of(x: np.ndarray, signs: int, copies: int) -> np.ndarray:
    """The part of each unit vector in every copy."""
    bits = (x @ directions(x.shape[1], copies * signs, 1) > 0).reshape(len(x), copies, signs)
    return bits @ (1 << np.arange(signs))


def _unit(data: list[bytes], kind) -> np.ndarray:
    x = np.frombuffer(b"".join(data), kind).reshape(len(data), -1).astype(np.float64)
    return x / np.sqrt((x * x).sum(1))[:, None]


def _parts(rows: DataFrame, signs: int, copies: int, kind: str, light: bool) -> DataFrame:
    """Each vector's part in each copy: key and, unless ``light``, rep, n, its parts in all copies and its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                lists = [np.asarray(v, kind) for v in part.column("v").to_pylist()]
                sizes = np.array([len(v) for v in lists])
                for size in np.unique(sizes):
                    at = np.flatnonzero(sizes == size)
                    data = [lists[i].tobytes() for i in at]
                    own = parts_of(_unit(data, kind), signs, copies)
                    key = (np.int64(size) << 44) + (np.arange(copies, dtype=np.int64) << 32) + own
                    columns = [pa.array(key.T.ravel())]
                    if not light:
                        pick = pa.array(np.tile(at, copies))
                        columns += [part.column("rep").take(pick), part.column("n").take(pick)]
                        columns += [pa.array([x.tobytes() for x in own.astype(np.int32)] * copies, pa.binary()), pa.array(data * copies, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["key"] if light else ["key", "rep", "n", "parts", "data"])

    return arrow_map(rows.select("rep", "n", "v"), run, "key bigint" if light else "key bigint, rep bigint, n bigint, parts binary, data binary")


def colliding(x: np.ndarray, own: np.ndarray | None, threshold: float, recall: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (s, t) of unit vectors that collide often enough, s < t; with ``own``, only of different ``own``."""
    size = len(x)
    k, orders, half = orders_for(size, threshold, recall)
    y = x @ directions(x.shape[1], orders * (k + 1), 2)
    cell = (y[:, orders:] > 0).reshape(size, orders, k) @ (1 << np.arange(k))
    # One number sorts by cell, then by value: values of unit vectors are far below 32.
    place = cell * 64.0 + y[:, :orders]
    order = np.argsort(place, axis=0)
    first, after = np.empty((size, orders), np.int64), np.empty((size, orders), np.int64)
    for o in range(orders):
        ranked = place[order[:, o], o]
        first[:, o] = np.searchsorted(ranked, place[:, o] - half, "left")
        after[:, o] = np.searchsorted(ranked, place[:, o] + half, "right")
    until = np.cumsum((after - first).sum(1))
    lo = 0
    while lo < size:
        hi = max(lo + 1, int(np.searchsorted(until, (until[lo - 1] if lo else 0) + _COUNTED, "right")))
        counted = []
        for o in range(orders):
            n = after[lo:hi, o] - first[lo:hi, o]
            s = np.repeat(np.arange(lo, hi), n)
            t = order[np.repeat(after[lo:hi, o] - np.cumsum(n), n) + np.arange(n.sum()), o]
            good = t > s if own is None else (t > s) & (own[t] != own[s])
            counted.append(s[good] * size + t[good])
        pair, times = np.unique(np.concatenate(counted), return_counts=True)
        pair = pair[times >= COLLISIONS]
        for at in range(0, len(pair), _VERIFIED):
            yield pair[at : at + _VERIFIED] // size, pair[at : at + _VERIFIED] % size
        lo = hi


def linked(x: np.ndarray, rep: np.ndarray, n: np.ndarray, parts: np.ndarray, copy: int, own: np.ndarray | None, threshold: float, recall: float) -> tuple[list, list, list]:
    """Of one part (or two of its blocks): vectors with links, how many, and the smallest vector of their group here."""
    links, label = np.zeros(len(x), np.int64), np.arange(len(x))
    for s, t in colliding(x, own, threshold, recall):
        good = ~(parts[s, :copy] == parts[t, :copy]).any(1)  # those that met in an earlier copy were verified there
        s, t = s[good], t[good]
        good = np.einsum("ij,ij->i", x[s], x[t]) >= threshold
        s, t = s[good], t[good]
        np.add.at(links, s, n[t])
        np.add.at(links, t, n[s])
        apart = label[s] != label[t]
        for a, b in zip(s[apart].tolist(), t[apart].tolist(), strict=True):
            if label[a] != label[b]:
                label[label == label[b]] = label[a]
    have = np.flatnonzero(links)
    root = np.full(len(x), np.iinfo(np.int64).max)
    np.minimum.at(root, label[have], rep[have])
    return rep[have].tolist(), links[have].tolist(), root[label[have]].tolist()


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id (smallest id reachable) and kept (id = component_id)."""
    spark = vectors.sparkSession
    kind = "float32" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "float64"
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))
    exact = v if kind == "float64" else F.col(vector_col)
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.when(usable & F.col(id_col).isNotNull(), exact).alias("v"))
    classes, classes_at = durable(
        rows.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"))
    )
    signs, copies = parts_for(classes.count(), threshold, recall)
    # Parts with many vectors are cut into blocks.
    counts = _parts(classes, signs, copies, kind, light=True).groupBy("key").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > BLOCK)
    large, large_at = durable(counts)
    if table_bytes(spark, large_at) <= BROADCAST_BYTES:
        large = F.broadcast(large)
    blocks = F.coalesce(F.ceil(F.col("m") / (BLOCK // 2)), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    meets = F.transform(F.sequence(F.lit(0), blocks - 1), lambda j: F.struct(F.least(own, j).alias("i"), F.greatest(own, j).alias("j")))
    dealt = _parts(classes, signs, copies, kind, light=False).join(large, "key", "left").withColumn("own", own).withColumn("meet", F.explode(meets))
    dealt = dealt.select("key", "meet.i", "meet.j", "own", "rep", "n", "parts", "data").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []

        def settle() -> pa.RecordBatch:
            key, i, j = held[0][:3]
            own, rep, n = (np.array([r[c] for r in held]) for c in (3, 4, 5))
            parts = np.frombuffer(b"".join(r[6] for r in held), np.int32).reshape(len(held), -1)
            out = linked(_unit([r[7] for r in held], kind), rep, n, parts, (key >> 32) & 0xFFF, own if i != j else None, threshold, recall)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["rep", "links", "root"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][:3] != row[:3]:
                    yield settle()
                    held = []
                held.append(row)
        if held:
            yield settle()

    links, links_at = durable(arrow_map(dealt, run, "rep bigint, links bigint, root bigint"))
    found = components(links.select(F.col("rep").alias("a"), F.col("root").alias("b")).distinct())
    per = links.groupBy("rep").agg(F.sum("links").alias("links"))
    whole, whole_at = durable(
        classes.join(per, "rep", "left")
        .join(found.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            F.col("v").alias("w"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    drop_table(spark, classes_at, large_at, links_at)
    # Unusable vectors have no class; they must not meet in one task, so they bypass the join.
    good = rows.where("v is not null").join(whole, F.col("v") == F.col("w"), "left")
    bad = rows.where("v is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component"))
    every = good.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "vec_id").alias("component")).unionByName(bad)
    kept = F.coalesce(F.col("vec_id") == F.col("component"), F.lit(True))
    out, _ = durable(every.select("vec_id", "n_links", F.col("component").alias("component_id"), kept.alias("kept")))
    drop_table(spark, whole_at)
    return out

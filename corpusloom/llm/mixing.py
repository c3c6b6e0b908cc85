"""Mixing sources to target weights by Pfair scheduling.

Every source's rows are dealt into blocks, and one block goes to each slot.  In the ideal
mixture all sources run at once, each at its weight out of the weights of those that
last; when one is used up, the others go on with their weights scaled up.  A block is
released in the slot in which the ideal mixture begins it and due by the slot in which
that ends it; each slot takes the released block with the earliest deadline (ties to the
smaller name).  On one processor this meets all deadlines, so after any number of slots
each source has had its share within less than one block, and every row comes out once.

Releases and deadlines are computed in whole numbers for the whole run (a block stands
for ``block_rows`` rows): weights that are not whole are multiples of 2^-48 of the largest
one.  The schedule is a table of source, block and slot, written in pieces and joined.  The
driver gets a number of rows for each source, never the names, and there may be any
number of sources.

A row's rank in its source is exact: rows are bucketed by hash so that no bucket of a hot
source is large, buckets are counted and summed up, and rows are numbered inside theirs.

Defined results: a null source is a source of its own; rows repeated in all columns are
interchangeable and numbered each; an empty table gives an empty table; sources without
a given weight get ``default``; a weight must be positive; input columns named as output
columns give way to them.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from itertools import islice
from math import ceil, inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import broadcast_if_small, drop_table, durable

BLOCK_ROWS = 64
#: Bits of a weight that is not whole; slots of the schedule written at once.
WEIGHT_BITS, PIECE = 48, 1 << 18
#: Rows of a source numbered together, on average.
BUCKET_ROWS = 4096

PLAN = T.StructType([T.StructField("__owner", T.LongType()), T.StructField("__turn", T.LongType()), T.StructField("__slot", T.LongType())])


def whole_weights(weights: list) -> list[int]:
    """Positive integers in proportion to ``weights``, to 2^-48 of the largest; whole weights stay as they are."""
    if any(not 0 < w < inf for w in weights):
        raise ValueError("weights must be positive")
    if all(w == int(w) and w <= 1 << WEIGHT_BITS for w in weights):
        return [int(w) for w in weights]
    top = max(weights)
    return [max(1, round(w / top * (1 << WEIGHT_BITS))) for w in weights]


def deal(blocks: list[int], weights: list[int]) -> Iterator[int]:
    """The source of each slot, as its place in the lists, by earliest deadline first among released blocks."""
    # A source has run its first i blocks when i / weight has passed on a clock of all sources.
    # As keys such times keep their order: different ones are 2^-96 apart or more.
    clock = lambda i, w: (i << 128) // w
    used_up = sorted((clock(n, w), k) for k, (n, w) in enumerate(zip(blocks, weights, strict=True)) if n)
    ends, gone, alive = [at for at, _ in used_up], [0], [sum(weights[k] for _, k in used_up)]
    for _, k in used_up:
        gone.append(gone[-1] + blocks[k])
        alive.append(alive[-1] - weights[k])
    begun = [0] * len(blocks)

    def window(k: int) -> tuple[int, int, int]:
        """The deadline of the source's next block, the source, and the release of the block after that."""
        begun[k] += 1
        at, w = bisect_left(ends, clock(begun[k], weights[k])), weights[k]
        run = begun[k] * alive[at]
        return gone[at] - (-run // w), k, gone[at] + run // w

    ready = [window(k) for k, n in enumerate(blocks) if n]
    waiting: list[tuple[int, int]] = []  # by release
    heapq.heapify(ready)
    for t in range(sum(blocks)):
        while waiting and waiting[0][0] <= t:
            heapq.heappush(ready, window(heapq.heappop(waiting)[1]))
        _, k, release = heapq.heappop(ready)
        yield k
        if begun[k] < blocks[k]:
            heapq.heappush(waiting, (release, k))


def _by_name(sources) -> list:
    return sorted(sources, key=lambda s: (s is not None, s))


def pattern(weights: dict) -> dict:
    """The slots of each source while each gives as many blocks as its whole weight."""
    return {s: phases[0][4] for s, phases in schedule(weights, weights).items()}


def schedule(blocks: dict, weights: dict) -> dict:
    """For each source its phases: (first block, last block + 1, base slot, period, slots in a period); one for the whole run."""
    names = _by_name(s for s, n in blocks.items() if n > 0)
    slots: list[list[int]] = [[] for _ in names]
    for t, k in enumerate(deal([blocks[s] for s in names], whole_weights([weights[s] for s in names]))):
        slots[k].append(t)
    return {s: [(0, len(own), 0, sum(map(len, slots)), own)] for s, own in zip(names, slots, strict=True)}


def plan_table(spark: SparkSession, blocks: list[int], weights: list[int]) -> tuple[DataFrame, str]:
    """The schedule as a durable table: ``__owner`` (the source's place), ``__turn`` (its block) and ``__slot``."""
    _, path = durable(spark.createDataFrame([], PLAN))
    owners, base, turn = deal(blocks, weights), 0, np.zeros(len(blocks), np.int64)
    while len(owner := np.fromiter(islice(owners, PIECE), np.int64)):
        # Blocks are numbered in their source: by place inside its run of the sorted piece.
        by = np.argsort(owner, kind="stable")
        own, first, n = np.unique(owner[by], return_index=True, return_counts=True)
        turns = np.empty(len(owner), np.int64)
        turns[by] = np.arange(len(owner)) - np.repeat(first, n) + np.repeat(turn[own], n)
        turn[own] += n
        columns = [pa.array(owner), pa.array(turns), pa.array(np.arange(base, base + len(owner)))]
        spark.createDataFrame(pa.table(columns, names=PLAN.names), PLAN).write.mode("append").parquet(path)
        base += len(owner)
    return spark.read.schema(PLAN).parquet(path), path


def temperature_weights(rows: dict, alpha: float = 0.5) -> dict:
    """Weights in proportion to each source's rows to the power ``alpha``: large sources are held back."""
    return {s: float(n) ** alpha for s, n in rows.items()}


def numbered(sources: DataFrame) -> tuple[DataFrame, str]:
    """``sources`` with ``__place``, from 0 in the order of ``__s``, as a durable table: ranges are counted and numbered apart."""
    ranges, at = durable(sources.repartitionByRange("__s").withColumn("__range", F.spark_partition_id()))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.groupBy("__range").agg(F.count(F.lit(1)).alias("n"))  # as many rows as partitions
    starts = starts.select("__range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    place = F.row_number().over(Window.partitionBy("__range").orderBy("__s")) - 1 + F.col("__start")
    out, path = durable(ranges.join(F.broadcast(starts), "__range").withColumn("__place", place.cast("bigint")).drop("__range", "__start"))
    drop_table(sources.sparkSession, at)
    return out, path


def mix(
    docs: DataFrame,
    weights: dict | None = None,
    source_col: str = "source",
    id_col: str = "doc_id",
    block_rows: int = BLOCK_ROWS,
    default: float = 1.0,
    alpha: float = 0.5,
) -> DataFrame:
    """Add ``block`` (in its source), ``slot`` (place of the block in the mixture) and ``in_block``; order by slot, in_block.

    ``weights`` maps sources to target weights; without it they follow
    ``temperature_weights``.
    """
    spark = docs.sparkSession
    source = F.col(source_col)
    kind = docs.schema[source_col].dataType
    sources, sources_at = numbered(docs.groupBy(source.alias("__s")).agg(F.count(F.lit(1)).alias("__rows")))
    asked = sources.select("__place", "__rows")
    if weights is not None:
        given = [(s, float(w)) for s, w in weights.items()]
        given = spark.createDataFrame(given, T.StructType([T.StructField("__of", kind), T.StructField("__weight", T.DoubleType())]))
        asked = sources.join(given, F.col("__s").eqNullSafe(F.col("__of")), "left")
        asked = asked.select("__place", "__rows", F.coalesce("__weight", F.lit(float(default))).alias("__weight"))
    got = asked.toArrow().sort_by("__place")
    rows = got["__rows"].to_pylist()
    own = list(temperature_weights(dict(enumerate(rows)), alpha).values()) if weights is None else got["__weight"].to_pylist()
    plan, plan_at = plan_table(spark, [ceil(n / block_rows) for n in rows], whole_weights(own))
    buckets = F.ceil(F.col("__rows") / BUCKET_ROWS).cast("int").alias("__buckets")
    by_source = broadcast_if_small(sources, sources_at).select("__s", buckets, "__place")
    same = source.eqNullSafe(F.col("__s"))
    taken = [c for c in docs.columns if c not in ("block", "slot", "in_block")]
    dealt = (
        docs.select(*taken)
        .join(by_source, same)
        .drop("__s")
        .withColumn("__h", F.xxhash64(F.col(id_col), F.lit(42)))
        .withColumn("__bucket", F.floor((F.col("__h") / F.lit(2.0**64) + 0.5) * F.col("__buckets")).cast("int"))
    )
    counts, at = durable(dealt.groupBy(source.alias("__s"), "__bucket").agg(F.count(F.lit(1)).alias("n")))
    before = Window.partitionBy("__s").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "__s", F.col("__bucket").alias("__b"), F.coalesce(F.sum("n").over(before), F.lit(0).cast("bigint")).alias("__start")
    )
    rest = [c for c in taken if c not in (source_col, id_col)]
    within = Window.partitionBy(source_col, "__bucket").orderBy("__h", id_col, F.xxhash64(*rest) if rest else F.lit(0))
    ranked = (
        dealt.withColumn("__n", F.row_number().over(within))
        .join(broadcast_if_small(starts, at), same & (F.col("__bucket") == F.col("__b")))
        .drop("__s")
        .withColumn("__rank", F.col("__start") + F.col("__n") - 1)
        .withColumn("block", F.floor(F.col("__rank") / block_rows))
    )
    placed = ranked.join(broadcast_if_small(plan, plan_at), (F.col("__place") == F.col("__owner")) & (F.col("block") == F.col("__turn")))
    return placed.select(
        *taken, "block", F.col("__slot").alias("slot"), (F.col("__rank") % block_rows).cast("int").alias("in_block")
    )


def mixed_order(mixed: DataFrame) -> DataFrame:
    """The rows in the order of the mixture: range-partitioned by slot, sorted inside."""
    return mixed.repartitionByRange("slot", "in_block").sortWithinPartitions("slot", "in_block")

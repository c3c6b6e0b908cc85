"""Shared pieces: durable tables, size-checked broadcasts, connected components."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most bytes of one batch that goes to a Python worker, so that two workers and their models fit beside an executor's heap.
BATCH_BYTES = 2 << 20
#: A side is broadcast only when its measured size is at most this.
BROADCAST_BYTES = 16 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share; one of this machine only where none is set and all runs here (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="corpusloom")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def small_batches(spark: SparkSession) -> None:
    """Bound the batches of this session's Python workers; a smaller bound set before stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name).lower().rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


_HELD: dict[str, object] = {}


def held(name: str, build: Callable[[], object]):
    """What a worker keeps from task to task under ``name``; only the last name is kept."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = build()
    return _HELD[name]


def _release() -> None:
    """Give memory that is free again back to the system, for the stages that follow."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not on this platform
        pass


def arrow_map(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow`` with bounded batches, in workers that don't hold on to freed memory."""
    small_batches(df.sparkSession)

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        try:
            yield from run(batches)
        finally:
            _release()

    return df.mapInArrow(tidy, schema)


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def drop_table(spark: SparkSession, *paths: str) -> None:
    """Delete tables that ``durable`` wrote and that nothing reads any more."""
    for path in paths:
        where, fs = _filesystem(spark, path)
        fs.delete(where, True)


def durable(df: DataFrame) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors.

    The table is deleted by ``drop_table`` or at the end of the session.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/corpusloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    where, fs = _filesystem(spark, path)
    fs.deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path), path


def table_bytes(spark: SparkSession, path: str) -> int:
    """Size on disk of a table that ``durable`` wrote."""
    where, fs = _filesystem(spark, path)
    return fs.getContentSummary(where).getLength()


def broadcast_if_small(df: DataFrame, path: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` (read from ``path``) with a broadcast hint when the written table is under ``limit``."""
    return F.broadcast(df) if table_bytes(df.sparkSession, path) <= limit else df


def with_fields(schema: T.StructType, fields: list[T.StructField]) -> T.StructType:
    """``schema`` with ``fields`` appended; an input column of the same name gives way."""
    new = {f.name for f in fields}
    return T.StructType([f for f in schema.fields if f.name not in new] + fields)


def map_text(
    df: DataFrame,
    text_col: str,
    fields: list[T.StructField],
    make: Callable[[], Callable[[list], list]],
    keep: list[str] | None = None,
    slice_bytes: int = 1 << 20,
) -> DataFrame:
    """Add ``fields`` computed from the texts of ``text_col`` by an Arrow map.

    ``make()`` runs once for each task and returns a function from a list of texts
    to one list of values per field.  Rows go through in slices of about
    ``slice_bytes`` of text, so that long texts don't pile up in memory.
    """
    kept = [c for c in (keep if keep is not None else df.columns) if c not in {f.name for f in fields}]
    own = with_fields(T.StructType([df.schema[c] for c in kept]), fields)
    row = F.struct(*kept) if kept else F.lit(None)
    source = df.select(row.alias("row"), *([] if text_col in kept else [F.col(text_col).alias("text")]))
    n_fields = len(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(own)
        work = make()
        for batch in batches:
            column = batch.column(0).field(text_col) if text_col in kept else batch.column(1)
            for lo, hi in text_slices(column, slice_bytes):
                rows, texts = batch.column(0).slice(lo, hi - lo), column.slice(lo, hi - lo)
                values = work(texts.to_pylist())
                left = rows.flatten() if kept else []
                right = [pa.array(values[i], type=arrow.field(len(kept) + i).type) for i in range(n_fields)]
                yield pa.RecordBatch.from_arrays([*left, *right], schema=arrow)

    return arrow_map(source, run, own)


def text_slices(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes of text each, one row at least."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    lo = total = 0
    for i, size in enumerate(sizes):
        if i > lo and total + size > most:
            yield lo, i
            lo, total = i, 0
        total += size
    if lo < len(sizes):
        yield lo, len(sizes)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components by alternating large-star and small-star.

    ``edges`` has two bigint columns ``a`` and ``b``.  Returns ``node`` and
    ``component`` (smallest node reachable) for each node of an edge.  Loops and
    repeated edges don't matter; rows with a null end are left out.  Every round
    is two grouped minima and two joins on the node; hot nodes are
    pre-aggregated for the minimum and their join is split by adaptive execution.
    """
    spark = edges.sparkSession
    now, at = durable(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    mark = None
    for _ in range(max_rounds):
        # Large-star: every larger neighbour of u goes to the least of u and its neighbours.
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small-star: u and its smaller neighbours go to the least of these neighbours.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after, path = durable(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        got = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop_table(spark, at)
        now, at, mark, last = after, path, tuple(got), mark
        if mark == last:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )

"""Streaming forms: snapshots compared batch by batch, and claims kept by key."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.manifest import snapshot_diff


def changed_keys(stream: DataFrame, snapshot_path: str, keys: list[str], columns: list[str], rebuild: Callable[[DataFrame, int], None], order: str = "ts"):
    """A stream writer that hands each batch's changed keys to ``rebuild`` and then takes them into the snapshot.

    The snapshot is one folder per batch; the newest row of a key counts.  A batch that
    is run again finds its own folder and overwrites it, so nothing is taken in twice.
    """

    def one(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        latest = batch.groupBy(*keys).agg(F.max_by(F.struct(*columns), order).alias("v")).select(*keys, "v.*")
        try:
            past = spark.read.parquet(snapshot_path).where(F.col("batch") < number)
            known = past.groupBy(*keys).agg(F.max_by(F.struct(*columns), "batch").alias("v")).select(*keys, "v.*")
        except Exception as error:  # no snapshot yet
            if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
                raise
            known = spark.createDataFrame([], latest.schema)
        changed = snapshot_diff(latest, known, keys, columns).select(*keys, *columns)
        changed.write.mode("overwrite").parquet(f"{snapshot_path}/batch={number}")
        rebuild(spark.read.parquet(f"{snapshot_path}/batch={number}"), number)

    return stream.writeStream.foreachBatch(one)


CLAIM = "key string, outcome string, n bigint"


def claim_states(stream: DataFrame) -> DataFrame:
    """The state of each key after its events (key, event, order): claimed, published or released, and how many events it took.

    A published key stays published; a released one may be claimed again.  The order column
    decides, not the arrival: a key's rows come in several frames, and in several batches,
    so the place of the event that counts is part of the state.
    """
    steps = {"claim": "claimed", "merge": "published", "close": "released"}

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        outcome, n, last = state.get if state.exists else ("candidate", 0, None)
        for frame in frames:
            n += len(frame)
            for event, order in zip(frame["event"], frame["order"]):
                if outcome == "published" or event not in steps:
                    continue
                place = None if pd.isna(order) else order  # without a place it comes before all others
                if event == "merge" or last is None or (place is not None and place >= last):
                    outcome, last = steps[event], place
        state.update((outcome, n, last))
        yield pd.DataFrame({"key": [key[0]], "outcome": [outcome], "n": [n]})

    kept = f"outcome string, n bigint, last {stream.schema['order'].dataType.simpleString()}"
    return stream.groupBy("key").applyInPandasWithState(step, CLAIM, kept, "update", GroupStateTimeout.NoTimeout)


def counted_events(stream: DataFrame, time_col: str, window: str, late: str, by: list[str]) -> DataFrame:
    """Events in windows of their own time, late ones up to a watermark."""
    return stream.withWatermark(time_col, late).groupBy(F.window(time_col, window), *by).agg(F.count(F.lit(1)).alias("n"))

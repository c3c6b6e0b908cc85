"""Exact removal of repeated byte strings by prefix-free parsing.

Every byte covered by a string of ``length`` bytes that also starts anywhere else goes.

1. Triggers.  A rolling hash of ``TRIGGER`` bytes is taken at every place; a place is a
   trigger when its hash is the least of some window of ``length`` bytes.  So each such
   string holds a trigger at a place that its own bytes determine, and phrases between
   triggers are never longer than the string.
2. Dictionary and parse.  At a trigger, what stands before it is a suffix of a dictionary
   phrase (at most length - TRIGGER bytes matter) and what stands after it is a suffix of
   the parse (at most ``length`` bytes).  Triggers with equal bytes on both sides are one
   entry; an entry that occurs twice is repeated over its whole reach.
3. Corpus order.  For triggers with several entries, the suffix array of the dictionary
   side (read backwards) and that of the parse side, each with its common-prefix lengths,
   are combined: two strings that start l bytes before the trigger are equal when the
   entries share l bytes in the first order and length - l in the second.  Strings of
   different entries are settled that way, in bytes; that two whole entries are equal is
   told by two 64-bit hashes, of the trigger and of all bytes on both sides.
4. The covered runs of each document are joined and cut out.

A task settles entries that repeat inside its own slice of text and passes one of them
on, so a passage in a third of all documents makes one row per slice, not one per copy.
Entries of a trigger with more than ``WIDE`` of them are not held together: their strings
are counted by digest, spread over all tasks.

Defined results: texts are UTF-8 bytes, null is empty; strings don't cross rows; a
repeated row repeats all its strings; a null doc_id is a document like others, and rows
with equal ids are told apart by 64 bits of their texts; texts shorter than ``length`` are
kept whole; long texts are hashed in pieces that overlap; input columns beside doc_id and
text are ignored, whatever their names; an empty table gives an empty table.

Where this departs from the textbook: triggers are the least hashes of a window instead of
the places whose hash has a given residue, so that phrases are bounded; and neither the
dictionary nor the parse is sorted as a whole.  Their orders are taken per trigger and only
to the depth that a string of ``length`` bytes can tell apart, so they can be dealt to tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_BYTES, arrow_map, broadcast_if_small, drop_table, durable, table_bytes, text_slices

LENGTH, TRIGGER = 200, 64
#: Bytes hashed at a time, and the overlap of the pieces of a longer text.
PIECE = 1 << 19
#: Entries of one trigger that are ordered in one task.
WIDE = 100_000
#: Entries ordered together at least, to use whole arrays.
_BATCH = 20_000

_RNG = np.random.default_rng(5)
_LETTER = _RNG.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, n at least."""
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        both = []
        for base in (_BASE, _BACK):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        _POWERS[size] = tuple(both)
    return _POWERS[size]


class Hashes:
    """Polynomial hashes modulo 2^64 of any stretch of a buffer."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_LETTER[data] * up[: len(data)], out=self.sums[1:])

    def of(self, lo, hi) -> np.ndarray:
        return (self.sums[hi] - self.sums[lo]) * self.down[lo]

    def rolling(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        return (self.sums[k:] - self.sums[:n]) * self.down[:n]


def sliding(x: np.ndarray, width: int, least) -> np.ndarray:
    """``least`` (np.minimum or np.maximum) of each run of ``width`` numbers, by doubling."""
    out, w = x, 1
    while 2 * w <= width:
        out = least(out[:-w], out[w:])
        w *= 2
    return least(out[: len(x) - width + 1], out[width - w : width - w + len(x) - width + 1])


def triggers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray, Hashes]:
    """Places of triggers in a buffer of texts [start, end), their hashes, and the buffer's hashes."""
    hashes = Hashes(data)
    if len(data) < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64), hashes
    h = hashes.rolling(k) | np.uint64(1)
    width = length - k + 1
    low = sliding(h, width, np.minimum)  # by the start of a string
    inside = np.zeros(len(low) + 1, np.int32)
    long = ends - starts >= length
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long] - length + 1, -1)
    low[np.cumsum(inside[:-1]) == 0] = 0
    pad = np.zeros(width - 1, np.uint64)
    high = sliding(np.concatenate([pad, low, pad]), width, np.maximum)
    at = np.flatnonzero(high == h)
    return at, h[at], hashes


def _pieces(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, int, int, int]]]:
    """Groups of (text, own start, own end, start, end): at most about ``PIECE`` bytes together, with margins inside long texts."""
    group, size = [], 0
    for i, text in enumerate(texts):
        if len(text) < length:
            continue
        for lo in range(0, len(text), PIECE):
            hi = min(lo + PIECE, len(text))
            first, last = max(0, lo - 2 * length), min(len(text), hi + 2 * length)
            if group and size + last - first > PIECE:
                yield group
                group, size = [], 0
            group.append((i, lo, hi, first, last))
            size += last - first
    if group:
        yield group


#: The count of a row that its own slice has settled.
_SETTLED = 3


#: A row's place, reach to either side and count in one number.
def packed(pos, left, right, n):
    return (pos << 20) | (left << 12) | (right << 4) | n


def entries(texts: list[bytes], length: int, k: int) -> tuple[np.ndarray, ...]:
    """Trigger hash, entry hash, text number, place, left and right reach of every trigger of ``texts``."""
    parts = []
    for group in _pieces(texts, length):
        data = np.frombuffer(b"".join(texts[i][first:last] for i, _, _, first, last in group), np.uint8)
        number, lo, hi, first, last = np.array(group).T
        ends = np.cumsum(last - first)
        starts = ends - (last - first)
        at, key, hashes = triggers(data, starts, ends, length, k)
        unit = np.searchsorted(ends, at, side="right")
        pos = at - starts[unit] + first[unit]
        own = (pos >= lo[unit]) & (pos < hi[unit])
        at, key, unit, pos = at[own], key[own], unit[own], pos[own]
        left = np.minimum(at - starts[unit], length - k)
        right = np.minimum(ends[unit] - at, length)
        with np.errstate(over="ignore"):
            entry = hashes.of(at - left, at + right) * np.uint64(_BASE) + (left * 1024 + right).astype(np.uint64)
            entry ^= entry >> np.uint64(32)
        parts.append((key, entry, number[unit], pos, left, right))
    if not parts:
        return tuple(np.empty(0, np.int64) for _ in range(6))
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def _combined(key, entry, row, pos) -> tuple[np.ndarray, np.ndarray]:
    """Within a slice: which rows go on as their entry's first, and how often (2: more than once) each row's entry occurs."""
    order = np.lexsort((pos, row, entry, key))
    k, e = key[order], entry[order]
    first = np.ones(len(order), bool)
    first[1:] = (k[1:] != k[:-1]) | (e[1:] != e[:-1])
    size = np.diff(np.append(np.flatnonzero(first), len(order)))
    count = np.empty(len(order), np.int64)
    count[order] = np.minimum(np.repeat(size, size), 2)
    goes = np.empty(len(order), bool)
    goes[order] = first
    return goes, count


def _entry_rows(docs: DataFrame, length: int, k: int, slice_bytes: int = 8 << 20) -> DataFrame:
    """key, entry, doc_id, mark, at (packed) of every trigger; those that their slice has settled are counted so."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_slices(batch.column(2), slice_bytes):
                part = batch.slice(lo, hi - lo)
                texts = [(t or "").encode("utf-8", "replace") for t in part.column(2).to_pylist()]
                key, entry, row, pos, left, right = entries(texts, length, k)
                if not len(key):
                    continue
                goes, count = _combined(key, entry, row, pos)
                count[~goes] = _SETTLED
                pick = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key.view(np.int64)),
                        pa.array(entry.view(np.int64)),
                        part.column(0).take(pick),
                        part.column(1).take(pick),
                        pa.array(packed(pos.astype(np.int64), left, right, count)),
                    ],
                    names=["key", "entry", "doc_id", "mark", "at"],
                )

    return arrow_map(docs, run, "key bigint, entry bigint, doc_id bigint, mark bigint, at bigint")


def orders(texts: list[bytes], group: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffix order of ``texts`` within groups: rows in order, common bytes with the row before (-1: another group), lengths."""
    size = np.array([len(t) for t in texts])
    grid = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in texts), np.uint8).reshape(len(texts), width)
    order = np.lexsort((np.ascontiguousarray(grid).view(f"S{width}").ravel(), group))
    a, b = order[:-1], order[1:]
    common = np.full(len(order), -1, np.int64)
    for lo in range(0, len(a), 4096):
        x, y = a[lo : lo + 4096], b[lo : lo + 4096]
        differ = grid[x] != grid[y]
        first = np.where(differ.any(1), differ.argmax(1), width)
        common[lo + 1 : lo + 1 + len(x)] = np.where(group[x] == group[y], np.minimum(first, np.minimum(size[x], size[y])), -1)
    return order, common, size


def covered(group: np.ndarray, left: list[bytes], right: list[bytes], count: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each entry the most and the least l such that its string from l bytes before the trigger is repeated (-1: none)."""
    most, least = np.full(len(group), -1), np.full(len(group), -1)
    parse, parse_common, parse_size = orders(right, group, length)
    words, words_common, words_size = orders([x[::-1] for x in left], group, max(1, length - k))
    one, two = np.empty(len(group), np.int64), np.empty(len(group), np.int64)
    for l in range(length - k + 1):  # noqa: E741
        one[words] = np.cumsum((words_common < l) | (words_common < 0))
        two[parse] = np.cumsum((parse_common < length - l) | (parse_common < 0))
        fits = np.flatnonzero((words_size >= l) & (parse_size >= length - l))
        both = one[fits] * (len(group) + 1) + two[fits]
        _, back = np.unique(both, return_inverse=True)
        again = fits[np.bincount(back, count[fits])[back] >= 2]
        most[again] = l
        least[again] = np.where(least[again] < 0, l, least[again])
    return most, least


def _ordered(contexts: DataFrame, length: int, k: int) -> DataFrame:
    """Repeated runs of single entries from ``contexts`` (key, doc_id, mark, pos, n, before, after), groups of a key together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []

        def settle(rows: list) -> pa.RecordBatch:
            key = np.array([r[0] for r in rows])
            group = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
            count = np.array([r[4] for r in rows])
            most, least = covered(group, [r[5] for r in rows], [r[6] for r in rows], count, length, k)
            good = np.flatnonzero((most >= 0) & (count < 2))
            pos = np.array([r[3] for r in rows])
            columns = [pa.array([rows[i][c] for i in good], t) for c, t in ((1, pa.int64()), (2, pa.int64()))]
            columns += [pa.array(pos[good] - most[good], pa.int64()), pa.array(pos[good] - least[good] + length, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "mark", "lo", "hi"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if len(held) >= _BATCH and held[-1][0] != row[0]:
                    yield settle(held)
                    held = []
                held.append(row)
        if held:
            yield settle(held)

    dealt = contexts.repartition("key").sortWithinPartitions("key")
    return arrow_map(dealt, run, "doc_id bigint, mark bigint, lo bigint, hi bigint")


def _counted(contexts: DataFrame, length: int, k: int) -> DataFrame:
    """The same for triggers with very many entries: each string by its digest, counted over all tasks."""
    l = F.explode(F.sequence(F.lit(0), F.lit(length - k)))  # noqa: E741
    strings = (
        contexts.select("*", l.alias("l"))
        .where((F.octet_length("before") >= F.col("l")) & (F.octet_length("after") >= length - F.col("l")))
        .select(
            "key", "doc_id", "mark", "pos", "n", "l",
            F.md5(F.expr(f"substring(concat(before, after), cast(octet_length(before) - l + 1 as int), {length})")).alias("digest"),
        )
    )
    again = strings.groupBy("key", "l", "digest").agg(F.sum("n").alias("m")).where("m >= 2").drop("m")
    found = strings.where("n < 2").join(again, ["key", "l", "digest"], "left_semi")
    return found.groupBy("doc_id", "mark", "pos").agg(
        (F.col("pos") - F.max("l")).cast("bigint").alias("lo"), (F.col("pos") - F.min("l") + length).cast("bigint").alias("hi")
    ).drop("pos")


def _contexts(wanted: DataFrame, docs: DataFrame, length: int, k: int) -> DataFrame:
    """The bytes on both sides of each wanted entry, cut from its text."""
    per = wanted.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("key", "at", "n", "many")).alias("all"))
    spans, at = durable(per)
    docs = _matching(docs, spans, at)
    joined = docs.join(spans.withColumnsRenamed({"doc_id": "d", "mark": "m"}), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("key", pa.int64()), ("doc_id", pa.int64()), ("mark", pa.int64()), ("pos", pa.int64()), ("n", pa.int64())]
            + [("before", pa.binary()), ("after", pa.binary()), ("many", pa.bool_())]
        )
        for batch in batches:
            out: list = []
            for doc, mark, text, wants in zip(*batch.columns, strict=True):
                data = (text.as_py() or "").encode("utf-8", "replace")
                for want in wants.as_py():
                    pos = want["at"] >> 20
                    before, after = data[max(0, pos - length + k) : pos], data[pos : pos + length]
                    out.append((want["key"], doc.as_py(), mark.as_py(), pos, want["n"], before, after, want["many"]))
                if len(out) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    schema = "key bigint, doc_id bigint, mark bigint, pos bigint, n bigint, before binary, after binary, many boolean"
    return arrow_map(joined.select("doc_id", "mark", "text", "all"), run, schema)


def _matching(docs: DataFrame, ids: DataFrame, at: str) -> DataFrame:
    """``docs`` without those surely not in ``ids``, before any shuffle, where the ids are few."""
    few, few_at = durable(ids.select(F.col("doc_id").alias("d")).distinct())
    if table_bytes(docs.sparkSession, few_at) > BROADCAST_BYTES:
        return docs
    return docs.join(F.broadcast(few), F.col("doc_id").eqNullSafe(F.col("d")), "left_semi")


def repeated_runs(docs: DataFrame, length: int = LENGTH, k: int = TRIGGER, wide: int = WIDE) -> DataFrame:
    """doc_id, mark (of the text) and the array ``runs`` of (lo, hi) of repeated bytes, disjoint and in order; only texts with any."""
    spark = docs.sparkSession
    rows, rows_at = durable(_entry_rows(docs.select("doc_id", "mark", "text"), length, k).withColumn("n", F.col("at").bitwiseAND(15)))
    # One row of each entry stands for it.  Its columns are taken together, from the same row.
    first = [F.first(c).alias(c) for c in ("doc_id", "mark", "at")]
    each, each_at = durable(rows.where(F.col("n") < _SETTLED).groupBy("key", "entry").agg(F.sum("n").alias("n"), *first))
    several = each.groupBy("key").agg(F.count(F.lit(1)).alias("entries"), F.min("n").alias("least")).where("entries > 1 and least < 2")
    several, several_at = durable(several.select("key", (F.col("entries") > wide).alias("many")))
    again, again_at = durable(each.where("n >= 2").select("key", "entry"))
    left, right = F.shiftright("at", 12).bitwiseAND(255), F.shiftright("at", 4).bitwiseAND(255)
    pos = F.shiftright("at", 20)
    repeated = rows.where("n >= 2").unionByName(rows.where("n = 1").join(broadcast_if_small(again, again_at), ["key", "entry"], "left_semi"))
    whole = repeated.select("doc_id", "mark", (pos - left).alias("lo"), (pos + right).alias("hi"))
    wanted = each.join(broadcast_if_small(several, several_at), "key").select(
        "key", "doc_id", "mark", "at", F.least("n", F.lit(2)).cast("bigint").alias("n"), "many"
    )
    contexts, contexts_at = durable(_contexts(wanted, docs, length, k))
    rest = ["key", "doc_id", "mark", "pos", "n", "before", "after"]
    parts = _ordered(contexts.where("not many").select(*rest), length, k).unionByName(
        _counted(contexts.where("many").select(*rest), length, k)
    )
    every = whole.unionByName(parts).groupBy("doc_id", "mark").agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("all"))
    runs, _ = durable(every.select("doc_id", "mark", _joined("all").alias("runs")))
    drop_table(spark, rows_at, each_at, several_at, again_at, contexts_at)
    return runs


def _joined(column: str):
    """Overlapping and touching runs as one, by a Pandas map over sorted arrays."""

    @F.pandas_udf(T.ArrayType(T.StructType([T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType())])))
    def join(spans):
        import pandas as pd

        def one(rows):
            lo = np.array([r["lo"] for r in rows])
            top = np.maximum.accumulate([r["hi"] for r in rows])
            new = np.flatnonzero(np.concatenate([[True], lo[1:] > top[:-1]]))
            ends = top[np.append(new[1:] - 1, len(lo) - 1)]
            return [{"lo": int(a), "hi": int(b)} for a, b in zip(lo[new], ends, strict=True)]

        return pd.Series([one(x) for x in spans])

    return join(column)


def marked(docs: DataFrame) -> DataFrame:
    """doc_id, text and a mark, 64 bits of the text, that tells rows with equal ids apart."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")


def remove_repeats(docs: DataFrame, length: int = LENGTH, k: int = TRIGGER, wide: int = WIDE) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept (the bytes that are left) and runs."""
    docs = marked(docs)
    runs = repeated_runs(docs, length, k, wide).withColumnsRenamed({"doc_id": "d", "mark": "m"})
    joined = docs.join(runs, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_slices(batch.column(1), 4 << 20):
                part = batch.slice(lo, hi - lo)
                sizes, gone, kept = [], [], []
                for text, spans in zip(part.column(1), part.column(2).to_pylist(), strict=True):
                    data = (text.as_py() or "").encode("utf-8", "replace")
                    spans = spans or []
                    edges = [0, *(x for s in spans for x in (s["lo"], s["hi"])), len(data)]
                    kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                    sizes.append(len(data))
                    gone.append(len(data) - len(kept[-1]))
                columns = [part.column(0), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64())]
                columns += [pa.array([len(s or []) for s in part.column(2).to_pylist()], pa.int64()), pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays([*columns, part.column(2)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "runs"])

    span = "array<struct<lo:bigint,hi:bigint>>"
    schema = f"doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, runs {span}"
    return arrow_map(joined.select("doc_id", "text", "runs"), run, schema)

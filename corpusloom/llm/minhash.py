"""Near-duplicate documents by MinHash banding, verification and connected components.

1. A document's set is its distinct word shingles.  Documents with equal sets are one
   class, found by a digest of the set; only one representative of a class goes on.
2. Universal hashes give minima; a band of some of them is a key.  How many bands, and of
   how many minima, follows from the similarity asked for.  Members of a bucket are paired
   with its smallest member, not with each other, so a bucket of any size makes as many
   pairs as it has members.
3. A pair is checked by its signatures (one byte of each minimum), then confirmed on the
   full shingle sets, recomputed from the texts where the pair's centre is.
4. Connected components by alternating large-star and small-star.
5. In buckets that still hold several components, members of different components are
   compared inside the bucket, in blocks, by a finer signature (one minimum in each of
   ``BINS`` bins, nearly the whole set for common lengths).  A block gives out a spanning
   forest of its most similar pairs, fewer pairs than members; they are confirmed as before
   and the components grow.
6. Where a pair of such a forest was refuted, the members that may still be similar to one
   of another component come together with their full sets, and each block gives out a
   spanning forest of the links that are left between them.  So no link between members of
   a bucket is lost, and no task gives out more pairs than it has members.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A to Z.  A document with fewer words
than a shingle has its whole sequence as one shingle; one without words (or with a null
text) has an empty set and is linked with nothing.  Rows that repeat a doc_id are one node
of the graph, with a result row each; a null doc_id is linked with nothing, has a null
component and is kept.  Texts of any length are read whole: a set is hashed in pieces, and
blocks of long texts hold fewer of them.  Input columns beside doc_id and text are ignored,
whatever their names.  An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_BYTES, arrow_map, broadcast_if_small, components, drop_table, durable, map_text, table_bytes

#: The default of near-duplicate operators here: five words and a Jaccard similarity of 0.8.
WORDS, PERCENT = 5, 80
#: A pair at the threshold shares none of the bands with this probability at most.
MISS = 3.2e-6
#: Minima of a document, at most.
HASHES = 192
#: Standard deviations below the threshold at which a signature rejects a pair; bins of the finer signature.
DEVIATIONS, BINS = 4.5, 1024
#: Members of a bucket that are compared with each other at a time, and the shingles of all of them, about.
BLOCK, BLOCK_SHINGLES = 2048, 1 << 21

_MEMORY = 300_000


class _WordHashes(dict):
    """A 64-bit hash of each word; forgets all when large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _MEMORY:
            self.clear()
        self[word] = got = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return got


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads its input."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, n: int, hashes: dict) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's word shingles."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(n, len(h))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - size + 1 + k])
    return np.unique(out)


def hash_family(count: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Multiply-add-shift universal hashes of 64-bit numbers: odd multipliers and offsets."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 63, count, np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 63, count, np.uint64)


def signature(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The minimum of each hash (upper 32 bits) over the set, in pieces that fit the cache."""
    low = np.full(len(a), 0xFFFFFFFF, np.uint64)
    for lo in range(0, len(x), 256):
        part = x[lo : lo + 256]
        np.minimum(low, ((a[:, None] * part + b[:, None]) >> np.uint64(32)).min(1), out=low)
    return low.astype(np.uint32)


def bands_for(percent: int) -> tuple[int, int]:
    """Bands, and minima in each, for links at ``percent``: the longest bands that keep to ``MISS`` and ``HASHES``."""
    s, best = min(percent, 99) / 100, None
    for rows in range(1, HASHES):
        bands = ceil(log(MISS) / log(1 - s**rows)) if s > 0 else HASHES + 1
        if bands * rows > HASHES:
            break
        best = bands, rows
    if best is None:
        raise ValueError(f"links at {percent} percent can't be found with {HASHES} minima")
    return best


def described(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set, signature bytes and band keys."""
    fields = [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("sig", T.BinaryType()),
        T.StructField("keys", T.ArrayType(T.LongType(), False)),
    ]

    def make():
        hashes = _WordHashes()
        a, b = hash_family(bands * rows)

        def one(text: str | None):
            x = shingles(text, n, hashes)
            if not len(x):
                return 0, None, None, []
            sig = signature(x, a, b)
            keys = np.arange(bands, dtype=np.uint64) + np.uint64(1)
            for k in range(rows):
                keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + sig.reshape(bands, rows)[:, k])
            return len(x), hashlib.blake2b(x.tobytes(), digest_size=16).digest(), sig.astype(np.uint8).tobytes(), keys.view(np.int64)

        return lambda texts: [list(c) for c in zip(*map(one, texts), strict=True)]

    return map_text(docs, "text", fields, make, keep=["doc_id"])


def _agreeing(pairs: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b, sig_a, sig_b) whose signatures agree enough; a and b."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for k in (2, 3))
            yield batch.filter(pa.array((one == two).mean(1) >= least)).select(["a", "b"])

    return arrow_map(pairs.select("a", "b", "sig_a", "sig_b"), run, "a bigint, b bigint")


def _confirmed(pairs: DataFrame, docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, str]:
    """Pairs (a, b) whose full shingle sets are similar.  Texts of b travel to their centre a."""
    # A centre with many members is dealt out by salt; its own text goes along with each part.
    want = pairs.select(F.col("a").alias("centre"), F.col("b").alias("doc_id"), F.pmod("b", F.lit(64)).alias("salt"))
    own = want.select("centre", F.col("centre").alias("doc_id"), "salt").distinct()
    want, want_at = durable(want.unionByName(own))
    # Where the ids are few, other texts are left out before the shuffle.
    ids, ids_at = durable(want.select("doc_id").distinct())
    if table_bytes(docs.sparkSession, ids_at) <= BROADCAST_BYTES:
        docs = docs.join(F.broadcast(ids), "doc_id", "left_semi")
    texts = want.join(docs, "doc_id").select("centre", "doc_id", "salt", "text")
    dealt = texts.repartition("centre", "salt").sortWithinPartitions("centre", "salt", F.col("doc_id") != F.col("centre"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, at, base = _WordHashes(), None, []
        for batch in batches:
            a, b = [], []
            for centre, doc, salt, text in zip(*(batch.column(k) for k in range(4)), strict=True):
                centre, doc, key = centre.as_py(), doc.as_py(), (centre.as_py(), salt.as_py())
                if key != at:
                    at, base = key, []
                x = shingles(text.as_py(), n, hashes)
                if doc == centre:
                    base.append(x)
                    continue
                for own in base:
                    both = int(np.isin(x, own, assume_unique=True).sum())
                    if both and 100 * both >= percent * (len(x) + len(own) - both):
                        a.append(centre)
                        b.append(doc)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    out, out_at = durable(arrow_map(dealt, run, "a bigint, b bigint"))
    drop_table(docs.sparkSession, want_at, ids_at)
    return out, out_at


def binned(x: np.ndarray) -> np.ndarray:
    """One byte for each bin that the set reaches, from the least hash in it; 0 for empty bins."""
    h = mixed(x ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    h.sort()
    where = (h >> np.uint64(54)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]])) if len(h) else np.empty(0, np.int64)
    out = np.zeros(BINS, np.uint8)
    out[where[first]] = (mixed(h[first]) % np.uint64(255)).astype(np.uint8) + 1
    return out


def _fine(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, size of the set and its binned signature."""
    fields = [T.StructField("size", T.LongType()), T.StructField("fine", T.BinaryType())]

    def make():
        hashes = _WordHashes()

        def work(texts: list) -> list:
            sets = [shingles(t, words, hashes) for t in texts]
            return [[len(x) for x in sets], [binned(x).tobytes() for x in sets]]

        return work

    return map_text(docs, "text", fields, make, keep=["doc_id"])


class _Block:
    """Members of a bucket that are compared: two blocks of it, or one with itself."""

    def __init__(self, rows: list, percent: int):
        self.key, self.i, self.j = rows[0][:3]
        self.own, self.doc, self.centre, self.c, self.size = (np.array([r[k] for r in rows]) for k in range(3, 8))
        self.fine = np.frombuffer(b"".join(r[8] for r in rows), np.uint8).reshape(len(rows), -1)
        self.least = percent / 100

    def similar(self, x: int, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of the members ``y`` that may be linked with ``x`` and aren't known to be, and their estimated similarity."""
        least = self.least
        y = y[self.c[y] != self.c[x]]
        if self.i != self.j:
            y = y[self.own[y] != self.own[x]]
        y = y[(self.centre[y] != self.doc[x]) & (self.doc[y] != self.centre[x])]  # pairs with the centre have been checked
        y = y[np.minimum(self.size[y], self.size[x]) >= least * np.maximum(self.size[y], self.size[x])]
        if not len(y):
            return y, np.empty(0)
        either = ((self.fine[y] > 0) | (self.fine[x] > 0)).sum(1)
        agree = ((self.fine[y] == self.fine[x]) & (self.fine[x] > 0)).sum(1) / either
        # Of a union of this size at the threshold, so many members were seen.
        unseen = np.maximum(0, 1 - either * (1 + least) / (self.size[y] + self.size[x]))
        good = agree >= least - 0.005 - DEVIATIONS * np.sqrt(least * (1 - least) / either * unseen)
        return y[good], agree[good]

    def forest(self) -> list[tuple[int, int]]:
        """Pairs of members that span what may be similar, components taken as connected: the most similar first."""
        best, via, outside = np.full(len(self.doc), -1.0), np.zeros(len(self.doc), np.int64), np.ones(len(self.doc), bool)
        pairs = []
        while outside.any():
            new = int(np.where(outside, best, -2.0).argmax())
            if best[new] >= 0:
                pairs.append((via[new], new))
            joining = np.flatnonzero(outside & (self.c == self.c[new]))
            outside[joining] = False
            for x in joining:
                y, about = self.similar(x, np.flatnonzero(outside))
                nearer = about > best[y]
                best[y[nearer]], via[y[nearer]] = about[nearer], x
        return pairs

    def clumps(self) -> np.ndarray:
        """A number for each member: members that may be similar, also over others, have one number; -1 for those without any."""
        clump, outside = np.full(len(self.doc), -1), np.ones(len(self.doc), bool)
        for first in range(len(self.doc)):
            edge = [first] if outside[first] else []
            outside[edge] = False
            while edge:
                y, _ = self.similar(edge.pop(), np.flatnonzero(outside))
                outside[y] = False
                clump[y] = clump[first] = first
                edge += y.tolist()
            if clump[first] == first and not (clump == first).sum() > 1:
                clump[first] = -1
        return clump


def _blocks(rows: DataFrame) -> DataFrame:
    """``rows`` (key, doc_id, a, c, n, all, size, fine) dealt to tasks by key and pair of blocks, sorted so.

    A bucket is cut into blocks of about ``BLOCK`` members, fewer long ones; block i meets
    block j in a group of its own, so no group holds more than two blocks.
    """
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("all") / BLOCK_SHINGLES)).cast("int")
    own = F.pmod(F.xxhash64("doc_id"), blocks).cast("int")
    meets = F.transform(F.sequence(F.lit(0), blocks - 1), lambda j: F.struct(F.least(own, j).alias("i"), F.greatest(own, j).alias("j")))
    dealt = rows.select("key", "doc_id", "a", "c", "size", "fine", own.alias("own"), F.explode(meets).alias("m"))
    dealt = dealt.select("key", "m.i", "m.j", "own", "doc_id", "a", "c", "size", "fine")
    return dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def _grouped(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[list]:
    """Runs of rows that are equal in their first ``width`` columns."""
    held: list = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[0][:width] != row[:width]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _bridges(rows: DataFrame, percent: int) -> DataFrame:
    """key, a and b: for each pair of blocks the forest of its most similar pairs of different components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, 3):
            block = _Block(group, percent)
            pairs = [sorted((int(block.doc[x]), int(block.doc[y]))) for x, y in block.forest()]
            columns = [[block.key] * len(pairs), [a for a, _ in pairs], [b for _, b in pairs]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["key", "a", "b"])

    return arrow_map(_blocks(rows), run, "key bigint, a bigint, b bigint")


def set_links(sets: list[np.ndarray], c: list[int], percent: int) -> list[tuple[int, int]]:
    """Places of linked sets that span what is linked, sets of equal ``c`` taken as connected."""
    label, size = np.array(c), np.array([len(x) for x in sets])
    _, item = np.unique(np.concatenate(sets), return_inverse=True)
    holder = np.repeat(np.arange(len(sets)), size)[np.argsort(item, kind="stable")]
    holders = np.bincount(item)
    ends, until = np.cumsum(size), np.cumsum(holders)
    links = []
    for x in range(len(sets)):
        both = np.zeros(len(sets), np.int64)
        own = item[ends[x] - size[x] : ends[x]]
        for lo in range(0, len(own), 1024):  # the holders of a few of its shingles at a time
            some = own[lo : lo + 1024]
            n = holders[some]
            at = np.repeat(until[some] - np.cumsum(n), n) + np.arange(n.sum())
            both += np.bincount(holder[at], minlength=len(sets))
        for y in np.flatnonzero((label != label[x]) & (both > 0) & (100 * both >= percent * (size + size[x] - both))):
            if label[y] != label[x]:
                links.append((x, int(y)))
                label[label == label[y]] = label[x]
    return links


def _last_links(rows: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The links a, b between members that may be similar to one of another component, from their full sets."""

    def undecided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, 3):
            block = _Block(group, percent)
            clump = block.clumps()
            x = np.flatnonzero(clump >= 0)
            fixed = [np.full(len(x), v) for v in (block.key, block.i, block.j)]
            columns = [*fixed, clump[x], block.doc[x], block.c[x]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["key", "i", "j", "clump", "doc_id", "c"])

    wanted, at = durable(arrow_map(_blocks(rows), undecided, "key bigint, i bigint, j bigint, clump bigint, doc_id bigint, c bigint"))
    ids, ids_at = durable(wanted.select("doc_id").distinct())
    texts = docs.join(broadcast_if_small(ids, ids_at), "doc_id", "left_semi").distinct()
    dealt = wanted.distinct().join(texts, "doc_id").select("key", "i", "j", "clump", "doc_id", "c", "text")
    dealt = dealt.repartition("key", "i", "j", "clump").sortWithinPartitions("key", "i", "j", "clump")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()

        def rows_with_sets() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sets = [shingles(t.as_py(), words, hashes).tobytes() for t in batch.column(6)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(sets, pa.binary())], names=batch.schema.names)

        for group in _grouped(rows_with_sets(), 4):
            sets = [np.frombuffer(r[6], np.uint64) for r in group]
            found = set_links(sets, [r[5] for r in group], percent)
            columns = [[group[x][4] for x, _ in found], [group[y][4] for _, y in found]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

    out, out_at = durable(arrow_map(dealt, run, "a bigint, b bigint"))
    drop_table(docs.sparkSession, at, ids_at)
    return out, out_at


def _grown(found: DataFrame, links: DataFrame) -> tuple[DataFrame, str]:
    """The components ``found`` (node, component) when ``links`` (a, b) come in: components of components."""
    edges = links
    for end in "ab":
        own = found.select(F.col("node").alias(end), F.col("component").alias("c"))
        edges = edges.join(own, end, "left").withColumn(end, F.coalesce("c", end)).drop("c")
    up, up_at = durable(components(edges))
    old = found.join(up.select(F.col("node").alias("component"), F.col("component").alias("top")), "component", "left")
    out = durable(old.select("node", F.coalesce("top", "component").alias("component")).unionByName(up.join(found, "node", "left_anti")))
    drop_table(found.sparkSession, up_at)
    return out


def near_duplicates(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, bands: int | None = None, rows: int | None = None
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest reachable doc_id) and kept (doc_id = component_id).

    Documents are linked when 100 * intersection >= ``percent`` * union.  ``docs`` has
    doc_id and text; other columns are ignored.  ``bands`` and ``rows`` follow ``percent``
    (see ``bands_for``) unless both are given.
    """
    spark = docs.sparkSession
    if bands is None or rows is None:
        bands, rows = bands_for(percent)
    least = percent / 100
    agree = least - DEVIATIONS * sqrt(least * (1 - least) / (bands * rows))
    docs = docs.select("doc_id", "text")
    sets, sets_at = durable(described(docs, words, bands, rows))
    docs = docs.where("doc_id is not null")
    # One class per set; its smallest doc_id stands for it.
    classes, classes_at = durable(
        sets.where("digest is not null and doc_id is not null")
        .groupBy("digest").agg(F.min(F.struct("doc_id", "n_shingles", "sig", "keys")).alias("r"))
        .select("digest", F.col("r.doc_id").alias("rep"), F.col("r.n_shingles").alias("size"), F.col("r.sig").alias("sig"), F.col("r.keys").alias("keys"))
    )
    member = classes.select(F.explode("keys").alias("key"), F.col("rep").alias("doc_id"), "size")
    centre = member.groupBy("key").agg(
        F.min("doc_id").alias("a"), F.max("doc_id").alias("z"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("all")
    )
    buckets, buckets_at = durable(member.join(centre.where("a < z").drop("z"), "key").select("key", "doc_id", "a", "n", "all"))
    sigs = classes.select(F.col("rep").alias("doc_id"), "sig")

    stars = buckets.where("doc_id <> a").select("a", F.col("doc_id").alias("b")).distinct()
    signed = stars.join(sigs.select(F.col("doc_id").alias("a"), F.col("sig").alias("sig_a")), "a").join(
        sigs.select(F.col("doc_id").alias("b"), F.col("sig").alias("sig_b")), "b"
    )
    links, links_at = _confirmed(_agreeing(signed, agree).distinct(), docs, words, percent)
    found, found_at = durable(components(links))
    drop_table(spark, links_at)

    named = buckets.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("c", F.coalesce("component", "doc_id"))
    mixed_keys = named.groupBy("key").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x < y").select("key")
    rest, rest_at = durable(named.join(mixed_keys, "key", "left_semi").select("key", "doc_id", "a", "c", "n", "all"))
    ids, ids_at = durable(rest.select("doc_id").distinct())
    fine, fine_at = durable(_fine(docs.join(broadcast_if_small(ids, ids_at), "doc_id", "left_semi"), words).distinct())
    bridges, bridges_at = durable(_bridges(rest.join(fine, "doc_id"), percent))
    drop_table(spark, ids_at, buckets_at)
    if not bridges.isEmpty():
        links, links_at = _confirmed(bridges.select("a", "b").distinct(), docs, words, percent)
        first, first_at = found, found_at
        found, found_at = _grown(first, links)
        drop_table(spark, links_at, first_at)
        # A bridge whose ends are still apart was refuted: other pairs of its bucket may be links.
        apart = bridges
        for end in "ab":
            own = found.select(F.col("node").alias(end), F.col("component").alias(f"c{end}"))
            apart = apart.join(own, end, "left").withColumn(f"c{end}", F.coalesce(f"c{end}", end))
        open_keys, open_at = durable(apart.where("ca <> cb").select("key").distinct())
        left = rest.join(broadcast_if_small(open_keys, open_at), "key", "left_semi").drop("c")
        left = left.join(found.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
        left = left.withColumn("c", F.coalesce("component", "doc_id")).drop("component")
        links, links_at = _last_links(left.join(fine, "doc_id"), docs, words, percent)
        if not links.isEmpty():
            first, first_at = found, found_at
            found, found_at = _grown(first, links)
            drop_table(spark, first_at)
        drop_table(spark, links_at, open_at)
    drop_table(spark, rest_at, fine_at, bridges_at)

    # Empty sets stand alone; their null digests must not meet in one task.
    rep = classes.select(F.col("digest").alias("d"), "rep")
    rep = rep.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("d", F.coalesce("component", "rep").alias("component"))
    key = F.when(F.col("doc_id").isNotNull(), F.col("digest"))
    component = F.coalesce("component", "doc_id")
    grouped = sets.select("doc_id", "n_shingles", key.alias("d")).withColumn("alone", F.col("d").isNull())
    alone = grouped.where("alone").withColumn("component", F.lit(None).cast("bigint"))
    out = grouped.where("not alone").join(rep, "d", "left").select(*alone.columns).unionByName(alone)
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    out, _ = durable(out.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept")))
    drop_table(spark, sets_at, classes_at, found_at)
    return out

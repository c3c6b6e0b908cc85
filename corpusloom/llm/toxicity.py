"""Toxicity from class-conditional Kneser-Ney models, compared by length-normalised likelihood.

Two models are learned, one from toxic and one from ordinary labelled documents.  Both are
chains of backoff whose lower part they share:

* words: in how many documents of its class a word stands.  An absolute discount is taken
  from each class's count, and the discounted mass goes back through the counts that both
  classes share, so rare words say little;
* letters: how that mass is dealt to the classes, and all that is said of unseen words, is
  told by interpolated Kneser-Ney of order ``ORDER`` over the letters of the word.  Its
  highest order is counted in each class; the lower ones are continuation counts that both
  classes share.

A word's evidence is the difference of its two log-likelihoods.  A document is measured by
that difference divided by the length, over the whole of it and over its best window of
each length in ``WINDOWS`` (one word: its strongest expression); a text shorter than a
window is one.  A logistic curve, fitted on labelled rows that the counts had not seen,
turns these into a probability.

Counts are gathered from every labelled training row and kept exactly, in tables that grow
with the labels.  Workers hold the commonest entries of these tables (all where there are
at most ``HELD``), by 64-bit keys; rarer ones are joined to the documents whose words ask
for them.

Defined results: null and empty texts have no words and get the score of all-zero
measures; with no usable labels of either class every score is the share of toxic labels
(0 without any); where one of the two folds of labels has only one class, the
curve has fixed weights (that of the share, and the best window's whole difference);
repeated document rows are scored each; of repeated labels the largest counts; null labels
are ignored; texts and words of any length are read whole, a batch of rows at a time; of
input columns named as the score, the score stays; an empty table gives an empty table.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, broadcast_if_small, drop_table, durable, held, map_text, text_slices, union_all

ORDER = 5
#: Lengths in words of the windows whose best one measures a document, beside its whole.
WINDOWS = (1,)
#: Fixed discount of the Kneser-Ney counts.
DISCOUNT = 0.75
#: Labelled rows, at most, that the logistic curve is fitted on.
CALIBRATION_ROWS = 20_000
#: Words, and letter n-grams, whose evidence a worker remembers.
REMEMBERED = 300_000
#: The commonest table entries that all workers hold, at most: 16 bytes each.  The rest is joined.
HELD = 1 << 22
#: Counts of an entry above this are not told apart when the commonest are chosen.
_COMMON = 10_000
#: Words of a task's counters at which it gives them out.
_WORDS = 100_000
_TRIM = ".,;:!?\"'()[]{}«»“”„…"
_PAD, _STOP = "\x02", "\x03"
#: First letters of the keys of words and of contexts: no n-gram of ``ORDER`` letters starts so.
_WORD, _CONTEXT = "\x01", "\x04"
#: Letters say no more than this of a word.
_CLIP = 3.0


def words_of(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def _letters(word: str) -> str:
    return _PAD * (ORDER - 1) + word + _STOP


def grams_of(word: str) -> list[str]:
    s = _letters(word)
    return [s[i : i + ORDER] for i in range(len(s) - ORDER + 1)]


def key_of(entry: str) -> int:
    """The 64-bit key of a table entry, the same as Spark's ``xxhash64``."""
    got = xxhash.xxh64_intdigest(entry.encode("utf-8", "replace"), 42)
    return got - (1 << 64) if got >> 63 else got


def word_counts(rows: DataFrame) -> DataFrame:
    """Words of ``rows`` (text, side): word and its counts c0 to c3 by ``side`` 0 to 3; a document counts a word once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [Counter() for _ in range(4)]

        def out() -> pa.RecordBatch:
            words = list(set().union(*counts))
            columns = [pa.array([w.encode("utf-8", "replace").decode() for w in words], pa.string())]
            columns += [pa.array([c[w] for w in words], pa.int64()) for c in counts]
            for c in counts:
                c.clear()
            return pa.RecordBatch.from_arrays(columns, names=["word", "c0", "c1", "c2", "c3"])

        for batch in batches:
            for text, side in zip(batch.column(0), batch.column(1), strict=True):
                counts[side.as_py()].update({w.strip(_TRIM) for w in set(words_of(text.as_py()))})
                if sum(map(len, counts)) > _WORDS:
                    yield out()
        yield out()

    part = arrow_map(rows.select("text", F.col("side").cast("int").alias("side")), run, "word string, c0 bigint, c1 bigint, c2 bigint, c3 bigint")
    return part.groupBy("word").agg(*(F.sum(f"c{k}").alias(f"c{k}") for k in range(4)))


def models(words: DataFrame) -> DataFrame:
    """``words`` of ``word_counts`` as counts of two models: a0, b0 (toxic and ordinary) of the sides 0 and 1, a1, b1 of all."""
    c = {"a0": F.col("c0"), "b0": F.col("c1"), "a1": F.col("c0") + F.col("c2"), "b1": F.col("c1") + F.col("c3")}
    return words.select("word", *(v.alias(k) for k, v in c.items()))


def _step(count: Column, total: Column, types: Column, lower: Column) -> Column:
    """One interpolation of Kneser-Ney; contexts never seen take the lower order whole."""
    got = F.greatest(count - DISCOUNT, F.lit(0.0)) / total + DISCOUNT * types / total * lower
    return F.when(total > 0, F.greatest(F.lit(1e-12), F.least(F.lit(1.0), got))).otherwise(lower)


def letter_tables(words: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """The difference of log-likelihoods f0, f1 of n-grams (gram, n) and of unseen ones by their context (context, n), and tables to drop.

    The lower orders are shared, so an unseen n-gram's difference is that of its context's
    backoff weights.
    """
    paths, counts = [], ["a0", "b0", "a1", "b1"]

    def kept(df: DataFrame) -> DataFrame:
        df, at = durable(df)
        paths.append(at)
        return df

    padded = F.concat(F.lit(_PAD * (ORDER - 1)), "word", F.lit(_STOP))
    spelled = words.select(padded.alias("s"), *counts).select(
        F.explode(F.expr(f"transform(sequence(1, length(s) - {ORDER - 1}), i -> substring(s, i, {ORDER}))")).alias("gram"), *counts
    )
    end = lambda n: F.expr(f"right(gram, {n})").alias("gram")
    start = lambda n: F.expr(f"left(gram, {n - 1})").alias("context")
    some = lambda c: F.sum((c > 0).cast("bigint"))
    levels = {ORDER: kept(spelled.groupBy("gram").agg(*(F.sum(c).alias(c) for c in counts)))}
    for n in range(ORDER - 1, 0, -1):  # continuation counts: distinct longer n-grams that end so
        seen = [F.col(f"a{m}") + (F.col(f"b{m}") if n + 1 == ORDER else 0) for m in (0, 1)]
        levels[n] = kept(levels[n + 1].groupBy(end(n)).agg(*(some(c).alias(f"a{m}") for m, c in enumerate(seen))))
    lower = None
    for n in range(1, ORDER + 1):
        own = [c for c in levels[n].columns if c != "gram"]
        sums = [F.sum(c).alias(f"s{c}") for c in own] + [some(F.col(c)).alias(f"t{c}") for c in own]
        context = levels[n].groupBy(start(n)).agg(*sums)
        rows = levels[n].withColumn("context", start(n)).join(context, "context")
        if lower is None:
            rows = rows.withColumns({"p0": F.lit(1e-4), "p1": F.lit(1e-4)})
        else:
            rows = rows.withColumn("ending", F.expr(f"right(gram, {n - 1})")).join(lower.withColumnRenamed("gram", "ending"), "ending")
        p = {c: _step(F.col(c), F.col(f"s{c}"), F.col(f"t{c}"), F.col(f"p{c[1]}")) for c in own}
        if n < ORDER:
            lower = kept(rows.select("gram", *(p[f"a{m}"].alias(f"p{m}") for m in (0, 1))))
    f = [(F.log(p[f"a{m}"]) - F.log(p[f"b{m}"])).alias(f"f{m}") for m in (0, 1)]
    back = {c: F.when(F.col(f"s{c}") > 0, F.log(DISCOUNT * F.col(f"t{c}") / F.col(f"s{c}"))).otherwise(0.0) for c in counts}
    u = [(back[f"a{m}"] - back[f"b{m}"]).alias(f"f{m}") for m in (0, 1)]
    return rows.select("gram", (F.col("a1") + F.col("b1")).alias("n"), *f), context.select("context", (F.col("sa1") + F.col("sb1")).alias("n"), *u), paths


def entry_table(words: DataFrame) -> tuple[DataFrame, str]:
    """Everything that scores read, as a durable table: key, n (how common), and f, g of both models.

    Of a word, f and g are its toxic and its ordinary count; of an n-gram or a context, f is
    the difference of log-likelihoods.
    """
    words = models(words)
    grams, contexts, paths = letter_tables(words)
    none = [F.lit(0.0).alias(f"g{m}") for m in (0, 1)]
    out = union_all([
        words.select(F.xxhash64(F.concat(F.lit(_WORD), "word")).alias("key"), (F.col("a1") + F.col("b1")).alias("n"), F.col("a0").alias("f0"), F.col("a1").alias("f1"), F.col("b0").alias("g0"), F.col("b1").alias("g1")),
        grams.select(F.xxhash64("gram").alias("key"), "n", "f0", "f1", *none),
        contexts.select(F.xxhash64(F.concat(F.lit(_CONTEXT), "context")).alias("key"), "n", "f0", "f1", *none),
    ])
    table, at = durable(out.select("key", "n", *(F.col(c).cast("float").alias(c) for c in ("f0", "f1", "g0", "g1"))))
    drop_table(words.sparkSession, *paths)
    return table, at


def _common_above(table: DataFrame) -> int:
    """Entries commoner than this are held by all workers: at most ``HELD`` (0: all are)."""
    of = F.least("n", F.lit(_COMMON)).alias("n")
    total = 0
    for r in sorted(table.groupBy(of).agg(F.count(F.lit(1)).alias("entries")).collect(), reverse=True):
        total += r["entries"]
        if total > HELD:
            return r["n"]
    return 0


def evidence(toxic, ordinary, letters, share: float) -> np.ndarray:
    """The difference of log-likelihoods of words: their counts, what their letters say, the share of toxic documents."""
    toxic, ordinary = np.asarray(toxic, float), np.asarray(ordinary, float)
    odds = share / (1 - share) * np.exp(np.clip(letters, -_CLIP, _CLIP))
    part = odds / (1 + odds)
    spare = np.where(toxic + ordinary > 0, np.minimum(toxic, DISCOUNT) + np.minimum(ordinary, DISCOUNT), DISCOUNT)
    p = (np.maximum(toxic - DISCOUNT, 0) + spare * part) / share
    q = (np.maximum(ordinary - DISCOUNT, 0) + spare * (1 - part)) / (1 - share)
    return np.log(p) - np.log(q)


class Entries:
    """The table entries that workers hold, for one model."""

    def __init__(self, table: pa.Table, all_held: bool, share: float):
        order = np.argsort(table["key"].to_numpy())
        self.keys = table["key"].to_numpy()[order]
        self.f, self.g = (table[c].to_numpy()[order] for c in ("f", "g"))
        self.all_held, self.share = all_held, share

    def find(self, entries: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """f and g of each entry (0 where it isn't held), and whether it is held."""
        keys = np.fromiter(map(key_of, entries), np.int64, len(entries))
        if not len(self.keys):
            return np.zeros(len(keys)), np.zeros(len(keys)), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[at] == keys
        return np.where(known, self.f[at], 0).astype(float), np.where(known, self.g[at], 0).astype(float), known


class Reader:
    """What a worker knows of words; NaN stands for what only the joined entries can tell."""

    def __init__(self, entries: Entries):
        self.entries, self.words, self.grams = entries, {}, {}

    def learn(self, lists: list[list[str]]) -> dict[str, float]:
        """The evidence of each word of ``lists``."""
        if len(self.words) > REMEMBERED:
            self.words.clear()
        if len(self.grams) > REMEMBERED:
            self.grams.clear()
        new = [w for w in set().union(*lists) if w not in self.words]
        for lo in range(0, len(new), 10_000):
            part = new[lo : lo + 10_000]
            self.words.update(zip(part, self._evidence(part).tolist(), strict=True))
        return self.words

    def _evidence(self, raw: list[str]) -> np.ndarray:
        words = [w.strip(_TRIM) for w in raw]
        toxic, ordinary, known = self.entries.find([_WORD + w for w in words])
        grams = [grams_of(w) for w in words]
        value = self.grams
        if new := list({g for gs in grams for g in gs if g not in value}):
            f, _, seen = self.entries.find(new)
            unseen = self.entries.find([_CONTEXT + g[:-1] for g in new])[0] if self.entries.all_held else np.nan
            value.update(zip(new, np.where(seen, f, unseen).tolist(), strict=True))
        letters = np.array([sum(map(value.__getitem__, gs)) for gs in grams])
        if not self.entries.all_held:
            letters[~known] = np.nan
        return evidence(toxic, ordinary, letters, self.entries.share)

    def missing(self, word: str) -> list[int]:
        """The keys of the entries that a word asks for and that aren't held."""
        word = word.strip(_TRIM)
        asked = {_WORD + word}
        for g in grams_of(word):
            asked |= {g, _CONTEXT + g[:-1]}
        asked = list(asked)
        _, _, known = self.entries.find(asked)
        return [key_of(a) for a, k in zip(asked, known.tolist(), strict=True) if not k]

    def settled(self, word: str, joined: dict[int, tuple[float, float]]) -> float:
        """The evidence of a word from the held and the joined entries."""
        word, grams = word.strip(_TRIM), grams_of(word.strip(_TRIM))

        def of(entries: list[str]) -> list[tuple[float, float] | None]:
            f, g, known = self.entries.find(entries)
            held_ones = zip(f.tolist(), g.tolist(), known.tolist(), strict=True)
            return [(a, b) if k else joined.get(key_of(e)) for e, (a, b, k) in zip(entries, held_ones, strict=True)]

        letters = sum((own or back or (0.0, 0.0))[0] for own, back in zip(of(grams), of([_CONTEXT + g[:-1] for g in grams]), strict=True))
        toxic, ordinary = of([_WORD + word])[0] or (0.0, 0.0)
        return float(evidence(toxic, ordinary, letters, self.entries.share))


def measures(z: np.ndarray, windows: tuple[int, ...] = WINDOWS) -> list[float]:
    """Length-normalised evidence of a document from its words' evidence: of the whole, and of its best windows."""
    n = len(z)
    if not n:
        return [0.0] * (1 + len(windows))
    run = np.concatenate([[0.0], np.cumsum(z)])
    return [float(run[-1] / n), *(float((run[w:] - run[:-w]).max() / w) for w in (min(w, n) for w in windows))]


MEASURED = T.StructField("__measures", T.ArrayType(T.DoubleType(), False))


def _measured(docs: DataFrame, table: DataFrame, m: int, share: float, above: int, keep: list[str]) -> tuple[DataFrame, object]:
    """Add the array of measures under the model ``m``, and return the broadcast variable too.

    ``table`` is what ``entry_table`` returns; entries commoner than ``above`` are held by all
    workers, the others joined.
    """
    own = table.select("key", "n", F.col(f"f{m}").alias("f"), F.col(f"g{m}").alias("g"))
    common = docs.sparkSession.sparkContext.broadcast(Entries(own.where(F.col("n") > above).drop("n").toArrow(), not above, share))
    name = uuid.uuid4().hex
    # A worker's memory of this model's words outlives a task.
    reader = lambda: held(name, lambda: Reader(common.value))

    if not above:

        def make():
            def work(texts: list) -> list:
                lists = [words_of(t) for t in texts]
                known = reader().learn(lists)
                return [[measures(np.fromiter(map(known.__getitem__, ws), float, len(ws))) for ws in lists]]

            return work

        return map_text(docs, "text", [MEASURED], make, keep=keep), common

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_slices(batch.column(1), 1 << 20):
                lists = [words_of(t) for t in batch.column(1).slice(lo, hi - lo).to_pylist()]
                known = reader().learn(lists)
                found = [list({k for w in set(ws) if known[w] != known[w] for k in reader().missing(w)}) for ws in lists]
                digests = np.repeat(np.arange(lo, hi), [len(f) for f in found])
                keys = pa.array([k for f in found for k in f], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(digests)), keys], names=["digest", "key"])

    # Texts are told by digest, so copies are looked up once.
    texts = docs.select(F.md5("text").alias("digest"), "text").where("text is not null")
    wanted = arrow_map(texts, asked, "digest string, key bigint").distinct()
    found = wanted.join(own.where(F.col("n") <= above), "key").groupBy("digest")
    found = found.agg(F.collect_list(F.struct("key", "f", "g")).alias("rare"))
    held_row = F.struct(*keep) if keep else F.lit(None)
    rows = docs.select(held_row.alias("row"), "text", F.md5("text").alias("digest")).join(found, "digest", "left").select("row", "text", "rare")
    schema = T.StructType([*(docs.schema[c] for c in keep), MEASURED])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            for lo, hi in text_slices(batch.column(1), 1 << 20):
                part = batch.slice(lo, hi - lo)
                lists = [words_of(t) for t in part.column(1).to_pylist()]
                known, out = reader().learn(lists), []
                for ws, rare in zip(lists, part.column(2), strict=True):
                    joined = {r["key"]: (r["f"], r["g"]) for r in rare.as_py() or ()}
                    own = {w: reader().settled(w, joined) if known[w] != known[w] else known[w] for w in set(ws)}
                    out.append(measures(np.fromiter(map(own.__getitem__, ws), float, len(ws))))
                left = part.column(0).flatten() if keep else []
                yield pa.RecordBatch.from_arrays([*left, pa.array(out, arrow.field(len(keep)).type)], schema=arrow)

    return arrow_map(rows, score, schema), common


def logistic_fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights, the intercept last, of a ridge logistic curve by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-3
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep), x.T @ (p - y) + keep * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def score_toxicity(
    docs: DataFrame, labels: DataFrame, train: Column, keep: list[str] | None = None, score_col: str = "score"
) -> DataFrame:
    """Add ``score_col`` (0 to 1) to ``docs`` (doc_id, text and others).

    ``labels`` has doc_id and toxic; ``train`` is a condition on doc_id that says which
    labels may be learned from.  ``keep`` are the columns of ``docs`` to return.
    """
    spark = docs.sparkSession
    keep = [c for c in (keep if keep is not None else docs.columns) if c != score_col]
    marks, at = durable(
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & train)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    # Two folds by another hash of the id: counts of the first calibrate on the second.
    fold = F.when(F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0, 1).otherwise(0)
    totals = {r["fold"]: (r["n"], r["t"] or 0) for r in marks.groupBy(fold.alias("fold")).agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t")).collect()}
    n, t = (sum(x) for x in zip(*totals.values(), strict=True)) if totals else (0, 0)
    if not 0 < t < n:
        drop_table(spark, at)
        return docs.select(*keep).withColumn(score_col, F.lit(t / n if n else 0.0))
    rows = docs.select("doc_id", "text").join(broadcast_if_small(marks, at), "doc_id").withColumn("fold", fold)
    words, words_at = durable(word_counts(rows.withColumn("side", F.col("fold") * 2 + (F.col("toxic") == 0).cast("int"))))
    table, table_at = entry_table(words)
    above = _common_above(table)
    drop_table(spark, words_at)
    if len(totals) == 2 and all(0 < t < n for n, t in totals.values()):
        ids = marks.where(fold == 1).orderBy(F.xxhash64("doc_id", F.lit(1))).limit(CALIBRATION_ROWS).select("doc_id")
        sample = rows.where("fold = 1").select("doc_id", "toxic", "text").join(F.broadcast(ids), "doc_id", "left_semi")
        measured, first = _measured(sample, table, 0, totals[0][1] / totals[0][0], above, ["toxic"])
        got = measured.toArrow()
        first.destroy()
        weights = logistic_fit(np.array(got["__measures"].to_pylist()), got["toxic"].to_numpy().astype(float))
    else:
        weights = np.array([0.0] * len(WINDOWS) + [float(WINDOWS[-1]), np.log(t / (n - t))])
    drop_table(spark, at)
    z = F.lit(float(weights[-1]))
    for i, w in enumerate(weights[:-1]):
        z = z + F.lit(float(w)) * F.col("__measures")[i]
    scored, _ = _measured(docs, table, 1, t / n, above, keep)
    if not above:  # workers hold all entries
        drop_table(spark, table_at)
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))
    return scored.select(*keep, score.alias(score_col))

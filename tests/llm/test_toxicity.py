"""The evidence of words against brute force, and rare words that are joined."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import toxicity


def texts(n=240):
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdeé漢") for _ in range(rng.randint(1, 7))) for _ in range(150)]
    rows = [(i, " ".join(rng.choice(words[: 150 - 60 * (i % 3 == 0)]) for _ in range(rng.randint(0, 20))) + (" Vile, vile" if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(n)]
    return [*rows, (n, None, 0), (n + 1, "", 1), (n + 2, "unseen öx ... " + "q" * 300, 0)]


def brute(rows, words, share):
    """The evidence of ``words`` from (text, toxic), with dictionaries."""
    order, d = toxicity.ORDER, toxicity.DISCOUNT
    docs, grams = [Counter(), Counter()], [Counter(), Counter()]
    for text, toxic in rows:
        docs[toxic].update({w.strip(toxicity._TRIM) for w in toxicity.words_of(text)})
    split = lambda w: [toxicity._letters(w)[i : i + order] for i in range(len(w) + 1)]
    for k in (0, 1):
        for w, n in docs[k].items():
            for g in split(w):
                grams[k][g] += n
    level = {order: None}
    below = set(grams[0]) | set(grams[1])
    for n in range(order - 1, 0, -1):
        level[n] = Counter(g[1:] for g in below)
        below = set(level[n])

    def step(counts, g, lower):
        inside = [c for h, c in counts.items() if h[:-1] == g[:-1] and c]
        if not inside:
            return lower
        return max(counts[g] - d, 0) / sum(inside) + d * len(inside) / sum(inside) * lower

    out = {}
    for w in words:
        y = 0.0
        for g in split(w):
            p = 1e-4
            for n in range(1, order):
                p = step(level[n], g[-n:], p)
            y += math.log(step(grams[1], g, p)) - math.log(step(grams[0], g, p))
        a, b = docs[1][w], docs[0][w]
        odds = share / (1 - share) * math.exp(max(-toxicity._CLIP, min(toxicity._CLIP, y)))
        spare = min(a, d) + min(b, d) or d
        toxic = (max(a - d, 0) + spare * odds / (1 + odds)) / share
        out[w] = math.log(toxic) - math.log((max(b - d, 0) + spare / (1 + odds)) / (1 - share))
    return out


def entries(spark, rows, m, share, all_held=True):
    side = F.expr("if(doc_id % 4 = 0, 2, 0) + if(toxic = 1, 0, 1)")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    table, _ = toxicity.entry_table(toxicity.word_counts(docs.withColumn("side", side)))
    return toxicity.Entries(table.select("key", F.col(f"f{m}").alias("f"), F.col(f"g{m}").alias("g")).toArrow(), all_held, share)


@pytest.mark.parametrize(("m", "share"), [(0, 0.3), (1, 0.4)])
def test_evidence_is_exact(spark, m, share):
    """Words and n-grams seen in both, in one or in none of the classes, against dictionaries."""
    rows = texts()
    words = {w.strip(toxicity._TRIM) for _, t, _ in rows for w in toxicity.words_of(t)} | {"vilest", "zzz", "abcabc", "漢漢漢漢漢漢"}
    reader = toxicity.Reader(entries(spark, rows, m, share))
    got = reader.learn([sorted(words)])
    expected = brute([(t, k) for i, t, k in rows if m or i % 4], words, share)
    assert {w: got[w] for w in words} == pytest.approx(expected, rel=1e-4, abs=1e-4)
    assert {w: reader.settled(w, {}) for w in words} == pytest.approx(expected, rel=1e-4, abs=1e-4)


def test_keys(spark):
    words = ["", "a", "é漢😀", "x" * 100]
    got = spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w")).collect()
    assert [r[0] for r in got] == [toxicity.key_of(w) for w in words]


def test_joined_entries_score_the_same(spark, monkeypatch):
    """Whether workers hold an entry or it is joined changes no score."""
    rows = texts() + [(5, "again " * 3, 0), (6, texts()[0][1], 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    labels = docs.where("doc_id % 5 > 0").select("doc_id", "toxic")
    run = lambda: sorted((r["doc_id"], r["score"]) for r in toxicity.score_toxicity(docs.drop("toxic"), labels, F.lit(True)).collect())
    held = run()
    assert len({s for _, s in held}) > 100
    for most in (200, 0):
        monkeypatch.setattr(toxicity, "HELD", most)
        got = run()
        assert [i for i, _ in got] == [i for i, _ in held]
        assert [s for _, s in got] == pytest.approx([s for _, s in held], rel=1e-4)


def test_one_class_in_a_fold(spark):
    """With one toxic label the curve can't be fitted, but the model still tells the classes apart."""
    rows = [(i, "plain words here " + f"w{i % 7}", 0) for i in range(60)] + [(100 + i, "vile vile vile", 1) for i in range(1)]
    docs = spark.createDataFrame([*rows, (200, "vile vile", 0)], "doc_id bigint, text string, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs.drop("toxic"), docs.where("doc_id < 200"), F.lit(True)).collect()}
    assert got[200] > 0.3 > max(got[i] for i in range(60))


def test_measures():
    assert toxicity.measures(np.array([])) == [0.0] * (1 + len(toxicity.WINDOWS))
    z = np.array([0.0, 4.0, 4.0, 0.0, -1.0, 0.0, 0.0, 0.0, 2.0])
    assert toxicity.measures(z, (4, 8, 16)) == pytest.approx([1.0, 2.0, 9 / 8, 1.0])

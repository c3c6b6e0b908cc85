"""Whole queries against plain versions of them."""

import random
from collections import Counter, defaultdict
from fractions import Fraction
from math import ceil, floor

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm import mixing, quality, queries
from tests.llm.test_brute import brute_components

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def earliest_deadline_first(blocks, weights):
    """The source of each slot, by exact fractions and a search of all sources at every slot."""
    passed = lambda clock: sum(min(Fraction(b), clock * w) for b, w in zip(blocks, weights, strict=True))
    begun, out = [0] * len(blocks), []
    window = lambda k: (ceil(passed(Fraction(begun[k] + 1, weights[k]))), k, floor(passed(Fraction(begun[k], weights[k]))))
    for t in range(sum(blocks)):
        ready = [window(k) for k, n in enumerate(blocks) if begun[k] < n]
        _, k, _ = min(x for x in ready if x[2] <= t)
        begun[k] += 1
        out.append(k)
    return out


def test_mixing_query(spark, tmp_path):
    rows = {"a": 1500, "b": 400, "c": 130, None: 60}
    docs = [(i, "", "en", s, 0) for i, s in enumerate(s for s, n in rows.items() for _ in range(n))]
    spark.createDataFrame(docs, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    names = [None, "a", "b", "c"]
    blocks = [-(-rows[s] // mixing.BLOCK_ROWS) for s in names]
    weights = mixing.whole_weights([float(rows[s]) ** 0.5 for s in names])
    slots = defaultdict(list)
    for t, k in enumerate(earliest_deadline_first(blocks, weights)):
        slots[names[k]].append(t)
    hashes = {r["doc_id"]: r["h"] for r in spark.range(len(docs)).select(F.col("id").alias("doc_id"), F.xxhash64("id", F.lit(42)).alias("h")).collect()}
    expected = {}
    for s in names:
        own = sorted((hashes[i], i) for i, _, _, source, _ in docs if source == s)
        for place, (_, i) in enumerate(own):
            block, in_block = divmod(place, mixing.BLOCK_ROWS)
            expected[i] = (s, block, slots[s][block], in_block)
    got = {r["doc_id"]: (r["source"], r["block"], r["slot"], r["in_block"]) for r in queries.op1_mixing(spark, str(tmp_path)).collect()}
    assert got == expected


def test_quality_query(spark, tmp_path):
    """Scores of the query against the machine fitted on the same rows, with all pairs of features summed one by one."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choices(words[: 30 if i % 3 else 60], k=rng.randint(0, 12))), "en", "s", 0) for i in range(90)]
    labels = [(i, int(i % 3 > 0), 0) for i in range(80)]
    spark.createDataFrame(docs, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    import zlib

    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    known = quality._Words()
    features = {i: quality.features(t, known) for i, t, *_ in docs}
    train = [(i, q) for i, q, _ in labels if not held(i)]
    rows = [(features[i][0], features[i][1].astype(np.float32).astype(float)) for i, _ in train]
    machine = quality.Machine.fit(rows, np.array([q for _, q in train], float))
    for r in queries.op3_quality(spark, str(tmp_path)).collect():
        index, value = features[r["doc_id"]]
        z = machine.w[index] @ value
        z += sum(machine.v[index[a]] @ machine.v[index[b]] * value[a] * value[b] for a in range(len(index)) for b in range(a))
        assert abs(r["score"] - 1 / (1 + np.exp(-z))) < 1e-6
        assert r["held_out"] == held(r["doc_id"]) and r["predicted"] == int(r["score"] >= 0.3)


def test_stages_in_a_row(spark, tmp_path):
    """All stages on a small collection, against plain versions of each."""
    from tokenizers import Tokenizer

    rng = random.Random(9)
    words = [f"{a}{b}" for a in "bcdfgklmnprst" for b in ("a", "e", "io", "un", "ar", "il")]
    docs = []
    for i in range(240):
        body = [rng.choice(words) for _ in range(70)]
        if i % 4 == 0:
            for at in rng.sample(range(70), 6):
                body[at] = rng.choice(["vile", "scum"])
        if i % 4 == 3 and i > 40:  # a near copy of an earlier document that stays
            body = docs[i - 40][1].replace("\nhome | about", "").split()
            body[rng.randrange(70)] = "changed"
        docs.append([i, " ".join(body) + ("\nhome | about" if i % 3 == 0 else ""), "en", f"s{i % 3}", 0])
    docs += [[240, None, "en", "s0", 0], [241, "", None, None, 0]]
    spark.createDataFrame(docs, DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(240)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    kept = [d for d in docs if not {"vile", "scum"} & set((d[1] or "").split())]
    pages, lines = Counter(d[3] for d in kept), Counter((d[3], x) for d in kept for x in set((d[1] or "").split("\n")) if x.strip())
    gone = {k for k, n in lines.items() if n >= 2 and n / pages[k[0]] > 0.1}
    texts = [None if d[1] is None else "\n".join(x for x in d[1].split("\n") if (d[3], x) not in gone) for d in kept]
    assert gone == {("s0", "home | about")}
    groups, _ = brute_components([t or "" for t in texts], 5, 80)
    assert len({*groups}) < len(groups) - 10
    library = Tokenizer.from_file(queries.vocabulary_path())
    expected = {kept[i][0]: library.encode(texts[i] or "", add_special_tokens=False).ids for i in range(len(kept)) if groups[i] == i}
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"]: list(r["ids"]) for r in got} == expected and len(got) == len(expected)
    assert all(r["n_tokens"] == len(r["ids"]) for r in got)

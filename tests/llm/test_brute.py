"""Operators against brute force, exact round trips and held-out accuracy."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import bpe, chat, common, embed, linededup, minhash, mixing, quality, queries, suffix, topk


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_vocabulary(queries.vocabulary_path()))


def test_bpe_equals_library(codec):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.vocabulary_path())
    rng = random.Random(1)
    letters = "ab '’tsrevmdll  \n\t.,!1234é漢😀 \x1c\x85\xa0　<|endoftext|>"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(2000)]
    texts += ["<|endoftext|>" * 2 + " x", "a" * 5000, "ab" * 4000, "퟿\U0010ffff", " \n\n  x"]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == ids
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


def test_segment_tree():
    rng = random.Random(2)
    leaves = [rng.randrange(1000) for _ in range(3000)]
    tree = bpe.SegmentTree(list(leaves))
    for _ in range(500):
        at, value = rng.randrange(3000), rng.randrange(1000)
        tree.put(at, value)
        leaves[at] = value
        assert tree.root() == min(leaves)


def test_decode_ids(spark, codec):
    df = spark.createDataFrame([(codec.encode("héllo 😀"),), (None,)], "ids array<int>")
    out = bpe.decode_ids(df, bpe.read_vocabulary(queries.vocabulary_path()))
    assert [r["decoded"] for r in out.collect()] == ["héllo 😀", ""]


def test_pfair_deviation():
    weights = {"a": 7, "b": 2, "c": 1}
    slots = mixing.pattern(weights)
    order = sorted((t, s) for s, own in slots.items() for t in own)
    assert [t for t, _ in order] == list(range(10))
    done = Counter()
    for t, s in order * 3:
        done[s] += 1
        n = sum(done.values())
        assert all(abs(done[x] - n * w / 10) < 1 for x, w in weights.items())


def test_schedule_uses_each_slot_once():
    rng = random.Random(3)
    for _ in range(30):
        blocks = {f"s{i}": rng.randint(0, 200) for i in range(rng.randint(1, 6))}
        weights = {s: rng.uniform(0.1, 5) for s in blocks}
        plan = mixing.schedule(blocks, weights)
        slots = []
        for phases in plan.values():
            for first, last, base, period, own in phases:
                slots += [base + j // len(own) * period + own[j % len(own)] for j in range(last - first)]
        assert sorted(slots) == list(range(sum(blocks.values())))


def test_mix(spark):
    rows = [(i, "abc"[min(i % 7, 2)]) for i in range(5000)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, source string"), {"a": 1, "b": 2, "c": 5}, block_rows=8).collect()
    assert sorted(r["doc_id"] for r in out) == list(range(5000))
    owner = {r["slot"]: r["source"] for r in out}
    assert sorted(owner) == list(range(len(owner)))
    done = Counter()
    for n in range(1, 150):  # all sources are alive there
        done[owner[n - 1]] += 1
        assert all(abs(done[s] - n * w / 8) < 1 for s, w in {"a": 1, "b": 2, "c": 5}.items())
    assert Counter((r["slot"], r["in_block"]) for r in out).most_common(1)[0][1] == 1


def near_texts(rng, n=300):
    words = [f"w{i}" for i in range(400)]
    base = [[rng.choice(words) for _ in range(rng.randint(3, 120))] for _ in range(n // 3)]
    out = []
    for i in range(n):
        text = list(base[i % len(base)])
        for _ in range(rng.choice([0, 0, 1, 2, 8])):
            text[rng.randrange(len(text))] = rng.choice(words)
        out.append(" ".join(text).upper() if i % 5 == 0 else " ".join(text))
    return out


def brute_components(texts, n, percent):
    sets = []
    for t in texts:
        ws = t.lower().split()
        sets.append({tuple(ws[i : i + n]) for i in range(max(1, len(ws) - n + 1))} if ws else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


def linked_as_brute(spark, texts, n, percent):
    out = minhash.near_duplicates(spark.createDataFrame([*enumerate(texts)], "doc_id bigint, text string"), words=n, percent=percent)
    expected, sizes = brute_components(texts, n, percent)
    rows = out.orderBy("doc_id").collect()
    assert [r["n_shingles"] for r in rows] == sizes
    assert [r["component_id"] for r in rows] == expected
    assert [r["kept"] for r in rows] == [i == c for i, c in enumerate(expected)]
    return expected


@pytest.mark.parametrize(("n", "percent"), [(4, 80), (5, 80), (3, 50), (4, 70), (4, 90)])
def test_minhash(spark, n, percent, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    linked_as_brute(spark, near_texts(random.Random(n)), n, percent)


@pytest.mark.parametrize("block", [7, 2048])
def test_minhash_centre_without_links(spark, block, monkeypatch):
    """The smallest member shares buckets with all and matches nobody; the others hang together in chains."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(8)
    base = [f"b{i}" for i in range(60)]
    texts = [" ".join([*base[:52], *(f"c{i}" for i in range(13))])]
    for i in range(60):
        own = list(base)
        for _ in range(i % 4):
            own[rng.randrange(20, 60)] = f"x{rng.randrange(30)}"
        texts.append(" ".join([*own, *(f"t{i}-{k}" for k in range(i % 9))]))
    assert len(set(linked_as_brute(spark, texts, 1, 80))) > 1


def test_set_links():
    rng = np.random.default_rng(4)
    for percent in (30, 45, 60):
        sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(40)]
        found = minhash.set_links(sets, list(range(40)), percent)
        root, own = list(range(40)), list(range(40))
        for x in range(40):
            for y in range(x):
                both = len(np.intersect1d(sets[x], sets[y]))
                if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                    root = [root[y] if r == root[x] else r for r in root]
        for x, y in found:
            own = [own[x] if r == own[y] else r for r in own]
        assert [root.index(r) for r in root] == [own.index(r) for r in own]
        assert len(found) == 40 - len(set(own))


def test_bands():
    for percent in (20, 50, 80, 95, 100):
        bands, rows = minhash.bands_for(percent)
        assert (1 - (min(percent, 99) / 100) ** rows) ** bands <= minhash.MISS * 1.001 and bands * rows <= minhash.HASHES
    with pytest.raises(ValueError, match="minima"):
        minhash.bands_for(3)


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 500)]
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame([*edges, (None, 1)], "a bigint, b bigint")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in range(600):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: root[x] for x in nodes}


def test_line_dedup(spark):
    rows = [(i, f"s{i % 2}", "\n".join(["menu" if i % 2 else f"x{i}", f"own {i}", "", " shared\t" if i < 12 else "y"])) for i in range(100)]
    out = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, source string, text string"), max_ratio=0.1, min_pages=5)
    pages, lines = Counter(s for _, s, _ in rows), defaultdict(set)
    for i, s, t in rows:
        for line in t.split("\n"):
            lines[s, line.strip()].add(i)
    gone = {k for k, v in lines.items() if k[1] and len(v) >= 5 and len(v) / pages[k[0]] > 0.1}
    expected = {i: "\n".join(x for x in t.split("\n") if (s, x.strip()) not in gone) for i, s, t in rows}
    assert {r["doc_id"]: r["text"] for r in out.collect()} == expected


def brute_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(d), int(gone.sum()), runs, bytes(np.frombuffer(d, np.uint8)[~gone])))
    return out


@pytest.mark.parametrize(("alphabet", "wide"), [("ab", 100_000), ("abcdefgh é", 100_000), ("abcdefgh é", 2)])
def test_suffix(spark, alphabet, wide, monkeypatch):
    monkeypatch.setattr(suffix, "PIECE", 900)  # long texts in several pieces
    rng = random.Random(7)
    parts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 90))) for _ in range(25)]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(80)]
    texts += [texts[3], "a" * 500, None, "x" + "a" * 70, "".join(rng.choice(alphabet) for _ in range(4000))]
    texts.append(texts[-1][100:3000])
    out = suffix.remove_repeats(spark.createDataFrame([*enumerate(texts)], "doc_id bigint, text string").repartition(5), 60, 20, wide).orderBy("doc_id").collect()
    got = [(r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in out]
    assert got == brute_repeats(texts, 60)


def test_topk(spark, monkeypatch):
    monkeypatch.setattr(topk, "FEW", 3)
    monkeypatch.setattr(topk, "BLOCK", 50)
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(300, 8)), 1)
    x[200:] = x[:100]  # ties
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>, label int")
    got = defaultdict(list)
    for r in topk.top_k(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    q = np.floor(256 * x).astype(int)
    for i in range(0, 300, 50):
        score = q @ q[i]
        best = sorted((j for j in range(300) if j != i), key=lambda j: (-score[j], j))[:5]
        assert got[i] == [(j, score[j]) for j in best]


def test_topk_rows_that_share_an_id(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.9, 0.0]), (0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [0.5, 0.0]), (2, [0.1, 0.1])], "vec_id bigint, embedding array<double>")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(df, F.col("vec_id") == 0, 4).collect())
    full, half = [(0, 65536), (1, 65536), (1, 58880), (0, 32768)], [(0, 32768), (0, 32768), (1, 32768), (1, 29440)]
    expected = [(0, i + 1, *row) for rows in (full, full, half) for i, row in enumerate(rows)]
    assert got == sorted(expected)


@pytest.mark.parametrize("least", [False, True])
def test_lists_with_and_without_pruning(least):
    rng = np.random.default_rng(3)
    centres = rng.integers(-200, 200, (50, 16))
    for x in (rng.integers(-200, 200, (3000, 16)), centres[rng.integers(0, 50, 3000)] + rng.integers(-9, 9, (3000, 16))):
        lists = topk.Lists(np.arange(3000), np.ones(3000, np.int64), x)
        expected = []
        for i in range(40):
            score = x @ x[i]
            expected.append([(j, score[j]) for j in sorted((j for j in range(3000) if j != i), key=lambda j: (-score[j], j))[:5]])
        low = np.array([e[-1][1] if least else -np.inf for e in expected])
        assert lists.best(list(range(40)), x[:40], 5, low) == expected


@pytest.mark.parametrize(("block", "part", "kind"), [(80, (40, 64), "double"), (20_000, (2048, 16_384), "float")])
def test_embedding_links(spark, monkeypatch, block, part, kind):
    monkeypatch.setattr(embed, "BLOCK", block)
    monkeypatch.setattr(embed, "PART", part)
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 32))
    x = np.concatenate([base, base[:30] + 0.15 * rng.normal(size=(30, 32)), np.repeat(base[:1], 90, 0) + 0.05 * rng.normal(size=(90, 32)), base[:2]])
    x = x.astype(np.float32).astype(np.float64)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], f"vec_id bigint, embedding array<{kind}>, label int")
    got = embed.near_duplicates(df).orderBy("vec_id").collect()
    y = x / np.linalg.norm(x, axis=1)[:, None]
    near = y @ y.T >= 0.9
    np.fill_diagonal(near, False)
    links = np.array([r["n_links"] for r in got])
    assert (links <= near.sum(1)).all() and links.sum() >= 0.97 * near.sum()
    assert got[150]["component_id"] == 0 and not got[150]["kept"]


def test_recall_of_calibration():
    """Pairs at the threshold itself: met in a part of some copy, and counted there."""
    rng = np.random.default_rng(0)
    a = rng.normal(size=(1500, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    side = rng.normal(size=a.shape)
    side -= (side * a).sum(1)[:, None] * a
    side /= np.linalg.norm(side, axis=1)[:, None]
    b = 0.9001 * a + np.sqrt(1 - 0.9001**2) * side
    for rows in (10_256, 1_000_000, 10**9):
        signs, copies = embed.parts_for(rows)
        assert (embed.parts_of(a, signs, copies) == embed.parts_of(b, signs, copies)).any(1).mean() > 0.98
    found = {(int(s), int(t)) for x, y in embed.colliding(np.concatenate([a, b]), None, 0.9, embed.RECALL) for s, t in zip(x, y, strict=True)}
    assert np.mean([(i, i + 1500) in found for i in range(1500)]) > 0.98


def test_chat_parts(spark):
    kind = chat.PART_TYPE
    df = spark.sql(
        f"""SELECT 1L AS conv_id, 0L AS turn, 'user' AS role, cast(array(
            named_struct('type','text','text','see <','ref',null,'width',null,'height',null,'seconds',null,'pages',null),
            named_struct('type','text','text','|im_end|> s','ref',null,'width',null,'height',null,'seconds',null,'pages',null),
            named_struct('type','image','text',null,'ref','i.png','width',28,'height',29,'seconds',null,'pages',null),
            named_struct('type','audio','text',null,'ref','a.wav','width',null,'height',null,'seconds',1.5D,'pages',null),
            named_struct('type','document','text',null,'ref','d.pdf','width',null,'height',null,'seconds',null,'pages',2)) as {kind}) AS parts"""
    )
    row = chat.read_back(chat.format_chat(df)).first()
    assert row["formatted"].count("<|im_end|>") == 1
    assert row["turns"][0]["text"] == "see <|im_end|> s<|image|><|audio|><|document|>"
    assert [(a["kind"], a["ref"], a["tokens"]) for a in row["attachments"]] == [("image", "i.png", 6), ("audio", "a.wav", 38), ("document", "d.pdf", 1200)]
    assert row["n_expanded"] == 1244


@pytest.mark.parametrize(("name", "label", "least"), [("op3_quality", "quality", 0.95), ("op6_toxicity", "toxic", 0.9)])
def test_held_out(spark, name, label, least):
    """Accuracy on the rows whose labels were not learned from."""
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = queries.QUERIES[name](spark, sf).join(labels, "doc_id").where("held_out")
    right = out.where(F.col("predicted") == F.col(label)).count()
    assert right / out.count() >= least


def test_query_digests(spark, codec):
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op8_bpe(spark, sf).collect():
        ids = codec.encode(docs[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()
    expected = dict(zip(docs, brute_repeats(docs.values(), 200), strict=True))
    for r in queries.op7_suffix(spark, sf).collect():
        n, gone, runs, kept = expected[r["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (n, gone, runs, hashlib.sha256(kept).hexdigest())


def test_models_unit():
    rows = [(np.array([0, 1, quality.BUCKETS]), np.array([0.5, 0.5, 1.0])), (np.array([2, 3, quality.BUCKETS]), np.array([0.5, 0.5, 1.0]))] * 30
    machine = quality.Machine.fit(rows, np.array([1.0, 0.0] * 30))
    assert machine.raw(*rows[0]) > 0 > machine.raw(*rows[1])
    index, value = rows[0]
    pairs = sum(machine.v[index[i]] @ machine.v[index[j]] * value[i] * value[j] for i in range(3) for j in range(i))
    assert machine.raw(index, value) == pytest.approx(machine.w[index] @ value + pairs)

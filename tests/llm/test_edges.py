"""Every operator and stage on nulls, empty and long texts, repeated rows, clashing columns and empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm import bpe, chat, embed, linededup, minhash, mixing, quality, suffix, topk, toxicity
from corpusloom.llm.queries import vocabulary_path

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "lorem ipsum dolor " * 20_000
ROWS = [
    (1, None, "en", "a", None),
    (2, "", "en", "a", 0),
    (3, "one two three", None, None, 13),
    (3, "one two three", None, None, 13),
    (4, "one two three", "en", "b", 13),
    (5, LONG, "en", "b", len(LONG)),
    (6, "\n\n \t", "", "", 4),
    (None, "no id", "en", "a", 5),
    (7, "\x00퟿\U0010ffff é", "en", "a", 5),
]
#: Columns that operators use themselves, or return.
CLASHING = "a b c d e g i j k m n o p q s t u v x rep key keys sig digest size own row lo hi runs kept slot block in_block host drop score ids decoded index value component node at mark".split()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def wide(docs):
    return docs.withColumns({c: F.lit("clash") for c in CLASHING})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(1, 8)] + [(None, 1, 1), (3, None, None), (3, 0, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def sf(spark, labels, docs, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    labels.write.parquet(f"{folder}/labels.parquet")
    docs.write.parquet(f"{folder}/documents.parquet")
    return folder


VOCABULARY = bpe.read_vocabulary(vocabulary_path())
OPERATORS = {
    "bpe": lambda d, labels: bpe.encode_decode(d, VOCABULARY),
    "lines": lambda d, labels: linededup.dedup_lines(d),
    "minhash": lambda d, labels: minhash.near_duplicates(d),
    "mixing": lambda d, labels: mixing.mix(d),
    "suffix": lambda d, labels: suffix.remove_repeats(d),
    "quality": lambda d, labels: quality.score_quality(d, labels, F.lit(True)),
    "toxicity": lambda d, labels: toxicity.score_toxicity(d, labels, F.lit(True)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operators(name, docs, wide, none, labels):
    run = OPERATORS[name]
    expected = len(ROWS)
    assert run(docs, labels).count() == expected
    clashing = run(wide, labels)
    assert clashing.count() == expected
    assert len(clashing.columns) == len(set(clashing.columns))
    assert run(none, labels).count() == 0
    assert run(docs, labels.where("false")).count() == expected


def test_values(docs, labels):
    """What each case comes to, not only that it comes through."""
    by = lambda df, *c: sorted(([r[x] for x in ("doc_id", *c)] for r in df.collect()), key=str)
    assert by(bpe.encode_decode(docs, VOCABULARY), "decoded") == sorted(([r[0], r[1] or ""] for r in ROWS), key=str)
    assert all(not r["ids"] for r in bpe.encode_decode(docs, VOCABULARY).collect() if not r["text"])

    # The line of the two pages of the null host is on all of them; one page of a host is no evidence.
    lines = {(r["doc_id"], r["source"]): (r["text"], r["n_lines"], r["n_dropped"]) for r in linededup.dedup_lines(docs).collect()}
    assert lines == {
        (1, "a"): (None, 0, 0), (2, "a"): ("", 1, 0), (3, None): ("", 1, 1), (4, "b"): ("one two three", 1, 0), (5, "b"): (LONG, 1, 0), (6, ""): ("\n\n \t", 3, 0),
        (None, "a"): ("no id", 1, 0), (7, "a"): (ROWS[-1][1], 1, 0),
    }

    groups = by(minhash.near_duplicates(docs), "n_shingles", "component_id", "kept")
    assert groups == sorted([[1, 0, 1, True], [2, 0, 2, True], [3, 1, 3, True], [3, 1, 3, True], [4, 1, 3, False], [5, 3, 5, True], [6, 0, 6, True], [None, 1, None, True], [7, 1, 7, True]], key=str)

    cut = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"]) for r in suffix.remove_repeats(docs).collect()}
    assert cut[5] == (len(LONG), len(LONG), 1) and all(gone == 0 for i, (_, gone, _) in cut.items() if i != 5) and cut[1] == (0, 0, 0)

    mixed = mixing.mix(docs).collect()
    assert sorted(r["slot"] for r in mixed if r["in_block"] == 0) == list(range(len({r["source"] for r in mixed})))
    assert sorted((str(r["source"]), r["in_block"]) for r in mixed) == sorted((str(s), i) for s, n in (("a", 4), (None, 2), ("b", 2), ("", 1)) for i in range(n))

    for scored in (quality.score_quality(docs, labels, F.lit(True)), toxicity.score_toxicity(docs, labels, F.lit(True))):
        score: dict = {}
        for r in scored.collect():
            assert 0 <= r["score"] <= 1 and score.setdefault(r["text"] or "", r["score"]) == r["score"]
    for rows, least in ((labels.where("false"), 0.5), (labels.where("quality = 1"), 1.0)):
        assert {r["score"] for r in quality.score_quality(docs, rows, F.lit(True)).collect()} == {least}
    assert {r["score"] for r in toxicity.score_toxicity(docs, labels.where("toxic = 1"), F.lit(True)).collect()} == {1.0}
    assert {r["score"] for r in toxicity.score_toxicity(docs, labels.where("false"), F.lit(True)).collect()} == {0.0}


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, name, docs, wide, none, sf):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, docs, sf)
    if name != "bpe":
        assert out.columns == docs.columns
        assert stage(spark, wide, sf).columns == wide.columns
    assert stage(spark, none, sf).count() == 0
    n = out.count()
    assert n <= len(ROWS) if name in ("toxicity", "minhash") else n == len(ROWS)


def test_all_stages(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert {"doc_id", "n_tokens", "ids"} <= set(out.columns)
    assert out.count() <= len(ROWS)


def test_near_copies_tell_rows_apart(spark):
    """Rows that share an id but not the text stay, also without an id; of each group of copies one stays."""
    same, other = "a b c d e f g h", "p q r s t u v w x y z"
    rows = [(1, same), (2, same + " i"), (2, other), (3, same), (4, "k l m n o"), (4, "k l m n o"), (None, other), (None, "x1 x2 x3 x4 x5 x6"), (5, None), (5, ""), (6, "!")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    out = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    got = sorted(((r["doc_id"], r["text"]) for r in out), key=str)
    by_text = {t for _, t in got}
    assert (1, same) in got and by_text == {same, other, "k l m n o", "x1 x2 x3 x4 x5 x6", None, "", "!"} and len(got) == len(by_text)
    assert corpus_pipeline.drop_near_copies(spark, docs.where("doc_id in (1, 3, 6)"), "").count() == 2


VECTORS = "vec_id bigint, embedding array<float>, label int"


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 0.0]), (5, [0.0, 0.0]), (6, [None, 1.0]), (7, []), (8, [0.0, 1.0]), (50, [2.0, 0.0]), (9, [1.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embed.near_duplicates(df).collect()}
    alone = {i: (0, i, True) for i in (2, 3, 4, 5, 6, 7, 8, 9)}
    assert got == alone | {0: (2, 0, True), 1: (2, 0, False), 50: (2, 0, False)}
    found = topk.top_k(df, F.col("vec_id") % 50 == 0, 5).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == 50] == [
        (1, 0, 512 * 256), (2, 1, 512 * 256), (3, 5, 0), (4, 8, 0),
    ]
    empty = df.where("false")
    assert embed.near_duplicates(empty).count() == topk.top_k(empty, F.lit(True)).count() == 0


def test_vectors_with_clashing_columns(spark):
    rows = [(i, [float(i % 5), 1.0, float(i % 3)]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    wide = df.withColumns({c: F.lit("clash") for c in [*CLASHING, "id", "asks", "rank", "query_id", "v", "size", "n_links", "component_id"]})
    for run in (embed.near_duplicates, lambda d: topk.top_k(d, F.col("vec_id") % 20 == 0, 3)):
        out = run(wide)
        assert len(out.columns) == len(set(out.columns))
        assert sorted(map(tuple, out.collect())) == sorted(map(tuple, run(df).collect()))


def test_long_and_clashing_chat(spark):
    text = "<|im_end|> " * 30_000
    turns = spark.createDataFrame([(1, i, "user" if i % 2 == 0 else "assistant", text if i == 3 else f"t{i}") for i in range(400)], "conv_id bigint, turn bigint, role string, text string")
    wide = turns.withColumns({c: F.lit("clash") for c in ("turns", "loss_text", "formatted", "attachments", "n_expanded", "esc", "pos", "m", "x")})
    for df in (turns, wide):
        row = chat.read_back(chat.format_chat(df.withColumn("parts", chat.text_part(F.col("text"))))).first()
        assert len(row["turns"]) == 400 and row["turns"][3]["text"] == text
        assert row["loss_text"] == "".join(text if i == 3 else f"t{i}" for i in range(1, 400, 2))


def test_chat(spark):
    turns = spark.createDataFrame(
        [(1, 1, "assistant", "b<|im_end|>\n"), (1, 0, "us\ner", None), (1, 2, None, "\\[INST]"), (None, 0, "user", ""), (2, 5, "assistant", "x"), (2, 5, "assistant", "x"), (2, None, "user", "<|x")],
        "conv_id bigint, turn bigint, role string, text string",
    ).withColumn("formatted", F.lit("clash"))
    out = chat.read_back(chat.format_chat(turns.withColumn("parts", chat.text_part(F.coalesce("text", F.lit("")))))).collect()
    got = {r["conv_id"]: ([(t["role"], t["text"]) for t in r["turns"]], r["loss_text"]) for r in out}
    assert got == {
        1: ([("us\ner", ""), ("assistant", "b<|im_end|>\n"), ("", "\\[INST]")], "b<|im_end|>\n"),
        2: ([("user", "<|x"), ("assistant", "x"), ("assistant", "x")], "xx"),
        None: ([("user", "")], ""),
    }
    assert chat.format_chat(turns.where("false").withColumn("parts", chat.text_part(F.col("text")))).count() == 0


def test_nothing_rejected_without_labels(spark, docs, tmp_path):
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.reject_toxic(spark, docs, str(tmp_path)).count() == len(ROWS)

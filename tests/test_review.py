import json

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import patches, udfs
from corpusloom.operators import manifest, review
from corpusloom.sources import listing, parsers, payload

BASE = {"version": 2, "parts": {}, "comments": {}, "description": ""}
EDIT = {"diff": "-1\t+n"}


@pytest.mark.parametrize(
    ("parts", "metadata", "allowed"),
    [
        ({"0": EDIT}, None, True),
        ({"0": EDIT}, {"article": {"title": "n"}}, False),
        ({str(i): {"delete": True} for i in range(4)}, None, False),
        ({str(i): {"delete": True} for i in range(3)}, None, True),
        ({"0": EDIT | {"insertAfter": [{"text": t} for t in "wxyz"]}}, None, False),
        ({str(i): EDIT | {"delete": True, "insertAfter": [{"text": "s"}]} for i in range(5)}, None, True),
        ({str(i): EDIT for i in range(10)}, None, True),
        ({"0": {"type": "heading"}, "1": {"type": "quote"}}, None, True),
        ({"0": {"diff": "-500"}}, None, True),
        ({"0": {"diff": "-501"}}, None, False),
        ({"0": {"insertAfter": [{"text": "é" * 500, "type": "p"}]}}, None, True),
        ({"0": {"insertAfter": [{"text": "é" * 501, "type": "p"}]}}, None, False),
        ({"0": {"diff": "x1"}}, None, False),
        ({}, None, False),
    ],
)
def test_policy(parts, metadata, allowed):
    got = patches.auto_merge_allowed("proofread", json.dumps(BASE | {"parts": parts}), None if metadata is None else json.dumps(metadata))
    assert got is allowed


@pytest.mark.parametrize("op", [{"delete": False}, {"insertAfter": []}, {"insertAfter": ["t"]}, {"delete": True, "diff": "=1"}, {"x": 1}, {}])
def test_invalid_patches(op):
    assert patches.patch_error(json.dumps(BASE | {"parts": {"0": op}}))


def test_valid_patch():
    assert patches.patch_error(json.dumps(BASE | {"parts": {"0": EDIT}})) is None
    assert patches.patch_error(json.dumps(BASE | {"parts": {"01": EDIT}})) == "index is invalid"
    assert patches.patch_error(json.dumps(BASE)) == "no changes"
    assert patches.patch_error("[]") and patches.patch_error("{") and patches.patch_error(None)


def test_delta():
    assert udfs.text_delta_apply("north", "=1\t-3\t+int+\t=1") == "nint+h"
    assert udfs.text_delta_apply("x🚀y", "=3\t+%F0%9F%9A%80\t-1") == "x🚀🚀"
    assert udfs.text_delta_apply("x", "=2") is None
    assert udfs.text_delta_apply("", "") == ""
    assert udfs.diff_cost("=9\t-3\t+%F0%9F%9A%80a") == 6
    assert udfs.diff_cost("") is None


def test_changes():
    article = {
        "parts": [{"text": "pq"}],
        "comments": [],
        "comment_pivots": [{"part_idx": 0, "offset": 1, "index": 1}],
        "dates": [{"year": 1801}],
        "tags": [{"name": "a", "type": "b"}],
    }
    patch = {"parts": {"0": {"diff": "=4\t-1\t+r"}}, "comments": {}}
    metadata = {"article": {"dates": [{"year": 1802}], "tags": [{"name": "a", "type": "b"}]}}
    rows = patches.article_changes(json.dumps(article), json.dumps(patch), json.dumps(metadata))
    assert [{k: v for k, v in r.items() if v is not None} for r in rows] == [
        {"kind": "part", "index": 1, "original": "p〔1〕q", "edited": "p〔1〕r"},
        {"kind": "metadata", "field": "dates", "old": '[{"year": 1801}]', "new": '[{"year": 1802}]'},
    ]
    assert patches.article_fulltext(json.dumps(article)) == "p〔1〕q"
    assert patches.article_fulltext(json.dumps(article), json.dumps(patch)) == "p〔1〕r"
    assert json.loads(patches.changed_metadata(json.dumps(article), json.dumps(metadata["article"]))) == {"dates": [{"year": 1802}]}


def test_merge():
    base = "a\nb\nc\nd\n"
    assert udfs.merge3(base, "A\nb\nc\nd\n", "a\nb\nc\nD\n") == ("A\nb\nc\nD\n", "merged")
    assert udfs.merge3(base, "A\nb\nc\nd\n", "X\nb\nc\nd\n") == (None, "conflict")
    assert udfs.merge3("a\nb\nc", "A\nb\nc", "a\nb\nC") == ("A\nb\nC", "merged")
    assert udfs.merge3(None, None, "x") == ("x", "added")
    assert udfs.merge3(None, "y", "x") == (None, "conflict")
    assert udfs.merge3("x", "y", None) == (None, "conflict")
    assert udfs.merge3("x", None, "y") == (None, "missing")


def test_diff_text():
    assert udfs.unified_diff("a\nb\nc", "a\nB\nc").splitlines() == ["@@ -1,3 +1,3 @@", " a", "-b", "+B", " c"]


def test_packing(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    items = F.array(*(F.lit(x) for x in ("a" * 10, "b" * 10, "c" * 200, "d")))
    assert one(manifest.packed(items, 65)) == [0, 0, 1, 2]
    texts = F.array(*(F.lit("x" * n) for n in (10, 50, 5)))
    assert one(manifest.fitting(texts, F.lit(0), 20)) == [True, False, True]


def test_overrides(spark):
    articles = spark.createDataFrame([("p", "a", "t1"), ("p", "b", "t2"), ("p", "c", "t3")], "publication_id string, article_id string, title string")
    overrides = spark.createDataFrame(
        [("p", "a", "z", "new"), ("p", "b", "c", None), ("q", "x", "y", "n")], "publication_id string, article_id string, new_article_id string, title string"
    )
    got = {(r["publication_id"], r["article_id"], r["old_article_id"], r["title"], r["error"]) for r in manifest.merge_overrides(articles, overrides, ["title"]).collect()}
    assert got == {
        ("p", "z", "a", "new", None),
        ("p", "c", "b", "t2", "target exists"),
        ("p", "c", None, "t3", None),
        ("q", "y", "x", "n", "article is missing"),
    }


def test_reverts(spark):
    pulls = spark.createDataFrame(
        [("r", 1, "t", "proofread/a", "r", "main"), ("r", 2, "t", "revert-1-a", "r", "main"), ("r", 3, "t", "revert-9-b", "r", "main"), ("r", 4, None, "proofread/c", "r", "main")],
        "repo string, number bigint, merged_at string, head_ref string, head_repo string, base_ref string",
    )
    good = review.proofreading_pulls(pulls)
    published = spark.createDataFrame([("r#9",)], "key string")
    got = {r["number"]: r["kept"] for r in review.settle_reverts(good, good, published).collect()}
    assert got == {1: False, 2: False, 3: True}


def test_existing_reverts(spark):
    pulls = spark.createDataFrame([(7, "Revert x", "see #12", 0), (8, "revert", "#1", 1), (9, "other", "#5", 2)], "pull int, title string, body string, position int")
    numbers = spark.createDataFrame([(1,), (12,), (5,)], "number int")
    assert {r["number"]: r["pull"] for r in review.existing_reverts(pulls, numbers).collect()} == {"1": 7, "12": 7, "5": None}


def test_listing(spark):
    lines = ["./a/b/x.pdf", "/x.tar.gz", "README", ".gitignore", ".a.b", "name.", "# c", "", "oid sha256:1", "size 12", "a//b.txt", "  　 "]
    rows = listing.parse_listing(spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "line_no int, line string")).orderBy("line_no").collect()
    got = [(list(r["folder"]), r["file"], r["extension"]) for r in rows]
    assert got == [(["a", "b"], "x", "pdf"), ([], "x.tar", "gz"), ([], "README", ""), ([], ".gitignore", ""), ([], ".a", "b"), ([], "name", ""), (["a", ""], "b", "txt")]
    paths = spark.createDataFrame([("a/b.txt",), (".hidden",), ("a.b/c",), ("x.tar.gz",)], "p string").select(listing.stem_of(F.col("p")).alias("s"))
    assert [r["s"] for r in paths.collect()] == ["a/b", ".hidden", "a.b/c", "x.tar"]


def test_payload(spark):
    records = spark.createDataFrame([(0, "o/r", "f", "txt", ["a"], 3, True), (1, "o/r", "g", "", [], None, False)], payload.RECORD)
    text = payload.encode_json(records)
    assert json.loads(text) == {"v": 2, "rp": ["o/r"], "fd": [["a"], []], "rc": [[0, "f", "txt", 0, 3, 1], [0, "g", "", 1, "", 0]]}
    back = payload.decode_json(spark, spark.createDataFrame([(text,)], "value string")).orderBy("record_id").collect()
    assert [tuple(r) for r in back] == [tuple(r) for r in records.collect()]
    short = payload.decode_json(spark, spark.createDataFrame([('{"v":2,"rp":["x"],"fd":[],"rc":[[5,"f","",7,"",0],[1]]}',)], "value string")).collect()
    assert [(r["repo"], r["folder"]) for r in short] == [("", [])]


def test_parsers(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    text = "〖BT/标题〗Head〖-BT/标题〗〖FT/副题〗line〖-FT/副题〗〖ZZ/作者〗u v〖-ZZ/作者〗〖RQ/日期〗20100304〖-RQ/日期〗"
    got = one(parsers.marked_article(F.lit(text)))
    assert (got["title"], got["authors"], tuple(got["date"])) == ("Headline", ["u", "v"], (2010, 3, 4))
    assert one(parsers.marked_article(F.lit("x"))) is None
    assert tuple(one(parsers.dashed_date(F.lit("1802-0-5")))) == (1802, None, 5)
    assert one(parsers.config_value(F.lit('{kind: "abc"}'), "kind")) == "abc"
    assert one(parsers.config_path(F.lit("path: '../x'"))) is None
    assert one(parsers.appended_patch(F.lit("export default [\n1\n]\n"), F.lit("2"))) == "export default [\n1,\n2\n]\n"
    page = '<h3 class=a>Q &amp; A</h3><strong>u</strong><div class="x info">2001-02-03</div>'
    row = parsers.page_article(spark.createDataFrame([(page,), ("none",)], "h string"), "h").collect()
    assert (row[0]["title"], row[0]["author"], tuple(row[0]["date"]), row[0]["error"]) == ("Q & A", "u", (2001, 2, 3), None)
    assert row[1]["error"]
    digest = '<a name="1">~{Head~}\n~{·u·v·~}\ntext<a name=T>'
    assert list(parsers.digest_articles(digest)) == [(1, 0, "Head", ["u", "v"])]


def test_images():
    png = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + (7).to_bytes(4, "big") + (9).to_bytes(4, "big")
    assert udfs.image_size(png) == (7, 9)
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08\x00\x05\x00\x06" + b"\0" * 8
    assert udfs.image_size(jpeg) == (6, 5)
    assert udfs.image_size(b"GIF89a") is None


def test_varints():
    ids = [0, 1, 130, 100_000]
    assert udfs.varint_decode(udfs.varint_postings(ids)) == ids
    assert udfs.varint(300) == b"\xac\x02"

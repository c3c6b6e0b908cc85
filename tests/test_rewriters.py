"""Literals edited in place, sources rewritten and read again, and the operators beside them."""

import json
import sqlite3

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import retries
from corpusloom.functions.identity import article_id_of
from corpusloom.operators import manifest, matching, review
from corpusloom.sources import databases, listing, literals, parsers, rewriters, sinks, state

CONFIG = """// a config
export default {
  entity: { name: 'old // name', "type": `x`, files: [] }, /* } */
  parser: run(1, { a: [2] }),
  parser_option: {
    articles: [
      { title: "First, \\"one\\"", authors: ["b"], dates: [{ year: 1801, month: 2 }], page_start: 1, page_end: 2 },
      { title: '【文章待拆分】rest', page_start: 3, page_end: 9 },
    ],
  },
};
"""


def test_values():
    root = literals.scanned(CONFIG)
    assert root.fields["entity"].value() == {"name": "old // name", "type": "x", "files": []}
    assert root.fields["parser"].value() is None
    assert [a["title"] for a in root.fields["parser_option"].value()["articles"]] == ['First, "one"', "【文章待拆分】rest"]
    for broken in ("none", "{ a: [1 }", "{ a: ", "{ a: 'x }"):
        with pytest.raises(literals.Refused):
            literals.scanned(broken)


def test_edits_leave_the_rest():
    first = literals.scanned(CONFIG).fields["parser_option"].fields["articles"].items[0].value()
    request = {"article_id": article_id_of(first), "metadata": {"article": {"title": "New", "tags": ["t"], "id": 1}, "source": {"name": "n", "author": "a"}}}
    content, changed, error = literals.edited(CONFIG, json.dumps(request))
    assert error is None and changed == article_id_of(first | {"title": "New"})
    root = literals.scanned(content)
    assert root.fields["entity"].value() == {"name": "n", "type": "x", "files": [], "author": "a"}
    assert root.fields["parser_option"].value()["articles"][0] == first | {"title": "New", "tags": ["t"]}
    assert "run(1, { a: [2] })" in content and "/* } */" in content and content.startswith("// a config")
    by_place = {"metadata": {"article": {"title": "Z"}}, "locator": {"title": first["title"], "page_start": 1, "page_end": 2}}
    assert 'title: "Z"' in literals.edited(CONFIG, json.dumps(by_place))[0]
    assert literals.edited(CONFIG, '{"article_id":"x","metadata":{"article":{"title":"Z"}}}')[2] == "expected one article"


def test_split():
    request = {"replace_articles": [{"title": "A"}, {"title": "B"}], "locator": {"title": "【文章待拆分】rest", "page_start": 3, "page_end": 9}}
    content, _, error = literals.edited(CONFIG, json.dumps(request))
    assert error is None
    assert literals.scanned(content).fields["parser_option"].value()["articles"] == [{"title": "A"}, {"title": "B"}]
    assert literals.edited(CONFIG, json.dumps(request | {"locator": {}}))[2] == "expected one article not yet split"


def test_marked_and_pages(spark):
    text = "〖BT/标题〗T〖-BT/标题〗〖RQ/日期〗20100304〖-RQ/日期〗"
    for names in (["u"], ["v", "w"]):  # put in, then replaced
        text, error = rewriters.rewritten(text, "marked", json.dumps({"authors": names}))
        assert error is None
        assert spark.range(1).select(parsers.marked_article(F.lit(text))["authors"].alias("a")).first()["a"] == names
    page = "<h3>a</h3><STRONG>b</STRONG><div class='info'>2001-02-03, 2004-05-06</div>"
    fields = {"title": "<x>", "authors": ["c"], "dates": [{"year": 7, "month": 8, "day": 9}]}
    assert rewriters.rewritten(page, "page", json.dumps(fields))[0] == "<h3>&lt;x&gt;</h3><STRONG>c</STRONG><div class='info'>0007-08-09, 2004-05-06</div>"


def test_digest_rewrites():
    page = '<a name="1">Head</a>\n\n  ·u·v·\ntext\n<a name="2">~{Next~}\n~{·w·~}\nmore'
    for segment, kind in ((1, 1), (2, 0)):
        page, error = rewriters.rewritten(page, "digest", '{"authors":["x","y"]}', segment, kind)
        assert error is None
    assert [(t, a) for _, _, t, a in parsers.digest_articles(page)] == [("Head", ["x", "y"]), ("Next", ["x", "y"])]


@pytest.mark.parametrize(
    ("form", "text", "fields"),
    [
        ("marked", "x", {"authors": ["a"]}), ("marked", "〖-BT/标题〗", {"title": "a"}), ("marked", "〖-BT/标题〗", {"authors": [" "]}), ("record", "{}", {}), ("record", "{", {"authors": []}),
        ("page", "<h3>x</h3>", {"authors": ["a"]}), ("page", "<strong>x</strong>", {"authors": ["a", "b"]}), ("page", "<div class=info>2001-02-03</div>", {"dates": [{"year": 1}]}),
        ("digest", "<a name=1>", {"authors": ["a·b"]}), ("listed", "[]", {"title": "x"}), ("described", "[]", {"title": "x"}), ("described", "{}", {"tags": [{"name": "x", "type": "y"}]}), ("other", "", {}),
    ],
)
def test_refused(form, text, fields):
    content, error = rewriters.rewritten(text, form, json.dumps(fields))
    assert content is None and error


def test_states_are_replaced_in_one_step(spark, tmp_path):
    path = f"{tmp_path}/state.json"
    for value in (b"one", b"two"):
        sinks.write_bytes(spark, path, value)
        assert (tmp_path / "state.json").read_bytes() == value
    assert not (tmp_path / "state.json.part").exists()


def test_lines_are_numbered_over_blocks(spark, tmp_path):
    lines = [f"./d/{i}.txt" for i in range(5000)]
    (tmp_path / "l.txt").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = {r["line_no"]: r["line"] for r in listing.read_listing(spark, f"{tmp_path}/l.txt", "r").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == dict(enumerate(lines))


def test_packed_rows_equals_the_fold(spark):
    sizes = [(g, i, "x" * ((i * 37 + g) % 90)) for g in range(3) for i in range(50)]
    df = spark.createDataFrame(sizes, "g int, i int, s string")
    got = {(r["g"], r["i"]): r["batch"] for r in manifest.packed_rows(df, "g", "i", "s", 150).collect()}
    folded = df.groupBy("g").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda x: x["s"]).alias("s")).select("g", manifest.packed(F.col("s"), 150).alias("b"))
    assert got == {(r["g"], i): b for r in folded.collect() for i, b in enumerate(r["b"])}


def test_segments(spark):
    rows = [(t, i) for t in ("a", "b", "ä") for i in range(0, 3000, 1 + len(t) + (t == "b"))]
    segments = sinks.index_segments(spark.createDataFrame(rows + rows[:5], "term string, id bigint"), most=2000)
    assert segments.count() > 4
    assert sorted((r["term"], r["id"]) for r in sinks.read_segments(segments).collect()) == sorted(rows)


def test_chains_that_go_on(spark):
    ids = spark.createDataFrame([("p", "e"), ("p", "c")], "publication_id string, article_id string")
    chain = spark.createDataFrame([("p", a, b) for a, b in ("ab", "bc", "cd", "de")], "publication_id string, article_id string, new_article_id string")
    got = {r["article_id"]: (r["source_id"], r["error"]) for r in matching.original_ids(ids, chain, most=2).collect()}
    assert got == {"e": ("c", "too many steps"), "c": ("a", None)}


def test_truncated_trees(spark):
    rows = [("x", "a.ts", "blob", "1", True)]
    tree = spark.createDataFrame(rows, "side string, path string, type string, blob string, truncated boolean")
    with pytest.raises(Exception, match="truncated listing"):
        state.tree_blobs(tree).collect()
    assert state.tree_blobs(tree.drop("truncated")).count() == 1


def test_waits(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    now = F.lit("2030-01-01 00:00:00+00:00").cast("timestamp")
    wait = lambda header, attempt=F.lit(3): one(retries.retry_delay(F.lit(header), now, attempt, 4, 100))
    assert [wait(h) for h in ("9", "0", "999", "Tue, 01 Jan 2030 00:00:30 GMT", "Mon, 31 Dec 2029 00:00:00 GMT", "soon", None)] == [9, 1, 100, 30, 1, 16, 16]
    assert one(retries.backoff(F.lit(2), 0.5)) == 2.0


def test_databases(spark):
    with sqlite3.connect(":memory:") as c:
        c.execute("CREATE TABLE documents (x)")
        c.execute("INSERT INTO documents VALUES (1)")
        c.commit()
        data = c.serialize()
    assert databases.inspected(data, ["documents", "other"], "k") == ("ok", None, {"documents": 1})
    assert databases.inspected(b"none", ["documents"])[0] != "ok"


def test_missing_markers_keep_the_smallest(spark):
    wanted = spark.createDataFrame([("m", "b"), ("m", "a"), ("n", "c")], "marker string, body string")
    assert [(r["marker"], r["body"]) for r in review.missing_markers(wanted, wanted.where("marker = 'n'").select("marker")).collect()] == [("m", "a")]

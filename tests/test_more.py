import json

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import dates, udtfs
from corpusloom.operators import catalog, manifest, review
from corpusloom.sources import paged, payload, sinks


def test_udtfs(spark):
    udtfs.register(spark)
    rows = spark.sql("""SELECT * FROM walk_strings('{"a": ["x", {"b": "y"}], "c": 1}')""").collect()
    assert [tuple(r) for r in rows] == [("$.a[0]", "x"), ("$.a[1].b", "y")]
    assert spark.sql("SELECT * FROM digest_articles('none')").count() == 0


def test_landed_pages(spark, tmp_path):
    paged.register(spark)
    for n, size in ((1, 3), (2, 3), (3, 1), (4, 3)):
        (tmp_path / f"{n}.json").write_text(json.dumps([{"number": n * 10 + i} for i in range(size)]))
    read = spark.read.format("landed_pages").schema("number int").option("path", str(tmp_path)).option("per_page", 3).option("pages_per_task", 1)
    assert sorted(r["number"] for r in read.option("max_pages", 3).load().collect()) == [10, 11, 12, 20, 21, 22, 30]
    assert read.option("max_pages", 2).option("overflow", "stop").load().count() == 6
    with pytest.raises(Exception, match="goes on after page 2"):
        read.option("max_pages", 2).option("overflow", "error").load().count()


def test_nested_tree(spark):
    rows = [(0, "r", "f", "txt", ["a", "b"], 1, False), (1, "r", "g", "", ["a"], 2, True), (2, "r", "h", "", [], None, False)]
    tree = sinks.nested_tree(catalog.folder_tree(spark.createDataFrame(rows, payload.RECORD)))
    leaf = {"n": "b", "c": 1, "df": True, "ch": []}
    assert tree == {"r": [{"n": "r", "c": 3, "df": True, "ch": [{"n": "a", "c": 2, "df": True, "ch": [leaf]}]}]}
    browser = sinks.nested_browser(spark.createDataFrame(rows, payload.RECORD))
    assert browser["r"][""] == {"d": [{"n": "a", "c": 2}], "f": [{"n": "h", "e": "", "t": False, "s": ""}]}


def test_sidebars(spark, tmp_path):
    rows = [(0, "o/r", "f", "txt", ["a"], 1, False), (1, "o/r", "g", "", [], 2, True), (2, "", "h", "", [], None, False)]
    urls = sinks.write_sidebars(spark, str(tmp_path), spark.createDataFrame(rows, payload.RECORD))
    assert urls == ["/data/sidebar/global.json", "/data/sidebar/repos/r.json"]
    page = json.loads((tmp_path / "sidebar/repos/r.json").read_text())
    assert page == {"repo": "o/r", "path": "", "folders": [{"n": "a", "c": 1}], "files": [{"n": "g", "e": "", "t": True, "s": 2}]}
    assert json.loads((tmp_path / "sidebar/global.json").read_text()) == {"repos": [{"name": "o/r", "count": 2}]}


def test_small_review_pieces(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    assert [one(review.verdict(F.lit(t))) for t in ("/proofread-approve", " /Proofread-Reject no", "/proofread-revert", "hi")] == ["approve", "reject", "revert", None]
    assert one(review.without_archive(F.lit("archives12/[a][b].ts"))) == "[a][b].ts"
    assert one(dates.local_date(F.lit("2020-01-01 20:00:00").cast("timestamp"))) == "2020-01-02"
    assert one(review.claim_repository(F.lit(""), F.lit("https://x.example/o/r/pull/5"))) == "o/r"
    assert one(review.section(F.lit("a\n## 修改内容\nb\nc\n## z\nd"), "修改内容")) == "b\nc"
    assert one(review.size_error(F.lit(5), 4)) == "too large"
    branches = spark.createDataFrame([("t/1",), ("t/2",), ("t/3",), ("m",)], "branch string")
    pulls = spark.createDataFrame([("t/1", "closed"), ("t/1", "closed"), ("t/2", "open"), ("t/2", "closed"), ("m", "closed")], "branch string, state string")
    assert [r["branch"] for r in review.closed_temporaries(branches, pulls, ["branch"], "^t/").collect()] == ["t/1"]
    issues = spark.createDataFrame([('<!-- conflict:{"archive_id":3} -->', "open"), ('<!-- conflict:{"archive_id":4} -->', "open"), ("x", "open")], "body string, state string")
    assert [r["archive_id"] for r in review.issues_to_close(issues, [3]).collect()] == [3]
    assert review.issues_to_close(issues, None).count() == 2
    counts = review.change_summary(F.lit(2), F.lit(0), F.lit(True), F.array(F.lit("标题")))
    assert one(counts) == ["正文段落 2 处", "描述", "标题"]


def test_exactly_one_counts_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "k int, v string")
    got = {r["v"]: (r["matches"], r["error"]) for r in manifest.exactly_one(df, ["k"]).collect()}
    assert got == {"a": (2, "2 matches"), "b": (2, "2 matches"), "c": (1, None), "d": (2, "2 matches"), "e": (2, "2 matches")}

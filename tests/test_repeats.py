"""Queries on tables in which urls come more than once."""

import pytest

from corpusloom import plans
from corpusloom.plans import composites
from corpusloom.sources import state

PAGES = [(0, "http://x.example/a/b?p=1", "aa"), (1, "http://x.example/a/b?p=1", "b"), (2, "http://x.example/a/b?p=2", "cc"), (3, "http://x.example/a/c", "d"), (4, "http://x.example/a/b?p=1", None)]


@pytest.fixture
def pages(spark, tmp_path):
    spark.createDataFrame(PAGES, "page_id bigint, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    return str(tmp_path)


def test_manifest_entries_of_repeated_urls(spark, pages):
    got = plans.QUERIES["manifest_entries"](spark, pages).collect()
    assert sorted((r["page_id"], r["url"], r["archive_id"], r["bytes"], r["profile"]) for r in got) == [
        (k, url, k, html and len(html), None if k % 2 else "v1") for k, url, html in PAGES
    ]


def test_manifest_rows_keep_their_manifest(spark):
    texts = spark.createDataFrame([(k, '{"files": {"u": {"path": "p%d"}, "v": {}}}' % k) for k in (1, 2)], "k int, value string")
    assert sorted((r["k"], r["url"], r["path"] or "") for r in state.manifest_rows(texts, keep=["k"]).collect()) == [(1, "u", "p1"), (1, "v", ""), (2, "u", "p2"), (2, "v", "")]
    assert "k" not in state.manifest_rows(texts).columns


def test_catalog_build_sizes_lines(spark, pages):
    """Pages 0, 1, 2 and 4 have one path; only every third page has a size."""
    got = {r["name"]: r["n"] for r in plans.QUERIES["catalog_build"](spark, pages).collect()}
    assert got == {"tree": 2, "repos": 1, "folders": 1, "fact": 5, "sized": 2, "browser_folders": 1, "browser_files": 1}


def test_sizes_of_paths_and_of_lines(spark):
    lines = spark.createDataFrame([(0, "r", "./x"), (1, "r", "x"), (2, "s", "x")], "record_id bigint, repo string, line string")
    sizes = spark.createDataFrame([(0, "r", "x", 5)], "record_id bigint, repo string, path string, size bigint")
    sized = lambda s: {r["record_id"]: r["size"] for r in composites.build_catalog(lines, s)["records"].collect()}
    assert sized(sizes) == {0: 5, 1: None, 2: None}
    assert sized(sizes.drop("record_id")) == {0: 5, 1: 5, 2: None}

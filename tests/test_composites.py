from pyspark.sql import functions as F

from corpusloom import plans
from corpusloom.operators import catalog, matching, requests
from corpusloom.plans import composites


def test_catalog_and_indexes(spark):
    lines = spark.createDataFrame([(0, "o/a", "./x/y.txt"), (1, "o/a", "x/z.pdf"), (2, "o/b", "q"), (3, "o/b", "# no")], "record_id bigint, repo string, line string")
    sizes = spark.createDataFrame([("o/a", "x/y.txt", 5), ("o/a", "x/z.pdf", 0)], "repo string, path string, size bigint")
    out = composites.build_catalog(lines, sizes)
    assert {r["record_id"]: r["size"] for r in out["records"].collect()} == {0: 5, 1: None, 2: None}
    assert [r["repo"] for r in out["repos"].orderBy("repo_id").collect()] == ["o/a", "o/b"]
    stems = spark.createDataFrame([("x/y",)], "stem string")
    index = composites.sync_indexes(out["records"], stems)
    assert {r["record_id"] for r in index["records"].where("has_txt").collect()} == {0}
    assert index["words"].where("term = 'x'").first()["postings"] == [0, 1]


def test_dense_number_by_ranges(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("k"), F.col("id").alias("tie"))
    out = catalog.dense_number(df, ["k", "tie"], "n", one_task_rows=100).collect()
    assert sorted(r["n"] for r in out) == list(range(1000)) and all(r["n"] == r["k"] for r in out)


def test_upstream_batches(spark):
    pulls = spark.createDataFrame([("r", n, "t", "proofread/a", "r", "main") for n in (1, 2, 3)], "repo string, number bigint, merged_at string, head_ref string, head_repo string, base_ref string")
    key = lambda *n: spark.createDataFrame([(f"r#{i}",) for i in n], "key string")
    out = composites.upstream_batches(pulls, key(1), key(9), key())
    assert [list(r["numbers"]) for r in out["groups"].collect()] == [[2, 3]]


def test_texts(spark):
    files = spark.createDataFrame([("a", bytearray("中文".encode("gb18030"))), ("b", bytearray(b"version https://git-lfs.x")), ("c", bytearray(b"x"))], "path string, content binary")
    existing = spark.createDataFrame([("a", bytearray(b"\xff\xff")), ("c", bytearray(b"x"))], "path string, content binary")
    assert {r["path"]: r["status"] for r in composites.publish_texts(files, existing).collect()} == {"a": "rewritten", "c": "existing"}


def test_request_errors(spark):
    base = {"request": 1, "source_start": 1, "source_end": 2, "title": "t", "authors": ["a"], "dates": [{"year": 1966, "month": 5, "day": None}], "is_range_date": False}
    base |= {"page_start": 1, "page_end": 2, "content": "c", "base_part_count": 1, "ocr": {"content_thresholds": [0.1, 0.0, 0.0, 0.0]}, "ocr_exceptions": {"2": {"content_thresholds": None}}}
    cases = [{}, {"title": "【文章待拆分】"}, {"page_end": 3}, {"authors": [" "]}, {"dates": [{"year": None, "month": 13, "day": None}]}, {"ocr": {"content_thresholds": [0.6, 0.5, 0.0, 0.0]}}, {"page_end": 1}]
    rows = [base | {"request": i} | c for i, c in enumerate(cases)]
    schema = "request int, source_start int, source_end int, " + requests.ARTICLE
    got = {r["request"]: r["error"] for r in requests.request_errors(spark.createDataFrame(rows, schema)).collect()}
    assert got == {0: None, 1: "invalid title", 2: "pages outside the source", 3: "invalid authors", 4: "invalid date", 5: "invalid crop", 6: "invalid exception page"}


def test_search_pieces(spark):
    got = spark.range(1).select(matching.search_pieces(F.lit("abcdef")).alias("p")).first()["p"]
    assert got == ["abcdef", "abcd", "bcde", "cdef", "ab", "cd", "ef"]


def test_every_query_runs(spark, sf):
    for name, query in plans.QUERIES.items():
        assert query(spark, sf).schema.names, name


def test_entry_without_llm():
    """The entry module imports without the corpus-preparation parts."""
    import subprocess
    import sys

    code = "import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert 'path_rollup' in e.queries() and not any(n.startswith('op') for n in e.queries() if n[2:3].isdigit())"
    subprocess.run([sys.executable, "-c", code], check=True)

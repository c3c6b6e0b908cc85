import gzip
import json
import os

from corpusloom.functions.udfs import varint
from corpusloom.sources import payload, sinks, state


def test_json_twins(spark, tmp_path):
    path = str(tmp_path / "x.json")
    sinks.write_json_gz(spark, path, {"a": "中"})
    with open(path, "rb") as f:
        assert f.read() == '{"a":"中"}'.encode()
    with gzip.open(path + ".gz") as f:
        assert json.load(f) == {"a": "中"}


def test_first_pages(spark, tmp_path):
    rows = [(i, f"o/r{i % 2}", f"f{i}", "txt", ["a"], i, False) for i in range(250)]
    urls = sinks.write_first_pages(spark, str(tmp_path), spark.createDataFrame(rows, payload.RECORD))
    assert urls == [f"/data/initial/{x}.json" for x in ("global", "repos/r0", "repos/r1")]
    with open(tmp_path / "initial/repos/r1.json") as f:
        page = json.load(f)
    assert {k: v for k, v in page.items() if k != "results"} == {"version": 2, "mode": "repo", "repo": "o/r1", "sort": "relevance", "page": 1, "page_size": 100, "total": 125}
    assert len(page["results"]) == 100
    assert page["results"][0] == {"Repo": "o/r1", "File": "f1", "Extension": "txt", "Folder": ["a"], "Size": 1, "HasTxt": False}
    with open(tmp_path / "initial/global.json") as f:
        assert json.load(f)["total"] == 250


def test_generations(spark, tmp_path):
    root = str(tmp_path / "gen")
    for i in range(3):
        sinks.publish_generation(spark, root, f"g{i}", {"t": spark.range(i)}, {"n": i})
        os.utime(f"{root}/g{i}", (i + 1, i + 1))
    with open(f"{root}/current.json") as f:
        assert json.load(f) == {"generation": "g2"}
    assert sorted(x for x in os.listdir(root) if x.startswith("g")) == ["g1", "g2"]


def test_tree(spark):
    df = spark.createDataFrame([("b/x10",), ("b/x9",), ("a",), (".h/y",)], "path string")
    assert sinks.tree_lines(df) == ["├── a", "└── b", "    ├── x9", "    └── x10"]


def test_index_bytes():
    assert sinks.index_bytes([("b", [3]), ("a", [0, 2])]) == varint(2) + b"\x01a\x02\x02\x00\x02" + b"\x01b\x01\x01\x03"


def test_index_file(spark, tmp_path):
    path = str(tmp_path / "x.bin.gz")
    postings = spark.createDataFrame([("ab", [1, 3])], "term string, postings array<bigint>")
    sinks.write_index(spark, path, postings, b"d" * 32, 5, width=2)
    with gzip.open(path) as f:
        assert f.read() == b"VNG3\x02" + b"d" * 32 + b"\x05" + b"\x01\x02ab\x02\x02\x01\x02"


def test_state(spark, tmp_path):
    path = str(tmp_path / "state.json")
    schema = "version int, name string"
    assert state.read_state(spark, path, schema).isEmpty()
    assert state.read_state(spark, path, schema, required=True) is None
    sinks.save_state(spark, path, {"version": 1, "name": "x"})
    assert state.read_state(spark, path, schema, version=1).first()["name"] == "x"


def test_segments(spark):
    import hashlib

    segments = spark.createDataFrame([("a", 1, "界"), ("a", 0, "世"), ("b", 0, "x")], "request string, position int, chunk string")
    digest = hashlib.sha256("世界".encode()).hexdigest()
    headers = spark.createDataFrame([("a", 2, digest), ("b", 1, "0"), ("c", 1, "0")], "request string, length int, sha256 string")
    got = {r["request"]: (r["payload"], r["error"]) for r in state.joined_segments(segments, headers).collect()}
    assert got == {"a": ("世界", None), "b": (None, "wrong digest"), "c": (None, "no segments")}

"""Registered queries that write files in the shared folder and read them again."""

from __future__ import annotations

import io
import json
import sqlite3
import tarfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import udfs, udtfs
from ..operators import catalog
from ..sources import databases, listing, members, paged, payload, sinks, state
from . import composites
from .base import PAGE_RECORDS, page_records, scratch, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def with_records(sql: str) -> str:
    return f"WITH {PAGE_RECORDS} {sql}"


@query(with_records("SELECT row_number() OVER (ORDER BY record_id) - 1 AS line_no, path FROM records"))
def read_listings(spark: SparkSession, sf: str) -> DataFrame:
    """A listing written as one file and read with the numbers of its lines."""
    folder = scratch(spark)
    lines = page_records(spark, sf).orderBy("record_id").select("path")
    lines.coalesce(1).write.text(f"{folder}/listing")
    return listing.read_listing(spark, f"{folder}/listing", "r").where("line <> ''").select("line_no", F.col("line").alias("path"))


@query("SELECT n_nationkey AS number, n_name AS name, n_nationkey < 10 AS kept, 2 AS version FROM nation")
def state_files(spark: SparkSession, sf: str) -> DataFrame:
    """States written in one step and read again: the last one counts, a missing one is empty or none."""
    folder = scratch(spark)
    rows = [r.asDict() for r in table(spark, sf, "nation").collect()]  # a state file is one small value
    for version in (1, 2):
        sinks.save_state(spark, f"{folder}/state.json", {"version": version, "items": [{"number": r["n_nationkey"], "name": r["n_name"]} for r in rows]})
    kind = "version int, items array<struct<number:int,name:string>>"
    got = state.read_state(spark, f"{folder}/state.json", kind, version=2)
    sinks.write_bytes(spark, f"{folder}/broken.json", b"{")
    none = state.read_state(spark, f"{folder}/none.json", kind, required=True)
    empty = state.read_state(spark, f"{folder}/broken.json", kind).unionByName(state.read_state(spark, f"{folder}/none.json", kind))
    every = got.unionByName(empty).select("version", F.explode("items").alias("i"))
    return every.select("i.number", "i.name", (F.col("i.number") < (10 if none is None else 0)).alias("kept"), "version")


@query(with_records("SELECT row_number() OVER (ORDER BY record_id) - 1 AS record_id, repo, array_to_string(folder, '|') AS folder, file, extension, size, record_id % 2 = 0 AS has_txt FROM records"))
def payload_files(spark: SparkSession, sf: str) -> DataFrame:
    """Records through the payload's JSON file, and through its parts written by the executors."""
    folder = scratch(spark)
    records = page_records(spark, sf).withColumn("has_txt", F.col("record_id") % 2 == 0)
    sinks.write_json_gz(spark, f"{folder}/payload.json", json.loads(payload.encode_json(records)))
    text = spark.read.text(f"{folder}/payload.json.gz", wholetext=True)
    return payload.decode_json(spark, text).select("record_id", "repo", F.array_join("folder", "|").alias("folder"), "file", "extension", "size", "has_txt")


@query(with_records("SELECT repo, file, extension, array_to_string(folder, '|') AS folder, CAST(NULL AS BIGINT) AS size, FALSE AS has_txt, 'a' AS folders, '' AS files FROM records"))
def listed_records(spark: SparkSession, sf: str) -> DataFrame:
    """Result rows with defaults from a plain list under long and short keys; browser entries under either."""
    records = page_records(spark, sf)
    long = F.struct("repo", "file", "extension", "folder")
    short = F.struct(F.col("repo").alias("r"), F.col("file").alias("f"), F.col("extension").alias("e"), F.col("folder").alias("d"))
    texts = records.select(F.when(F.col("record_id") % 2 == 0, F.to_json(F.array(long))).otherwise(F.to_json(F.array(short))).alias("value"))
    rows = payload.trim_columns(payload.decode_list(texts))
    kind = "struct<folders:array<string>,d:array<string>,files:array<string>,f:array<string>>"
    entry = payload.normalized_entry(F.from_json(F.when(F.length("file") % 2 == 0, '{"d":["a"]}').otherwise('{"folders":["a"],"files":[]}'), kind))
    return rows.select(
        "repo", "file", "extension", F.array_join("folder", "|").alias("folder"), "size", "has_txt", F.array_join(entry["folders"], ",").alias("folders"), F.array_join(entry["files"], ",").alias("files")
    )


@query(with_records("SELECT repo, record_id, path, size FROM records"))
def written_pages(spark: SparkSession, sf: str) -> DataFrame:
    """All records by repo as files, read again."""
    folder = scratch(spark)
    sinks.write_pages(page_records(spark, sf).select("repo", "record_id", "path", "size"), f"{folder}/pages")
    return spark.read.schema("record_id bigint, path string, size bigint, repo string").json(f"{folder}/pages").select("repo", "record_id", "path", "size")


@query(
    with_records(
        """, r AS (SELECT repo, count(*) AS n FROM records WHERE repo <> '' GROUP BY repo)
SELECT 'page' AS kind, repo, n AS total, least(n, 100) AS shown FROM r UNION ALL SELECT 'page', '', (SELECT count(*) FROM records), least((SELECT count(*) FROM records), 100)
UNION ALL SELECT 'sidebar', repo, n, (SELECT count(*) FROM records x WHERE x.repo = r.repo AND len(folder) = 0) FROM r"""
    )
)
def page_files(spark: SparkSession, sf: str) -> DataFrame:
    """First pages and sidebar entries as files, with the rows that each shows."""
    folder = scratch(spark)
    records = page_records(spark, sf)
    sinks.write_first_pages(spark, folder, records)
    sinks.write_sidebars(spark, folder, records)
    pages = spark.read.schema("repo string, total bigint, results array<string>").json([f"{folder}/initial/global.json", f"{folder}/initial/repos/*.json"])
    pages = pages.select(F.lit("page").alias("kind"), F.coalesce("repo", F.lit("")).alias("repo"), "total", F.size("results").cast("bigint").alias("shown"))
    entries = spark.read.schema("repo string, files array<string>").json(f"{folder}/sidebar/repos/*.json")
    totals = spark.read.schema("repos array<struct<name:string,count:bigint>>").json(f"{folder}/sidebar/global.json").select(F.explode("repos").alias("t")).select("t.name", "t.count")
    bars = entries.join(totals, F.col("repo") == F.col("name")).select(F.lit("sidebar").alias("kind"), "repo", F.col("count").alias("total"), F.size("files").cast("bigint").alias("shown"))
    return pages.unionByName(bars)


@query(
    with_records(
        """, d AS (SELECT repo, folder, unnest(range(0, len(folder) + 1)) AS depth FROM records)
SELECT repo, count(*) AS n_files, (SELECT count(DISTINCT folder[1:depth]) FROM d WHERE d.repo = records.repo) AS n_folders FROM records GROUP BY repo"""
    )
)
def tree_texts(spark: SparkSession, sf: str) -> DataFrame:
    """The nested tree of each repo as one JSON text, written where its rows are: files at the root, folders in all."""
    texts = sinks.tree_texts(catalog.folder_tree(page_records(spark, sf)))
    return texts.select("repo", F.get_json_object("tree", "$[0].c").cast("bigint").alias("n_files"), F.regexp_count("tree", F.lit('"n":')).cast("bigint").alias("n_folders"))


@query(
    """WITH g AS (SELECT DISTINCT item_id, substr(text, i, 2) AS term FROM (SELECT item_id, text, unnest(range(1, length(text))) AS i FROM benchmark))
SELECT term, count(*) AS doc_freq, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS postings FROM g GROUP BY term"""
)
def index_segments(spark: SparkSession, sf: str) -> DataFrame:
    """A binary index in segments by ranges of terms, each written in its own task, and read again."""
    from ..operators import index

    rows = index.posting_rows(table(spark, sf, "benchmark"), index.ngrams(F.col("text"), 2), "item_id")
    folder = scratch(spark)
    sinks.index_segments(rows).write.parquet(f"{folder}/index")
    out = sinks.read_segments(spark.read.parquet(f"{folder}/index"))
    return out.groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq"), F.array_join(F.array_sort(F.collect_list("id")), ",").alias("postings"))


@query("SELECT 'g' || n_regionkey || '/' || n_name AS stem FROM nation")
def text_stems(spark: SparkSession, sf: str) -> DataFrame:
    """Text files below a folder by their paths; other files don't count."""
    folder = scratch(spark)
    for r in table(spark, sf, "nation").collect():  # 25 files
        sinks.write_bytes(spark, f"{folder}/t/g{r['n_regionkey']}/{r['n_name']}.txt", b"x")
        sinks.write_bytes(spark, f"{folder}/t/g{r['n_regionkey']}/{r['n_name']}.pdf", b"x")
    return members.scan_stems(spark, f"{folder}/t")


@query("SELECT n_nationkey AS member_order, 'd/' || n_name AS path, n_name AS content, n_nationkey % 4 = 0 AS unsafe FROM nation WHERE n_nationkey % 5 > 0")
def archive_members(spark: SparkSession, sf: str) -> DataFrame:
    """Members of a compressed archive, by file and by table function; those outside of it are left out."""
    rows = sorted((r["n_nationkey"], r["n_name"]) for r in table(spark, sf, "nation").collect())  # one small archive
    folder = scratch(spark)
    sinks.write_bytes(spark, f"{folder}/a.tar.gz", _tar([(f"top/../{name}" if key % 5 == 0 else f"top/d/{name}", name.encode()) for key, name in rows]))
    found = members.read_archives(spark, f"{folder}/*.tar.gz").select("member_order", "path", "content")
    udtfs.register(spark)
    spark.read.format("binaryFile").load(f"{folder}/a.tar.gz").createOrReplaceTempView("corpusloom_archive")
    again = spark.sql("SELECT t.member_order, t.path AS again FROM corpusloom_archive a, LATERAL tar_members(a.content) t")
    key = F.col("member_order")
    unsafe = F.when(key % 4 == 0, members.unsafe_member("a/../b", False)).otherwise(members.unsafe_member("a/b", False) or members.unsafe_member("top/x", False))
    joined = found.join(again, (found["member_order"] == again["member_order"]) & (F.col("path") == F.col("again"))).drop(again["member_order"])
    return joined.select("member_order", "path", "content", unsafe.alias("unsafe"))


def _tar(files: list[tuple[str, bytes]]) -> bytes:
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as archive:
        for name, data in files:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            archive.addfile(info, io.BytesIO(data))
    return out.getvalue()


@query(
    """WITH a AS (SELECT n_regionkey AS archive_id, n_nationkey AS k FROM nation),
f AS (SELECT archive_id, 'empty_title' AS issue FROM a WHERE k % 2 = 0 UNION ALL SELECT archive_id, 'author_many_slashes' FROM a WHERE k % 3 = 0 UNION ALL SELECT archive_id, 'orphan_article' FROM a WHERE k % 5 = 0)
SELECT issue, archive_id, count(*) AS n FROM f GROUP BY GROUPING SETS ((issue, archive_id), (issue))"""
)
def audited_archives(spark: SparkSession, sf: str) -> DataFrame:
    """The counts of an audit of archive files, one for each region with an article for each nation."""
    folder = scratch(spark)
    rows = [(r["n_regionkey"], r["n_nationkey"]) for r in table(spark, sf, "nation").collect()]  # 25 rows
    for region in sorted({a for a, _ in rows}):
        files = [("top/s/v/x.metadata", b"{}")]
        for k in (k for a, k in rows if a == region):
            article = {"title": "" if k % 2 == 0 else "t", "authors": ["a/b/c/d" if k % 3 == 0 else "a"], "parts": [{"text": "x"}]}
            files.append((f"top/s/{'none' if k % 5 == 0 else 'v'}/m/{k}.json", sinks.compact_json(article)))
        sinks.write_bytes(spark, f"{folder}/archive-{region}.tar.gz", _tar(files))
    number = F.regexp_extract("archive", r"archive-(\d+)\.", 1).cast("int")
    return composites.audit_archives(spark, f"{folder}/*.tar.gz", number)["counts"]


@query("SELECT n_nationkey AS number, n_name AS name FROM nation")
def landed_listings(spark: SparkSession, sf: str) -> DataFrame:
    """A paginated listing that has been landed, ten rows a page."""
    folder = scratch(spark)
    rows = [{"number": r["n_nationkey"], "name": r["n_name"]} for r in table(spark, sf, "nation").orderBy("n_nationkey").collect()]  # 25 rows
    for page in range(3):
        sinks.write_bytes(spark, f"{folder}/{page + 1}.json", sinks.compact_json(rows[page * 10 : page * 10 + 10]))
    paged.register(spark)
    local = folder.removeprefix("file://").removeprefix("file:")
    return spark.read.format("landed_pages").schema("number int, name string").option("path", local).option("per_page", 10).option("pages_per_task", 1).load()


@query("SELECT 'g2' AS generation, 'g1' AS kept, count(*) AS n, 'g0' AS dropped FROM nation")
def published_generations(spark: SparkSession, sf: str) -> DataFrame:
    """Generations published one after the other: the pointer names the last, the oldest is dropped, and an older one can be named again."""
    root, nation = scratch(spark), table(spark, sf, "nation")
    dropped = []
    for k in range(3):
        name, stale = composites.publish_index(spark, root, {"nation": nation}, {"nation": nation.count()}, [f"g{k}"])
        dropped += stale
    current = spark.read.schema("generation string").json(f"{root}/current.json")
    rows = spark.read.parquet(f"{root}/{name}/nation").agg(F.count(F.lit(1)).alias("n"))
    kept = spark.read.schema("format int").json(f"{root}/g1/manifest.json").select(F.lit("g1").alias("kept"))
    return current.crossJoin(F.broadcast(kept)).crossJoin(F.broadcast(rows)).withColumn("dropped", F.lit(",".join(dropped)))  # one row each


@query("SELECT 'u' || n_nationkey AS url, CAST(n_regionkey AS INTEGER) AS archive_id, 'p' || n_nationkey AS path FROM nation WHERE n_nationkey % 3 > 0")
def committed_manifests(spark: SparkSession, sf: str) -> DataFrame:
    """A manifest after files were added and removed, written last, read as rows; and the next snapshot beside it."""
    folder = scratch(spark)
    rows = [(r["n_nationkey"], r["n_regionkey"]) for r in table(spark, sf, "nation").collect()]  # 25 rows
    entry = lambda k, a: {"archive_id": a, "path": f"p{k}"}
    old = {f"u{k}": entry(k, a) for k, a in rows if k % 2 == 0}
    sinks.commit_manifest(spark, f"{folder}/manifest.json", old, {f"u{k}": entry(k, a) for k, a in rows}, [f"u{k}" for k, _ in rows if k % 3 == 0])
    got = state.manifest_rows(spark.read.text(f"{folder}/manifest.json", wholetext=True)).select("url", "archive_id", "path")
    return spark.read.parquet(sinks.next_snapshot(got, f"{folder}/state", 1))


@query("SELECT n, line FROM (VALUES (0, '├── a1'), (1, '│   ├── x2.txt'), (2, '│   └── x10.txt'), (3, '└── a10'), (4, '    └── b'), (5, 'done=true'), (6, 'n=25')) t(n, line)")
def drawn_trees(spark: SparkSession, sf: str) -> DataFrame:
    """A folder tree drawn in natural order, and output lines.  The tree is a literal one: its drawing is what counts."""
    paths = spark.createDataFrame([(p,) for p in ("a10/b", "a1/x10.txt", "a1/x2.txt", ".hidden/y", "a1/skip/z")], "path string")
    lines = sinks.tree_lines(paths, ("skip",)) + sinks.output_lines({"done": True, "n": table(spark, sf, "nation").count()}).splitlines()
    return spark.createDataFrame([*enumerate(lines)], "n int, line string")


@query("SELECT n_nationkey % 3 AS file, 'ok' AS integrity, 'v1' AS setting, count(*) AS documents, CASE WHEN n_nationkey % 3 = 2 THEN 'unexpected rows in documents' END AS error FROM nation GROUP BY ALL UNION ALL SELECT 3, 'broken', NULL, 0, 'integrity'")
def database_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Database files: sound or not, how many rows, and whether as many as expected."""
    rows = [(r["n_nationkey"], r["n_name"]) for r in table(spark, sf, "nation").collect()]  # three small files
    files = []
    for k in range(3):
        with sqlite3.connect(":memory:") as c:
            c.execute("CREATE TABLE documents (id, name)")
            c.execute("CREATE TABLE metadata (key, value)")
            c.execute("INSERT INTO metadata VALUES ('tokenizer_version', 'v1')")
            c.executemany("INSERT INTO documents VALUES (?, ?)", [r for r in rows if r[0] % 3 == k])
            c.commit()
            files.append((f"{k}", bytearray(c.serialize())))
    files.append(("3", bytearray(b"SQLite format 3\0" + b"\1" * 200)))
    reports = databases.inspect_databases(spark.createDataFrame(files, "path string, content binary"), ["documents", "none"], "tokenizer_version")
    expected = spark.createDataFrame([(f"{k}", len([r for r in rows if r[0] % 3 == k]) + (k == 2)) for k in range(4)], "path string, documents bigint")
    out = databases.database_errors(reports, expected, "v1", ["documents"], [])
    return out.select(
        F.col("path").cast("int").alias("file"), F.when(F.col("integrity") == "ok", "ok").otherwise("broken").alias("integrity"), "setting",
        F.coalesce(F.try_element_at("counts", F.lit("documents")), F.lit(0)).alias("documents"), F.regexp_replace("error", "^integrity: .*", "integrity").alias("error"),
    )


@query("SELECT event_type, strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1, 2")
def streamed_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Events counted in windows of a day as a stream that takes in what is there and stops."""
    from ..streaming import changes

    folder = scratch(spark)
    events = table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    events.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{folder}/in")
    counted = changes.counted_events(stream, "ts", "1 day", "10 years", ["event_type"])
    run = counted.writeStream.outputMode("update").foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{folder}/out/batch={n}"))
    run.option("checkpointLocation", f"{folder}/check").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.parquet(f"{folder}/out").groupBy("event_type", F.date_format("window.start", "yyyy-MM-dd").alias("day"))
    return out.agg(F.max_by("n", "batch").alias("n"))


@query(
    """WITH e AS (SELECT o_custkey, o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'merge' WHEN 'O' THEN 'claim' ELSE 'close' END AS event FROM orders),
m AS (SELECT o_custkey, min(o_orderkey) FILTER (event = 'merge') AS merged, arg_max(event, o_orderkey) AS last, count(*) AS n FROM e GROUP BY 1)
SELECT CAST(o_custkey AS VARCHAR) AS key, CASE WHEN merged IS NOT NULL THEN 'published' WHEN last = 'claim' THEN 'claimed' ELSE 'released' END AS outcome, n FROM m"""
)
def streamed_claims(spark: SparkSession, sf: str) -> DataFrame:
    """The state of each key after its events, kept by key as a stream."""
    from ..streaming import changes

    folder = scratch(spark)
    event = F.when(F.col("o_orderstatus") == "F", "merge").when(F.col("o_orderstatus") == "O", "claim").otherwise("close")
    events = table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("key"), event.alias("event"), F.col("o_orderkey").alias("order"))
    events.write.parquet(f"{folder}/in")
    states = changes.claim_states(spark.readStream.schema(events.schema).parquet(f"{folder}/in"))
    run = states.writeStream.outputMode("update").foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{folder}/out/batch={n}"))
    run.option("checkpointLocation", f"{folder}/check").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.parquet(f"{folder}/out")
    return out.groupBy("key").agg(F.max_by(F.struct("outcome", "n"), "batch").alias("s")).select("key", "s.outcome", "s.n")


@query("SELECT p_partkey, p_name, CAST(CASE WHEN p_partkey % 4 = 0 THEN 2 ELSE 1 END AS BIGINT) AS builds FROM part")
def streamed_rebuilds(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots as batches of a stream: a key is rebuilt when it is new or has changed."""
    from ..streaming import changes

    folder = scratch(spark)
    parts = table(spark, sf, "part")
    before = parts.select("p_partkey", F.when(F.col("p_partkey") % 4 == 0, "old").otherwise(F.col("p_name")).alias("p_name"), F.lit(1).alias("ts"))
    after = parts.select("p_partkey", "p_name", F.lit(2).alias("ts"))
    for rows in (before, after):  # two batches, one after the other
        rows.write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(before.schema).parquet(f"{folder}/in")
        run = changes.changed_keys(stream, f"{folder}/snapshot", ["p_partkey"], ["p_name"], lambda df, n: df.write.mode("overwrite").parquet(f"{folder}/built/n={n}"))
        run.option("checkpointLocation", f"{folder}/check").trigger(availableNow=True).start().awaitTermination()
    built = spark.read.parquet(f"{folder}/built")
    return built.groupBy("p_partkey").agg(F.max_by("p_name", "n").alias("p_name"), F.count(F.lit(1)).alias("builds"))


@query("SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 7 WHEN 1 THEN 5 END AS width, CASE n_nationkey % 3 WHEN 0 THEN 9 WHEN 1 THEN 6 END AS height FROM nation")
def image_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes from the headers of images; other bytes have none."""
    png = bytes([0x89]) + b"PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + bytes([0, 0, 0, 7, 0, 0, 0, 9])
    jpeg = bytes([0xFF, 0xD8, 0xFF, 0xC0, 0, 11, 8, 0, 6, 0, 5, 1, 1])
    data = F.get(F.array(F.lit(png), F.lit(jpeg), F.lit(b"none")), (F.col("n_nationkey") % 3).cast("int"))
    return table(spark, sf, "nation").select("n_nationkey", udfs.image_size_udf(data).alias("s")).select("n_nationkey", "s.width", "s.height")

"""Sinks: reproducible files, pages per repo, the binary index, generations and state.

Small single files are written by the driver through Spark's file system, so paths may be
remote; everything that grows goes through distributed writers.
"""

from __future__ import annotations

import gzip
import hashlib
import json
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.udfs import varint, varint_decode, varint_postings
from ..operators.catalog import first_page

#: The beginnings of index files, the version of page files, their rows, and the size above which a text is stored as a large file.
NGRAM_MAGIC, WORD_MAGIC = b"VNG3", b"VWI2"
VERSION, PAGE = 2, 100
LARGE_FILE = 10 << 20


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Write a file under another name first, then move it into place in one step: a reader finds the old one or the new one."""
    jvm, where, fs = _path(spark, path)
    part = jvm.org.apache.hadoop.fs.Path(path + ".part")
    out = fs.create(part, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    overwrite = spark.sparkContext._gateway.new_array(kind, 1)
    overwrite[0] = kind.OVERWRITE
    context.rename(part, where, overwrite)


def compact_json(value) -> bytes:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":")).encode()


def write_json_gz(spark: SparkSession, path: str, value) -> None:
    """Compact JSON and its compressed twin, the same bytes for the same value."""
    data = compact_json(value)
    write_bytes(spark, path, data)
    write_bytes(spark, path + ".gz", gzip.compress(data, 9, mtime=0))


def save_state(spark: SparkSession, path: str, state: dict) -> None:
    """A state file with sorted keys, replaced in one step."""
    write_bytes(spark, path, (json.dumps(state, ensure_ascii=False, indent=2, sort_keys=True) + "\n").encode())


def page_name(repo: str) -> str:
    """The file of a repo's page: its last part, quoted; repos with the same last part share it."""
    return quote(repo.rsplit("/", 1)[-1], safe="") + ".json"


def _result(repo: str, row: dict) -> dict:
    """A result row under its long keys; a missing size is the empty text."""
    size = "" if row["size"] is None else row["size"]
    return {"Repo": repo, "File": row["file"], "Extension": row["extension"], "Folder": list(row["folder"] or []), "Size": size, "HasTxt": row["has_txt"]}


def _page(repo: str | None, total: int, results: list[dict], page: int) -> dict:
    head = {"version": VERSION, "mode": "repo" if repo else "global", "repo": repo, "sort": "relevance"}
    return head | {"page": 1, "page_size": page, "total": total, "results": results}


def write_first_pages(spark: SparkSession, folder: str, records: DataFrame, order_col: str = "record_id", page: int = PAGE, prefix: str = "/data") -> list[str]:
    """The first page of all records and of every repo, and a manifest of their addresses, which are returned."""
    columns = ["repo", "file", "extension", "folder", "size", "has_txt"]
    rows = records.select(order_col, *columns)
    every = [_result(r["repo"], r.asDict()) for r in rows.orderBy(order_col).limit(page).collect()]
    write_bytes(spark, f"{folder}/initial/global.json", compact_json(_page(None, records.count(), every, page)))
    urls = [f"{prefix}/initial/global.json"]
    top = first_page(rows.where(F.col("repo") != ""), order_col, ["repo"], page)
    files = top.groupBy("repo").agg(F.max("total").alias("total"), F.array_sort(F.collect_list(F.struct("place", *columns[1:]))).alias("results"))
    for row in files.orderBy("repo").toLocalIterator():
        repo = row["repo"]
        results = [_result(repo, r.asDict()) for r in row["results"]]
        write_bytes(spark, f"{folder}/initial/repos/{page_name(repo)}", compact_json(_page(repo, row["total"], results, page)))
        urls.append(f"{prefix}/initial/repos/{page_name(repo)}")
    write_bytes(spark, f"{folder}/initial/manifest.json", compact_json({"version": VERSION, "urls": urls}))
    return urls


def nested_tree(tree: DataFrame) -> dict[str, list[dict]]:
    """By repo, the folder tree as nested nodes under short keys (n name, c count, df direct files, ch children), by name."""
    nodes: dict[tuple, dict] = {}
    roots: dict[str, list[dict]] = {}
    for r in tree.orderBy("depth", "repo", "name").toLocalIterator():  # parents come before their children
        node = {"n": r["name"], "c": r["n_files"], "df": r["has_direct"], "ch": []}
        nodes[r["repo"], r["depth"], r["path"]] = node
        above = roots.setdefault(r["repo"], []) if r["depth"] == 0 else nodes[r["repo"], r["depth"] - 1, r["parent_path"]]["ch"]
        above.append(node)
    return roots


def tree_texts(tree: DataFrame) -> DataFrame:
    """(repo, tree): the nested tree of each repo as JSON text, put together in a task per repo."""

    def one(nodes: pd.DataFrame) -> pd.DataFrame:
        made: dict[tuple, dict] = {}
        roots: list[dict] = []
        for r in nodes.sort_values(["depth", "name"]).itertuples():  # parents come before their children
            node = {"n": r.name, "c": int(r.n_files), "df": bool(r.has_direct), "ch": []}
            made[r.depth, r.path] = node
            (made[r.depth - 1, r.parent_path]["ch"] if r.depth else roots).append(node)
        return pd.DataFrame({"repo": [nodes["repo"].iloc[0]], "tree": [compact_json(roots).decode()]})

    columns = ["repo", "path", "parent_path", "name", "depth", "n_files", "has_direct"]
    return tree.select(*columns).groupBy("repo").applyInPandas(one, "repo string, tree string")


def _folder_item(x) -> dict:
    return {"n": x["name"], "c": x["n_files"]}


def _file_item(x) -> dict:
    return {"n": x["file"], "e": x["extension"], "t": x["has_txt"], "s": "" if x["size"] is None else x["size"]}


def nested_browser(records: DataFrame) -> dict[str, dict[str, dict]]:
    """By repo and path, the folder and file items under short keys (d folders, f files)."""
    from ..operators.catalog import browser_files, browser_folders

    both = browser_folders(records).join(browser_files(records), ["repo", "path"], "full")
    out: dict[str, dict[str, dict]] = {}
    for r in both.orderBy("repo", "path").toLocalIterator():
        entry = {"d": [_folder_item(x) for x in r["folders"] or []], "f": [_file_item(x) for x in r["files"] or []]}
        out.setdefault(r["repo"], {})[r["path"]] = entry
    return out


def write_sidebars(spark: SparkSession, folder: str, records: DataFrame, prefix: str = "/data") -> list[str]:
    """All repos' counts, the root entry of every repo, and a manifest of their addresses, which are returned."""
    from ..operators.catalog import browser_files, browser_folders, sidebar_counts

    root = F.col("path") == ""
    counts = sidebar_counts(records)
    entries = counts.join(browser_folders(records).where(root).drop("path"), "repo", "left").join(browser_files(records).where(root).drop("path"), "repo", "left")
    totals, urls = [], [f"{prefix}/sidebar/global.json"]
    for r in entries.orderBy("repo").toLocalIterator():
        entry = {"repo": r["repo"], "path": "", "folders": [_folder_item(x) for x in r["folders"] or []], "files": [_file_item(x) for x in r["files"] or []]}
        write_bytes(spark, f"{folder}/sidebar/repos/{page_name(r['repo'])}", compact_json(entry))
        totals.append({"name": r["repo"], "count": r["n"]})
        urls.append(f"{prefix}/sidebar/repos/{page_name(r['repo'])}")
    write_bytes(spark, f"{folder}/sidebar/global.json", compact_json({"repos": totals}))
    write_bytes(spark, f"{folder}/sidebar/manifest.json", compact_json({"version": VERSION, "urls": urls}))
    return urls


def next_snapshot(df: DataFrame, folder: str, version: int) -> str:
    """Write a candidate snapshot beside the present one; whoever accepts it moves the pointer."""
    path = f"{folder}/v{version + 1}"
    df.write.mode("errorifexists").parquet(path)
    return path


def write_pages(records: DataFrame, folder: str) -> None:
    """All records by repo, as JSON lines written by the executors."""
    records.write.mode("overwrite").partitionBy("repo").json(folder)


def stream_digest(df: DataFrame, fields: list[str], order_col: str) -> bytes:
    """The digest of all rows in order, every field ended by a zero byte; rows pass the driver one by one."""
    digest = hashlib.sha256()
    for row in df.select(order_col, *fields).orderBy(order_col).toLocalIterator():
        for name in fields:
            digest.update((row[name] or "").encode() + b"\0")
    return digest.digest()


def index_bytes(terms: Iterable[tuple[str, list[int]]]) -> bytes:
    """Sorted terms with their postings: counts and lengths as varints, ids as gaps."""
    rows = sorted(terms)
    out = bytearray(varint(len(rows)))
    for term, ids in rows:
        name, data = term.encode(), varint_postings(ids)
        out += varint(len(name)) + name + varint(len(ids)) + varint(len(data)) + data
    return bytes(out)


SEGMENT = "first string, last string, n_terms bigint, data binary"


def index_segments(rows: DataFrame, most: int = 8 << 20) -> DataFrame:
    """The index of posting rows (term, id) as segments by ranges of terms: each holds sorted terms with gaps of ids, as ``index_bytes``.

    A task makes the segments of its own range as rows stream by; no term list, and no list
    of a frequent term, is held whole: a term goes on in the next segment after ``most`` bytes.
    """
    dealt = rows.select("term", F.col("id").cast("bigint").alias("id")).distinct().repartitionByRange("term", "id").sortWithinPartitions("term", "id")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms: list[tuple[str, list[int]]] = []
        size = 0

        def made() -> pd.DataFrame:
            values = [(terms[0][0], terms[-1][0], len(terms), index_bytes(terms))]
            return pd.DataFrame(values, columns=["first", "last", "n_terms", "data"])

        for frame in frames:
            for term, number in zip(frame["term"], frame["id"], strict=True):
                if not terms or terms[-1][0] != term:
                    terms.append((term, []))
                    size += len(term)
                terms[-1][1].append(number)
                size += 4
                if size >= most:
                    yield made()
                    terms, size = [], 0
        if terms:
            yield made()

    return dealt.mapInPandas(run, SEGMENT)


def segment_rows(data: bytes) -> Iterator[tuple[str, int]]:
    """(term, id) of ``index_bytes``."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    for _ in range(number()):
        size = number()
        term, at = data[at : at + size].decode(), at + size
        number()
        size = number()
        for i in varint_decode(data[at : at + size]):
            yield term, i
        at += size


def read_segments(segments: DataFrame) -> DataFrame:
    """The posting rows (term, id) of index segments."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for data in frame["data"]:
                yield pd.DataFrame(segment_rows(bytes(data)), columns=["term", "id"])

    return segments.select("data").mapInPandas(run, "term string, id bigint")


def write_index(spark: SparkSession, path: str, postings: DataFrame, digest: bytes, n_records: int, width: int | None = None, tokenizer: str = "latin-cjk-char-v1") -> None:
    """The compressed binary index of (term, postings): n-grams of ``width`` or, without it, words of a named tokenizer."""
    name = tokenizer.encode()
    head = WORD_MAGIC + varint(len(name)) + name if width is None else NGRAM_MAGIC + bytes([width])
    rows = ((r["term"], r["postings"]) for r in postings.select("term", "postings").toLocalIterator())
    write_bytes(spark, path, gzip.compress(head + digest + varint(n_records) + index_bytes(rows), 9, mtime=0))


def publish_generation(spark: SparkSession, root: str, generation: str, tables: dict[str, DataFrame], manifest: dict, keep: int = 2) -> list[str]:
    """Write a generation's tables and manifest, then the pointer to it, then drop all but the last ``keep``; returns what was dropped."""
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{root}/{generation}/{name}")
    write_bytes(spark, f"{root}/{generation}/manifest.json", compact_json(manifest))
    return promote_generation(spark, root, generation, keep)


def promote_generation(spark: SparkSession, root: str, generation: str, keep: int = 2) -> list[str]:
    """Point to a generation that is there and sweep the oldest others, never the one pointed to."""
    _, manifest, fs = _path(spark, f"{root}/{generation}/manifest.json")
    if not fs.exists(manifest):
        raise ValueError(f"generation {generation} is not complete")
    write_bytes(spark, f"{root}/current.json", compact_json({"generation": generation}))
    jvm, where, fs = _path(spark, root)
    folders = sorted((s.getModificationTime(), s.getPath().getName()) for s in fs.listStatus(where) if s.isDirectory())
    stale = [name for _, name in folders if name != generation][: max(0, len(folders) - keep)]
    for name in stale:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root}/{name}"), True)
    return stale


def commit_manifest(spark: SparkSession, path: str, old: dict, added: dict, removed: Iterable[str]) -> dict:
    """The manifest after a commit, written last: entries by url, sorted."""
    files = {k: v for k, v in (old | added).items() if k not in set(removed)}
    save_state(spark, path, {"version": 1, "files": dict(sorted(files.items()))})
    return files


def text_status(texts: DataFrame, existing: DataFrame) -> DataFrame:
    """What becomes of each text (path, text): written, rewritten (the stored one is unreadable) or existing; and whether it is large."""
    from ..operators.clean import needs_rewrite

    stored = existing.select(F.col("path").alias("__path"), needs_rewrite(F.col("content")).alias("__bad"))
    joined = texts.join(stored, F.col("path") == F.col("__path"), "left")
    status = F.when(F.col("__path").isNull(), "written").when(F.col("__bad"), "rewritten").otherwise("existing")
    return joined.select("path", status.alias("status"), (F.octet_length("text") > LARGE_FILE).alias("large"))


def tree_lines(paths: DataFrame, excluded: tuple[str, ...] = ()) -> list[str]:
    """A drawing of a folder tree in natural order, hidden and excluded names left out."""
    from ..functions.text import natural_key
    from .payload import excluded as hidden

    parts = F.split("path", "/")
    steps = paths.select(F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.slice(parts, 1, n))).alias("p")).distinct()
    shown = steps.where(~F.exists("p", lambda x: hidden(x, excluded)))
    rows = shown.orderBy(F.transform("p", lambda x: natural_key(x))).toLocalIterator()
    children: dict[tuple, list[str]] = {}
    for row in rows:
        children.setdefault(tuple(row["p"][:-1]), []).append(row["p"][-1])
    lines: list[str] = []
    stack = [((), "", iter(children.get((), [])), len(children.get((), [])))]
    while stack:
        at, prefix, names, left = stack.pop()
        name = next(names, None)
        if name is None:
            continue
        stack.append((at, prefix, names, left - 1))
        last = left == 1
        lines.append(prefix + ("└── " if last else "├── ") + name)
        below = children.get((*at, name), [])
        stack.append(((*at, name), prefix + ("    " if last else "│   "), iter(below), len(below)))
    return lines


def output_lines(values: dict) -> str:
    """key=value lines, truths in lower case."""
    return "".join(f"{k}={str(v).lower() if isinstance(v, bool) else v}\n" for k, v in values.items())

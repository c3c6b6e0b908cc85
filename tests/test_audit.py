import io
import json
import tarfile

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import dates
from corpusloom.operators import audit
from corpusloom.sources import members


def archive(path, files):
    with tarfile.open(path, "w:gz") as tar:
        for name, value in files.items():
            raw = value if isinstance(value, bytes) else json.dumps(value, ensure_ascii=False).encode()
            info = tarfile.TarInfo(f"top/{name}")
            info.size = len(raw)
            tar.addfile(info, io.BytesIO(raw))
    return str(path)


def audited(spark, tmp_path, files, number=7):
    path = archive(tmp_path / "snapshot.tar.gz", files)
    rows = members.read_archives(spark, path).withColumn("archive_id", F.lit(number))
    found, totals = audit.audit_members(rows)
    counts = {r["issue"]: r["count"] for r in found.groupBy("issue").count().collect()}
    return counts, totals.first().asDict()


#: One name for each rule, built from what the rule says.
NAMES = {
    "author_image_placeholder": "IMG = q7",
    "unbalanced_author_parenthesis": "Lee (ed",
    "square_bracket_author": "Board [2]",
    "angle_bracket_author": "x > y",
    "wrapped_author": " (Nobody) ",
    "author_ocr_residue": "z〗z",
    "author_placeholder": "?somebody",
    "author_title_prefix": "━━ continued",
    "author_date_statement": "1901年春天起草",
    "author_pure_noise": "7",
    "unbalanced_author_delimiter": "「Half",
    "very_long_author": "y" * 81,
    "author_ascii_question": "who? me",
    "author_odd_edge": "。Dot",
    "author_sentence_punctuation": "abcdefghijk；z",
    "author_prose_cue": "本文" + "z" * 16,
    "author_many_slashes": "k/l/m/n",
    "author_review_length": "w" * 41,
}


def test_author_rules(spark):
    """Every rule finds its own name, and a plain name breaks none."""
    assert set(NAMES) == set(audit.author_rules(F.lit("")))
    rows = spark.createDataFrame([*NAMES.items(), ("", "Plain Name")], "issue string, name string")
    for r in rows.select("issue", F.transform(audit.author_findings(F.array("name")), lambda f: f["issue"]).alias("found")).collect():
        assert r["issue"] in r["found"] if r["issue"] else r["found"] == []


def test_first_name_counts(spark):
    """A rule reports an article once, at the place of the first name that breaks it."""
    found = spark.range(1).select(audit.author_findings(F.array(F.lit("ok"), F.lit("p/q/r/s"), F.lit("t/u/v/w"))).alias("f")).first()["f"]
    assert [(f["issue"], f["field"], f["sample"]) for f in found] == [("author_many_slashes", "$.authors[1]", "p/q/r/s")]


def test_members_by_kind(spark, tmp_path):
    """A shelf with two volumes that share a folder, an article filed twice, and a folder without a volume."""
    article = lambda text: {"title": "T", "parts": [{"text": text}]}
    counts, totals = audited(
        spark,
        tmp_path,
        {
            "shelf/v/one.metadata": {},
            "shelf/v/two.metadata": {"files": []},
            "shelf/v/m1/art.json": article("plain"),
            "shelf/v/m2/art.json": article("a<br>b"),
            "shelf/v/m1/art.tags": ["\u200e"],
            "shelf/none/m/alone.json": article("x"),
            "shelf/v/deep.json": article("not deep enough"),
        },
    )
    assert (totals["article_files"], totals["metadata_files"], totals["tag_files"]) == (3, 2, 1)
    assert (totals["indexed"], totals["unique_ids"], totals["overwritten"]) == (4, 2, 2)
    assert counts == {"multiple_metadata": 1, "duplicate_doc_id": 2, "html_tag": 1, "zero_width": 1, "orphan_article": 1}


def test_broken_members(spark, tmp_path):
    """Members of the wrong shape, and an article with nothing in it."""
    counts, totals = audited(
        spark,
        tmp_path,
        {
            "s/v/n.metadata": 5,
            "s/v/a/list.json": [1],
            "s/v/a/void.json": {"authors": "one", "dates": {}, "parts": [{"text": "\u3000"}]},
            "s/v/a/day.json": {"title": "d", "description": "d", "dates": [{"year": 850, "day": 32}]},
            "s/v/a/cut.json": b'{"title"',
            "s/v/a/t.tags": "none",
        },
    )
    assert totals["indexed"] == 0
    assert counts == {
        "metadata_not_object": 1, "article_not_object": 1, "empty_title": 1, "empty_content": 1, "authors_not_list": 1, "dates_not_list": 1,
        "non_four_digit_year": 1, "invalid_date": 1, "invalid_json": 1, "tags_not_list": 1, "orphan_article": 3,
    }


@pytest.mark.parametrize(
    ("text", "issue"),
    [
        ("naïve – “quoted”, 12 °C", None),
        ("rÃ©sumÃ©", "probable_mojibake"),
        ("left〖AB/name〗right", "ocr_markup"),
        ("end〖-QQ；open", "ocr_markup_unclosed"),
        ("tab\tstays, bell\x07 does not", "control_character"),
        ("R&D; no", None),
        ("", None),
    ],
)
def test_text_rules(spark, text, issue):
    strings = F.array(F.struct(F.lit("$").alias("field"), F.lit(text).alias("text")))
    found = spark.range(1).select(audit.text_findings(strings).alias("f")).first()["f"]
    assert [f["issue"] for f in found] == ([issue] if issue else [])


def test_valid_dates(spark):
    rows = [(None, m, d, True) for m, d in ((1, 31), (2, 29), (4, 30), (12, None), (None, 1))] + [(1999, None, None, True), (2400, 2, 29, True)]
    rows += [(None, m, d, False) for m, d in ((None, None), (13, None), (0, 5), (None, 32), (6, 31), (2, 30))] + [(2100, 2, 29, False), (1999, 2, 29, False)]
    df = spark.createDataFrame(rows, "y int, m int, d int, ok boolean")
    got = df.select(F.coalesce(dates.valid_date(F.col("y"), F.col("m"), F.col("d")), F.lit(False)).alias("v"), "ok").collect()
    assert all(r["v"] == r["ok"] for r in got)


def test_archive_numbers():
    assert audit.parse_archives("1,3-5") == [1, 3, 4, 5]
    assert audit.parse_archives("all") == list(range(32))
    with pytest.raises(ValueError):
        audit.parse_archives("32")


def test_member_paths():
    assert members.member_path("top/a/b.json") == "a/b.json"
    assert members.member_path("top/../b") is None
    assert members.unsafe_member("/x", False) and members.unsafe_member("x", True) and not members.unsafe_member("a/b", False)

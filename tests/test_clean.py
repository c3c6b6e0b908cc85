import pytest
from pyspark.sql import functions as F

from corpusloom.functions import identity, udfs
from corpusloom.functions import text as tx
from corpusloom.operators import clean

ARTICLE = "archive_id int, title string, description string, comments array<string>, parts array<struct<type:string,text:string>>, authors array<string>"


@pytest.mark.parametrize(
    ("raw", "kept"),
    [
        ("img = 9z9", None),  # a picture's name
        ("<>", None),
        ("x〖-RQ/y", None),  # a whole record
        ("Ann〖HH/换行〗DW：unit", "Ann"),  # layout marks, then pictures
        ("Bob<img=77q>", "Bob"),
        ("&amp;#65;l\u200b", "Al"),  # entities and invisible signs
        ("Team<red>", "Teamred"),
        ("传达记录要点", None),
        ("Quinn；[机密]", "Quinn"),  # brackets
        ("[Office] Two", "Office Two"),
        ("Kim (Photo", "Kim"),  # annotations that are cut off
        ("Zed（某某", "Zed"),
        ("(乌玛", "乌玛"),
        ("Vic)", "Vic"),
        ("（Wes）", "Wes"),
        ("解放军报》某员", "《解放军报》某员"),
        ("Xi；阅办文件；", "Xi"),
        ("Yan？Zoe", "Yan/Zoe"),
        ("Lin、", "Lin"),
        ("5", None),  # what is left is none
        ("「Half", None),
        ("━━ more", None),
        ("z" * 81, None),
    ],
)
def test_author_chain(raw, kept):
    assert udfs.clean_author(raw) == kept


def test_authors_keep_their_order():
    assert udfs.clean_authors(["b", None, "7", "(a)"]) == ["b", "a"]


def test_author_split():
    joined = ["p/q；r", "s;t"]
    assert udfs.split_authors(joined, 24) == ["p", "q；r", "s;t"]
    assert udfs.split_authors(joined, 9) == ["p", "q", "r", "s", "t"]
    assert udfs.split_authors(joined, 3) == joined


def test_clean_articles(spark):
    part = lambda t: [("p", t)]
    rows = [
        (31, "He<BR clear=all>ad", "", [], part("<Table>cell</Table> after"), []),
        (14, "t", None, None, part("&amp;lt;p&amp;gt;R&amp;amp;D"), None),
        (24, "bad", None, [], part("�"), []),
        (24, "good", None, ["c\ufeff"], part(""), ["u/v"]),
        (20, "bare", "", [" "], part("<br>"), []),
        (7, "<i>as it is</i>", "", [], [], ["[as it is]"]),
    ]
    got = {(r["archive_id"], r["title"]): r for r in clean.clean_articles(spark.createDataFrame(rows, ARTICLE)).collect()}
    assert set(got) == {(31, "Head"), (14, "t"), (24, "good"), (7, "<i>as it is</i>")}
    assert got[31, "Head"]["parts"][0]["text"] == "cell after"
    assert got[14, "t"]["parts"][0]["text"] == "R&D"
    assert got[24, "good"]["comments"] == ["c"] and got[24, "good"]["authors"] == ["u", "v"]
    assert got[7, "<i>as it is</i>"]["authors"] == ["[as it is]"]


def test_decoding():
    text = "汉字编码测试文"
    for encoding in ("utf-8", "gb18030", "utf-16"):
        assert udfs.decode_text(text.encode(encoding))[0] == text
    assert udfs.decode_text(b"\xef\xbb\xbfabc") == ("abc", "utf-8-sig")


def test_scores(spark):
    df = spark.createDataFrame([("abc",), ("中文",), ("",), (None,), ("Ж" * 25,)], "t string")
    got = df.select(clean.quality_score(F.col("t")).alias("s"), F.coalesce(clean.probably_mojibake(F.col("t")), F.lit(False)).alias("m")).collect()
    assert [round(r["s"], 6) for r in got] == [0.45, 8.0, -1e6, -1e6, -150.0]
    assert [r["m"] for r in got] == [False, False, False, False, True]
    assert round(udfs.quality_score("a中�\x01Ж"), 6) == round(0.15 + 4 - 30 - 20 - 6, 6)


def test_article_identity(spark):
    import hashlib
    import json

    value = json.dumps(["head\x01", ["1801-02-03", "0000-00-00"][::-1], False, ["u", "v"], "f"], ensure_ascii=False, separators=(",", ":"))
    row = spark.range(1).select(
        identity.article_id(
            F.lit("head\x01"),
            F.array(identity.date_text(F.lit(1801), F.lit(2), F.lit(3)), identity.date_text(*(F.lit(None).cast("int"),) * 3)),
            F.lit(False),
            F.array(F.lit("v"), F.lit("u")),
            F.lit("f"),
        ).alias("i")
    )
    assert row.first()["i"] == hashlib.md5(value.encode()).hexdigest()[:10]


def test_text_columns(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    assert one(tx.strip(F.lit("\u3000 a b\t\n"))) == "a b"
    assert one(tx.utf16_length(F.lit("a😀"))) == 3
    assert one(tx.marker_decode(tx.marker_encode(F.lit("标记?>~")))) == "标记?>~"
    assert one(tx.marker_decode(F.lit("%%%"))) is None
    assert one(tx.longest_run(F.lit("a``b````"), "`")) == 4
    assert [c["text"] for c in one(tx.chunks(F.lit("abcde"), 2))] == ["ab", "cd", "e"]
    assert [c["text"] for c in one(tx.chunks(F.lit(""), 2))] == [""]
    assert one(tx.quoted_path(F.lit("a b/中~*"))) == "a%20b/%E4%B8%AD~%2A"
    pivots = F.array(F.struct(F.lit(1).alias("offset"), F.lit(1).alias("index")))
    assert one(tx.with_pivots(F.lit("pq"), pivots)) == "p〔1〕q"
    assert one(tx.full_text(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("c")))) == "a\nb\n\n〔1〕c"
    names = spark.createDataFrame([("x10",), ("x9",), ("X1",)], "n string").orderBy(tx.natural_key(F.col("n")))
    assert [r["n"] for r in names.collect()] == ["X1", "x9", "x10"]

import pytest
from pyspark.sql import functions as F

from corpusloom import plans
from corpusloom.functions import udfs
from corpusloom.operators import clean
from corpusloom.sources import parsers

CUT = "<title>a&amp;&am</title><style>p{margin:0}</style>&amp</b>p &amp;quot; &quot;&middot;&copy;"


def test_html_text_of_cut_entities(spark, tmp_path):
    """A title cut inside an entity and the text after its tag make no entity together; nothing is resolved twice."""
    rows = [(0, CUT), (1, " <b>x</b> "), (2, None), (3, "&amp;amp;lt;")]
    spark.createDataFrame(rows, "page_id bigint, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r["page_id"]: r["text"] for r in plans.QUERIES["html_text"](spark, str(tmp_path)).collect()}
    assert got == {0: 'a&&amp{margin:0}&ampp &quot; "·©', 1: "x", 2: None, 3: "&amp;lt;"}


def test_entities_are_resolved_once(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    assert one(clean.html_text(F.lit(" <i>&amp;lt;</i>&lt;&#65 &ampb "))) == "&lt;<A &b"
    page = "<h3>a &amp;amp; b</h3><strong>&amp;lt;</strong><div class='info'>2002-03-04</div>"
    row = parsers.page_article(spark.createDataFrame([(page,)], "h string"), "h").first()
    assert (row["title"], row["author"]) == ("a &amp; b", "&lt;")


@pytest.mark.parametrize("text, out", [("&#x41;&#65;", "AA"), ("&#65 &amp", "&#65 &amp"), ("&nosuch;&amplt;", "&nosuch;&amplt;"), ("&am&amp;&;", "&am&&;"), ("&notin;&NotEqualTilde;", "∉≂̸")])
def test_terminated(text, out):
    assert udfs.html_unescape_terminated(text) == out

"""Requests to split a source into articles, and crops of its pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identity import article_id, date_text
from ..functions.text import strip

#: Bounds of a request.
MOST_ARTICLES, MOST_FILES, MOST_CONTENT, MOST_PARTS = 200, 1000, 200_000, 15_000
MOST_CROPS, MOST_ARTICLE_CROPS = 200, 50
UNSPLIT = "【文章待拆分】"
TILE = (1600, 1400)
PDF_MAGIC, WEBP_MAGIC = b"%PDF-", (b"RIFF", b"WEBP")

ARTICLE = (
    "title string, authors array<string>, dates array<struct<year:int,month:int,day:int>>, is_range_date boolean, page_start int, page_end int, "
    "content string, base_part_count int, ocr struct<content_thresholds:array<double>>, ocr_exceptions map<string,struct<content_thresholds:array<double>>>"
)


def bad_thresholds(t: Column) -> Column:
    """Four shares from 0 to 1, opposite ones adding up to less than 1."""
    four = (F.size(t) == 4) & F.forall(t, lambda x: x.between(0, 1))
    return t.isNotNull() & ~(four & (F.get(t, F.lit(0)) + F.get(t, F.lit(1)) < 1) & (F.get(t, F.lit(2)) + F.get(t, F.lit(3)) < 1))


def _in(c: Column, low: int, high: int) -> Column:
    return c.isNull() | c.between(low, high)


def article_errors(articles: DataFrame) -> DataFrame:
    """Add ``error`` (the first thing wrong, or null) and ``article_id`` to a request's articles (request, source_start, source_end and ``ARTICLE``)."""
    title = strip(F.coalesce("title", F.lit("")))
    authors = F.coalesce("authors", F.array().cast("array<string>"))
    dates = F.coalesce("dates", F.array().cast("array<struct<year:int,month:int,day:int>>"))
    empty = lambda d: d["year"].isNull() & d["month"].isNull() & d["day"].isNull()
    odd = lambda d: ~(_in(d["year"], 1, 9999) & _in(d["month"], 1, 12) & _in(d["day"], 1, 31))
    pages = F.map_keys("ocr_exceptions")
    outside = lambda k: ~k.rlike(r"\A[1-9][0-9]*\z") | ~F.coalesce(k.try_cast("int").between(F.col("page_start"), F.col("page_end")), F.lit(False))
    rules = [
        ((title == "") | F.startswith("title", F.lit(UNSPLIT)), "invalid title"),
        ((strip(F.coalesce("content", F.lit(""))) == "") | (F.length("content") > MOST_CONTENT), "invalid content"),
        (~F.coalesce(F.col("base_part_count").between(1, MOST_PARTS), F.lit(False)), "invalid baseline size"),
        (F.col("page_start").isNull() | F.col("page_end").isNull(), "invalid page range"),
        ((F.col("page_start") < F.col("source_start")) | (F.col("page_end") > F.col("source_end")) | (F.col("page_start") > F.col("page_end")), "pages outside the source"),
        (F.exists(authors, lambda a: a.isNull() | (strip(a) == "")), "invalid authors"),
        (F.exists(dates, empty), "empty date"),
        (F.exists(dates, odd), "invalid date"),
        (bad_thresholds(F.col("ocr.content_thresholds")), "invalid crop"),
        (F.exists(F.map_values("ocr_exceptions"), lambda o: bad_thresholds(o["content_thresholds"])), "invalid crop"),
        (F.exists(pages, outside), "invalid exception page"),
    ]
    error = reduce(lambda done, rule: F.coalesce(done, F.when(F.coalesce(rule[0], F.lit(False)), F.lit(rule[1]))), rules, F.lit(None).cast("string"))
    own = article_id(
        title,
        F.transform(dates, lambda d: date_text(d["year"], d["month"], d["day"])),
        F.col("is_range_date"),
        F.transform(authors, strip),
        F.lit(""),
    )
    return articles.withColumn("error", error).withColumn("article_id", own)


def request_errors(articles: DataFrame) -> DataFrame:
    """One row per request: its first error (of an article, in number, repeated ids or pages left out), or null."""
    checked = article_errors(articles)
    pages = checked.where("error is null").select("request", F.explode(F.sequence("page_start", "page_end")).alias("page")).groupBy("request").agg(F.count_distinct("page").alias("covered"))
    whole = checked.groupBy("request").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("article_id").alias("ids"), F.min("error").alias("first"),
        (F.max("source_end") - F.min("source_start") + 1).alias("pages"),
    )
    error = (
        F.when(F.col("n") > MOST_ARTICLES, "too many articles")
        .when(F.col("first").isNotNull(), F.col("first"))
        .when(F.col("ids") < F.col("n"), "repeated article ids")
        .when(F.coalesce("covered", F.lit(0)) < F.col("pages"), "pages left out")
    )
    return whole.join(pages, "request", "left").select("request", error.alias("error"))


def effective_crop(ocr: Column, exceptions: Column, page: Column) -> Column:
    """The thresholds of a page: its exception's, else the article's; null unless they are four with one above 0."""
    own = F.try_element_at(exceptions, page.cast("string"))["content_thresholds"]
    t = F.coalesce(own, ocr["content_thresholds"])
    return F.when((F.size(t) == 4) & F.exists(t, lambda x: x > 0), t)


def requested_crops(articles: DataFrame) -> DataFrame:
    """(request, article, page, thresholds) of all cropped pages; ``error`` where an article or a request has too many."""
    pages = articles.select("*", F.explode(F.sequence("page_start", "page_end")).alias("page"))
    found = pages.select("request", "article", "page", effective_crop(F.col("ocr"), F.col("ocr_exceptions"), F.col("page")).alias("thresholds"))
    found = found.where("thresholds is not null")
    n = F.count(F.lit(1))
    error = F.when(n.over(Window.partitionBy("request", "article")) > MOST_ARTICLE_CROPS, "too many pages of an article").when(
        n.over(Window.partitionBy("request")) > MOST_CROPS, "too many pages"
    )
    return found.withColumn("error", error)


def crop_box(t: Column, width: Column, height: Column) -> Column:
    """The pixels that thresholds (top, bottom, left, right) leave: at least one each way."""
    at = lambda i: F.get(t, F.lit(i))
    left, top = (at(2) * width).cast("int"), (at(0) * height).cast("int")
    edge = lambda share, size: ((1 - share) * size + 0.9999).cast("int")
    return F.struct(
        left.alias("left"), top.alias("top"), F.greatest(left + 1, edge(at(3), width)).alias("right"), F.greatest(top + 1, edge(at(1), height)).alias("bottom")
    )


def page_images(pages: DataFrame, manifest: DataFrame) -> DataFrame:
    """The mirrored image of each page: pages (request, files array, page) against a manifest (url, path, previews).

    One file gives its previews by page, or itself as page 1; several give one page each,
    their first preview or themselves.  ``error`` where there is none.
    """
    single = F.size("files") == 1
    url = F.when(single, F.get("files", F.lit(0))).otherwise(F.get("files", F.col("page") - 1))
    joined = pages.withColumn("url", url).join(manifest.select("url", "path", "previews"), "url", "left")
    has = F.coalesce(F.size("previews") > 0, F.lit(False))
    image = (
        F.when(single & has, F.get("previews", F.col("page") - 1))
        .when(single & (F.col("page") == 1), F.col("path"))
        .when(~single, F.when(has, F.get("previews", F.lit(0))).otherwise(F.col("path")))
    )
    return joined.withColumn("image", F.nullif(image, F.lit(""))).withColumn("error", F.when(F.col("image").isNull(), "page can't be resolved"))


def looks_like_pdf(data: Column) -> Column:
    return F.startswith(data, F.lit(PDF_MAGIC))


def looks_like_webp(data: Column) -> Column:
    return F.startswith(data, F.lit(WEBP_MAGIC[0])) & (F.substring(data, 9, 4) == F.lit(WEBP_MAGIC[1]))

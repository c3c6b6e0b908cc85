"""Columns and UDFs against plain Python on generated values."""

import re
from urllib.parse import quote, unquote_to_bytes

from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.functions import rules, udfs
from corpusloom.operators import index

TEXT = st.text(st.characters(exclude_categories=["Cs"]), max_size=30)


@given(st.lists(st.integers(0, 1 << 40), unique=True).map(sorted))
def test_varints(ids):
    assert udfs.varint_decode(udfs.varint_postings(ids)) == ids


def delta(old: str, keep: list[bool], insert: str) -> tuple[str, str]:
    """A delta that keeps or deletes each character and puts a text at the end, with its result."""
    tokens = [("=" if k else "-") + str(len(c.encode("utf-16-le")) // 2) for c, k in zip(old, keep, strict=False)]
    rest = old[len(tokens) :]
    if rest:
        tokens.append(f"={len(rest.encode('utf-16-le')) // 2}")
    tokens.append("+" + quote(insert, safe=" !~*'()+"))
    return "\t".join(tokens), "".join(c for c, k in zip(old, keep, strict=False) if k) + rest + insert


@given(TEXT, st.lists(st.booleans(), max_size=30), TEXT)
def test_delta(old, keep, insert):
    change, new = delta(old, keep, insert)
    assert udfs.text_delta_apply(old, change) == new
    deleted = sum(len(c.encode("utf-16-le")) // 2 for c, k in zip(old, keep, strict=False) if not k)
    assert udfs.diff_cost(change) == deleted + len(insert.encode("utf-16-le")) // 2


LINES = st.lists(st.sampled_from(["a\n", "b\n", "c\n", "d\n"]), max_size=8).map("".join)


@given(LINES, LINES)
def test_merge_with_one_side_changed(base, side):
    assert udfs.merge3(base, base, side) == (side, "taken")
    assert udfs.merge_lines(base, side, base) == side
    assert udfs.merge_lines(base, base, side) == side
    assert udfs.merge_lines(base, side, side) == side


@settings(max_examples=3, deadline=None, phases=[Phase.generate])
@given(st.lists(TEXT, min_size=20, max_size=60))
def test_columns(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    s = F.col("s")
    rows = df.select(
        "i", tx.strip(s).alias("strip"), tx.utf16_length(s).alias("units"), tx.marker_decode(tx.marker_encode(s)).alias("marker"),
        index.ngrams(s, 2).alias("grams"), tx.quoted_path(s).alias("quoted"), tx.longest_run(s, "a").alias("run"),
    ).orderBy("i").collect()
    for v, r in zip(values, rows, strict=True):
        assert r["strip"] == v.strip()
        assert r["units"] == len(v.encode("utf-16-le")) // 2
        assert r["marker"] == v
        assert r["grams"] == [v[i : i + 2] for i in range(len(v) - 1)]
        assert r["quoted"] == quote(v, safe="/~")
        assert r["run"] == max(map(len, re.findall("a+", v)), default=0)


@settings(max_examples=3, deadline=None, phases=[Phase.generate])
@given(st.lists(st.from_regex(r"[a-cA-C]{0,2}[0-9]{0,3}[a-c]?[0-9]{0,2}", fullmatch=True), min_size=10, max_size=40, unique=True))
def test_natural_order(spark, names):
    got = [r["n"] for r in spark.createDataFrame([(n,) for n in names], "n string").orderBy(tx.natural_key(F.col("n")), "n").collect()]
    runs = lambda n: [(0, int(x), "") if x.isdigit() else (1, 0, x.lower()) for x in re.findall("[0-9]+|[^0-9]+", n)]
    assert got == sorted(names, key=lambda n: (runs(n), n))


@given(st.text(max_size=30), st.text(alphabet="&<〖>aZ;#6​\x01é", max_size=12))
def test_clean_texts_hold_no_sign(head, tail):
    """Whatever cleaning changes holds one of the signs that send a text to it."""
    text = head + tail
    if udfs.clean_text(text) != text:
        assert re.search(rules.DIRTY, text)


@given(st.text(alphabet="aé漢🚀\n", max_size=12), st.lists(st.tuples(st.sampled_from("=-+"), st.integers(0, 4)), max_size=6))
def test_delta_equals_utf16_replay(text, steps):
    tokens = [f"+{'🚀%41+'[:n]}" if sign == "+" and n != 3 else f"{'=' if sign == '+' else sign}{n}" for sign, n in steps]
    units, at, out = text.encode("utf-16-le"), 0, b""
    for token in tokens:
        if token[0] == "+":
            out += unquote_to_bytes(token[1:].replace("+", "%2B")).decode().encode("utf-16-le")
        else:
            end = at + 2 * int(token[1:])
            out, at = out + (units[at:end] if token[0] == "=" else b""), end
    try:
        expected = out.decode("utf-16-le") if at == len(units) else None
    except UnicodeDecodeError:
        expected = None
    assert udfs.text_delta_apply(text, "\t".join(tokens)) == expected

"""What columns can't express, as plain Python functions and their Arrow-batched UDFs.

Each function works on one value and is tested without Spark; the UDF of the same name
with ``_udf`` maps it over batches.  Nulls in give nulls out unless said otherwise.
"""

from __future__ import annotations

import ast
import difflib
import hashlib
import html
import json
import re
import struct
from collections.abc import Callable, Iterable
from functools import cache
from html.entities import html5
from urllib.parse import unquote_to_bytes

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import rules


def _python(pattern: str) -> re.Pattern:
    return re.compile(pattern)


def mapped(f: Callable, returns: T.DataType, null: bool = True):
    """A pandas UDF that maps ``f`` over one or more columns; with ``null``, a null first value stays null."""

    @F.pandas_udf(returns)
    def run(*columns: pd.Series) -> pd.Series:
        return pd.Series([None if null and row[0] is None else f(*row) for row in zip(*columns, strict=True)], dtype=object)

    return run


def html_unescape2(text: str) -> str:
    """Entities resolved twice over, as they were escaped twice."""
    return html.unescape(html.unescape(text))


_TERMINATED = re.compile(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[0-9A-Za-z]+);")


def html_unescape_terminated(text: str) -> str:
    """Entities that end in a semicolon resolved once; a name without one is text."""
    return _TERMINATED.sub(lambda m: html.unescape(m[0]) if m[0][1] == "#" or m[0][1:] in html5 else m[0], text)


@cache
def _text_steps() -> list[re.Pattern]:
    order = ("zero_width", "control_character", "ocr_markup", "ocr_markup_unclosed")
    return [_python(rules.CLEAN_TAGS), *(_python(rules.TEXT_RULES[k]) for k in order)]


def clean_text(text: str) -> str:
    """Without entities, known tags, invisible characters and layout marks."""
    text = html_unescape2(text)
    for pattern in _text_steps():
        text = pattern.sub("", text)
    return text


def _drop_open(name: str, left: str, right: str) -> str:
    """What stands before the last of too many opening signs."""
    at = name.rfind(left)
    return name[:at].strip() if name.count(left) > name.count(right) and at > 0 else name


def _drop_lone(name: str, left: str, right: str) -> str:
    if name[:1] == left and right not in name:
        return name[1:].strip()
    if name[-1:] == right and left not in name:
        return name[:-1].strip()
    return name


def _unwrapped(name: str) -> str:
    hit = re.fullmatch(rules.WRAPPED, name)
    inner = next((g for g in hit.groups() if g is not None), None) if hit else None
    return name if inner is None else inner.strip()


def _credited(name: str) -> str:
    name = re.sub(rules.MISSING_BOOK_MARK, r"《\1》\2", name, count=1)
    hit = re.fullmatch(rules.PUBLISHER_CREDIT, name)
    return hit[1].strip() if hit else name


#: The author chain: each step takes a name to a better one, or to None when it is no author.
AUTHOR_STEPS: list[Callable[[str], str | None]] = [
    lambda s: None if any(re.fullmatch(p, s) for p in rules.RAW_NOT_AUTHORS) or re.search(rules.RAW_RECORD, s) else s,
    lambda s: re.sub(rules.LAYOUT_MARK, "", s).strip(),
    lambda s: re.sub(rules.IMAGE_FRAGMENT, "", s).strip(),
    clean_text,
    lambda s: re.sub(rules.ANGLE_NOTE, r"\1", s).strip(" <>\t\r\n"),
    lambda s: None if re.fullmatch(rules.NOTES_NOT_AUTHORS, s) else s,
    lambda s: re.sub(rules.SQUARE_BRACKETS, "", re.sub(rules.BRACKET_SEGMENT, "", s)).strip(),
    lambda s: re.sub(rules.CUT_ANNOTATION, "", s).strip(),
    lambda s: _drop_open(_drop_open(s, "(", ")"), "（", "）"),
    lambda s: _drop_lone(_drop_lone(s, "(", ")"), "（", "）"),
    lambda s: _credited(_unwrapped(s)),
    lambda s: re.sub(rules.REVIEW_NOTE, "", s).replace("？", "/").rstrip(rules.EDGE_MARKS).strip(),
]


def _acceptable(name: str) -> bool:
    if not name or len(name) > rules.AUTHOR_LIMIT or any(re.fullmatch(p, name) for p in rules.CLEAN_NOISE):
        return False
    found = (rules.AUTHOR_RULES[k] for k in ("author_placeholder", "author_title_prefix", "author_date_statement"))
    if any(re.search(p, name) for p in (*found, rules.MISPARSED_PROSE)):
        return False
    return all(name.count(a) == name.count(b) for a, b in rules.CLEAN_PAIRS)


def clean_author(name: str | None) -> str | None:
    """A name through the whole chain; None when nothing acceptable is left."""
    for step in AUTHOR_STEPS:
        if name is None:
            return None
        name = step(name)
    return name if name is not None and _acceptable(name) else None


def clean_authors(names: Iterable[str | None]) -> list[str]:
    return [good for name in names if (good := clean_author(name)) is not None]


def split_authors(names: Iterable[str], archive: int) -> list[str]:
    """Names divided at the signs that two archives join them with."""
    if archive not in (rules.SPLIT_ALL, rules.SPLIT_SLASH):
        return list(names)
    out: list[str] = []
    for name in names:
        signs = "/"
        if archive == rules.SPLIT_ALL:
            if name == rules.SPLIT_DROPPED:
                continue
            if name == rules.SPLIT_JOINED:
                out.append(name.replace("/", "、"))
                continue
            name, signs = rules.SPLIT_RENAMED.get(name, name), "/；;"
        out += filter(None, (piece.strip() for piece in re.split(f"[{signs}]", name)))
    return out


def inserted_text(token: str) -> str:
    """The text of an insertion: percent-encoded UTF-8 in which a plus is a plus."""
    return unquote_to_bytes(token.replace("+", "%2B")).decode("utf-8")


def text_delta_apply(text: str, delta: str) -> str | None:
    """Replay a delta over UTF-16 units; None when it doesn't use up the text or can't be read.

    Unknown tokens are passed over.
    """
    # Where every character is one unit, the text is cut as it is.
    plain = text.isascii() or max(text, default="") <= "\uffff"
    units, width, at, out = (text, 1, 0, []) if plain else (text.encode("utf-16-le"), 2, 0, [])
    try:
        for token in filter(None, (delta or "").split("\t")):
            sign, rest = token[0], token[1:]
            if sign == "+":
                new = inserted_text(rest) if "%" in rest else rest
                out.append(new if plain else new.encode("utf-16-le"))
            elif sign in "=-" and rest.isdigit():
                end = at + width * int(rest)
                if sign == "=":
                    out.append(units[at:end])
                at = end
        if at != len(units):
            return None
        return "".join(out) if plain else b"".join(out).decode("utf-16-le")
    except (UnicodeDecodeError, ValueError):
        return None


def diff_cost(delta: str) -> int | None:
    """UTF-16 units deleted and inserted; None when any token is none."""
    cost = 0
    for token in delta.split("\t"):
        sign, rest = token[:1], token[1:]
        if sign == "+":
            try:
                cost += len(inserted_text(rest).encode("utf-16-le")) // 2
            except (UnicodeDecodeError, ValueError):
                return None
        elif sign and sign in "=-" and rest.isdigit():
            cost += int(rest) if sign == "-" else 0
        else:
            return None
    return cost


def unified_diff(old: str, new: str, context: int = 2, most: int = 5000) -> str:
    """A unified diff without its file lines, cut to ``most`` characters."""
    lines = list(difflib.unified_diff(old.splitlines(), new.splitlines(), "old", "new", lineterm="", n=context))[2:]
    return "\n".join(lines)[:most]


def _changes(base: list[str], side: list[str]) -> list[tuple[int, int, list[str]]]:
    matcher = difflib.SequenceMatcher(None, base, side, autojunk=False)
    return [(a, b, side[c:d]) for tag, a, b, c, d in matcher.get_opcodes() if tag != "equal"]


def merge_lines(base: str, ours: str, theirs: str) -> str | None:
    """Three-way merge by lines; None when both sides change the same or touching lines differently."""
    lines = base.splitlines(keepends=True)
    left, right = (_changes(lines, s.splitlines(keepends=True)) for s in (ours, theirs))
    out: list[str] = []
    at = 0
    while left or right:
        a, b = (left[0] if left else None), (right[0] if right else None)
        if a is not None and b is not None and a[0] <= b[1] and b[0] <= a[1]:
            if a != b:
                return None
            right.pop(0)
            take = left.pop(0)
        elif b is None or (a is not None and a[:2] < b[:2]):
            take = left.pop(0)
        else:
            take = right.pop(0)
        out += lines[at : take[0]] + take[2]
        at = take[1]
    return "".join(out + lines[at:])


def merge3(base: str | None, current: str | None, changed: str | None) -> tuple[str | None, str]:
    """The content after a change is carried over, and how: a None content is an absent file."""
    if base is None:
        if changed is None:
            return None, "no_change"
        return (changed, "added") if current in (None, changed) else (None, "conflict")
    if changed is None:
        return None, "deleted" if current in (None, base) else "conflict"
    if current is None:
        return None, "missing"
    if current in (base, changed):
        return changed, "taken"
    merged = merge_lines(base, current, changed)
    return (merged, "merged") if merged is not None else (None, "conflict")


def py_json(value: str) -> str | None:
    """JSON text in the form with sorted keys and a blank after commas and colons."""
    try:
        return json.dumps(json.loads(value), ensure_ascii=False, sort_keys=True)
    except ValueError:
        return None


def correction_id(value: str) -> str | None:
    """Twelve hex digits of the request's JSON in that form."""
    text = py_json(value)
    return None if text is None else hashlib.sha256(text.encode()).hexdigest()[:12]


def varint(n: int) -> bytes:
    """Seven bits a byte, the lowest first, the high bit on all but the last."""
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def varint_postings(ids: Iterable[int]) -> bytes:
    """Ascending ids as varints of their gaps."""
    before, out = 0, bytearray()
    for i in ids:
        out += varint(i - before)
        before = i
    return bytes(out)


def varint_decode(data: bytes) -> list[int]:
    """The ids of ``varint_postings``."""
    ids, total, value, shift = [], 0, 0, 0
    for byte in data:
        value |= (byte & 0x7F) << shift
        shift += 7
        if byte < 0x80:
            total += value
            ids.append(total)
            value = shift = 0
    return ids


#: Encodings tried whole, in order, and those tried with replacement.
STRICT_ENCODINGS = ("utf-8", "gb18030", "gbk", "big5", "cp932", "shift_jis", "euc_jp")
REPLACE_ENCODINGS = ("gb18030", "utf-8")
MOJIBAKE_SIGNS = "№¤±µґєЄЈЎўїЇ"
_MARKS = ((b"\xef\xbb\xbf", "utf-8-sig"), (b"\xff\xfe\x00\x00", "utf-32"), (b"\x00\x00\xfe\xff", "utf-32"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16"))
_CLASSES = (
    (4.0, re.compile(r"[一-鿿぀-ヿ가-힯]")),
    (-30.0, re.compile("�")),
    (-20.0, re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f]")),
    (0.15, re.compile(r"[ -~]")),
    (-6.0, re.compile(rf"[Ѐ-ӿ{MOJIBAKE_SIGNS}]")),
)


def quality_score(text: str) -> float:
    """How readable a text looks in its first 20,000 characters."""
    if not text:
        return -1_000_000.0
    return sum(weight * len(pattern.findall(text[:20_000])) for weight, pattern in _CLASSES)


def decode_text(data: bytes) -> tuple[str, str]:
    """(text, encoding): by its byte order mark, else the best-scoring of the encodings, the earlier on ties."""
    for mark, encoding in _MARKS:
        if data.startswith(mark):
            return data.decode(encoding), encoding
    found: list[tuple[str, str]] = []
    for encoding in STRICT_ENCODINGS:
        try:
            found.append((data.decode(encoding), encoding))
        except UnicodeDecodeError:
            continue
    found += [(data.decode(e, "replace"), f"{e}-replace") for e in REPLACE_ENCODINGS]
    return max(found, key=lambda x: quality_score(x[0]))


def image_size(data: bytes) -> tuple[int, int] | None:
    """(width, height) from the header of a PNG, JPEG or WebP image."""
    if data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 24:
        return struct.unpack(">II", data[16:24])
    if data[:4] == b"RIFF" and data[8:12] == b"WEBP":
        kind = data[12:16]
        if kind == b"VP8X" and len(data) >= 30:
            return tuple(1 + int.from_bytes(data[a : a + 3], "little") for a in (24, 27))
        if kind == b"VP8L" and len(data) >= 25:
            bits = int.from_bytes(data[21:25], "little")
            return 1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF)
        if kind == b"VP8 " and len(data) >= 30:
            w, h = struct.unpack("<HH", data[26:30])
            return w & 0x3FFF, h & 0x3FFF
        return None
    if data[:2] == b"\xff\xd8":
        at = 2
        while at + 9 <= len(data):
            if data[at] != 0xFF:
                at += 1
                continue
            kind = data[at + 1]
            if kind == 0xFF:
                at += 1
            elif kind in (0x01, *range(0xD0, 0xDA)):
                at += 2
            elif kind in range(0xC0, 0xD0) and kind not in (0xC4, 0xC8, 0xCC):
                h, w = struct.unpack(">HH", data[at + 5 : at + 9])
                return w, h
            else:
                at += 2 + struct.unpack(">H", data[at + 2 : at + 4])[0]
    return None


def walk_strings(value: str) -> list[tuple[str, str]]:
    """Every string of a JSON text with the path that leads to it."""
    out: list[tuple[str, str]] = []
    try:
        left = [("$", json.loads(value))]
    except ValueError:
        return out
    while left:
        path, x = left.pop()
        if isinstance(x, str):
            out.append((path, x))
        elif isinstance(x, list):
            left += [(f"{path}[{i}]", y) for i, y in reversed([*enumerate(x)])]
        elif isinstance(x, dict):
            left += [(f"{path}.{k}", y) for k, y in reversed(x.items())]
    return out


def literal_list(value: str) -> list[str] | None:
    """A list written as JSON or as a literal; None when it is neither."""
    for read in (json.loads, ast.literal_eval):
        try:
            got = read(value)
        except (ValueError, SyntaxError, MemoryError, RecursionError):
            continue
        return [x if isinstance(x, str) else json.dumps(x, ensure_ascii=False) for x in got] if isinstance(got, list) else None
    return None


def first_replaced(text: str, old: str, new: str) -> str:
    """Only the first occurrence replaced."""
    return text.replace(old, new, 1)


def cleaned(c: Column) -> Column:
    """``clean_text`` as a column: texts without any sign that it could change don't go to Python."""
    return F.coalesce(clean_text_udf(F.when(c.rlike(rules.DIRTY), c)), c)


def unescaped(c: Column, terminated: bool = False) -> Column:
    """Entities resolved once, or only those that end in a semicolon: texts without an ampersand don't go to Python."""
    resolve = html_unescape_terminated_udf if terminated else html_unescape_udf
    return F.coalesce(resolve(F.when(F.contains(c, F.lit("&")), c)), c)


_STRINGS = T.ArrayType(T.StringType())
html_unescape_udf = mapped(html.unescape, T.StringType())
html_unescape_terminated_udf = mapped(html_unescape_terminated, T.StringType())
clean_text_udf = mapped(clean_text, T.StringType())
clean_authors_udf = mapped(clean_authors, _STRINGS)
split_authors_udf = mapped(split_authors, _STRINGS)
text_delta_apply_udf = mapped(text_delta_apply, T.StringType())
diff_cost_udf = mapped(diff_cost, T.LongType())
unified_diff_udf = mapped(unified_diff, T.StringType())
py_json_udf = mapped(py_json, T.StringType())
correction_id_udf = mapped(correction_id, T.StringType())
varint_postings_udf = mapped(varint_postings, T.BinaryType())
varint_decode_udf = mapped(varint_decode, T.ArrayType(T.LongType()))
literal_list_udf = mapped(literal_list, _STRINGS)
first_replaced_udf = mapped(first_replaced, T.StringType())
walk_strings_udf = mapped(
    lambda x: [{"field": a, "text": b} for a, b in walk_strings(x)],
    T.ArrayType(T.StructType([T.StructField("field", T.StringType()), T.StructField("text", T.StringType())])),
)


def _structs(f: Callable, names: list[str], kinds: list[T.DataType], null: bool = True):
    """A pandas UDF that maps ``f`` to a struct column."""

    @F.pandas_udf(T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)]))
    def run(*columns: pd.Series) -> pd.DataFrame:
        none = (None,) * len(names)
        rows = [none if null and row[0] is None else f(*row) or none for row in zip(*columns, strict=True)]
        return pd.DataFrame(rows, columns=names, dtype=object)

    return run


merge3_udf = _structs(merge3, ["content", "outcome"], [T.StringType(), T.StringType()], null=False)
decode_text_udf = _structs(decode_text, ["text", "encoding"], [T.StringType(), T.StringType()])
image_size_udf = _structs(image_size, ["width", "height"], [T.IntegerType(), T.IntegerType()])

"""Configurations written as object literals: read without running them, edited in place.

A literal is scanned into nodes that know where they stand in the text, so that a change
touches only the values it names and comments, quotes and layout stay.  Values are the
strings, numbers, truths, nulls, lists and objects of the literal; anything else (a call, a
name) is kept as text and has no value.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

from ..functions.identity import article_id_of
from ..functions.udfs import _structs

_TOKEN = re.compile(
    r"""(?P<blank>\s+|//[^\n]*|/\*.*?\*/)|(?P<text>"(?:\\.|[^"\\])*"|'(?:\\.|[^'\\])*'|`(?:\\.|[^`\\])*`)|(?P<sign>[{}\[\](),:;])|(?P<word>(?:(?!//|/\*)[^\s"'`{}\[\](),:;])+)""",
    re.S,
)
_CLOSING = {"{": "}", "[": "]", "(": ")"}
_WORDS = {"true": True, "false": False, "null": None, "undefined": None}
#: Fields of an article and of a source that a request may change; the title that marks a source not yet split.
ARTICLE_FIELDS, SOURCE_FIELDS = ("title", "authors", "dates", "tags"), ("name", "author", "type", "files")
UNSPLIT = "【文章待拆分】"


class Refused(ValueError):
    """A change that can't be made; the text stays as it is."""


@dataclass
class Node:
    """A value of the literal, from ``start`` to ``end`` in the text."""

    start: int
    end: int = 0
    fields: dict[str, Node] | None = None
    items: list[Node] | None = None
    tokens: list[tuple[str, str]] = field(default_factory=list)

    def value(self):
        """The plain value of the node; None for what isn't one."""
        if self.fields is not None:
            return {k: v.value() for k, v in self.fields.items()}
        if self.items is not None:
            return [x.value() for x in self.items]
        if len(self.tokens) != 1:
            return None
        kind, raw = self.tokens[0]
        if kind == "text":
            return _unquoted(raw)
        if raw in _WORDS:
            return _WORDS[raw]
        try:
            return json.loads(raw)
        except ValueError:
            return None


def _unquoted(raw: str) -> str:
    named = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f", "v": "\v", "0": "\0", "\n": ""}

    def one(m: re.Match) -> str:
        if m[1]:
            return chr(int(m[1].strip("{}"), 16))
        return named.get(m[2], m[2])

    return re.sub(r"\\(?:u(\{[0-9a-fA-F]+\}|[0-9a-fA-F]{4})|(.))", one, raw[1:-1], flags=re.S)


def scanned(text: str) -> Node:
    """The first object of a text as a node."""
    at = text.find("{")
    if at < 0:
        raise Refused("no object")
    return _Scan(text, at).node()


class _Scan:
    def __init__(self, text: str, at: int):
        self.text, self.at = text, at
        self._skip()

    def _skip(self) -> None:
        """Step to the next token that isn't blank."""
        while True:
            self.token = _TOKEN.match(self.text, self.at)
            if self.token is None or self.token.lastgroup != "blank":
                return
            self.at = self.token.end()

    def _take(self) -> re.Match:
        if self.token is None:
            raise Refused("the literal is not closed")
        token, self.at = self.token, self.token.end()
        self._skip()
        return token

    def node(self) -> Node:
        sign = self.token[0] if self.token else ""
        out = Node(self.at)
        if sign in ("{", "["):
            out.end = self._filled(out, sign)
            if self.token and self.token[0] not in (",", "}", "]", ")", ";", ":"):
                self._rest(out)
            return out
        self._rest(out)
        return out

    def _rest(self, out: Node) -> None:
        """Tokens up to the comma or bracket that ends the value."""
        out.end = max(out.end, out.start)
        while self.token is not None and self.token[0] not in (",", "}", "]", ")", ";"):
            token = self._take()
            out.tokens.append((token.lastgroup, token[0]))
            out.end = token.end()
            if token[0] in _CLOSING:
                inner = Node(token.start())
                out.end = self._filled(inner, token[0], opened=True)
        if not out.tokens and out.end == out.start:
            raise Refused("a value is missing")

    def _filled(self, out: Node, sign: str, opened: bool = False) -> int:
        """What stands between brackets; returns the place after the closing one."""
        if not opened:
            self._take()
        fields, items = {}, []
        while True:
            if self.token is None:
                raise Refused("the literal is not closed")
            if self.token[0] == _CLOSING[sign]:
                end = self._take().end()
                break
            if self.token[0] in (",", ";"):
                self._take()
                continue
            if sign == "{" and self.token.lastgroup in ("text", "word"):
                name = self._take()
                key = _unquoted(name[0]) if name.lastgroup == "text" else name[0]
                if self.token is not None and self.token[0] == ":":
                    self._take()
                    fields.setdefault(key, self.node())
                continue
            items.append(self.node())
            if self.token is not None and self.token[0] == ":":
                self._take()
        if sign == "{":
            out.fields = fields
        elif sign == "[":
            out.items = items
        return end


def shown(text: str, start: int, value) -> str:
    """A value as it is written at ``start``: two blanks a level, lines after the first set in like the line it stands on."""
    line = text[text.rfind("\n", 0, start) + 1 : start]
    return json.dumps(value, ensure_ascii=False, indent=2).replace("\n", "\n" + re.match(r"\s*", line)[0])


def assignments(text: str, node: Node, values: dict) -> list[tuple[int, int, str]]:
    """Spans to replace so that an object has these values; fields it lacks are put before its end."""
    spans = [(own.start, own.end, shown(text, own.start, v)) for k, v in values.items() if (own := node.fields.get(k))]
    lacking = {k: v for k, v in values.items() if k not in node.fields}
    if lacking:
        line = text[text.rfind("\n", 0, node.start) + 1 : node.start]
        inset = re.match(r"\s*", line)[0] + "  "
        body = text[node.start + 1 : node.end - 1].rstrip()
        comma = "," if body.strip() and not body.endswith(",") else ""
        lines = ",\n".join(f"{inset}{json.dumps(k, ensure_ascii=False)}: " + json.dumps(v, ensure_ascii=False, indent=2).replace("\n", "\n" + inset) for k, v in lacking.items())
        spans.append((node.end - 1, node.end - 1, f"{comma}\n{lines}"))
    return spans


def spliced(text: str, spans: list[tuple[int, int, str]]) -> str:
    """All spans replaced, the last one first so that the places before it stay right."""
    for start, end, new in sorted(spans, reverse=True):
        text = text[:start] + new + text[end:]
    return text


def _articles(root: Node) -> Node:
    options = root.fields.get("parser_option")
    found = options.fields.get("articles") if options is not None and options.fields is not None else None
    if found is None or found.items is None:
        raise Refused("no list of articles")
    return found


def _place(articles: list[dict], article_id: str | None, locator: dict | None) -> int:
    """The article with this id, else the only one with the locator's title and pages."""
    for i, a in enumerate(articles):
        if article_id_of(a) == article_id:
            return i
    keys = ("title", "page_start", "page_end")
    found = [i for i, a in enumerate(articles) if locator and all(a.get(k) == locator.get(k) for k in keys)]
    if len(found) != 1:
        raise Refused("expected one article")
    return found[0]


def updated(text: str, request: dict) -> tuple[str, str]:
    """A configuration after a request's changes of article and source fields, and the changed article's id."""
    root = scanned(text)
    metadata = request.get("metadata") or {}
    article = {k: v for k, v in (metadata.get("article") or {}).items() if k in ARTICLE_FIELDS}
    source = {k: v for k, v in (metadata.get("source") or {}).items() if k in SOURCE_FIELDS}
    spans, changed = [], request.get("article_id") or ""
    if article:
        nodes = _articles(root).items
        values = [x.value() or {} for x in nodes]
        place = _place(values, request.get("article_id"), request.get("locator"))
        spans += assignments(text, nodes[place], article)
        changed = article_id_of(values[place] | article)
    if source:
        entity = root.fields.get("entity")
        if entity is None or entity.fields is None:
            raise Refused("no entity")
        spans += assignments(text, entity, source)
    return spliced(text, spans), changed


def split(text: str, articles: list[dict], locator: dict) -> str:
    """A configuration whose one article not yet split gives way to ``articles``."""
    found = _articles(scanned(text))
    keys = ("title", "page_start", "page_end")
    waiting = [a for x in found.items if str((a := x.value() or {}).get("title") or "").startswith(UNSPLIT) and all(a.get(k) == locator.get(k) for k in keys)]
    if len(waiting) != 1:
        raise Refused("expected one article not yet split")
    return spliced(text, [(found.start, found.end, shown(text, found.start, articles))])


def edited(text: str, request: str) -> tuple[str | None, str | None, str | None]:
    """(content, article_id, error) of a configuration after a request given as JSON."""
    try:
        asked = json.loads(request)
        if isinstance(asked.get("replace_articles"), list):
            return split(text, asked["replace_articles"], asked.get("locator") or {}), "", None
        return *updated(text, asked), None
    except (ValueError, AttributeError, TypeError) as error:
        return None, None, str(error) or type(error).__name__


edited_udf = _structs(edited, ["content", "article_id", "error"], [T.StringType()] * 3)

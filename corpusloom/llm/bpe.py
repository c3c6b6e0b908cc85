"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks.

A pre-tokenised piece becomes a row of symbols.  The leaves of the tree hold, for
each adjacent pair, its merge rank and place; the root is the lowest rank, leftmost
on ties.  A merge updates three leaves, so a piece of n bytes takes O(n log n)
whatever its length.  Finished pieces are remembered, as text repeats them.

Defined results: a null text encodes as the empty text (no ids, decoded ``''``);
an empty table gives an empty table; an input column named as an output column
gives way to it; repeated rows are encoded each.
"""

from __future__ import annotations

import hashlib
import json
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import held, map_text

#: Fixed value: the split of byte-level BPE before merging, as the public vocabulary's pre-tokeniser defines it.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Unicode white space; the regex module's own \s also takes U+001C to U+001F.
_SPACE = r"\p{White_Space}"
_NEVER = 1 << 62
#: Pieces that a worker remembers in a generation (about 250 bytes each), and the longest of them in characters.
MEMORY, LONGEST = 500_000, 64
#: Children of a node of the segment tree; a minimum over a short list is one fast call.
FAN = 32


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class SegmentTree:
    """Minima over ints (``_NEVER``: no merge) with ``FAN`` children per node; ``root()`` is the least leaf."""

    def __init__(self, leaves: list[int]):
        self.levels = [leaves]
        while len(below := self.levels[-1]) > FAN:
            self.levels.append([min(below[i : i + FAN]) for i in range(0, len(below), FAN)])

    def root(self) -> int:
        return min(self.levels[-1])

    def put(self, place: int, value: int) -> None:
        levels = self.levels
        levels[0][place] = value
        for k in range(1, len(levels)):
            at = place // FAN * FAN
            low = min(levels[k - 1][at : at + FAN])
            place //= FAN
            if levels[k][place] == low:
                return
            levels[k][place] = low


class Codec:
    """Encodes and decodes with the vocabulary of a ``tokenizers`` JSON file, given as its text."""

    def __init__(self, tokenizer_json: str, remember: int = MEMORY):
        import regex

        self.remember = remember
        conf = json.loads(tokenizer_json)
        model = conf["model"]
        vocab: dict[str, int] = model["vocab"]
        letters = byte_letters()
        self.byte_id = [vocab[letters[b]] for b in range(256)]
        back = {c: b for b, c in letters.items()}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        #: (left id, right id) to (rank, merged id)
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in reversed([*enumerate(merges)])}
        added = {x["content"]: x["id"] for x in conf.get("added_tokens", [])}
        size = 1 + max([*vocab.values(), *added.values()])
        self.bytes_of: list[bytes] = [b""] * size
        for piece, i in vocab.items():
            self.bytes_of[i] = bytes(back[c] for c in piece) if all(c in back for c in piece) else piece.encode()
        for piece, i in added.items():
            self.bytes_of[i] = piece.encode()
        self.added = added
        self.find_added = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.pieces = regex.compile(SPLIT.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", _SPACE).replace(r"\S", r"\P{White_Space}")).findall
        self.known = _Known(self)

    def merge(self, data: bytes) -> tuple[int, ...]:
        """The ids of one piece."""
        ids = [self.byte_id[b] for b in data]
        n = len(ids)
        if n < 2:
            return tuple(ids)
        pairs, never = self.merges.get, _NEVER
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        # A leaf is rank * n + place; the merged id is looked up again when its turn comes.
        leaves = [hit[0] * n + i if (hit := pairs((ids[i], ids[i + 1]))) else never for i in range(n - 1)]
        leaves.append(never)
        tree = SegmentTree(leaves)
        small, put = len(tree.levels) == 1, tree.put
        while (low := min(leaves) if small else tree.root()) != never:
            i = low % n
            j = after[i]
            own = ids[i] = pairs((ids[i], ids[j]))[1]
            ids[j] = -1
            after[i] = k = after[j]
            right = never
            if k < n:
                before[k] = i
                if hit := pairs((own, ids[k])):
                    right = hit[0] * n + i
            h = before[i]
            if small:
                leaves[j] = never
                leaves[i] = right
                if h >= 0:
                    leaves[h] = hit[0] * n + h if (hit := pairs((ids[h], own))) else never
            else:
                put(j, never)
                put(i, right)
                if h >= 0:
                    put(h, hit[0] * n + h if (hit := pairs((ids[h], own))) else never)
        return tuple(i for i in ids if i >= 0)

    def _plain(self, text: str) -> list[int]:
        if len(self.known) >= self.remember:
            self.known = _Known(self, self.known)
        return [*chain.from_iterable(map(self.known.__getitem__, self.pieces(text)))]

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if self.find_added is None or not any(a in text for a in self.added):
            return self._plain(text)
        ids: list[int] = []
        at = 0
        for m in self.find_added.finditer(text):
            ids += self._plain(text[at : m.start()])
            ids.append(self.added[m[0]])
            at = m.end()
        return ids + self._plain(text[at:])

    def decode(self, ids) -> str:
        """All bytes together, then UTF-8; bytes that aren't valid become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


class _Known(dict):
    """Pieces met so far in two generations: when the young one is full it becomes the old one of the next."""

    def __init__(self, codec: Codec, old: dict | None = None):
        super().__init__()
        if old is not None:
            old.old = {}
        self.codec, self.old = codec, old if old is not None else {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.codec.merge(piece.encode("utf-8", "replace"))
            if len(piece) > LONGEST:
                return ids
        self[piece] = ids
        return ids


def codec_of(vocabulary: str, remember: int = MEMORY) -> Codec:
    """The codec of a vocabulary; a worker keeps the last one, and the pieces it has met, from task to task."""
    return held(f"bpe{remember}-{hashlib.sha256(vocabulary.encode()).hexdigest()}", lambda: Codec(vocabulary, remember))


def read_vocabulary(path: str) -> str:
    """The text of a vocabulary file; read on the driver and sent to tasks (its size is the file's)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_decode(
    docs: DataFrame,
    vocabulary: str,
    text_col: str = "text",
    ids_col: str = "ids",
    decoded_col: str | None = "decoded",
    keep: list[str] | None = None,
    remember: int = MEMORY,
) -> DataFrame:
    """Add the ids of each whole text and, unless ``decoded_col`` is None, their decoding.

    ``vocabulary`` is the text of a tokenizer file (see ``read_vocabulary``).  No
    shuffle: a map over the rows, in slices of bounded size.  ``remember`` bounds the pieces
    that a worker keeps: fewer take less memory and more merging.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    fields = [T.StructField(ids_col, T.ArrayType(T.IntegerType(), False))]
    if decoded_col:
        fields.append(T.StructField(decoded_col, T.StringType()))

    def make():
        codec = codec_of(shared.value, remember)

        def work(texts: list) -> list:
            ids = [codec.encode(t) for t in texts]
            return [ids, [codec.decode(i) for i in ids]] if decoded_col else [ids]

        return work

    return map_text(docs, text_col, fields, make, keep=keep, slice_bytes=1 << 20)


def decode_ids(df: DataFrame, vocabulary: str, ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """Decode a column of id arrays; a null array decodes as the empty text."""
    from pyspark.sql import functions as F

    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    @F.pandas_udf(T.StringType())
    def decode(parts):
        import pandas as pd

        codec = codec_of(shared.value)
        return pd.Series([codec.decode(ids if ids is not None else ()) for ids in parts])

    return df.withColumn(decoded_col, decode(ids_col))

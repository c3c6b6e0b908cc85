"""Chat formatting of typed content parts, with DataFrame functions only.

Each turn is an array of parts (text, image, audio, document).  A visitor walks the
parts in order: text is escaped and kept, every other part becomes one placeholder
and an attachment record (turn, part, kind, reference, expanded token count).  Turns
are marked as ``<|im_start|>role\\ntext<|im_end|>\\n``; control strings inside texts
and roles are escaped with backslashes, reversibly, so none survives in the output
except the template's own.  What assistants say is under the loss mask.

Defined results: a null text or role is the empty string; null parts are skipped;
unknown kinds are treated as documents; turns with equal number go by role and
content; null turn numbers come first; repeated rows are turns each; rows with a
null conv_id form one conversation; no rows give no rows.

A conversation is one output value, so it must fit one; its turns are rendered before
the shuffle and put together in blocks of ``BLOCK`` turn numbers first, so that a very
long conversation isn't sorted as single rows in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The template's own control strings.
START, END = "<|im_start|>", "<|im_end|>"
#: Tokens that one unit of a part expands to (an image patch, a second of audio, a page).
TOKENS_PER_UNIT = {"image": 1, "audio": 25, "document": 600}
#: Pixels on the side of an image patch.
PATCH = 14
BLOCK = 64

#: Where a backslash breaks a control string: after "<" or "[" that begins one.
_BREAK = r"(?<=<)(?=\||/?s>)|(?<=\[)(?=/?INST\])"

PART_TYPE = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"


def escape(text: Column) -> Column:
    """Double every backslash, then break each control string with one."""
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), _BREAK, r"\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    """A role ends at the first line break, so its own line breaks are spelled out first."""
    return F.regexp_replace(escape(role), "\n", "\\\\\n")


def text_part(text: Column) -> Column:
    """An array of one text part."""
    return F.array(
        F.struct(
            F.lit("text").alias("type"),
            text.alias("text"),
            F.lit(None).cast("string").alias("ref"),
            F.lit(None).cast("int").alias("width"),
            F.lit(None).cast("int").alias("height"),
            F.lit(None).cast("double").alias("seconds"),
            F.lit(None).cast("int").alias("pages"),
        )
    )


def _kind(p: Column) -> Column:
    return F.when(p["type"].isin("text", "image", "audio"), p["type"]).otherwise(F.lit("document"))


def expanded_tokens(p: Column) -> Column:
    """Tokens that a part's placeholder stands for; 0 for text, 1 at least for others."""
    side = lambda c: F.ceil(F.coalesce(c, F.lit(0)) / F.lit(PATCH))
    units = (
        F.when(p["type"] == "image", side(p["width"]) * side(p["height"]) * TOKENS_PER_UNIT["image"])
        .when(p["type"] == "audio", F.ceil(F.coalesce(p["seconds"], F.lit(0.0)) * TOKENS_PER_UNIT["audio"]))
        .otherwise(F.coalesce(p["pages"], F.lit(0)) * TOKENS_PER_UNIT["document"])
        .cast("bigint")
    )
    return F.when(p["type"] == "text", F.lit(0).cast("bigint")).otherwise(F.greatest(units, F.lit(1).cast("bigint")))


def _visit(p: Column, i: Column) -> Column:
    """The output of one part: escaped text or a placeholder.  No control string can form where two parts meet."""
    text = escape(F.coalesce(p["text"], F.lit("")))
    text = F.when(i == 0, text).otherwise(F.regexp_replace(text, r"^(?=[|/sI])", r"\\"))
    return F.when(p["type"] == "text", text).otherwise(F.concat(F.lit("<|"), _kind(p), F.lit("|>")))


def format_chat(turns: DataFrame, parts_col: str = "parts", loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``n_turns``, ``loss_spans``, ``attachments``, ``n_expanded``.

    ``turns`` has conv_id, turn, role and ``parts_col`` (``PART_TYPE``); other columns
    are ignored.  ``loss_spans`` holds, for each turn under the loss mask, its number in
    the conversation and the code points [begin, end) of its content, counted from the
    start of the turn (``turn_begin`` of the whole text), so that a reader can split the
    text once and cut each turn by itself.
    """
    parts = F.filter(F.coalesce(F.col(parts_col), F.array().cast(PART_TYPE)), lambda p: p.isNotNull())
    rows = turns.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        parts.alias("parts"),
    ).select(
        "conv_id",
        "turn",
        F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")).alias("head"),
        F.array_join(F.transform("parts", _visit), "").alias("body"),
        F.filter(
            F.transform(
                "parts",
                lambda p, i: F.struct(
                    i.alias("part"), _kind(p).alias("kind"), p["ref"].alias("ref"), expanded_tokens(p).alias("tokens")
                ),
            ),
            lambda a: a["kind"] != "text",
        ).alias("files"),
        (F.col("role") == loss_role).alias("loss"),
    )
    turn = F.struct("turn", "head", "body", "loss", "files")
    blocks = (
        rows.groupBy("conv_id", F.floor(F.col("turn") / BLOCK).alias("block"))
        .agg(F.sort_array(F.collect_list(turn)).alias("turns"))
        .select(
            "conv_id",
            F.struct(
                "block",
                F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END + "\n"))), "").alias("text"),
                F.transform(
                    "turns",
                    lambda t: F.struct(
                        F.length(t["head"]).cast("bigint").alias("head"),
                        F.length(t["body"]).cast("bigint").alias("body"),
                        t["loss"].alias("loss"),
                        t["files"].alias("files"),
                    ),
                ).alias("turns"),
            ).alias("b"),
        )
    )
    whole = blocks.groupBy("conv_id").agg(F.sort_array(F.collect_list("b")).alias("blocks")).select(
        "conv_id",
        F.array_join(F.transform("blocks", lambda b: b["text"]), "").alias("formatted"),
        F.flatten(F.transform("blocks", lambda b: b["turns"])).alias("turns"),
    )
    # Spans count from their own turn, so no running sum over a long conversation is needed.
    return whole.select(
        "conv_id",
        "formatted",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.filter(
            F.transform(
                "turns",
                lambda t, i: F.struct(
                    i.cast("bigint").alias("turn"),
                    t["head"].alias("begin"),
                    (t["head"] + t["body"]).alias("end"),
                    t["loss"].alias("loss"),
                ),
            ),
            lambda s: s["loss"],
        ).alias("loss_spans"),
        F.flatten(
            F.transform(
                "turns",
                lambda t, i: F.transform(
                    t["files"],
                    lambda f: F.struct(
                        i.cast("bigint").alias("turn"),
                        f["part"].alias("part"),
                        f["kind"].alias("kind"),
                        f["ref"].alias("ref"),
                        f["tokens"].alias("tokens"),
                    ),
                ),
            )
        ).alias("attachments"),
    ).withColumn("n_expanded", F.aggregate("attachments", F.lit(0).cast("bigint"), lambda s, a: s + a["tokens"]))


def read_back(formatted: DataFrame) -> DataFrame:
    """Add ``turns`` (role and text, unescaped) and ``loss_text``, both taken from the formatted text alone and its mask."""
    marked = F.split("formatted", r"<\|im_end\|>\n")
    chunk = F.slice("chunks", 1, F.size("chunks") - 1)
    head = r"(?s)^<\|im_start\|>((?:[^\\\n]|\\.)*+)\n(.*)$"
    return (
        formatted.withColumn("chunks", marked)
        .withColumn("chunks", chunk)
        .withColumn(
            "turns",
            F.transform(
                "chunks",
                lambda c: F.struct(
                    unescape(F.regexp_extract(c, head, 1)).alias("role"), unescape(F.regexp_extract(c, head, 2)).alias("text")
                ),
            ),
        )
        .withColumn(
            "loss_text",
            F.array_join(
                F.transform(
                    "loss_spans",
                    lambda s: unescape(
                        F.substring(
                            F.get("chunks", s["turn"].cast("int")),
                            (s["begin"] + 1).cast("int"),
                            (s["end"] - s["begin"]).cast("int"),
                        )
                    ),
                ),
                "",
            ),
        )
        .drop("chunks")
    )

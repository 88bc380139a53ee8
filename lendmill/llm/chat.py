"""Chat formatting of typed content parts, with built-in functions only.

A message has ordered parts of kind text, image, audio or document. A visitor turns each
part into text: text parts with the control strings in them broken up reversibly, all
others into a placeholder, an attachment reference and the number of tokens that the
placeholder stands for. A turn is written as

    <|turn|>ROLE<|text|>CONTENT<|end|>

and its content is under the loss mask if the role is the trained one.

A conversation is written in consecutive parts of a bounded number of turns, so that no
task has to hold a long one; put together they are the conversation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
KINDS = ("image", "audio", "document")
TRAINED = "assistant"
TURNS_EACH = 64

#: Tokens of an image: a base and so many for each tile; of audio by second; by page.
TILE, TILE_TOKENS, IMAGE_TOKENS = 512, 170, 85
TOKENS_PER_SECOND = 25
TOKENS_PER_PAGE = 1024

CONTENT = (
    "array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
)

_CONTROL = r"<(?=\|[A-Za-z_]+\|>|/?s>)|\[(?=/?[A-Z_]+\])"


def escaped(text: Column) -> Column:
    """Control strings get a backslash after their first character, backslashes are doubled."""
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), _CONTROL, r"$0\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_part(text: Column) -> Column:
    """A part of kind text, for messages that are nothing else."""
    empty = {
        "kind": F.lit("text"), "text": text, "ref": F.lit(None).cast("string"),
        "width": F.lit(None).cast("int"), "height": F.lit(None).cast("int"),
        "seconds": F.lit(None).cast("double"), "pages": F.lit(None).cast("int"),
    }
    return F.struct(*(value.alias(name) for name, value in empty.items()))


def _tokens(part: Column) -> Column:
    """0 where a size is not given."""
    tiles = F.ceil(part["width"] / TILE) * F.ceil(part["height"] / TILE)
    found = (
        F.when(part["kind"] == "image", tiles * TILE_TOKENS + IMAGE_TOKENS)
        .when(part["kind"] == "audio", F.ceil(part["seconds"] * TOKENS_PER_SECOND))
        .when(part["kind"] == "document", part["pages"].cast("long") * TOKENS_PER_PAGE)
    )
    return F.coalesce(found, F.lit(0)).cast("long")


def _visited(part: Column) -> Column:
    """The text that a part becomes; a part of an unknown kind or without kind counts as text."""
    placeholder = reduce(
        lambda case, kind: case.when(part["kind"] == kind, F.lit(f"<|{kind}|>")),
        KINDS[1:],
        F.when(part["kind"] == KINDS[0], F.lit(f"<|{KINDS[0]}|>")),
    )
    return placeholder.otherwise(escaped(F.coalesce(part["text"], F.lit(""))))


def format_chat(messages: DataFrame, trained: str = TRAINED, turns_each: int = TURNS_EACH) -> DataFrame:
    """Rows ``conv_id``, ``part``, ``n_turns``, ``formatted``, ``loss`` (start and length of
    each masked span in code points), ``attachments`` (``place`` among those of the part,
    ``turn``, ``kind``, ``ref``, ``n_tokens``) and ``n_tokens`` of the placeholders.

    ``messages`` has ``conv_id``, ``turn``, ``role`` and ``content`` (see ``CONTENT``).
    Turns are ordered by number, null first, and equal numbers by role and content; a
    repeated row is written each time. A null role, content or part is empty. Messages
    without ``conv_id`` make up one conversation. Other columns are ignored.
    """
    parts = F.filter(F.coalesce("content", F.array().cast(CONTENT)), lambda p: p.isNotNull())
    attached = F.filter(parts, lambda p: p["kind"].isin(*KINDS))
    head = F.concat(F.lit(TURN), escaped(F.coalesce("role", F.lit(""))), F.lit(TEXT))
    turns = messages.select(
        "conv_id",
        F.floor(F.col("turn") / turns_each).alias("part"),
        F.struct(
            "turn",
            "role",
            head.alias("head"),
            F.array_join(F.transform(parts, _visited), "").alias("body"),
            F.transform(
                attached,
                lambda p: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), _tokens(p).alias("n_tokens")),
            ).alias("attached"),
        ).alias("turn"),
    )
    in_order = turns.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    at = F.aggregate(
        "turns",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda found, t: F.struct(
            (found["at"] + F.length(t["head"]) + F.length(t["body"]) + len(END)).alias("at"),
            F.when(
                t["role"] == trained,
                F.concat(
                    found["spans"],
                    F.array(
                        F.struct(
                            (found["at"] + F.length(t["head"])).alias("start"),
                            F.length(t["body"]).alias("length"),
                        )
                    ),
                ),
            )
            .otherwise(found["spans"])
            .alias("spans"),
        ),
    )
    references = F.flatten(
        F.transform(
            "turns",
            lambda t: F.transform(t["attached"], lambda a: F.struct(t["turn"].alias("turn"), a.alias("a"))),
        )
    )
    return in_order.select(
        "conv_id",
        "part",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("formatted"),
        at["spans"].alias("loss"),
        F.transform(
            references,
            lambda r, i: F.struct(
                i.alias("place"), r["turn"].alias("turn"), r["a"]["kind"].alias("kind"),
                r["a"]["ref"].alias("ref"), r["a"]["n_tokens"].alias("n_tokens"),
            ),
        ).alias("attachments"),
        F.aggregate(references, F.lit(0).cast("long"), lambda n, r: n + r["a"]["n_tokens"]).alias("n_tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted part as an array of ``role`` and ``text``, unescaped."""
    pieces = F.filter(F.split(formatted, r"<\|turn\|>", -1), lambda x: x != "")
    return F.transform(
        pieces,
        lambda x: F.struct(
            unescaped(F.substring_index(x, TEXT, 1)).alias("role"),
            unescaped(F.regexp_replace(F.regexp_replace(x, r"(?s)\A.*?<\|text\|>", ""), r"<\|end\|>\z", "")).alias("text"),
        ),
    )


def read_loss(formatted: Column, loss: Column) -> Column:
    """The unescaped text of each masked span."""
    return F.transform(
        loss, lambda s: unescaped(F.substring(formatted, s["start"] + 1, s["length"]))
    )


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """What the formatted parts say, read back: one row for each conversation."""
    turns = F.transform(
        read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    parts = formatted.select(
        "conv_id",
        "n_turns",
        F.length("formatted").cast("long").alias("chars"),
        F.struct(
            "part",
            F.array_join(turns, "").alias("turns"),
            F.array_join(read_loss(F.col("formatted"), F.col("loss")), "").alias("loss"),
        ).alias("piece"),
    )
    whole = parts.groupBy("conv_id").agg(
        F.sum("n_turns").alias("n_turns"),
        F.sum("chars").alias("formatted_chars"),
        F.sort_array(F.collect_list("piece")).alias("pieces"),
    )
    joined = lambda name: F.array_join(F.transform("pieces", lambda p: p[name]), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(joined("turns"), 256).alias("turns_sha256"),
        F.length(joined("loss")).cast("long").alias("loss_chars"),
        F.sha2(joined("loss"), 256).alias("loss_sha256"),
        "formatted_chars",
    )

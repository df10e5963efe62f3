"""Chat formatting with typed content parts, in column expressions only.

A turn's content is an array of parts: text, image, audio or document. Text is
escaped; every other part becomes a placeholder, and its reference and the
tokens that it will take are recorded in the order of the placeholders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
#: Side of the square of an image that is one token, tokens of a second of audio and of a page.
PATCH, PER_SECOND, PER_PAGE = 28, 25, 256
#: What starts a control string here or in common templates, and what stands for it in a text.
ESCAPES = (("\\", "\\s"), ("<", "\\l"), ("[", "\\b"))


def escaped(text: Column) -> Column:
    """The text without any character that starts a control string; null is empty."""
    out = F.coalesce(text, F.lit(""))
    for plain, code in ESCAPES:
        out = F.replace(out, F.lit(plain), F.lit(code))
    return out


def unescaped(text: Column) -> Column:
    out = text
    for plain, code in reversed(ESCAPES):
        out = F.replace(out, F.lit(code), F.lit(plain))
    return out


def text_part(text: Column) -> Column:
    """Content of a turn that is only text."""
    part = F.struct(
        F.lit("text").alias("kind"), text.cast("string").alias("text"), F.lit(None).alias("ref"), F.lit(None).alias("width"),
        F.lit(None).alias("height"), F.lit(None).alias("seconds"), F.lit(None).alias("pages"),
    )
    return F.array(part.cast(PART))


def _visited(part: Column) -> Column:
    """What a part is in the formatted text. Unknown kinds and null parts are their text."""
    out = escaped(part["text"])
    for kind, mark in PLACEHOLDERS.items():
        out = F.when(part["kind"] == kind, F.lit(mark)).otherwise(out)
    return out


def _tokens(part: Column) -> Column:
    image = F.ceil(F.coalesce(part["width"], F.lit(0)) / PATCH) * F.ceil(F.coalesce(part["height"], F.lit(0)) / PATCH)
    audio = F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * PER_SECOND)
    page = F.coalesce(part["pages"], F.lit(0)).cast("long") * PER_PAGE
    return F.when(part["kind"] == "image", image).when(part["kind"] == "audio", audio).otherwise(page).cast("long")


def format_chats(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts") -> DataFrame:
    """One row per conversation: ``formatted`` text, ``loss`` spans and ``attachments``.

    ``loss`` holds start and end, in code points, of every assistant content.
    ``attachments`` holds turn, kind, reference and expanded tokens of all parts
    that are no text, in the order of their placeholders. Turns are ordered by
    number (null first), then role and content; repeated rows are turns of their own. A null
    conversation id is a conversation. Null roles, contents and texts are
    empty. A conversation is one row of the result, so its turns meet in one task. Other
    columns are ignored; an empty table gives an empty result.
    """
    visited = F.transform(F.coalesce(F.col(parts), F.array().cast(f"array<{PART}>")), _visited)
    rows = turns.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.array_join(visited, "").alias("content"),
        F.filter(F.col(parts), lambda p: p["kind"].isin(*PLACEHOLDERS)).alias("others"),
    )
    rows = rows.withColumn("head", F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(TEXT)))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "content")
    before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    place = F.row_number().over(order)
    end = F.sum(F.length("head") + F.length("content") + len(END)).over(before) - len(END)
    placed = rows.withColumn("place", place).withColumn("end", end)
    # The window has dealt and sorted the rows by conversation; grouping needs no further shuffle.
    grouped = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "role", F.concat("head", "content", F.lit(END)).alias("piece"), "end", F.length("content").alias("size"), "turn", "others"))).alias("turns")
    )
    spans = F.transform(
        F.filter("turns", lambda t: t["role"] == "assistant"), lambda t: F.struct((t["end"] - t["size"]).alias("start"), t["end"].alias("end"))
    )
    attached = F.flatten(
        F.transform(
            "turns",
            lambda t: F.transform(
                F.coalesce(t["others"], F.array().cast(f"array<{PART}>")),
                lambda p: F.struct(t["turn"].alias("turn"), p["kind"].alias("kind"), p["ref"].alias("ref"), _tokens(p).alias("tokens")),
            ),
        )
    )
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        spans.alias("loss"),
        attached.alias("attachments"),
        F.aggregate(attached, F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("attachment_tokens"),
    )


def turns_of(formatted: Column) -> Column:
    """Turns read back from formatted text: array of role and text (placeholders stay as they are)."""
    pieces = F.filter(F.split(formatted, r"<\|turn\|>", -1), lambda p: p != "")

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, TEXT, 1)
        content = F.replace(F.substring(piece, F.length(role) + len(TEXT) + 1, F.length(piece)), F.lit(END), F.lit(""))
        return F.struct(unescaped(role).alias("role"), unescaped(content).alias("text"))

    return F.transform(pieces, turn)


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescaped(F.substring(formatted, s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int")))), "")

"""Chat formatting: conversations of typed content parts as training text.

A conversation is rows of turns, a turn an ordered list of parts: text, or an
image, an audio clip or a document that is kept elsewhere. A visitor flattens
the parts in order: text is escaped, everything else becomes a numbered
placeholder, and what it stands for is recorded as an attachment: its number,
kind, reference, place in the text, and the tokens that it will be expanded to

* image: one token per started PATCH x PATCH pixels,
* audio: one per started 1 / AUDIO_RATE seconds,
* document: PAGE_TOKENS per page,

unless the part states its own count. A part of another kind, or one whose
size is not stated, counts as one token.

Template, with two parts of text and one image in the turn::

    <turn user>
    What is<part image 1>this?<part text>More text.</turn>

Every control string starts with ``<turn``, ``</turn`` or ``<part``. In a text
a backslash is doubled and one is put after the ``<`` of each of these, so an
escaped text holds no control string, whatever it is joined with, and dropping
the first of every two characters that start with a backslash restores it. A
role may be any string: it ends at the first ``>`` before a line break, and
these two are parted in the same way inside of a role.

The loss mask is a list of spans [start, end) in code points of the formatted
text, one per non-empty text part of a turn whose role is to be learnt;
placeholders, headers and end marks are outside of it.

Everything is SQL functions. The rows are dealt by conversation once; numbers
and places are running sums of windows in that partitioning, so a
conversation with very many turns is streamed, and only its finished string
and lists are one row, which is what a conversation is (2 GB at most).

Defined results: a null text, an empty list of parts and a null one are an
empty text; a null role is an empty one; a null kind is ``text``; turns that
share a number are ordered by role, then by parts, and repeated rows each
count; a null turn number sorts first; rows with a null id are one
conversation; an empty table gives no row; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PATCH = 28
AUDIO_RATE = 25.0
PAGE_TOKENS = 256
# What control strings of the template start with, and its end mark.
OPENERS = ("<turn", "</turn", "<part")
END = "</turn>\n"

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int,tokens:long>"


def text_part(text: Column) -> Column:
    """A part of plain text."""
    return F.struct(F.lit("text").alias("type"), text.alias("text"), *[
        F.lit(None).cast(kind).alias(name)
        for name, kind in (x.split(":") for x in PART.removeprefix("struct<").removesuffix(">").split(",")[2:])
    ]).cast(PART)


def escape(text: Column) -> Column:
    """``text`` without any control string."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for opener in OPENERS:
        out = F.replace(out, F.lit(opener), F.lit("<\\" + opener[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("\\")), F.regexp_replace(text, r"(?s)\\(.)", "$1")).otherwise(text)


def _header(role: Column) -> Column:
    return F.concat(F.lit("<turn "), F.replace(escape(role), F.lit(">\n"), F.lit(">\\\n")), F.lit(">\n"))


def expanded_tokens(part: Column) -> Column:
    """How many tokens an attachment stands for."""

    def units(x: Column) -> Column:
        return F.greatest(F.coalesce(F.ceil(x), F.lit(1)), F.lit(1)).cast("long")

    size = F.when(
        part["type"] == "image", units(part["width"] / PATCH) * units(part["height"] / PATCH)
    ).when(part["type"] == "audio", units(part["seconds"] * AUDIO_RATE)).when(
        part["type"] == "document", F.coalesce(units(part["pages"]) * F.when(part["pages"].isNotNull(), PAGE_TOKENS), F.lit(1))
    )
    return F.coalesce(part["tokens"], size, F.lit(1)).cast("long")


def visit(turns: DataFrame, loss_roles: Sequence[str]) -> DataFrame:
    """The visitor: one row per part of the turns (id, turn, role, parts), in
    the partitioning by id: id, seq (turn), pos (part in the turn), piece (its
    text in the formatted conversation), start (the piece's place in it),
    before (code points of the header in the piece), body (code points of an
    escaped text), learnt, and the attachment's number, kind, ref and tokens,
    null for a text."""
    order = Window.partitionBy("id").orderBy("turn", "role", "parts")
    numbered = turns.withColumn("seq", F.row_number().over(order))
    parts = F.coalesce(F.when(F.size("parts") > 0, F.col("parts")), F.array(text_part(F.lit(""))))
    flat = numbered.select("id", "seq", "role", F.size(parts).alias("n_parts"), F.posexplode(parts).alias("pos", "part"))
    kind = F.coalesce(F.col("part.type"), F.lit("text"))
    along = Window.partitionBy("id").orderBy("seq", "pos")
    sofar = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flat = flat.withColumns(
        {
            "kind": kind,
            "escaped": F.when(kind == "text", escape(F.coalesce(F.col("part.text"), F.lit("")))),
            "number": F.sum((kind != "text").cast("long")).over(sofar),
            "follows": F.lag(kind).over(along),
        }
    )
    text = F.col("kind") == "text"
    header = F.when(F.col("pos") == 0, _header(F.col("role"))).when(
        text & (F.col("follows") == "text"), F.lit("<part text>")
    ).otherwise(F.lit(""))
    mark = F.concat(F.lit("<part "), F.replace(escape(F.col("kind")), F.lit(">"), F.lit("\\>")), F.lit(" "), F.col("number"), F.lit(">"))
    flat = flat.withColumns({"header": header, "mark": F.when(~text, mark)})
    flat = flat.withColumn(
        "piece",
        F.concat("header", F.coalesce("escaped", "mark"), F.when(F.col("pos") + 1 == F.col("n_parts"), F.lit(END)).otherwise(F.lit(""))),
    )
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    return flat.select(
        "id", "seq", "pos", "piece",
        F.coalesce(F.sum(F.length("piece").cast("long")).over(before), F.lit(0).cast("long")).alias("start"),
        F.length("header").cast("long").alias("before"),
        F.coalesce(F.length("escaped"), F.lit(0)).cast("long").alias("body"),
        F.col("role").isin(list(loss_roles)).alias("learnt"),
        F.when(~text, F.col("number")).alias("number"),
        F.when(~text, F.col("kind")).alias("kind"),
        F.when(~text, F.col("part.ref")).alias("ref"),
        F.when(~text, expanded_tokens(F.col("part"))).alias("tokens"),
    )


def format_conversations(
    turns: DataFrame, loss_roles: Sequence[str] = ("assistant",), id_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str | None = "text", parts_col: str | None = None,
) -> DataFrame:
    """One row per conversation: id, formatted, n_turns, loss (spans),
    attachments (number, kind, ref, tokens, start) and n_expanded (their
    tokens). The parts are those of ``parts_col`` (an array of PART) or the
    one text of ``text_col``."""
    parts = F.col(parts_col).cast(f"array<{PART}>") if parts_col else F.array(text_part(F.col(text_col)))
    role = F.coalesce(F.col(role_col), F.lit(""))
    rows = turns.select(F.col(id_col).alias("id"), F.col(turn_col).alias("turn"), role.alias("role"), parts.alias("parts"))
    at = F.col("start") + F.col("before")
    span = F.when(F.col("learnt") & (F.col("body") > 0), F.struct(at.alias("start"), (at + F.col("body")).alias("end")))
    attachment = F.when(F.col("number").isNotNull(), F.struct("number", "kind", "ref", "tokens", at.alias("start")))
    # Lists leave nulls out. A piece carries its place, since a list has none.
    lists = (
        visit(rows, loss_roles)
        .groupBy("id")
        .agg(
            F.sort_array(F.collect_list(F.struct("seq", "pos", "piece"))).alias("pieces"),
            F.sort_array(F.collect_list(span)).alias("loss"),
            F.sort_array(F.collect_list(attachment)).alias("attachments"),
            F.max("seq").cast("long").alias("n_turns"),
            F.coalesce(F.sum("tokens"), F.lit(0)).cast("long").alias("n_expanded"),
        )
    )
    return lists.select("id", F.array_join(F.col("pieces.piece"), "").alias("formatted"), "n_turns", "loss", "attachments", "n_expanded")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of (role, text):
    texts unescaped, without the placeholders."""
    turns = F.split(formatted, END, -1)

    def turn(x: Column) -> Column:
        role = F.substring_index(x, ">\n", 1)
        body = F.substr(x, F.length(role) + 3)
        marks = F.when(F.contains(body, F.lit("<part ")), F.regexp_replace(body, r"<part (?:[^>\\]|\\.)*+>", "")).otherwise(body)
        return F.struct(unescape(F.substr(role, F.lit(len("<turn ") + 1))).alias("role"), unescape(marks).alias("text"))

    return F.transform(F.slice(turns, 1, F.size(turns) - 1), turn)


def masked_text(formatted: Column, loss: Column) -> Column:
    """The unescaped text under the loss mask."""
    parts = F.transform(loss, lambda x: unescape(F.substr(formatted, x["start"] + 1, x["end"] - x["start"])))
    return F.array_join(parts, "")

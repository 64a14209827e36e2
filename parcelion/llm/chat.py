"""Chat formatting with a grammar round trip.

    conversation := turn*
    turn         := "### " role ": " body " </turn>" newline

Role and body are written as they are unless reading the turn back gives something else (or one of them holds a
control string, which the parser refuses); then role and body are escaped and read back again.
Escapes are a backslash and a letter, so that an escaped text holds neither "<" nor "#", and an
escaped role no ":". Only DataFrame functions are used.

The result has, per conversation, ``turns`` (the source, in order), ``pieces`` (text and whether it is
under the loss mask; joined they are the formatted conversation) and ``round_trip`` (whether the
parser gives back the turns).

Defined results: null role or text is empty; rows go by turn, then role, then text, null turns
first; repeated rows are turns of their own; null conversation ids form one conversation; an empty table
gives an empty result; columns besides the four named ones are ignored. A conversation is one row of
the result, so it must fit in a row (2 GB).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "### ", ": ", " </turn>\n"
# Control strings that may not stand in a role or body.
CONTROL = ["</turn>", "###"]
# Character and its escape; the backslash comes first when escaping and last when reading.
ESCAPES = [("\\", "\\b"), ("<", "\\l"), ("#", "\\h"), (":", "\\c")]


def escape(text: Column, role: bool = False) -> Column:
    used = ESCAPES if role else ESCAPES[:3]
    return reduce(lambda out, pair: F.replace(out, F.lit(pair[0]), F.lit(pair[1])), used, text)


def unescape(text: Column) -> Column:
    return reduce(lambda out, pair: F.replace(out, F.lit(pair[1]), F.lit(pair[0])), ESCAPES[::-1], text)


def parse_turn(turn: Column) -> Column:
    """Struct (role, text) of a turn without its closing mark; null when it is no turn."""
    header = F.substring_index(turn, MIDDLE, 1)
    body = F.substr(turn, F.char_length(header) + len(MIDDLE) + 1)
    role = F.substr(header, F.lit(len(OPEN) + 1))
    refused = reduce(lambda out, mark: out | F.contains(body, F.lit(mark)) | F.contains(role, F.lit(mark)), CONTROL, F.lit(False))
    return F.when(
        F.startswith(turn, F.lit(OPEN)) & F.contains(turn, F.lit(MIDDLE)) & ~refused,
        F.struct(unescape(role).alias("role"), unescape(body).alias("text")),
    )


def parse(formatted: Column) -> Column:
    """Turns of a formatted conversation, as an array of (role, text)."""
    parts = F.split(formatted, CLOSE, -1)
    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), parse_turn)


def formatted(pieces: Column) -> Column:
    return F.array_join(F.transform(pieces, lambda p: p["piece"]), "")


def under_loss(pieces: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    kept = F.filter(pieces, lambda p: p["loss"])
    return F.array_join(F.transform(kept, lambda p: unescape(p["piece"])), "")


def format_chat(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    loss_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: ``conv_col``, ``turns``, ``pieces``, ``round_trip``."""
    source = rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    plain = F.concat(F.lit(OPEN), "role", F.lit(MIDDLE), "text")
    same = F.struct(F.col("role"), F.col("text"))
    rendered = source.withColumn("plain", F.coalesce(parse_turn(plain) == same, F.lit(False)))
    rendered = rendered.select(
        "conv", "turn", "role", "text",
        F.when(F.col("plain"), F.col("role")).otherwise(escape(F.col("role"), role=True)).alias("shown_role"),
        F.when(F.col("plain"), F.col("text")).otherwise(escape(F.col("text"))).alias("shown"),
    )
    grouped = rendered.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "shown_role", "shown"))).alias("rows")
    )

    def piece(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("piece"), loss.alias("loss"))

    pieces = F.flatten(F.transform("rows", lambda r: F.array(
        piece(F.concat(F.lit(OPEN), r["shown_role"], F.lit(MIDDLE)), F.lit(False)),
        piece(r["shown"], r["role"] == loss_role),
        piece(F.lit(CLOSE), F.lit(False)),
    )))
    turns = F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text")))
    out = grouped.select("conv", turns.alias("turns"), pieces.alias("pieces"))
    return out.select(
        F.col("conv").alias(conv_col), "turns", "pieces",
        (parse(formatted(F.col("pieces"))) == F.col("turns")).alias("round_trip"),
    )

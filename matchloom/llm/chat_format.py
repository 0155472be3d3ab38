"""Chat formatting and reading back, in column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, ROLE, TEXT, NEXT, END = "<s>", "[ROLE]", "[TEXT]", "[NEXT]", "</s>"
# strings that no text may contain as they are, after their first character
_TAILS = r"/?s>|/?INST\]|ROLE\]|TEXT\]|NEXT\]|</?SYS>>"


def escape(text: Column) -> Column:
    """One more backslash after the first character of every control string, whatever backslashes it has."""
    return F.regexp_replace(text, rf"([<\[])(\\*)(?={_TAILS})", r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)(?={_TAILS})", "$1$2")


def _literal(marker: str) -> str:
    return marker.replace("[", r"\[").replace("]", r"\]")


def format_chats(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and ``loss_spans``.

    Turns are sorted by (turn, role, text); adjacent turns of one role become one block, whose texts stand
    apart by a marker, so that the turns can be read back. ``loss_spans`` holds (start from 1, length) of each
    text of ``loss_role`` within ``formatted``, in characters. Null texts and roles are empty; null turns come
    first; rows with a null ``conv_id`` are one conversation; repeated rows are repeated turns. Columns other
    than conv_id, turn, role and text are not read. An empty table gives no row. A conversation is one row, as
    its reader needs; conversations are short against a partition.
    """
    rows = turns.select(
        "conv_id",
        F.struct(
            F.col("turn"),
            F.coalesce(F.col("role"), F.lit("")).alias("role"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
        ).alias("turn"),
    )
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    size = lambda block: F.size(block["texts"])
    no_block = F.array().cast("array<struct<role:string,texts:array<string>>>")

    def merge(blocks: Column, turn: Column) -> Column:
        last = F.get(blocks, F.size(blocks) - 1)
        grown = F.struct(last["role"].alias("role"), F.concat(last["texts"], F.array(escape(turn["text"]))).alias("texts"))
        new = F.struct(escape(turn["role"]).alias("role"), F.array(escape(turn["text"])).alias("texts"))
        same = F.coalesce(last["role"] == escape(turn["role"]), F.lit(False))
        return F.when(same, F.concat(F.slice(blocks, 1, F.greatest(F.size(blocks) - 1, F.lit(0))), F.array(grown))).otherwise(
            F.concat(blocks, F.array(new))
        )

    blocks = whole.select("conv_id", F.aggregate("turns", no_block, merge).alias("blocks"))
    # pieces of the output in order, each with whether the loss counts it
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    plain = lambda text: piece(text, F.lit(False))
    pieces = F.flatten(
        F.transform(
            "blocks",
            lambda b: F.concat(
                F.array(plain(F.concat(F.lit(ROLE), b["role"], F.lit(TEXT)))),
                F.flatten(
                    F.transform(
                        b["texts"],
                        lambda t, i: F.array(
                            piece(t, b["role"] == F.lit(loss_role)),
                            plain(F.when(i + 1 == size(b), F.lit(END)).otherwise(F.lit(NEXT))),
                        ),
                    )
                ),
            ),
        )
    )
    with_pieces = blocks.select("conv_id", pieces.alias("pieces"))
    state = F.struct(F.lit(len(BEGIN) + 1).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(a: Column, p: Column) -> Column:
        n = F.length(p["text"])
        span = F.array(F.struct(a["at"].alias("start"), n.alias("length")))
        return F.struct((a["at"] + n).alias("at"), F.when(p["loss"], F.concat(a["spans"], span)).otherwise(a["spans"]).alias("spans"))

    return with_pieces.select(
        "conv_id",
        F.concat(F.lit(BEGIN), F.array_join(F.transform("pieces", lambda p: p["text"]), "")).alias("formatted"),
        F.aggregate("pieces", state, step, lambda a: a["spans"]).alias("loss_spans"),
    )


def read_chats(formatted: DataFrame) -> DataFrame:
    """``turns`` (role, text) and ``loss_text`` of each conversation, from the formatted string and its spans only."""
    body = F.substring(F.col("formatted"), F.lit(len(BEGIN) + 1), F.length("formatted"))
    # the last piece after the split is empty: every block ends with the end marker
    parts = F.split(body, _literal(END))
    blocks = F.slice(parts, 1, F.size(parts) - 1)

    def turns_of(block: Column) -> Column:
        role_and_texts = F.split(block, _literal(TEXT))
        role = unescape(F.substring(role_and_texts[0], F.lit(len(ROLE) + 1), F.length(role_and_texts[0])))
        return F.transform(
            F.split(role_and_texts[1], _literal(NEXT)), lambda t: F.struct(role.alias("role"), unescape(t).alias("text"))
        )

    loss = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"], s["length"])))
    return formatted.select(
        "conv_id", "formatted", F.flatten(F.transform(blocks, turns_of)).alias("turns"), F.array_join(loss, "").alias("loss_text")
    )

"""Chat formatting as a grammar round trip, in DataFrame functions only.

A turn is written as ``### role: text</turn>`` and a line break. The parser cuts at the end marks, takes the role up to the first
colon and space, and undoes escapes; a piece that does not start with the turn mark, or holds a turn or end mark inside, is no
turn. A conversation is first rendered as it is, parsed again and compared with its source. Where the recovered turns
differ, control strings inside roles and texts get a backslash (one more if they have some), which keeps them from being
control strings and can be undone exactly; the escaped form is parsed and compared as well, and anything that still differed
would be an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN = "### "
AFTER_ROLE = ": "
END = "</turn>"

# Control strings with the backslashes that escapes put into them: (pattern, escaped by, pattern to undo, undone by).
TEXT_ESCAPES = [
    (r"###(\\*) ", r"###\\$1 ", r"###\\(\\*) ", "###$1 "),
    (r"</turn(\\*)>", r"</turn\\$1>", r"</turn\\(\\*)>", "</turn$1>"),
]
ROLE_ESCAPES = [*TEXT_ESCAPES, (r":(\\*) ", r":\\$1 ", r":\\(\\*) ", ":$1 ")]


def _replaced(text: Column, escapes: list, at: int) -> Column:
    for escape in escapes:
        text = F.regexp_replace(text, escape[at], escape[at + 1])
    return text


def escaped(text: Column, escapes: list = TEXT_ESCAPES) -> Column:
    return _replaced(text, escapes, 0)


def unescaped(text: Column, escapes: list = TEXT_ESCAPES) -> Column:
    return _replaced(text, escapes, 2)


def _render(turns: Column, escape: bool) -> Column:
    def one(turn: Column) -> Column:
        role, text = turn["role"], turn["text"]
        if escape:
            role, text = escaped(role, ROLE_ESCAPES), escaped(text)
        return F.concat(F.lit(TURN), role, F.lit(AFTER_ROLE), text, F.lit(END + "\n"))

    return F.array_join(F.transform(turns, one), "")


def _pieces(formatted: Column) -> Column:
    cut = F.split(formatted, END + "\n", -1)
    return F.slice(cut, 1, F.size(cut) - 1)


def parse(formatted: Column) -> Column:
    """The turns of a rendered conversation as array<struct<role, text>>; a piece that is no turn has nulls."""

    def one(piece: Column) -> Column:
        at = F.instr(piece, AFTER_ROLE)
        role = F.substring(piece, F.lit(len(TURN) + 1), at - len(TURN) - 1)
        text = F.substring(piece, at + len(AFTER_ROLE), F.length(piece))
        whole = (
            piece.startswith(TURN) & (at > len(TURN)) & ~role.contains(TURN) & ~text.contains(TURN)
            & ~piece.contains(END)
        )
        return F.struct(
            F.when(whole, unescaped(role, ROLE_ESCAPES)).alias("role"), F.when(whole, unescaped(text)).alias("text"))

    return F.transform(_pieces(formatted), one)


def loss_spans(formatted: Column, learned: str = "assistant") -> Column:
    """array<struct<start, length>>: where the texts of the learned role stand, in code points from 0."""
    empty = F.expr("cast(array() as array<struct<start:int,length:int>>)")

    def step(done: Column, piece: Column) -> Column:
        head = F.instr(piece, AFTER_ROLE) + len(AFTER_ROLE) - 1
        role = F.substring(piece, F.lit(len(TURN) + 1), head - len(TURN) - len(AFTER_ROLE))
        span = F.struct(
            (done["at"] + head).cast("int").alias("start"), (F.length(piece) - head).cast("int").alias("length"))
        return F.struct(
            (done["at"] + F.length(piece) + len(END) + 1).cast("int").alias("at"),
            F.when(unescaped(role, ROLE_ESCAPES) == learned, F.concat(done["spans"], F.array(span)))
            .otherwise(done["spans"]).alias("spans"))

    start = F.struct(F.lit(0).cast("int").alias("at"), empty.alias("spans"))
    return F.aggregate(_pieces(formatted), start, step)["spans"]


def format_chats(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    learned: str = "assistant",
) -> DataFrame:
    """(conv_id, formatted, escaped, loss_spans): one rendered conversation per id.

    Turns come in the order of their number; ties, repeated rows and rows without a number are ordered by number (null
    first), role and text and all stay. A null text or role is empty; rows without an id are one conversation. A conversation
    is one value and must fit into a row. Other columns are dropped.
    """
    said = rows.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(
            F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).alias("said"),
    )
    grouped = said.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    source = grouped.select(
        "conv_id", F.transform("said", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    plain = source.withColumn("_plain", _render(F.col("turns"), False))
    plain = plain.withColumn("escaped", ~parse(F.col("_plain")).eqNullSafe(F.col("turns")))
    tried = plain.withColumn(
        "formatted", F.when(F.col("escaped"), _render(F.col("turns"), True)).otherwise(F.col("_plain")))
    same = ~F.col("escaped") | parse(F.col("formatted")).eqNullSafe(F.col("turns"))
    return tried.select(
        "conv_id",
        F.when(same, F.col("formatted")).otherwise(F.raise_error(F.lit("a conversation does not survive its round trip")))
        .alias("formatted"),
        "escaped",
    ).withColumn("loss_spans", loss_spans(F.col("formatted"), learned))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_text, formatted): what a reader recovers from rendered conversations and their masks."""
    return formatted.select(
        "conv_id", parse(F.col("formatted")).alias("turns"),
        F.array_join(
            F.transform("loss_spans", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))),
            "").alias("loss_text"),
        "formatted",
    )

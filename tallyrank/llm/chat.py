"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted. Adjacent turns of one role
become one block, and blocks and turns are joined into one text::

    <turn>user
    first text
    <part/>
    second text of the same role
    </turn>
    <turn>assistant
    answer
    </turn>

Inside texts a control string gets a backslash in front, and backslashes that stand right
before it are doubled; so the marks can be found by plain splitting and every text comes back
unchanged. Roles use percent signs for ``%``, ``<`` and line ends. The loss mask is a list of
code point spans, one for each assistant text as it stands in the output.

Defined results: a null text is empty; a null role is the empty role; null turns come first;
equal turn numbers are ordered by role and text; repeated rows stay. Rows with a null
conversation form one conversation. An empty table gives an empty result. A conversation is one
row of the output by definition, so its size is bounded by what one row can hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, PART, CLOSE = "<turn>", "<part/>", "</turn>"
_CONTROL = "(</?turn>|<part/>)"
_BETWEEN_TURNS = f"\n{CLOSE}\n"
_BETWEEN_PARTS = f"\n{PART}\n"


def escape(text: Column) -> Column:
    # A run of backslashes is only tried from its start and never in part, or long runs
    # would cost their square.
    return F.regexp_replace(text, r"(?<!\\)(\\*+)" + _CONTROL, r"$1$1\\$2")


def unescape(text: Column) -> Column:
    """Read from the end: behind a control string one backslash goes and pairs become one.

    ``\\G`` is where the last match ended, so each pair is looked at once.
    """
    behind = r"(>nrut/?<|>/trap<)\\|\G(?!\A)\\(\\)"
    return F.reverse(F.regexp_replace(F.reverse(text), behind, "$1$2"))


def escape_role(role: Column) -> Column:
    for plain, coded in (("%", "%25"), ("<", "%3C"), ("\n", "%0A")):
        role = F.replace(role, F.lit(plain), F.lit(coded))
    return role


def unescape_role(role: Column) -> Column:
    for plain, coded in (("\n", "%0A"), ("<", "%3C"), ("%", "%25")):
        role = F.replace(role, F.lit(coded), F.lit(plain))
    return role


def _with_prefix(turns: Column) -> Column:
    """Per turn: the marks in front of its text, the escaped text, whether it is masked in."""

    def piece(turn: Column, i: Column) -> Column:
        head = F.concat(F.lit(OPEN), escape_role(turn["role"]), F.lit("\n"))
        # get() gives null before the first turn.
        same = turn["role"] == F.get(turns, i - 1)["role"]
        prefix = (
            F.when(i == 0, head)
            .when(same, F.lit(_BETWEEN_PARTS))
            .otherwise(F.concat(F.lit(_BETWEEN_TURNS), head))
        )
        return F.struct(
            prefix.alias("prefix"),
            escape(turn["text"]).alias("text"),
            turn["role"].alias("role"),
        )

    return F.transform(turns, piece)


def _spans(pieces: Column, loss_role: str) -> Column:
    start = F.struct(
        F.lit(0).cast("long").alias("end"),
        F.array().cast("array<struct<first:bigint,length:bigint>>").alias("spans"),
    )

    def add(state: Column, piece: Column) -> Column:
        first = state["end"] + F.length(piece["prefix"])
        length = F.length(piece["text"]).cast("long")
        span = F.struct(first.alias("first"), length.alias("length"))
        spans = F.when(
            piece["role"] == loss_role, F.concat(state["spans"], F.array(span))
        ).otherwise(state["spans"])
        return F.struct((first + length).alias("end"), spans.alias("spans"))

    return F.aggregate(pieces, start, add, lambda state: state["spans"])


def format_chats(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    loss_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: id, formatted text, loss_spans (first, length)."""
    rows = turns.select(
        F.col(f"`{conv_col}`").alias("id"),
        F.struct(
            F.col(f"`{turn_col}`").alias("turn"),
            F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
            F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
        ).alias("one"),
    )
    chats = rows.groupBy("id").agg(F.sort_array(F.collect_list("one")).alias("turns"))
    chats = chats.select("id", _with_prefix(F.col("turns")).alias("pieces"))
    body = F.array_join(
        F.transform("pieces", lambda p: F.concat(p["prefix"], p["text"])), ""
    )
    return chats.select(
        "id",
        F.concat(body, F.lit(_BETWEEN_TURNS)).alias("formatted"),
        _spans(F.col("pieces"), loss_role).alias("loss_spans"),
    )


def read_chats(formatted: Column) -> Column:
    """The turns (role, text) that ``format_chats`` was given, from its output alone."""
    blocks = F.filter(F.split(formatted, _BETWEEN_TURNS, -1), lambda b: b != "")

    def turns(block: Column) -> Column:
        end = F.instr(block, "\n")
        role = unescape_role(F.substring(block, F.lit(len(OPEN) + 1), end - len(OPEN) - 1))
        texts = F.split(F.substring(block, end + 1, F.length(block)), _BETWEEN_PARTS, -1)
        return F.transform(
            texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text"))
        )

    return F.flatten(F.transform(blocks, turns))


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    parts = F.transform(
        spans,
        lambda s: unescape(
            F.substring(formatted, (s["first"] + 1).cast("int"), s["length"].cast("int"))
        ),
    )
    return F.array_join(parts, "")

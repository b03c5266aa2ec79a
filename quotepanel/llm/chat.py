"""Operator 5, chat formatting by event-sourced reconstruction (DataFrame functions only).

Input is a log of events (conv_id, seq, message, kind, role, text). Within a
conversation, in the order of ``seq``, the events of one message fold into its
final form: ``open`` begins it, ``delta`` appends streamed text, ``edit``
replaces the text so far, ``regenerate`` drops it so that later deltas start
again, ``delete`` drops the message. Messages stand in the order of ``message``.

Template: ``<|turn:role|>\\n`` text ``<|end|>\\n`` per message, between ``<s>``
and ``</s>``. Inside texts each control string gets one backslash after its
first character, and a control string that already has n of them gets n+1, so
taking one off restores every text; in roles the characters they are made of are spelled out. The loss mask is the list of
(begin, size) of assistant texts in code points of the formatted string.

Defined cases: null texts and roles are empty; a null kind is a ``delta``; ties in ``seq`` go by kind and
text; ``null`` is a conversation id like any other; conversations without a
message do not appear. A conversation is one output string, so its own
messages meet in one row; nothing else is gathered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Control strings of the template and of common chat formats.
CONTROL = r"(\|[^|<]*\|>|/?s>|/?INST\]|</?SYS>>)"
_LEAD = r"([<\[])"
#: What stands in roles for characters that control strings need; the backslash goes first.
ROLE_MARKS = (("\\", "\\b"), ("|", "\\p"), ("<", "\\l"), ("[", "\\o"))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _LEAD + r"(\\*)(?=" + CONTROL + ")", r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _LEAD + r"\\(\\*)(?=" + CONTROL + ")", "$1$2")


def escape_role(role: Column) -> Column:
    return reduce(lambda out, x: F.replace(out, F.lit(x[0]), F.lit(x[1])), ROLE_MARKS, role)


def unescape_role(role: Column) -> Column:
    return reduce(lambda out, x: F.replace(out, F.lit(x[1]), F.lit(x[0])), ROLE_MARKS[::-1], role)


def reconstruct(events: DataFrame) -> DataFrame:
    """conv_id, message, role, text: the final messages of the log."""
    events = events.withColumn("kind", F.coalesce("kind", F.lit("delta")))
    message = Window.partitionBy("conv_id", "message")
    so_far = message.orderBy("seq", "kind", "text").rowsBetween(Window.unboundedPreceding, 0)
    resets = F.col("kind").isin("edit", "regenerate")
    return (
        events.withColumn("reset", F.sum(resets.cast("int")).over(so_far))
        .withColumn("resets", F.max("reset").over(message))
        .groupBy("conv_id", "message")
        .agg(
            F.min_by("role", F.when(F.col("role").isNotNull(), F.struct("seq", "kind", "text"))).alias("role"),
            F.bool_or(F.col("kind") == "delete").alias("deleted"),
            F.sort_array(
                F.collect_list(F.when((F.col("reset") == F.col("resets")) & (F.col("kind") != "regenerate"), F.struct("seq", "kind", "text")))
            ).alias("parts"),
        )
        .filter(~F.coalesce("deleted", F.lit(False)))
        .select("conv_id", "message", F.coalesce("role", F.lit("")).alias("role"), F.concat_ws("", "parts.text").alias("text"))
    )


def render(messages: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_mask (array of begin, size) from final messages."""
    turn = F.struct(
        "message",
        (F.col("role") == "assistant").alias("learn"),
        F.concat(F.lit("<|turn:"), escape_role(F.col("role")), F.lit("|>\n")).alias("head"),
        escape(F.col("text")).alias("body"),
    )
    turns = messages.select("conv_id", turn.alias("turn")).groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    ends = "<|end|>\n"
    pieces = F.transform("turns", lambda t: F.concat(t.head, t.body, F.lit(ends)))

    def step(state, t):
        begin = state.at + F.length(t.head)
        size = F.length(t.body)
        return F.struct(
            (begin + size + F.lit(len(ends))).alias("at"),
            F.when(t.learn, F.concat(state.mask, F.array(F.struct(begin.alias("begin"), size.alias("size"))))).otherwise(state.mask).alias("mask"),
        )

    start = F.struct(F.lit(3).alias("at"), F.expr("cast(array() as array<struct<begin:int,size:int>>)").alias("mask"))
    return turns.select(
        "conv_id",
        F.concat(F.lit("<s>"), F.array_join(pieces, ""), F.lit("</s>")).alias("formatted"),
        F.aggregate("turns", start, step, lambda state: state.mask).alias("loss_mask"),
    )


def parsed(formatted: Column) -> Column:
    """Turns (role, text) read back from a formatted string; control strings of texts are escaped, so marks split it safely."""
    inner = F.substring(formatted, F.lit(4), F.length(formatted) - 7)
    blocks = F.split(inner, r"<\|end\|>\n")
    return F.transform(
        F.slice(blocks, F.lit(1), F.size(blocks) - 1),
        lambda b: F.struct(
            unescape_role(F.regexp_extract(b, r"(?s)^<\|turn:([^|]*)\|>\n", 1)).alias("role"),
            unescape(F.regexp_replace(b, r"(?s)^<\|turn:[^|]*\|>\n", "")).alias("text"),
        ),
    )


def learned(formatted: Column, mask: Column) -> Column:
    """The unescaped text under the loss mask."""
    return F.array_join(F.transform(mask, lambda m: unescape(F.substring(formatted, m.begin + 1, m.size))), "")


def digest(rendered: DataFrame) -> DataFrame:
    turns = parsed(F.col("formatted"))
    said = F.array_join(F.transform(turns, lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    loss = learned(F.col("formatted"), F.col("loss_mask"))
    return rendered.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def log_of(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as a log that folds back to them.

    A message is opened, a wrong draft is streamed, and then it is regenerated
    or edited and the rest of its text streamed in pieces; after every third
    message another one is begun and deleted again.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", F.row_number().over(order).alias("nth"), "role", F.coalesce("text", F.lit("")).alias("text"))
    third = F.ceil(F.length("text") / 3).cast("int")
    first, second = F.substring(F.col("text"), F.lit(1), third), F.substring(F.col("text"), third + 1, third)
    rest = F.substring(F.col("text"), 2 * third + 1, F.length("text"))
    again = F.col("nth") % 2 == 1

    def event(seq: int, kind: str | Column, text: Column, role: Column | None = None, late: int = 0) -> Column:
        role = F.lit(None).cast("string") if role is None else role
        kind = F.lit(kind) if isinstance(kind, str) else kind
        return F.struct((2 * F.col("nth") + late).alias("message"), F.lit(seq).alias("seq"), kind.alias("kind"), role.alias("role"), text.alias("text"))

    nothing, role = F.lit(None).cast("string"), F.coalesce("role", F.lit(""))
    streamed = F.array(
        event(0, "open", F.lit(""), role),
        event(1, "delta", F.reverse(first)),
        event(2, F.when(again, "regenerate").otherwise("edit"), F.when(~again, first)),
        event(3, "delta", F.when(again, first).otherwise(F.lit(""))),
        event(4, "delta", second),
        event(5, "delta", rest),
    )
    dropped = F.array(event(0, "open", F.lit(""), role, 1), event(1, "delta", F.reverse(first), None, 1), event(2, "delete", nothing, None, 1))
    events = F.concat(streamed, F.when(F.col("nth") % 3 == 0, dropped).otherwise(F.slice(dropped, 1, 0)))
    return rows.select("conv_id", F.inline(events))

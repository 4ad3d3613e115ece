"""Chat formatting from event logs.

Method: event-sourced reconstruction. The log of a conversation holds events in the order
of ``seq``: a *delta* appends text to its message, an *edit* or a *regenerate* discards
what the message said and starts anew with the event's text. Events are folded into final
messages, one per (conversation, turn); the messages of a conversation are rendered in
turn order with a mask of what is learned from (the assistant's words).

Only DataFrame functions are used. The fold runs by (conversation, turn), so a busy
conversation is spread over many tasks until its one formatted text is put together.

Template of a turn: ``### role: text</turn>`` and a line feed. In texts ``\\`` becomes
``\\b``, ``###`` becomes ``\\h`` and ``</turn>`` becomes ``\\t``; in roles also ``:``
becomes ``\\c``. So no text holds a mark, and reading back is exact.

Cases: null text counts as empty, a null role as an empty role; a null conversation id or
turn is a value of its own (first in order); events of the same ``seq`` are taken in the
order regenerate, edit, delta and then by text; repeated delta rows append repeatedly; an
unknown kind counts as a delta; of a table of whole messages every row is a message, those of an equal turn
in the order of role and text; empty tables give empty tables; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

END = "</turn>\n"
#: (text, its escape), in the order of escaping; undone in the opposite order
ESCAPES = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\t"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))


def escape(text: Column, escapes=ESCAPES) -> Column:
    for a, b in escapes:
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def unescape(text: Column, escapes=ESCAPES) -> Column:
    for a, b in reversed(escapes):
        text = F.replace(text, F.lit(b), F.lit(a))
    return text


def events_of_turns(turns: DataFrame) -> DataFrame:
    """The log of a table with one whole message a row (conv_id, turn, role, text). Rows of an equal
    turn are messages of their own: ``part`` numbers them by role and text."""
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    alike = Window.partitionBy("conv_id", "turn").orderBy(blank("role"), blank("text"))
    return turns.select("conv_id", "turn", F.row_number().over(alike).alias("part"), F.col("turn").alias("seq"), F.lit("delta").alias("kind"), "role", "text")


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, turn, part, role, text) of a log (conv_id, turn, seq, kind, role, text); with a
    column ``part`` a turn may have several messages."""
    order = F.when(F.col("kind") == "regenerate", 0).when(F.col("kind") == "edit", 1).otherwise(2)
    event = F.struct("seq", order.alias("step"), F.coalesce("text", F.lit("")).alias("text"), "role")
    events = events if "part" in events.columns else events.withColumn("part", F.lit(1))
    e = events.groupBy("conv_id", "turn", "part").agg(F.sort_array(F.collect_list(event)).alias("log"))
    e = e.withColumn("start", F.array_max(F.transform("log", lambda x, i: F.when(x["step"] < 2, i).otherwise(0))))
    e = e.withColumn("log", F.expr("slice(log, start + 1, size(log))"))
    role = F.try_element_at(F.filter(F.transform("log", lambda x: x["role"]), lambda r: r.isNotNull()), F.lit(-1))
    return e.select("conv_id", "turn", "part", F.coalesce(role, F.lit("")).alias("role"),
                    F.array_join(F.transform("log", lambda x: x["text"]), "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, n_turns, ``formatted`` and ``loss_spans``.

    A span is where an assistant's text lies in ``formatted``: ``start`` (code points from
    its beginning), ``turn`` (number of the turn, from 0), ``offset`` (code points from
    the beginning of that turn) and ``length``.
    """
    head = F.concat(F.lit("### "), escape(F.col("role"), ROLE_ESCAPES), F.lit(": "))
    body = escape(F.col("text"))
    m = messages.select("conv_id", "turn", "part", F.concat(head, body, F.lit(END)).alias("piece"), F.length(head).alias("offset"),
                        F.length(body).alias("length"), (F.col("role") == "assistant").alias("learned"))
    before = Window.partitionBy("conv_id").orderBy("turn", "part").rowsBetween(Window.unboundedPreceding, -1)
    m = m.withColumn("at", F.coalesce(F.sum(F.length("piece").cast("long")).over(before), F.lit(0)))
    turns = F.sort_array(F.collect_list(F.struct("at", "piece", "offset", "length", "learned")))
    m = m.groupBy("conv_id").agg(turns.alias("turns"))
    spans = F.transform("turns", lambda t, i: F.struct(
        (t["at"] + t["offset"]).alias("start"), i.alias("turn"), t["offset"].alias("offset"), t["length"].alias("length"),
        t["learned"].alias("learned")))
    spans = F.transform(F.filter(spans, lambda s: s["learned"]), lambda s: s.dropFields("learned"))
    return m.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                    F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"), spans.alias("loss_spans"))


def format_chats(events: DataFrame) -> DataFrame:
    """Fold a log and render it."""
    return render(fold(events))


def read_back(chats: DataFrame) -> DataFrame:
    """``chats`` with ``messages`` (array of role and text) and ``loss_texts`` (array of
    text), both read from ``formatted`` and ``loss_spans`` alone."""
    c = chats.withColumn("_pieces", F.split("formatted", "</turn>\n"))
    c = c.withColumn("_pieces", F.slice("_pieces", F.lit(1), F.size("_pieces") - 1))
    def parse(p):
        role, text = F.substring_index(p, ": ", 1), F.substr(p, F.instr(p, ": ") + 2)
        return F.struct(unescape(F.substr(role, F.lit(5)), ROLE_ESCAPES).alias("role"), unescape(text).alias("text"))
    learned = lambda s: unescape(F.substr(F.get(F.col("_pieces"), s["turn"]), s["offset"] + 1, s["length"]))
    return (c.withColumn("messages", F.transform("_pieces", parse))
            .withColumn("loss_texts", F.transform("loss_spans", learned)).drop("_pieces"))

"""Chat formatting from an event log (DataFrame functions only).

A conversation is a log of events in sequence: messages that start, streamed deltas, edits,
deletions and regenerations. The log is partitioned by conversation and folded into final
messages, and these are rendered by a template whose control strings cannot occur inside a
text: an occurrence there is broken by a backslash after its first character (backslashes
are doubled first), which one rule undoes: a backslash stands for the character after it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The template's control strings, and those of another common template, which
# are escaped too so that texts can't imitate either.
START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROLS = (START, SEPARATOR, END, "<s>", "</s>", "[INST]", "[/INST]")
_CONTROL = "|".join(re.escape(c[0]) + "(?=" + re.escape(c[1:]) + ")" for c in CONTROLS)
_TURN = f"(?s){re.escape(START)}(.*?){re.escape(SEPARATOR)}(.*?){re.escape(END)}"


def escape(text: Column) -> Column:
    """``text`` without control strings, reversibly."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), f"({_CONTROL})", "$1\\\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fold(events: DataFrame) -> DataFrame:
    """Final messages ``(conv_id, message, role, text)`` of an event log.

    ``events``: ``conv_id, seq, message, kind, role, text``; ``message`` numbers a
    conversation's messages in their order, ``seq`` orders its events. Kinds:

    * ``start``: the message begins, with its role and any first text;
    * ``delta``: text is appended;
    * ``edit``: text replaces what the message has so far;
    * ``delete``: the message goes (until a later ``start``);
    * ``regenerate``: the message and all after it are undone as far as the log has come,
      and the message begins anew with this event's text, in its role.

    Null text is empty; a null kind is a delta; a message's role is the last one given,
    empty if none is. Of events of equal ``seq`` deltas come last, else by kind and text;
    repeated events each count. A delta without a start makes a message. A null ``conv_id`` is a
    conversation of its own; an empty log gives no rows; other columns are ignored.
    """
    e = events.select("conv_id", "seq", "message", F.coalesce("kind", F.lit("delta")).alias("kind"), "role",
                      F.coalesce("text", F.lit("")).alias("text"))
    at = [F.col("seq"), F.col("kind") == "delta", F.col("kind"), F.col("text")]
    here = Window.partitionBy("conv_id", "message").orderBy(*at).rowsBetween(Window.unboundedPreceding, 0)
    later = Window.partitionBy("conv_id").orderBy(*[c.desc() for c in at]).rowsBetween(Window.unboundedPreceding, -1)
    e = e.withColumn("role", F.last("role", ignorenulls=True).over(here))
    undone = F.min(F.when(F.col("kind") == "regenerate", F.col("message"))).over(later)
    e = e.withColumn("_undone", undone).where("_undone is null or message is null or message < _undone")
    e = e.withColumn("_part", F.count(F.when(F.col("kind") != "delta", 1)).over(here)).withColumn("_delta", F.col("kind") == "delta")
    parts = e.groupBy("conv_id", "message", "_part").agg(
        F.max_by("kind", F.struct(F.col("kind") != "delta", "seq")).alias("kind"),
        F.max_by("role", F.when(F.col("role").isNotNull(), F.col("seq"))).alias("role"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", "_delta", "kind", "text"))), lambda x: x["text"]), "").alias("text"))
    last = parts.groupBy("conv_id", "message").agg(
        F.max_by(F.struct("kind", "text"), "_part").alias("m"),
        F.coalesce(F.max_by("role", F.when(F.col("role").isNotNull(), F.col("_part"))), F.lit("")).alias("role"))
    return last.where("m.kind <> 'delete'").select("conv_id", "message", "role", F.col("m.text").alias("text"))


def render(messages: DataFrame, learn: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id, formatted, segments``.

    ``formatted`` is the whole conversation under the template; ``segments`` is the same
    text in pieces ``(text, loss)``, where ``loss`` marks what a model learns from: the
    texts of role ``learn``, without control strings.
    """
    m = messages.select("conv_id", F.struct("message", F.coalesce("role", F.lit("")).alias("role"),
                                            F.coalesce("text", F.lit("")).alias("text")).alias("m"))
    c = m.groupBy("conv_id").agg(F.sort_array(F.collect_list("m")).alias("turns"))

    def piece(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    no = F.lit(False)
    segments = F.flatten(F.transform("turns", lambda t: F.array(
        piece(F.concat(F.lit(START), escape(t["role"]), F.lit(SEPARATOR)), no),
        piece(escape(t["text"]), t["role"] == learn), piece(F.lit(END), no))))
    c = c.select("conv_id", segments.alias("segments"))
    return c.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def parse(formatted: Column) -> Column:
    """The turns ``(role, text)`` of a formatted conversation, unescaped."""
    def field(k: int) -> Column:
        return F.transform(F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(k)), unescape)
    return F.transform(F.arrays_zip(field(1).alias("role"), field(2).alias("text")),
                       lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def learned_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def events_of_rows(rows: DataFrame) -> DataFrame:
    """The event log of finished ``(conv_id, turn, role, text)`` rows: each row a message,
    in the order of turn (then role and text; none is lost where turns repeat); assistant
    texts as they stream, a start and two deltas."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    r = rows.select("conv_id", F.row_number().over(order).cast("long").alias("message"), "role", "text")
    half = F.expr("char_length(text) div 2")

    def event(at: int, kind: str, text: Column) -> Column:
        return F.struct((F.col("message") * 3 + at).alias("seq"), F.lit(kind).alias("kind"), text.alias("text"))

    streamed = F.array(event(0, "start", F.lit("")), event(1, "delta", F.expr("substring(text, 1, char_length(text) div 2)")),
                       event(2, "delta", F.col("text").substr(half.cast("int") + 1, F.char_length("text"))))
    whole = F.array(event(0, "start", F.col("text")))
    r = r.withColumn("e", F.explode(F.when(F.col("role") == "assistant", streamed).otherwise(whole)))
    return r.select("conv_id", "e.seq", "message", "e.kind", "role", "e.text")

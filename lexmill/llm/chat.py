"""Chat formatting (operator 1): event-sourced reconstruction and rendering.

A log holds events of conversations.  They are sorted by sequence and folded into the
final messages:

* ``message`` starts the message with that id (a further one, if the id is in use);
  ``delta`` appends to it (and starts it if it is new);
* ``edit`` replaces its text; later deltas append to the new text;
* ``regenerate`` starts it anew with the event's text and discards every message that
  began after it and before this event;
* ``delete`` discards it.

The fold has two levels.  Events are first folded by message, so that a long stream of
deltas is spread over tasks by message; only final messages are gathered by conversation.

The template is ``<|start|>role<|text|>text<|end|>`` for each message.  Control strings
inside roles and texts, those of this template and of other common ones alike, are escaped
by one more backslash after their first character, which ``unescaped`` takes away again.

Defined results: a null text or role is empty; texts of any length are taken whole; events of
equal sequence are ordered by kind, role and text; repeated rows are events each, so a repeated
message is one more message and a repeated delta appends twice; a null conversation id is a
conversation of its own; empty tables give empty tables; columns beside the named ones,
whatever their names, are ignored by ``fold`` and kept by ``render``.  All of it is column
expressions; nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Openers and tails of control strings of common chat templates.
_OPEN, _TAIL = r"<|\[", r"\||/?s>|/?INST\]"
START, TEXT, END = "<|start|>", "<|text|>", "<|end|>"


def escaped(c: Column) -> Column:
    return F.regexp_replace(c, rf"({_OPEN})(\\*)({_TAIL})", r"$1\\$2$3")


def unescaped(c: Column) -> Column:
    return F.regexp_replace(c, rf"({_OPEN})\\(\\*)({_TAIL})", "$1$2$3")


def fold(events: DataFrame, conv: str = "conv_id", seq: str = "seq", kind: str = "kind", message: str = "message_id", role: str = "role", text: str = "text") -> DataFrame:
    """One row a conversation: ``conv_id`` and ``messages``, an array of (role, text) in order of their start."""
    e = events.select(
        F.col(conv).alias("conv_id"),
        F.col(message).alias("message_id"),
        F.struct(F.col(seq).alias("seq"), F.col(kind).alias("kind"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).alias("e"),
    )
    m = e.groupBy("conv_id", "message_id").agg(F.sort_array(F.collect_list("e")).alias("es"))
    m = m.withColumn("ix", F.filter(F.sequence(F.lit(0), F.size("es") - 1), lambda i: (i == 0) | (F.get("es", i)["kind"] == "message")))
    m = m.withColumn("es", F.explode(F.transform("ix", lambda s, k: F.slice("es", s + 1, F.coalesce(F.get("ix", k + 1), F.size("es")) - s))))
    reset = F.array_max(F.transform("es", lambda x, i: F.when(x["kind"] != "delta", i).otherwise(F.lit(0))))
    m = m.select("conv_id", "es", reset.alias("at"))
    m = m.select(
        "conv_id",
        F.col("es")[0]["seq"].alias("start"),
        F.array_max(F.transform(F.filter("es", lambda x: x["kind"] == "regenerate"), lambda x: x["seq"])).alias("cut"),
        F.col("es")[0]["role"].alias("role"),
        F.concat_ws("", F.transform(F.slice("es", F.col("at") + 1, F.size("es")), lambda x: x["text"])).alias("text"),
        (F.exists("es", lambda x: x["kind"] == "delete")).alias("gone"),
    )
    c = m.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("start", "role", "text", "gone"))).alias("ms"),
        F.collect_list(F.when(F.col("cut").isNotNull(), F.struct(F.col("start").alias("a"), F.col("cut").alias("b")))).alias("cuts"),
    )
    kept = F.filter("ms", lambda x: ~x["gone"] & ~F.exists("cuts", lambda k: (k["a"] < x["start"]) & (x["start"] < k["b"])))
    return c.select("conv_id", F.transform(kept, lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("messages"))


def render(conversations: DataFrame) -> DataFrame:
    """Adds ``formatted``, and ``loss_spans``: the code points (start, end exclusive) of assistants' texts."""
    part = F.transform(
        "messages",
        lambda m: F.struct(F.concat(F.lit(START), escaped(m["role"]), F.lit(TEXT)).alias("head"), escaped(m["text"]).alias("body"), (m["role"] == "assistant").alias("learned")),
    )
    out = conversations.withColumn("__parts", part)
    walk = F.aggregate(
        "__parts",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,end:long>>").alias("spans")),
        lambda s, p: F.struct(
            (s["at"] + F.length(p["head"]) + F.length(p["body"]) + len(END)).alias("at"),
            F.when(
                p["learned"],
                F.concat(s["spans"], F.array(F.struct((s["at"] + F.length(p["head"])).alias("start"), (s["at"] + F.length(p["head"]) + F.length(p["body"])).alias("end")))),
            )
            .otherwise(s["spans"])
            .alias("spans"),
        ),
        lambda s: s["spans"],
    )
    text = F.concat_ws("", F.transform("__parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))))
    return out.withColumn("formatted", text).withColumn("loss_spans", walk).drop("__parts")


def parse(formatted: Column) -> Column:
    """The array of (role, text) that a rendered conversation was made from."""
    parts = F.filter(F.split(formatted, r"<\|end\|>"), lambda x: x != "")
    body = F.transform(parts, lambda x: F.split(F.substring(x, F.lit(len(START) + 1), F.length(x)), r"<\|text\|>", 2))
    return F.transform(body, lambda x: F.struct(unescaped(x[0]).alias("role"), unescaped(x[1]).alias("text")))


def masked(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask, one after another."""
    return F.concat_ws("", F.transform(spans, lambda s: unescaped(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))))

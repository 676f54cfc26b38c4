"""Chat formatting by event sourcing, in DataFrame operations only.

A log of events is partitioned by conversation and sorted by sequence; streamed deltas, edits and
regenerations are folded into the final messages, which are rendered into one string per
conversation with the spans that a training loss covers.

The template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn. Inside roles and texts a backslash
becomes two and ``<|`` becomes ``<\\|``, so no control string can occur there; a newline in a role
becomes ``<|nl|>``. ``unescape`` undoes it exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END, NEWLINE = "<|im_start|>", "<|im_end|>\n", "<|nl|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(NEWLINE))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(NEWLINE), F.lit("\n")))


def fold_events(events: DataFrame) -> DataFrame:
    """``events``: conv_id, seq, turn, kind, role, text; returns final messages conv_id, turn, role, text.

    kind 'message' opens a turn with a text, 'delta' appends to what its turn holds, 'edit' puts a
    new text in its place, 'regenerate' empties it for the deltas that follow. An edit or a
    regeneration takes back the later turns that (last) began before it in the log. An unknown or null
    kind counts as 'delta', null text as empty, a null turn or seq sorts first. The role is that
    of the first event of the turn that has one. Events of one turn with equal seq are taken in the
    order of their texts, and repeated rows count each. Other columns are not read.
    """
    events = events.select("conv_id", "seq", "turn", "kind", "role", "text")
    resets = F.col("kind").isin("message", "edit", "regenerate")
    revisions = F.col("kind").isin("edit", "regenerate")
    turn = Window.partitionBy("conv_id", "turn")
    earlier = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first()).rangeBetween(Window.unboundedPreceding, -1)
    e = (
        events.withColumn("_from", F.max(F.when(resets, F.col("seq"))).over(turn))
        .withColumn("_began", F.coalesce("_from", F.min("seq").over(turn)))
        .withColumn("_role", F.min(F.when(F.col("role").isNotNull(), F.struct("seq", "role"))).over(turn))
        .withColumn("_cut", F.max(F.when(revisions, F.col("seq"))).over(earlier))
    )
    live = e.filter(F.coalesce(F.col("seq") >= F.col("_from"), F.lit(True)) & F.coalesce(F.col("_began") > F.col("_cut"), F.lit(True)))
    said = F.when(F.col("kind") == "regenerate", F.lit("")).otherwise(F.coalesce(F.col("text"), F.lit("")))
    parts = F.array_sort(F.collect_list(F.struct(F.col("seq"), said.alias("said"))))
    return live.groupBy("conv_id", "turn").agg(F.any_value("_role.role").alias("role"), F.array_join(F.transform(parts, lambda x: x["said"]), "").alias("text"))


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """``messages``: conv_id, turn, role, text; returns conv_id, formatted, loss_spans.

    loss_spans are (start, length) in code points of ``formatted``: the escaped text of each turn of
    ``loss_role``. A null role renders as empty. Rows of one turn come in the order of role and text.
    A conversation is one output value, so it is the one thing here that has to fit a task.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    order = Window.partitionBy("conv_id").orderBy(*[F.col(c).asc_nulls_first() for c in ("turn", "head", "body", "loss")]).rowsBetween(Window.unboundedPreceding, -1)
    turns = messages.select(
        "conv_id", "turn", F.concat(F.lit(START), escape_role(role), F.lit("\n")).alias("head"), escape(text).alias("body"), (role == loss_role).alias("loss")
    ).withColumn("before", F.coalesce(F.sum(F.length("head") + F.length("body") + F.lit(len(END))).over(order), F.lit(0)))
    listed = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("before", "turn", "head", "body", "loss"))).alias("turns"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    spans = F.transform(
        F.filter("turns", lambda t: t["loss"]), lambda t: F.struct((t["before"] + F.length(t["head"])).cast("long").alias("start"), F.length(t["body"]).cast("long").alias("length"))
    )
    return listed.select("conv_id", whole.alias("formatted"), spans.alias("loss_spans"))


def parse_turns(formatted: Column) -> Column:
    """Array of (role, text), unescaped, read from a rendered conversation."""
    pieces = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda x: x != "")
    return F.transform(
        pieces,
        lambda x: F.struct(
            unescape_role(F.substring_index(x, "\n", 1)).alias("role"),
            unescape(F.substring(x, F.length(F.substring_index(x, "\n", 1)) + 2, F.length(x) - F.length(F.substring_index(x, "\n", 1)) - F.lit(1 + len(END)))).alias("text"),
        ),
    )


def masked_text(formatted: Column, spans: Column) -> Column:
    """What lies under the loss spans, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")

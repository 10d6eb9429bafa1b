"""Dialogues rotated through the perspectives of their speakers.

Every participant of a conversation gets a rendering in which this speaker is the assistant and
all others are named users, with the spans on which a model may be trained. Renderings come in
parts of a fixed number of messages, so that a conversation of any length is spread over tasks;
the parts of a perspective, put together in order, are the whole dialogue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.tables import columns
from wayfare.operators.positions import with_position
from wayfare.session import cut_lineage

#: Messages in a part.
PART = 32
#: Roles that set the scene: shown as they are in every rendering, and no participants.
NARRATORS = ("system",)
UNNAMED = "unknown"
OPEN, CLOSE = "<|", "|>"
END = "<|end|>\n"


def escaped(text: Column) -> Column:
    """``text`` without the opening of a marker: every ``<|`` has one bar more, which ``unescaped`` takes off."""
    return F.replace(text, F.lit(OPEN), F.lit(OPEN + "|"))


def unescaped(text: Column) -> Column:
    return F.replace(text, F.lit(OPEN + "|"), F.lit(OPEN))


def escaped_name(role: Column) -> Column:
    """A name without the opening or the close of a marker."""
    return F.replace(escaped(role), F.lit(CLOSE), F.lit("|" + CLOSE))


def _header(role: Column, perspective: Column, narrators: tuple[str, ...]) -> Column:
    return (
        F.when(role.isin(*narrators), F.concat(F.lit(OPEN), role, F.lit(CLOSE + "\n")))
        .when(role == perspective, F.lit(f"{OPEN}assistant{CLOSE}\n"))
        .otherwise(F.concat(F.lit(f"{OPEN}user name="), escaped_name(role), F.lit(CLOSE + "\n")))
    )


def messages(conversations: DataFrame, part: int = PART) -> DataFrame:
    """(conv_id, part, n_messages, messages) with messages in order of turn, role and text.

    Rows without conv_id belong to no conversation and are left out. Rows equal in all columns are
    one message. A null turn comes first, a null role is ``unknown``, a null text is empty.
    """
    rows = (
        columns(conversations, "conv_id", "turn", "role", "text")
        .where("conv_id IS NOT NULL")
        .select("conv_id", "turn", F.coalesce("role", F.lit(UNNAMED)).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .distinct()
    )
    # Ranges of rows are sorted side by side; no conversation is sorted in one task.
    numbered = with_position(rows, [F.col("conv_id"), F.col("turn"), F.col("role"), F.col("text")], "at")
    starts = cut_lineage(numbered.groupBy("conv_id").agg(F.min("at").alias("start")))
    placed = numbered.join(starts, "conv_id").withColumn("at", F.col("at") - F.col("start"))
    parts = placed.groupBy("conv_id", F.floor(F.col("at") / part).cast("int").alias("part"))
    # At most ``part`` messages.
    return parts.agg(F.sort_array(F.collect_list(F.struct("at", "role", "text"))).alias("messages"))


def rotate(conversations: DataFrame, part: int = PART, narrators: tuple[str, ...] = NARRATORS) -> DataFrame:
    """(conv_id, perspective, part, n_messages, text, mask) for every participant of every conversation.

    A participant is a role that has a message and is not among ``narrators``; the perspective's own
    messages are those of the assistant, others are users with their role as name, narrators stay.
    ``mask`` lists (start, length) in characters of the part's text: what the assistant says, with
    its end mark, is trained on and nothing else. Markers inside texts and names are ``escaped``, so that
    no message can speak for another. Parts in which the perspective is silent have an
    empty mask. Conversations of narrators alone, and empty tables, give no rows.
    """
    written = cut_lineage(messages(conversations, part))
    roles = written.select("conv_id", F.explode("messages.role").alias("perspective")).distinct()
    roles = cut_lineage(roles.where(~F.col("perspective").isin(*narrators)))
    both = written.join(roles, "conv_id")
    shown = F.transform(
        "messages", lambda m: F.struct(_header(m["role"], F.col("perspective"), narrators).alias("head"), F.concat(escaped(m["text"]), F.lit(END)).alias("body"), (m["role"] == F.col("perspective")).alias("own"))
    )
    rendered = both.withColumn("shown", shown)
    sizes = F.transform("shown", lambda m: (F.length(m["head"]) + F.length(m["body"])).cast("long"))
    # Running ends of the messages; a part is short, so the list is rebuilt without harm.
    ends = F.aggregate(sizes, F.array(F.lit(0).cast("long")), lambda ends, n: F.concat(ends, F.array(F.element_at(ends, -1) + n)))
    rendered = rendered.withColumn("ends", ends)
    spans = F.transform(
        "shown",
        lambda m, i: F.struct(
            m["own"].alias("own"), (F.get("ends", i) + F.length(m["head"])).alias("start"), F.length(m["body"]).cast("long").alias("length")
        ),
    )
    mask = F.transform(F.filter(spans, lambda s: s["own"]), lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length")))
    text = F.array_join(F.transform("shown", lambda m: F.concat(m["head"], m["body"])), "")
    return rendered.select(
        "conv_id", "perspective", "part", F.size("messages").cast("long").alias("n_messages"), text.alias("text"), mask.alias("mask")
    )

"""Rules on conversation logs ``conv_id, turn, role, text``; ``(conv_id, turn)`` is unique and turns count from 0.

Where a conversation becomes one row, one of more than ``max_turns`` turns becomes several in
order of ``part``, so no task gathers a conversation of any length. Messages put before turn 0 are
in part 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.functions.text import newline_to_break
from rowloom.operators.groups import turn_part

MAX_TURNS = 10_000


def last_message(messages: DataFrame) -> DataFrame:
    """The last turn of each conversation, all columns."""
    others = [c for c in messages.columns if c != "conv_id"]
    return (
        messages.groupBy("conv_id")
        .agg(F.max_by(F.struct(*others), "turn").alias("_last"))
        .select("conv_id", "_last.*")
    )


def with_system_message(messages: DataFrame, prompt: str | None) -> DataFrame:
    """Put a system message first in each conversation, beside any it has; nothing without a prompt."""
    if not prompt:
        return messages
    first = messages.groupBy("conv_id").agg((F.min("turn") - 1).alias("turn"))
    system = first.withColumn("role", F.lit("system")).withColumn("text", F.lit(prompt))
    return messages.unionByName(system, allowMissingColumns=True)


def route(messages: DataFrame, tool_calls: Column) -> DataFrame:
    """``continue`` where the last message asks for tools, else ``end``: ``conv_id, route``."""
    last = last_message(messages.select("conv_id", "turn", tool_calls.alias("_calls")))
    return last.select(
        "conv_id", F.when(F.coalesce(F.size("_calls"), F.lit(0)) > 0, "continue").otherwise("end").alias("route")
    )


def assemble(messages: DataFrame, max_turns: int = MAX_TURNS) -> DataFrame:
    """Messages in order as one list: ``conv_id, part, messages array<struct<turn, role, text>>``."""
    return messages.groupBy("conv_id", turn_part(F.col("turn"), max_turns).alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("messages")
    )


def explode_messages(assembled: DataFrame) -> DataFrame:
    """One row per message again: ``conv_id, turn, role, text``."""
    return assembled.select("conv_id", F.inline("messages"))


# How a transcript opens and closes a message.
_USER = '<div class="user">{}</div>'
_OTHER = '<div class="assistant">{}</div>'


def _wrap(form: str, text: Column) -> Column:
    before, after = form.split("{}")
    return F.concat(F.lit(before), text, F.lit(after))


def transcript(assembled: DataFrame, sources: Column | None = None) -> DataFrame:
    """Each conversation as one HTML text, users and others rendered apart, then the list of sources.

    Output: ``conv_id, part, transcript``. The sources follow a conversation's last part.
    """
    body = F.array_join(
        F.transform(
            "messages",
            lambda m: F.when(m["role"] == "user", _wrap(_USER, newline_to_break(m["text"]))).otherwise(
                _wrap(_OTHER, newline_to_break(m["text"]))
            ),
        ),
        "",
    )
    if sources is not None:
        links = F.array_join(
            F.transform(sources, lambda s: F.concat(F.lit('<li><a href="'), s, F.lit('">'), s, F.lit("</a></li>"))), "\n"
        )
        listed = F.concat(F.lit("<strong>Sources:</strong><ul>"), links, F.lit("</ul>"))
        # Reads keys and turns only; texts are gathered once.
        last = assembled.groupBy(F.col("conv_id").alias("_conv")).agg(F.max("part").alias("_last"))
        assembled = assembled.join(last, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_last")), "left")
        body = F.concat(body, F.when(F.col("_last").isNotNull() & (F.size(sources) > 0), listed).otherwise(""))
    return assembled.select("conv_id", "part", body.alias("transcript"))

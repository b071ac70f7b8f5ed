"""Rules on the conversation log."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowloom.operators import conversations as conv
from rowloom.plans.registry import query, table


def _log(spark, folder):
    return table(spark, folder, "conversations")


def _listed(assembled):
    joined = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "|")
    return assembled.select("conv_id", F.size("messages").alias("n"), F.md5(joined).alias("h"))


@query(
    """SELECT conv_id, max(turn) AS turn, arg_max(role, turn) AS role, md5(arg_max(text, turn)) AS h
       FROM conversations GROUP BY conv_id"""
)
def conv_last_message(spark, folder):
    return conv.last_message(_log(spark, folder)).select("conv_id", "turn", "role", F.md5("text").alias("h"))


@query(
    """SELECT conv_id, turn, role, md5(text) AS h FROM conversations
       UNION ALL SELECT conv_id, min(turn) - 1, 'system', md5('Answer briefly.') FROM conversations GROUP BY conv_id"""
)
def conv_with_system(spark, folder):
    whole = conv.with_system_message(_log(spark, folder), "Answer briefly.")
    return whole.select("conv_id", "turn", "role", F.md5("text").alias("h"))


@query(
    """SELECT conv_id, CASE WHEN arg_max(role, turn) = 'user' THEN 'continue' ELSE 'end' END AS route
       FROM conversations GROUP BY conv_id"""
)
def conv_route(spark, folder):
    """A user's message stands for one that asks for a tool."""
    return conv.route(_log(spark, folder), F.when(F.col("role") == "user", F.array(F.lit("search"))))


@query(
    """SELECT conv_id, CAST(count(*) AS INTEGER) AS n, md5(string_agg(role || ':' || text, '|' ORDER BY turn)) AS h
       FROM conversations GROUP BY conv_id"""
)
def conv_assemble(spark, folder):
    return _listed(conv.assemble(_log(spark, folder)))


@query(
    """SELECT conv_id, CAST(count(*) + 1 AS INTEGER) AS n,
              md5('system:Answer briefly.|' || string_agg(role || ':' || text, '|' ORDER BY turn)) AS h
       FROM conversations GROUP BY conv_id"""
)
def conv_system_assembled(spark, folder):
    """The system message comes first in the same list."""
    return _listed(conv.assemble(conv.with_system_message(_log(spark, folder), "Answer briefly.")))


@query("SELECT conv_id, turn, role, md5(text) AS h FROM conversations")
def conv_explode(spark, folder):
    rows = conv.explode_messages(conv.assemble(_log(spark, folder)))
    return rows.select("conv_id", "turn", "role", F.md5("text").alias("h"))


@query(
    """SELECT conv_id, md5(t) AS h, CAST(length(t) AS INTEGER) AS n_chars FROM (
         SELECT conv_id,
                string_agg('<div class="' || CASE role WHEN 'user' THEN 'user' ELSE 'assistant' END || '">'
                           || replace(text, chr(10), '<br/>') || '</div>', '' ORDER BY turn)
                || '<strong>Sources:</strong><ul><li><a href="log/' || conv_id || '">log/' || conv_id || '</a></li></ul>' AS t
         FROM conversations GROUP BY conv_id)"""
)
def conv_transcript(spark, folder):
    source = F.array(F.concat(F.lit("log/"), F.col("conv_id").cast("string")))
    texts = conv.transcript(conv.assemble(_log(spark, folder)), source)
    return texts.select("conv_id", F.md5("transcript").alias("h"), F.length("transcript").alias("n_chars"))

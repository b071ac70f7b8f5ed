"""Evaluation sets and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowloom.operators import evaluation
from rowloom.plans.registry import query, table, words_sql
from rowloom.plans.vectors import TOPK_SQL, neighbours


def _docs(spark, folder):
    return table(spark, folder, "documents").select(F.col("doc_id").alias("doc_uri"), F.col("text").alias("content"))


_TEN_SQL = "SELECT doc_id, text FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id LIMIT 10"


@query(f"SELECT doc_id AS doc_uri, CAST(length(text) AS INTEGER) AS n_chars FROM ({_TEN_SQL})")
def eval_docs(spark, folder):
    drawn = evaluation.eval_docs(_docs(spark, folder), "doc_uri")
    return drawn.select("doc_uri", F.length("content").alias("n_chars"))


def ask(prompts):
    """A stand-in model: a question on the last word of the prompt."""
    return [f"What is {p.split()[-1]}?" for p in prompts]


@query(rf"SELECT doc_id AS doc_uri, 'What is ' || list_extract({words_sql('text')}, -1) || '?' AS question FROM ({_TEN_SQL})")
def generate_evals(spark, folder):
    """Ten evaluation questions, the number being the point of the operator."""
    asked = evaluation.generate_evals(_docs(spark, folder), "doc_uri", "content", ask, "Ask about the text only.")
    return asked.select("doc_uri", "question")


@query(
    f"""SELECT query_id, round(avg(CASE WHEN q.label = m.label THEN 1.0 ELSE 0.0 END), 6) AS precision
        FROM ({TOPK_SQL}) t JOIN embeddings q ON q.vec_id = t.query_id JOIN embeddings m ON m.vec_id = t.vec_id GROUP BY query_id"""
)
def precision_at_k(spark, folder):
    """Share of the five nearest vectors with the same label, for every vector."""
    labels = table(spark, folder, "embeddings").select("vec_id", "label")
    scored = evaluation.precision_at_k(neighbours(spark, folder), labels, "vec_id", "label")
    return scored.select("query_id", F.round("precision", 6).alias("precision"))


@query("SELECT lang, count(*) AS n, CAST(sum(toxic) AS BIGINT) AS toxic FROM labels JOIN documents USING (doc_id) GROUP BY lang")
def toxicity_rate(spark, folder):
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    langs = table(spark, folder, "documents").select("doc_id", "lang")
    return evaluation.rate_by(labels.join(langs, "doc_id"), "lang", "toxic")


@query(
    f"""SELECT conv_id, turn, round(len(list_intersect(said, context)) / len(said), 6) AS overlap FROM (
          SELECT a.conv_id, a.turn, list_distinct({words_sql('a.text')}) AS said, {words_sql('b.text')} AS context
          FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn - 1
          WHERE a.role = 'assistant')"""
)
def lexical_overlap(spark, folder):
    """How much of each answer occurs in the turn before it."""
    log = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    before = log.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("context"))
    pairs = log.where("role = 'assistant'").join(before, ["conv_id", "turn"])
    scored = evaluation.lexical_overlap(pairs, "context", "text")
    return scored.select("conv_id", "turn", F.round("overlap", 6).alias("overlap"))

"""Evaluation sets and metrics that need no judge model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.functions.text import words
from rowloom.operators.inference import PRESETS, TextModel, batch_infer
from rowloom.operators.relational import first_keys


def eval_docs(docs: DataFrame, key: str, num_evals: int = 10) -> DataFrame:
    """``num_evals`` documents to ask about: those whose keys hash lowest."""
    return first_keys(docs, key, num_evals, F.md5(F.col(key).cast("string")))


def generate_evals(docs: DataFrame, key: str, content: str, model: TextModel, guidelines: str, num_evals: int = 10) -> DataFrame:
    """Add a ``question`` to each of ``num_evals`` documents, written by ``model`` under the guidelines."""
    prompt = PRESETS["question"].prompt(F.col(content), guidelines=guidelines)
    return batch_infer(eval_docs(docs, key, num_evals), prompt, model, "question")


def precision_at_k(neighbours: DataFrame, labels: DataFrame, id_column: str, label: str) -> DataFrame:
    """Share of each query's neighbours that carry the query's label: ``query_id, precision``.

    ``neighbours(query_id, id)``; every id has one label.
    """
    of_query = labels.select(F.col(id_column).alias("query_id"), F.col(label).alias("_want"))
    of_match = labels.select(F.col(id_column).alias("id"), F.col(label).alias("_got"))
    return (
        neighbours.select("query_id", "id")
        .join(of_match, "id")
        .join(of_query, "query_id")
        .groupBy("query_id")
        .agg(F.avg((F.col("_want") == F.col("_got")).cast("double")).alias("precision"))
    )


def rate_by(df: DataFrame, group: str, flag: str) -> DataFrame:
    """``group, n, <flag>``: rows, and rows whose flag is 1."""
    return df.groupBy(group).agg(F.count("*").alias("n"), F.sum(F.col(flag).cast("long")).alias(flag))


def lexical_overlap(answers: DataFrame, context: str, answer: str, out: str = "overlap") -> DataFrame:
    """Share of an answer's distinct words that occur in its context; NULL for an empty answer."""
    said = F.array_distinct(words(F.col(answer)))
    shared = F.array_intersect(said, words(F.col(context)))
    return answers.withColumn(out, F.try_divide(F.size(shared), F.size(said)))

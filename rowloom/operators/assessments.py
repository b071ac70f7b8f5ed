"""De-duplication of review assessments.

Input rows: ``request_id, step_id, source struct<id>, timestamp, text_assessment,
retrieval_assessment`` and a unique row key that settles ties.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowloom.operators.groups import with_parts


def latest_text_assessments(log: DataFrame, row_id: str = "row_id") -> DataFrame:
    """The newest text assessment of each request, whoever gave it."""
    newest = Window.partitionBy("request_id").orderBy(F.desc("timestamp"), F.desc(row_id))
    return (
        log.where(F.col("text_assessment").isNotNull())
        .withColumn("_rank", F.row_number().over(newest))
        .where("_rank = 1")
        .drop("_rank")
    )


def retrieval_assessments(log: DataFrame, row_id: str = "row_id", max_rows: int = 100_000) -> DataFrame:
    """All retrieval assessments of each request, reviewer and step, in order of time.

    Output: ``request_id, source, step_id, part, timestamp, retrieval_assessments``. A group of more than
    ``max_rows`` assessments comes in parts counted from 0; their lists, part after part, are the whole in order.
    """
    rows = log.where(F.col("retrieval_assessment").isNotNull()).select(
        "request_id", F.col("source.id").alias("source_id"), "step_id", "timestamp", "retrieval_assessment", row_id
    )
    keys = ["request_id", "source_id", "step_id"]
    item = F.struct("timestamp", row_id, "retrieval_assessment")
    return (
        with_parts(rows, keys, ["timestamp", row_id], max_rows)
        .groupBy(*keys, "part")
        .agg(F.min("timestamp").alias("timestamp"), F.array_sort(F.collect_list(item)).alias("_items"))
        .select(
            "request_id",
            F.struct(F.col("source_id").alias("id")).alias("source"),
            "step_id",
            "part",
            "timestamp",
            F.transform("_items", lambda x: x["retrieval_assessment"]).alias("retrieval_assessments"),
        )
    )


def merge_assessments(texts: DataFrame, retrievals: DataFrame, coalesce_keys: bool = False) -> DataFrame:
    """Full outer merge of the two on request and reviewer.

    Output: the text side's columns, and ``step_id, part, retrieval_assessments`` of a list, NULL without one. A row
    without a text assessment keeps its list but not its request and reviewer, unless ``coalesce_keys``.

    A request has one text row but may have many lists. A full outer join cannot split such a
    key, so the merge is a left join from the lists, which can, and the text rows no list
    asks for, found against the distinct keys.
    """
    of_list = ["step_id", "part", "retrieval_assessments"]
    text_side = texts.drop("retrieval_assessment", "step_id")
    list_side = retrievals.select(
        F.col("request_id").alias("_request"), F.col("source.id").alias("_reviewer"), *of_list
    )
    match = (F.col("request_id") == F.col("_request")) & (F.col("source.id") == F.col("_reviewer"))
    with_list = list_side.join(text_side, match, "left")
    if coalesce_keys:
        with_list = with_list.withColumn("request_id", F.coalesce("request_id", "_request")).withColumn(
            "source", F.coalesce("source", F.struct(F.col("_reviewer").alias("id")))
        )
    asked = retrievals.select(F.col("request_id").alias("_request"), F.col("source.id").alias("_reviewer")).distinct()
    without_list = text_side.join(asked, match, "left_anti").withColumns(
        {name: F.lit(None).cast(list_side.schema[name].dataType) for name in of_list}
    )
    columns = [*text_side.columns, *of_list]
    return with_list.select(*columns).unionByName(without_list.select(*columns))

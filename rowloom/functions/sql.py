"""Named SQL functions: creating them, and listing them with their comments."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_scalar_function(spark: SparkSession, name: str, argument: str, returns: str, body: str, comment: str) -> None:
    """A one-argument SQL function. ``body`` may call any built-in or registered function."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({argument}) RETURNS {returns} COMMENT {_quote(comment)} RETURN {body}"
    )


def create_table_function(spark: SparkSession, name: str, columns: str, body: str, comment: str) -> None:
    """A SQL table function. The declared columns take the body's columns by position."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}() RETURNS TABLE({columns}) COMMENT {_quote(comment)} RETURN {body}"
    )


def function_registry(spark: SparkSession, prefix: str = "") -> DataFrame:
    """``name, kind, comment`` of every user function whose own name starts with ``prefix``.

    The catalog lists names only, so each one is described in turn; their number is that of
    the functions the user created.
    """
    rows = []
    for (full_name,) in spark.sql("SHOW USER FUNCTIONS").collect():
        name = full_name.split(".")[-1]
        if not name.startswith(prefix):
            continue
        usage = {}
        for (line,) in spark.sql(f"DESCRIBE FUNCTION EXTENDED {full_name}").collect():
            label, _, value = line.partition(":")
            if label == "Usage" and value.strip().startswith("{"):
                usage = json.loads(value)
        kind = "table" if usage.get("sqlFunction.isTableFunc") == "true" else "scalar"
        rows.append((name, kind, usage.get("sqlFunction.comment", "")))
    return spark.createDataFrame(rows, "name string, kind string, comment string")


def tool_resources(tools: DataFrame, endpoint: str) -> DataFrame:
    """What an assistant depends on: its model endpoint, and one resource per tool by the tool's kind.

    ``tools(name, kind, comment)`` may hold functions and ``retriever`` rows.
    """
    own = tools.sparkSession.createDataFrame([("model endpoint", endpoint)], "resource string, name string")
    return own.unionByName(
        tools.select(
            F.when(F.col("kind") == "retriever", "vector index").otherwise("function").alias("resource"), "name"
        )
    )

"""Registration of queries ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register the function under its own name, with the equivalent SQL if there is one."""

    def register(function):
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words_sql(column: str) -> str:
    """The words of a text column, as SQL."""
    return rf"list_filter(regexp_split_to_array({column}, '[ \t\r\n]+'), lambda w: w <> '')"

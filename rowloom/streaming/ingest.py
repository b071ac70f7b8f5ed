"""Files to tables, run until caught up.

Each query keeps its own checkpoint and commits each micro-batch under its origin and number to the
log of the table (see ``sources.commits``). So a batch counts once, and only when it is whole;
several queries may feed one table, and a restart without new input adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rowloom.sources.commits import CommittedTable

# Fixed value: the columns of a binary file source.
BINARY_FILE = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
# Files per micro-batch: a batch that fails is repeated whole.
MAX_FILES = 10_000


def binary_files(spark: SparkSession, folder: str, glob: str, max_files: int = MAX_FILES) -> DataFrame:
    """A stream of the files of ``folder`` whose names match ``glob``, each once."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE).option("pathGlobFilter", glob)
    return reader.option("maxFilesPerTrigger", max_files).load(folder)


def parquet_stream(spark: SparkSession, path: str, schema: StructType, max_files: int = MAX_FILES) -> DataFrame:
    """A stream of the rows of parquet files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def table_stream(spark: SparkSession, name: str) -> DataFrame | None:
    """A stream of the rows appended to a named table; None while there is no such table."""
    return spark.readStream.table(name) if spark.catalog.tableExists(name) else None


def append(
    stream: DataFrame, table: str, checkpoint: str, origin: str, each_batch: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Append what the stream has not yet delivered to the table at path ``table``; returns when done.

    ``each_batch`` turns a micro-batch into the rows to append. There a batch is a plain table, so that its rows, which
    may come from a few files, can be spread over all tasks first.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = batch if each_batch is None else each_batch(batch)
        marked = rows.withColumn("origin", F.lit(origin)).withColumn("batch", F.lit(number).cast("bigint"))
        CommittedTable(batch.sparkSession, table).append(marked, key=f"{origin}/{number}", place={"origin": origin, "batch": number})

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def append_to_table(stream: DataFrame, table: str, checkpoint: str) -> None:
    """The same into a named table that has this one writer."""
    stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).toTable(table).awaitTermination()


def read_table(spark: SparkSession, table: str, schema: str = "") -> DataFrame:
    """Everything committed so far, with ``origin`` and ``batch``; before the first batch, no rows of ``schema`` and these two."""
    columns = ", ".join(part for part in (schema, "origin STRING, batch BIGINT") if part)
    return CommittedTable(spark, table, columns).read()


def chunk_and_embed(
    source: DataFrame, chunk: Callable[[DataFrame], DataFrame], embed: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Documents to embedded chunks. ``source`` may be a stream or a table: both steps work row by row."""
    return embed(chunk(source))

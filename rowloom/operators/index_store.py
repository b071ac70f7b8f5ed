"""A vector index kept in buckets, of which an update writes only those that change."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rowloom.operators.vectors import index_changes
from rowloom.session import materialise
from rowloom.sources.commits import CommitLog

BUCKETS = 64
_COLUMNS = ["id", "content_hash", "embedding"]


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")


def _state(log: CommitLog) -> tuple[int, dict | None]:
    commits = log.commits()
    return commits[-1] if commits else (0, None)


def _rows(spark: SparkSession, path: str, state: dict, buckets: list[int] | None = None) -> DataFrame:
    """The rows of a version, or of some of its buckets: other files are not read."""
    schema = StructType.fromJson(json.loads(state["schema"]))
    names = [str(b) for b in buckets] if buckets is not None else list(state["files"])
    files = [f"{path}/{state['files'][b]}" for b in names if b in state["files"]]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The last version of the index at ``path``: ``id, content_hash, embedding``.

    A reader keeps the files of the version that it began with, so an update in the meantime does not disturb it.
    """
    number, state = _state(CommitLog(spark, path.rstrip("/")))
    if state is None:
        raise ValueError(f"there is no index at {path}")
    return _rows(spark, path.rstrip("/"), state)


def sync(spark: SparkSession, path: str, source: DataFrame, embed: Callable[[DataFrame], DataFrame], buckets: int = BUCKETS) -> int:
    """Bring the index at ``path`` in step with ``source(id, content_hash, <columns>)``, or make it; the number of the version in force.

    ``embed(frame)`` turns source rows into index rows and sees new and changed rows only. Rows lie in ``buckets`` (set when the
    index is made) by a hash of their id; only keys and hashes of the whole index are read, and only buckets with a
    change are read whole and written anew, to new files. A manifest that names each bucket's files is then published by one
    exclusive write. Nothing changed, no version. If another writer published in between, the work is done again on
    top of its version. Ids are not NULL and unique; choose buckets so that one fits a task.
    """
    path = path.rstrip("/")
    log = CommitLog(spark, path)
    while True:
        taken = log.last_number()
        number, state = _state(log)
        if state is None:
            rows, count, files = embed(source).select(*_COLUMNS), buckets, {}
            touched = None
        else:
            count, files = state["buckets"], dict(state["files"])
            known = _rows(spark, path, state).select("id", "content_hash")
            changes = materialise(index_changes(known, source.select("id", "content_hash")), "changes")
            # One row per bucket at most.
            touched = [row["bucket"] for row in changes.select(_bucket(count).alias("bucket")).distinct().collect()]
            if not touched:
                return number
            stale = changes.where("action <> 'insert'").select("id")
            fresh = changes.where("action <> 'delete'").select("id")
            kept = _rows(spark, path, state, touched).join(stale, "id", "left_anti").select(*_COLUMNS)
            rows = kept.unionByName(embed(source.join(fresh, "id", "left_semi")).select(*_COLUMNS))
        folder = f"data/{uuid.uuid4().hex}"
        schema = rows.schema
        dealt = rows.withColumn("bucket", _bucket(count)).repartition(len(touched) if touched else count, "bucket")
        dealt.write.partitionBy("bucket").parquet(f"{path}/{folder}")
        written = spark.read.schema(StructType([*schema.fields]).add("bucket", "integer")).parquet(f"{path}/{folder}").select("bucket").distinct().collect()
        for bucket in touched or []:
            files.pop(str(bucket), None)
        files |= {str(row["bucket"]): f"{folder}/bucket={row['bucket']}" for row in written}
        if log.publish(taken + 1, {"buckets": count, "files": files, "schema": schema.json()}):
            return taken + 1

"""Groups gathered into arrays, with a bound on how many rows one task gathers."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.session import materialise

# Most hot keys that are broadcast; one is a few key columns and two counts.
BROADCAST_KEYS = 100_000
# Pieces that rows of a key are dealt into where hot keys are too many to broadcast.
SALTS = 64


def turn_part(position: Column, max_rows: int) -> Column:
    """Part number of a row whose ``position`` counts up from 0 within its group, once each.

    Rows put before position 0 belong to part 0, so the parts in order hold the group in order.
    """
    return F.greatest(F.floor(position / max_rows).cast("long"), F.lit(0).cast("long"))


def _with_key(df: DataFrame, keyed: DataFrame, keys: list[str], row_id: str, few: bool) -> DataFrame:
    """Left join with the one row ``keyed`` holds for some of the keys; NULL keys match each other.

    Few rows are broadcast. Otherwise both sides meet by key and salt, so no task gets a whole group.
    """
    others = [c for c in keyed.columns if c not in keys]
    renamed = keyed.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], *others)
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
    if few:
        joined = df.join(F.broadcast(renamed), same, "left")
    else:
        salted = renamed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = df.withColumn("_row_salt", F.pmod(F.xxhash64(F.lit(1), F.col(row_id)), F.lit(SALTS)).cast("int"))
        joined = rows.join(salted, same & (F.col("_row_salt") == F.col("_salt")), "left").drop("_salt", "_row_salt")
    return joined.drop(*[f"_hot_{k}" for k in keys])


def with_parts(df: DataFrame, keys: list[str], order: list[str], max_rows: int) -> DataFrame:
    """Add ``part``, counted from 0 in each group; the parts in turn hold the group in ``order``.

    A group of up to ``max_rows`` rows is one part. The rows of larger ones are ranged by key and order over
    as many slices as they fill, and what a slice holds of a group is a part of about that size at most.
    The last column of ``order`` is unique. No row is lost.
    """
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    hot = materialise(sizes.where(F.col("_n") > max_rows), "hot-keys")
    found, rows = hot.agg(F.count("*"), F.sum("_n")).first()
    if found == 0:
        return df.withColumn("part", F.lit(0))
    few, row_id = found <= BROADCAST_KEYS, order[-1]
    marked = _with_key(df, hot, keys, row_id, few)
    slices = -(-rows // max_rows)
    # Written, so that a row keeps its slice when a task is repeated.
    ranged = materialise(
        marked.where("_n IS NOT NULL").drop("_n").repartitionByRange(slices, *keys, *order).withColumn("_slice", F.spark_partition_id()),
        "ranged",
    )
    first = ranged.groupBy(*keys).agg(F.min("_slice").alias("_first"))
    large = _with_key(ranged, first, keys, row_id, few).withColumn("part", F.col("_slice") - F.col("_first"))
    small = marked.where("_n IS NULL").withColumn("part", F.lit(0))
    columns = [*df.columns, "part"]
    return small.select(*columns).unionByName(large.select(*columns))

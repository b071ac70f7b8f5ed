"""Sharding a corpus by a k-d tree over its metadata."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.common import before_cut, empty_if_null, small, uniform, weighted_cut
from rowloom.session import materialise

# Levels into which the range of a dimension is cut; a power of two, so that 29 bits of a key are left for ties.
LEVELS = 1 << 24
# Distinct values that one task ranks.
RANKED_ROWS = 100_000


def text_ranks(rows: DataFrame, value: str, rank: str) -> DataFrame:
    """The distinct strings of ``value`` with their place among them, as a double; null comes first.

    The values are ranged over slices of a bounded number of them and numbered in each, behind those of the earlier slices.
    """
    found = materialise(rows.select(value).distinct(), "kd-values")
    slices = max(1, -(-found.count() // RANKED_ROWS))
    # Written, so that a value keeps its slice when a task is repeated.
    ranged = materialise(found.repartitionByRange(slices, F.col(value).asc_nulls_first()).withColumn("__slice", F.spark_partition_id()), "kd-values")
    counts = ranged.groupBy("__slice").agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1))
    starts = F.broadcast(counts.select("__slice", F.coalesce(earlier, F.lit(0)).alias("__start")))
    place = F.row_number().over(Window.partitionBy("__slice").orderBy(F.col(value).asc_nulls_first()))
    return small(ranged.withColumn("__place", place).join(starts, "__slice").select(value, (F.col("__start") + F.col("__place") - 1).cast("double").alias(rank)), "kd-ranks")


def with_text_rank(rows: DataFrame, value: str, rank: str) -> DataFrame:
    """``rows`` with ``rank`` in place of the strings of ``value``; see ``text_ranks``."""
    ranks = text_ranks(rows, value, rank).withColumnRenamed(value, "__value")
    return rows.join(ranks, F.col(value).eqNullSafe(F.col("__value"))).drop(value, "__value")


def _spread(level: Column, weight: Column) -> Column:
    """The weighted variance of ``level`` as a part of the range, to 12 digits; 0 only if there is one level."""
    at, w = level / F.lit(float(LEVELS)), weight.cast("double")
    mean = F.sum(at * w) / F.sum(w)
    variance = F.round(F.sum(at * at * w) / F.sum(w) - mean * mean, 12)
    return F.when(F.max(level) == F.min(level), 0.0).otherwise(F.greatest(F.coalesce(variance, F.lit(0.0)), F.lit(1e-12)))


def kd_leaves(rows: DataFrame, dimensions: list[str], weight: str, tie: str, leaves: int) -> DataFrame:
    """Add ``leaf`` (0 to ``leaves`` - 1): the leaf of a k-d tree whose leaves weigh nearly the same.

    A node that must hold k leaves is split along the dimension in which its weight is spread widest (by its
    variance, relative to the whole table's range, so that a few outlying values do not decide), where
    floor(k / 2) of k parts of its weight lie below: for even k the weighted median. A dimension in which a node has
    two values is wider than one in which it has one. Rows level with the median are divided by ``tie``, uniform in [0, 1), so a value
    that a third of all rows share can still be split. ``dimensions`` are double columns without null.
    Only sums per node and interval are shuffled, and one row per node is sent to executors.
    """
    ends = rows.agg(*[f(d).alias(f"{n}{i}") for i, d in enumerate(dimensions) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    levels = []
    for i, d in enumerate(dimensions):
        lo, hi = ends[f"lo{i}"], ends[f"hi{i}"]
        span = (hi - lo) if lo is not None and hi > lo else 1.0
        levels.append(F.floor((F.col(d) - F.lit(lo or 0.0)) / F.lit(span) * (LEVELS - 1)).cast("int"))
    nodes = materialise(rows.withColumn("__levels", F.array(*levels)).withColumn("leaf", F.lit(0)).withColumn("__k", F.lit(leaves)), "kd-rows")
    for _ in range(math.ceil(math.log2(max(leaves, 1)))):
        open_rows = nodes.where(F.col("__k") > 1)
        widths = [_spread(F.col("__levels")[i], F.col(weight)) for i in range(len(dimensions))]
        # The widest dimension, the first of them on a tie: its negated number decides.
        widest = F.greatest(*[F.struct(w.alias("w"), F.lit(-i).alias("d")) for i, w in enumerate(widths)])
        half = F.floor(F.col("__k") / 2)
        splits = open_rows.groupBy("leaf", "__k").agg(widest["d"].alias("d"), F.sum(weight).alias("s"))
        splits = small(splits.select("leaf", (-F.col("d")).alias("__d"), (F.col("s") * half / F.col("__k")).alias("target")), "kd-splits")
        place = (F.element_at("__levels", F.col("__d") + 1) + F.col(tie)) / LEVELS
        keyed = open_rows.join(splits.drop("target"), "leaf").withColumn("__key", place)
        cuts = weighted_cut(keyed.select("leaf", "__key", weight), ["leaf"], "__key", weight, splits.select("leaf", "target"))
        cuts = small(cuts.join(splits.select("leaf", "__d"), "leaf"), "kd-cuts")
        sides = nodes.join(cuts, "leaf", "left").withColumn("__key", place)
        low = F.col("__d").isNull() | before_cut("__key")
        k = F.when(F.col("__d").isNull(), F.col("__k")).when(before_cut("__key"), half).otherwise(F.col("__k") - half)
        nodes = sides.withColumn("__leaf", F.when(low, F.col("leaf")).otherwise(F.col("leaf") + half)).withColumn("__next", k)
        nodes = nodes.drop("leaf", "__k", "__key", "__d", "below", "upto").withColumnsRenamed({"__leaf": "leaf", "__next": "__k"})
        nodes = nodes.withColumn("leaf", F.col("leaf").cast("int")).withColumn("__k", F.col("__k").cast("int"))
        # Written at each level: the next one reads its rows several times.
        nodes = materialise(nodes, "kd-rows")
    return nodes.drop("__levels", "__k")


def shards(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", leaves: int | None = None, target_bytes: int | None = None, seed: int = 5) -> DataFrame:
    """Put every row into one of the leaves of a k-d tree over size, source, language and id.

    Give the number of ``leaves``, or ``target_bytes``, to which leaves are split. A row's size is the
    UTF-8 bytes of its text (null: none) plus 1; the leaves' sums of sizes are nearly equal. Sources and
    languages count by their ranks among the distinct ones. Null sources, languages and ids lie below all others. Equal texts are not kept together, as one group
    may be larger than a shard.

    Returns one row per input row: doc_id, size, text_crc32 (of the UTF-8 text), shard, slot (0, 1, 2 ...
    within a shard) and key (64-bit hash of the text). An empty table gives an empty result.
    """
    whole = empty_if_null(F.col(text))
    plain = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(whole) + 1).cast("long").alias("size"),
        F.crc32(F.encode(whole, "UTF-8")).alias("text_crc32"),
        F.col(source).cast("string").alias("source"),
        F.col(lang).cast("string").alias("lang"),
        F.coalesce(F.col(doc_id).cast("double"), F.lit(-1.0)).alias("d_id"),
        F.xxhash64(whole).alias("key"),
    )
    # Equal rows are counted before the shuffle and numbered after it, so none of them is a hot key.
    rows = plain.groupBy(*plain.columns).agg(F.count("*").alias("n"))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).drop("n")
    rows = rows.withColumn("d_size", F.log2(F.col("size").cast("double"))).withColumn("part", F.spark_partition_id())
    rows = materialise(rows.withColumn("tie", uniform(F.lit(seed), "doc_id", "key", "copy")), "shard-rows")
    rows = with_text_rank(with_text_rank(rows, "source", "d_source"), "lang", "d_lang")
    if leaves is None:
        total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
        leaves = max(1, math.ceil(total / target_bytes))
    placed = kd_leaves(rows, ["d_size", "d_source", "d_lang", "d_id"], "size", "tie", leaves)
    # Rows are numbered within the pieces that a shard has from each partition, behind the earlier pieces.
    pieces = placed.groupBy("leaf", "part").agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("leaf").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = pieces.select("leaf", "part", F.coalesce(earlier, F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("leaf", "part").orderBy("doc_id", "key", "copy"))
    numbered = placed.withColumn("place", place).join(starts, ["leaf", "part"])
    return numbered.select("doc_id", "size", "text_crc32", F.col("leaf").alias("shard"), (F.col("start") + F.col("place") - 1).cast("long").alias("slot"), "key")


def write_shards(docs: DataFrame, assignment: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the rows of ``docs`` in one folder per shard, as ``shards`` assigned them.

    Rows equal in id and text that got different shards are written to each of them.
    """
    key = F.xxhash64(empty_if_null(F.col(text)))
    places = assignment.select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"), "shard").distinct()
    same = F.col(doc_id).eqNullSafe(F.col("__id")) & (key == F.col("__key"))
    docs.join(places, same).drop("__id", "__key").write.partitionBy("shard").parquet(path)

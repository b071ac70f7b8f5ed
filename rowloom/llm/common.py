"""Helpers that several corpus operators share."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowloom.session import materialise

# Most rows of a table that is sent to every executor; the tables it is asked for have one row
# per source, split or similar, a few dozen bytes each.
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once, marked for broadcast if its counted rows allow it."""
    kept = materialise(df, label)
    return F.broadcast(kept) if kept.count() <= BROADCAST_ROWS else kept


def empty_if_null(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def worker_state(name: str, make: Callable[[], Any], version: Any = None, beside: tuple[str, ...] = ()) -> Any:
    """A value kept by a Python worker, such as a tokenizer or a cache, until another is asked for; only the last version of it.

    A worker serves one operator after another. What an earlier one kept is let go and its memory given back, but for
    the names ``beside``, which steps of the same tasks use.
    """
    holder = sys.modules.setdefault("rowloom_worker_state", types.ModuleType("rowloom_worker_state"))
    let_go(name, *beside)
    held = getattr(holder, name, None)
    if held is None or held[0] != version:
        setattr(holder, name, None)
        held = (version, make())
        setattr(holder, name, held)
    return held[1]


def let_go(*names: str) -> None:
    """Drop what earlier operators kept in this worker (see ``worker_state``), but for ``names``."""
    holder = sys.modules.get("rowloom_worker_state")
    others = [x for x in vars(holder) if not x.startswith("__") and x not in names] if holder else []
    for other in others:
        delattr(holder, other)
    if others:
        give_back()


def give_back() -> None:
    """Freed memory of this process back to the system, as a Python worker lives on idle beside the tasks that follow."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes sum up to at most ``most``, or of one row."""
    at = 0
    while at < len(sizes):
        stop, total = at + 1, sizes[at]
        while stop < len(sizes) and total + sizes[stop] <= most:
            total += sizes[stop]
            stop += 1
        yield at, stop
        at = stop


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until ``docs`` has no column of that name in any case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def uniform(*columns: Column | str) -> Column:
    """A number in [0, 1) of 40 bits that depends on nothing but the values."""
    return F.pmod(F.shiftrightunsigned(F.xxhash64(*columns), 8), F.lit(1 << 40)) / F.lit(float(1 << 40))


def row_key(doc_id: Column, text: Column, source: Column | None = None) -> Column:
    """A key that rows share only if their id and text are equal, and their source if one is given. Null text is empty."""
    parts = [F.coalesce(doc_id.cast("string"), F.lit("null")), F.sha2(empty_if_null(text), 256)]
    if source is not None:
        parts.append(F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null")))
    return F.concat_ws(":", *parts)


def copies_of(docs: DataFrame, copies: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str | None = None) -> DataFrame:
    """The rows of ``docs`` as often as ``copies`` (columns ``key`` by ``row_key``, ``n``) says, all columns kept.

    Keys that are not listed are dropped. Rows with the same key count as one row, so
    ``n`` is meant for all of them; which of their other columns stay is open.
    """
    key, n = free_name(docs, "__llm_key"), free_name(docs, "__llm_n")
    named = row_key(F.col(doc_id), F.col(text), F.col(source) if source else None)
    once = docs.withColumn(key, named).dropDuplicates([key])
    wanted = copies.where(F.col("n") > 0).select(F.col("key").alias(key), F.col("n").alias(n))
    repeat = F.explode(F.sequence(F.lit(1), F.col(n).cast("int")))
    return once.join(wanted, key).withColumn(n, repeat).select(*[F.col(f"`{c}`") for c in docs.columns])


def weighted_cut(rows: DataFrame, groups: list[str], key: str, weight: str, targets: DataFrame, few: int = 20_000) -> DataFrame:
    """Per group, the place in the order of ``key`` where the running sum of ``weight`` is nearest ``target``.

    ``key`` is in [0, 1). Each pass sums the weights of 4,096 intervals and goes on inside the one
    that holds the target, so only sums are shuffled, whatever the size of a group. Once the interval
    has at most ``few`` rows in every group (or is 2 ** -36 wide), its rows are ordered. ``targets`` has
    the groups and ``target``.

    Returns the groups with ``below`` and ``upto``: the rows before the cut are those with
    ``key < below or key <= upto`` (``before_cut``). A target at or beyond the sum takes all rows,
    one of 0 or less none.
    """
    fan, scale = 4096, 1
    state = small(targets.select(*groups, F.col("target").cast("double").alias("__left"), F.lit(0).cast("long").alias("__bin")), "cut")
    beyond = []
    while scale < fan**3:
        inside = rows.join(state, groups).where(F.floor(F.col(key) * scale) == F.col("__bin"))
        scale *= fan
        sums = inside.groupBy(*groups, F.floor(F.col(key) * scale).alias("__bin")).agg(
            F.sum(weight).cast("double").alias("__w"), F.first("__left").alias("__left"), F.count("*").alias("__rows")
        )
        order = Window.partitionBy(*groups).orderBy("__bin")
        running = sums.withColumn("__sum", F.sum("__w").over(order))
        reached = running.where(F.col("__sum") >= F.col("__left"))
        first = reached.withColumn("__at", F.row_number().over(order)).where(F.col("__at") == 1)
        found = materialise(first.select(*groups, (F.col("__left") - F.col("__sum") + F.col("__w")).alias("__left"), "__bin", "__rows"), "cut")
        if not beyond:
            beyond.append(state.join(found, groups, "left_anti").select(*groups, F.lit(2.0).alias("below"), F.lit(None).cast("double").alias("upto")))
        groups_left, most = found.agg(F.count("*"), F.max("__rows")).first()
        state = found.drop("__rows")
        state = F.broadcast(state) if groups_left <= BROADCAST_ROWS else state
        if (most or 0) <= few:
            break
    last = rows.join(state, groups).where(F.floor(F.col(key) * scale) == F.col("__bin"))
    by_key = last.groupBy(*groups, key).agg(F.sum(weight).cast("double").alias("__w"), F.first("__left").alias("__left"), F.first("__bin").alias("__bin"))
    running = by_key.withColumn("__sum", F.sum("__w").over(Window.partitionBy(*groups).orderBy(key)))
    none = state.select(*groups, F.lit(None).cast("double").alias(key), F.lit(0.0).alias("__sum"), "__left", "__bin")
    options = running.select(*groups, key, "__sum", "__left", "__bin").unionByName(none)
    best = options.groupBy(*groups).agg(F.min(F.struct(F.abs(F.col("__sum") - F.col("__left")).alias("d"), F.col("__sum").alias("s"), F.col(key).alias("k"), F.col("__bin").alias("b"))).alias("o"))
    cut = best.select(*groups, (F.col("o.b") / F.lit(float(scale))).alias("below"), F.col("o.k").alias("upto"))
    return cut.unionByName(beyond[0])


def before_cut(key: str) -> Column:
    """Whether a row joined with the result of ``weighted_cut`` lies before the cut."""
    return F.coalesce((F.col(key) < F.col("below")) | (F.col(key) <= F.col("upto")), F.lit(False))


def connected(edges: DataFrame) -> DataFrame:
    """The connected parts of an undirected graph: ``node`` and ``part``, the part's smallest node.

    ``edges`` has ``a`` and ``b``. Alternates the two star steps that hang every node's larger
    (then smaller) neighbours on its smallest one until nothing changes. A pre-aggregated minimum
    per node is all that is gathered; it is written first, so that the edges of a node with many neighbours can be split in the join.
    """
    pairs = materialise(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialise(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialise(large, "edges")
        least = materialise(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        star = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b"))
        following = materialise(star.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        if following.count() == pairs.count() and following.join(pairs, ["a", "b"], "left_anti").limit(1).count() == 0:
            break
        pairs = following
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("part")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("part")).unionByName(roots)

"""Exact duplicates by deterministic naming of blocks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.common import copies_of, empty_if_null
from rowloom.session import materialise

BLOCK_BYTES = 2048


def block_hash(block: Column, attempt: int) -> Column:
    return F.xxhash64(F.lit(attempt), block)


def _named(values: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Distinct ``keys`` with ``name``, an integer that grows along their sorted order."""
    return materialise(values.orderBy(*keys).withColumn("name", F.monotonically_increasing_id()), label)


def identities(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES, hashed: Callable[[Column, int], Column] = block_hash) -> DataFrame:
    """An identity per row that rows share exactly if their texts are equal.

    Texts are cut into blocks of ``block_bytes`` of UTF-8. Distinct blocks are sorted, by hash and then
    by content, and named by integers in that order. Adjacent pairs of names are named alike, and so on
    until one name is left; it and the number of blocks are the identity. No two different texts can
    share it: a pair's name stands for exactly that pair, and a block's for exactly that block. For
    the latter, all distinct blocks are compared by content in one shuffle; should two of them
    share a hash, the naming starts over with another one (``attempt``).

    Null texts count as empty; an empty text is one empty block. Returns row (any unique number), doc_id, sha256, blocks, name;
    an empty table gives an empty result. Other columns are not read.
    """
    binary = F.encode(empty_if_null(F.col(text)), "UTF-8")
    count = F.greatest(F.lit(1), F.ceil(F.octet_length("bytes") / block_bytes)).cast("int")
    at = F.sequence(F.lit(0), F.col("blocks") - 1)
    cut = docs.select(F.col(doc_id).alias("doc_id"), binary.alias("bytes")).withColumn("blocks", count)
    for attempt in range(64):
        blocks = cut.withColumn("block", F.explode(F.transform(at, lambda i: F.col("bytes").substr(i * block_bytes + 1, F.lit(block_bytes)))))
        contents = blocks.select(hashed(F.col("block"), attempt).alias("hash"), "block").distinct()
        names = _named(contents.groupBy("hash").agg(F.count("*").alias("contents")), ["hash"], "block-names")
        if names.where(F.col("contents") > 1).limit(1).count() == 0:
            break
    else:
        raise RuntimeError("no hash told all blocks apart")
    hashes = F.transform(at, lambda i: hashed(F.col("bytes").substr(i * block_bytes + 1, F.lit(block_bytes)), attempt))
    rows = cut.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.sha2("bytes", 256).alias("sha256"), "blocks", hashes.alias("hashes"))
    rows = materialise(rows, "blocks")

    level = rows.select("row", F.col("blocks").alias("left"), F.posexplode("hashes").alias("pos", "hash"))
    level = level.join(names.select("hash", "name"), "hash").drop("hash")
    done = []
    most = rows.agg(F.max("blocks")).first()[0] or 1
    while True:
        done.append(level.where(F.col("left") == 1).select("row", "name"))
        if most <= 1:
            break
        # Both names of a pair meet by row and place; a last one without a partner pairs with -1.
        even = F.col("pos") % 2 == 0
        pairs = level.where(F.col("left") > 1).groupBy("row", F.ceil(F.col("left") / 2).cast("int").alias("left"), F.floor(F.col("pos") / 2).cast("int").alias("pos"))
        pairs = pairs.agg(F.max(F.when(even, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b"))
        pairs = materialise(pairs, "pairs")
        level = pairs.join(_named(pairs.select("a", "b").distinct(), ["a", "b"], "pair-names"), ["a", "b"]).drop("a", "b")
        most = -(-most // 2)
    named = done[0]
    for more in done[1:]:
        named = named.unionByName(more)
    return rows.select("row", "doc_id", "sha256", "blocks").join(named, "row")


def exact_groups(docs: DataFrame, **options) -> DataFrame:
    """Groups of rows with equal texts, the row of the largest doc_id kept in each.

    Null ids are below all others; among equal ids any one row is kept. Returns one row per input row:
    doc_id, keep_id, group_size, kept, text_sha256. Rows meet only by names and counts; the minimum
    per group is taken before the shuffle, and the join back can be split where a group is large.
    """
    rows = materialise(identities(docs, **options), "identities")
    best = F.max(F.struct("doc_id", "row"))
    # Written, so that the join sees two plain inputs, of which a large group's rows can be split.
    groups = materialise(rows.groupBy("blocks", "name").agg(best.alias("best"), F.count("*").alias("group_size")), "groups")
    joined = rows.join(groups, ["blocks", "name"])
    return joined.select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"), F.col("sha256").alias("text_sha256"))


def without_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that ``exact_groups`` keeps, with all their columns."""
    kept = exact_groups(docs, doc_id=doc_id, text=text, **options).where("kept")
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text_sha256")
    return copies_of(docs, kept.select(key.alias("key"), F.lit(1).alias("n")), doc_id, text)

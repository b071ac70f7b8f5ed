"""Chat formatting of reply trees."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.common import empty_if_null
from rowloom.session import materialise

# What marks a turn, and how the characters that marks are made of are written in texts.
OPEN, AFTER_ROLE, CLOSE = "### ", ": ", "</turn>\n"
ESCAPES = (("\\", "\\\\"), ("#", "\\h"), ("<", "\\l"), (":", "\\c"))
_WRITTEN = re.compile(r"\\(.)", re.S)
_MEANT = {written[1]: plain for plain, written in ESCAPES}
_TURN = re.compile(r"### ([^:#<]*): ([^#<]*)</turn>\n")


def escape(text: Column) -> Column:
    """``text`` without the characters that marks begin with; ``unescape`` gives it back."""
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: str) -> str:
    return _WRITTEN.sub(lambda m: _MEANT[m[1]], text)


def reply_trees(turns: DataFrame, tree: str, position: str) -> DataFrame:
    """Rows with ``node`` and ``parent``: each turn replies to the one before it in its tree.

    Nodes are numbered by position, rows level with each other by role and text, so repeated rows
    follow one another. Null positions come first. For tables that hold no parents.
    """
    order = Window.partitionBy(tree).orderBy(position, *[c for c in ("role", "text") if c in turns.columns])
    return turns.withColumn("node", F.row_number().over(order).cast("long")).withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))


def _null_safe(rows: DataFrame) -> DataFrame:
    """``rows`` with ``tree`` as a struct that is never null, so that joins also match the null tree; ``tree.value`` gives it back."""
    return rows.withColumn("tree", F.struct(F.col("tree").isNull().alias("none"), F.col("tree").alias("value")))


def branches(messages: DataFrame, best: int = 1) -> DataFrame:
    """The nodes of the best root-to-leaf paths of each reply tree: tree, leaf, rank, node, place, score.

    ``messages`` has tree, node (unique in its tree), parent (null at a root) and score (null counts
    as 0). Self-joins double the distance that each node sees towards its root, adding up scores
    and steps on the way, so a path of n turns needs log2(n) rounds. A leaf's path scores the mean of
    its messages; paths are ranked per tree by score, longer first, then by smaller leaf, and the
    ``best`` of them are expanded by going back through the distances, again doubling. ``place`` counts from 0 at the root.

    Replies to a missing node start a path of their own. Messages on a cycle have no root and lie on no path.
    The messages of the null tree are one tree.
    """
    alive = materialise(_null_safe(messages).select("tree", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")), "replies")
    nodes = alive.select("tree", F.col("node").alias("parent"), F.lit(True).alias("there"))
    linked = alive.join(nodes, ["tree", "parent"], "left").withColumn("up", F.when(F.col("there"), F.col("parent")))
    state = materialise(linked.select("tree", "node", "up", F.col("score").alias("sum"), F.lit(1).cast("long").alias("steps")), "replies")
    # hops[i]: where a node gets in 2 ** i steps. After as many rounds as nodes could need, what still climbs is on a cycle.
    hops, rounds, limit = [], 0, state.count()
    while (1 << rounds) <= max(limit, 1) and state.where(F.col("up").isNotNull()).limit(1).count():
        climbing = state.where(F.col("up").isNotNull())
        hops.append(climbing.select("tree", "node", "up"))
        ahead = state.select("tree", F.col("node").alias("up"), F.col("up").alias("next"), F.col("sum").alias("more"), F.col("steps").alias("further"))
        # Only nodes that have not reached their root are joined again.
        joined = climbing.join(ahead, ["tree", "up"])
        joined = joined.select("tree", "node", F.col("next").alias("up"), (F.col("sum") + F.col("more")).alias("sum"), (F.col("steps") + F.col("further")).alias("steps"))
        state = materialise(state.where(F.col("up").isNull()).unionByName(joined), "replies")
        rounds += 1
    parents = alive.where(F.col("parent").isNotNull()).select("tree", F.col("parent").alias("node")).distinct()
    leaves = state.where(F.col("up").isNull()).join(parents, ["tree", "node"], "left_anti")
    leaves = leaves.withColumn("score", F.col("sum") / F.col("steps"))
    order = Window.partitionBy("tree").orderBy(F.col("score").desc(), F.col("steps").desc(), "node")
    ranked = leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    path = ranked.select("tree", F.col("node").alias("leaf"), "rank", "score", "node", (F.col("steps") - 1).alias("place"))
    for i, hop in enumerate(hops):
        further = path.join(hop, ["tree", "node"]).select("tree", "leaf", "rank", "score", F.col("up").alias("node"), (F.col("place") - (1 << i)).alias("place"))
        path = materialise(path.unionByName(further), "paths")
    return path.withColumn("tree", F.col("tree.value"))


def _write(batches: Iterator[pa.RecordBatch], part_chars: int) -> Iterator[pa.RecordBatch]:
    """Formatted turns, in order, to parts of conversations with the spans of their loss mask."""
    names = ["tree", "leaf", "rank", "part", "text", "mask_from", "mask_to"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    current, part, held, size, lo, hi = None, 0, [], 0, [], []
    out: list[tuple] = []
    for batch in batches:
        for tree, leaf, rank, turn, start, stop in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if current != (tree, leaf, rank) or size >= part_chars:
                if current:
                    out.append((*current, part, "".join(held), lo, hi))
                part = part + 1 if current == (tree, leaf, rank) else 0
                current, held, size, lo, hi = (tree, leaf, rank), [], 0, [], []
            if start is not None:
                lo.append(size + start)
                hi.append(size + stop)
            held.append(turn)
            size += len(turn)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
            out = []
    if current:
        out.append((*current, part, "".join(held), lo, hi))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


def conversations(messages: DataFrame, best: int = 1, learned: str = "assistant", part_chars: int = 1_000_000) -> DataFrame:
    """Each chosen path of each reply tree formatted as one conversation: tree, leaf, rank, part, text, mask_from, mask_to.

    ``messages`` as for ``branches``, with role and text (null: empty). A turn is written
    ``### role: text</turn>`` and a line end, with the characters of these marks escaped in roles and
    texts. The loss mask are spans (code points, end exclusive) of the escaped texts of role ``learned``. A conversation of
    over ``part_chars`` goes on in further parts, cut between turns, in order; it is written as its
    sorted turns stream by, so no more than a part is held.
    """
    paths = _null_safe(branches(messages, best))
    words = _null_safe(messages).select("tree", "node", "role", "text")
    role = escape(empty_if_null(F.col("role")))
    head = F.concat(F.lit(OPEN), role, F.lit(AFTER_ROLE))
    text = escape(empty_if_null(F.col("text")))
    masked = F.col("role") == learned
    turns = paths.join(words, ["tree", "node"]).select(
        F.col("tree.value").alias("tree"), "leaf", F.col("rank").cast("int").alias("rank"), "place",
        F.concat(head, text, F.lit(CLOSE)).alias("turn"),
        F.when(masked, F.length(head)).cast("long").alias("start"),
        F.when(masked, F.length(head) + F.length(text)).cast("long").alias("stop"),
    )
    ordered = turns.repartition("tree", "leaf").sortWithinPartitions("tree", "leaf", "rank", "place").drop("place")
    schema = "tree bigint, leaf bigint, rank int, part int, text string, mask_from array<bigint>, mask_to array<bigint>"
    return ordered.mapInArrow(lambda batches: _write(batches, part_chars), schema)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What formatted conversations hold, read back from their text, part by part."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    current, turns, loss, counts = None, None, None, [0, 0, 0]
    out: list[tuple] = []

    def rows() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * 6
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    for batch in batches:
        for tree, leaf, text, lo, hi in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if current != (tree, leaf):
                if current:
                    out.append((current[0], counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2]))
                current, turns, loss, counts = (tree, leaf), hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
            at = 0
            for match in _TURN.finditer(text):
                if match.start() != at:
                    raise ValueError(f"conversation {tree} cannot be read back")
                at = match.end()
                turns.update(f"{unescape(match[1])}\n{unescape(match[2])}\n".encode())
                counts[0] += 1
            if at != len(text):
                raise ValueError(f"conversation {tree} cannot be read back")
            for a, b in zip(lo, hi, strict=True):
                learned = unescape(text[a:b])
                loss.update(learned.encode())
                counts[1] += len(learned)
            counts[2] += len(text)
        yield rows()
    if current:
        out.append((current[0], counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2]))
    yield rows()


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of formatted conversations (see ``conversations``), taken from text and mask alone."""
    ordered = formatted.repartition("tree", "leaf").sortWithinPartitions("tree", "leaf", "rank", "part").select("tree", "leaf", "text", "mask_from", "mask_to")
    return ordered.mapInArrow(_digest, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")

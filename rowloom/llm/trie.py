"""The prefix trie of conversations, with subtree totals by parallel tree contraction."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from rowloom.llm.common import empty_if_null
from rowloom.session import materialise

# Rows of one conversation in one slice of it, and ids of one node in one piece.
SLICE_ROWS = 4_096
PIECE_IDS = 4_096
# Turns of another conversation that may stand at the head of a rebuilt one.
HEADS = 9
_EMPTY = hashlib.sha256(b"").hexdigest()


def _sliced(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (of ``conv_id``) with ``place``, counted from 0 in each conversation by ``order``, and ``slice``, runs of places.

    Rows are ranged over partitions by conversation and order, written, and numbered per partition; what
    lies in earlier partitions is added from counts, so a long conversation is not gathered in a task.
    """
    partitions = max(1, -(-rows.count() // SLICE_ROWS))
    ranged = rows.repartitionByRange(partitions, "conv_id", *order).withColumn("slice", F.spark_partition_id())
    ranged = materialise(ranged, "turn-slices")
    counts = ranged.groupBy("conv_id", "slice").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy("conv_id", "slice").orderBy(*order))
    numbered = ranged.withColumn("__at", inside)
    placed = numbered.join(counts.drop("__n"), ["conv_id", "slice"]).withColumn("place", F.col("__at") + F.col("__before") - 1)
    return placed.drop("__at", "__before")


def numbered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, place (from 0), digest and bytes of every turn, in the order of ``turn``, null first.

    ``turns`` has conv_id, turn, role and text; null roles and texts count as empty. The digest stands for
    role and text, bytes are those of the text. Turns level with each other go by their digests, so that
    repeated rows follow one another. Rows without a conv_id belong to no conversation and are left out.
    Texts are not shuffled.
    """
    role, text = empty_if_null(F.col("role")), empty_if_null(F.col("text"))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = turns.where(F.col("conv_id").isNotNull()).select("conv_id", "turn", digest.alias("digest"), F.octet_length(text).cast("bigint").alias("bytes"))
    order = [F.col("turn").asc_nulls_first(), "digest"]
    return materialise(_sliced(rows, order).select("conv_id", "place", "digest", "bytes"), "turns")


def grafted(turns: DataFrame, base: Column, heads: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin as another one does: their turns as those of ``numbered_turns``, and all conv_id.

    Each conversation gets the first ``heads`` turns (below 9) of conversation ``base`` (all if it has
    fewer, none if there is none), then its own but for as many. Both are expressions of ``conv_id``. A conversation
    may end up without turns; it is among the ids.
    """
    sizes = materialise(turns.groupBy("conv_id").agg(F.count("*").alias("size")), "conversations")
    ids = sizes.select("conv_id", base.alias("base"), heads.cast("int").alias("heads"))
    found = sizes.select(F.col("conv_id").alias("base"), "size")
    plan = ids.join(found, "base", "left").withColumn("taken", F.least("heads", F.coalesce("size", F.lit(0))))
    plan = materialise(plan.select("conv_id", "base", "heads", "taken"), "grafts")
    first = turns.where(F.col("place") < HEADS - 1).withColumnRenamed("conv_id", "base")
    head = plan.where(F.col("taken") > 0).join(first, "base").where(F.col("place") < F.col("taken")).select("conv_id", "place", "digest", "bytes")
    own = turns.join(plan, "conv_id").where(F.col("place") >= F.col("heads"))
    tail = own.select("conv_id", (F.col("place") - F.col("heads") + F.col("taken")).alias("place"), "digest", "bytes")
    return head.unionByName(tail), sizes.select("conv_id")


def prefixes(turns: DataFrame) -> DataFrame:
    """Each turn with the node it leads to: conv_id, depth (from 1), a, b, up_a, up_b, digest, bytes.

    ``turns`` as of ``numbered_turns``, places without gaps. (a, b), 128 bits, name the sequence of turns up to this one:
    the exclusive or of hashes of each turn with its place, which is summed per slice of a conversation and
    then over slices. (up_a, up_b) name the sequence before it; the root is (0, 0).
    """
    hashed = turns.select(
        "conv_id", "digest", "bytes", "place", F.floor(F.col("place") / SLICE_ROWS).alias("slice"),
        F.xxhash64(F.lit(1), "place", "digest").alias("x"), F.xxhash64(F.lit(2), "digest", "place").alias("y"),
    )
    hashed = materialise(hashed, "turn-hashes")
    sums = hashed.groupBy("conv_id", "slice").agg(F.bit_xor("x").alias("__x"), F.bit_xor("y").alias("__y"))
    before = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    sums = sums.select(
        "conv_id", "slice", F.coalesce(F.bit_xor("__x").over(before), zero).alias("__x"), F.coalesce(F.bit_xor("__y").over(before), zero).alias("__y")
    )
    upto = Window.partitionBy("conv_id", "slice").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    run = hashed.withColumn("__a", F.bit_xor("x").over(upto)).withColumn("__b", F.bit_xor("y").over(upto)).join(sums, ["conv_id", "slice"])
    a, b = F.col("__a").bitwiseXOR(F.col("__x")), F.col("__b").bitwiseXOR(F.col("__y"))
    return run.select(
        "conv_id", (F.col("place") + 1).alias("depth"), a.alias("a"), b.alias("b"), a.bitwiseXOR(F.col("x")).alias("up_a"),
        b.bitwiseXOR(F.col("y")).alias("up_b"), "digest", "bytes",
    )


def nodes_of(steps: DataFrame, ids: DataFrame) -> DataFrame:
    """The nodes of ``prefixes``, and the root of all ``ids``: a, b, up_a, up_b (null at the root), conv_id, depth, n_convs, bytes.

    Proves that names are unique: of one name, every row has the same last turn and the same name before it. By induction
    over depth it then stands for one sequence. Raises an error otherwise.
    """
    same = (F.min("digest") == F.max("digest")) & (F.min("up_a") == F.max("up_a")) & (F.min("up_b") == F.max("up_b")) & (F.min("depth") == F.max("depth"))
    found = steps.groupBy("a", "b").agg(
        F.first("up_a").alias("up_a"), F.first("up_b").alias("up_b"), F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"),
        F.count("*").alias("n_convs"), F.first("bytes").alias("bytes"), same.alias("same"),
    )
    error = F.raise_error(F.lit("two sequences of turns share a name"))
    found = found.withColumn("bytes", F.when(F.col("same"), F.col("bytes")).otherwise(error)).drop("same")
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    root = ids.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where(F.col("n_convs") > 0)
    root = root.select(zero.alias("a"), zero.alias("b"), none.alias("up_a"), none.alias("up_b"), "conv_id", zero.alias("depth"), "n_convs", zero.alias("bytes"))
    return materialise(found.select(root.columns).unionByName(root), "nodes")


def _priority(a: Column, b: Column, turn: int) -> Column:
    return F.xxhash64(F.lit(turn), a, b)


def subtree_totals(nodes: DataFrame, values: list[str]) -> DataFrame:
    """a, b and the ``values`` summed over the subtree of every node, its top included, by tree contraction.

    ``nodes`` has a, b, up_a, up_b (null at the root, of which there is one) and ``values``, not null. Each round
    rakes and compresses. Rake: nodes without children end with what they have gathered, and their parents gather it. Compress: of the
    nodes with one child, those whose hash is above that of parent and child are spliced out; what they
    hold goes to the link between both. No two neighbours are spliced at once, so a chain loses a third of its
    nodes each round and a tree of n nodes is one node after about log n rounds, however deep it is. A node knows its one
    remaining child by the exclusive or of its children's names, which raked and spliced ones leave. Then
    rounds are gone through backwards: a spliced node's total is what it held and its child's.

    Nothing is gathered: a parent's children meet in sums that are taken before the shuffle too.
    """
    a, b, up = F.col("a"), F.col("b"), F.col("up_a").isNotNull()
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    links = [f"link_{v}" for v in values]
    kids = nodes.where(up).groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(
        F.count("*").alias("k"), F.bit_xor("a").alias("kid_a"), F.bit_xor("b").alias("kid_b")
    )
    state = nodes.select("a", "b", "up_a", "up_b", *values, *[zero.alias(link) for link in links]).join(kids, ["a", "b"], "left").fillna(0, ["k", "kid_a", "kid_b"])
    # Per round: the nodes raked before it, those spliced out in it and those that stay, written as one table.
    rounds: list[tuple[DataFrame, int]] = []
    while True:
        turn = len(rounds) + 1
        # Rake.
        ends = state.where(F.col("k") == 0)
        given = ends.where(up).groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(
            F.count("*").alias("__k"), F.bit_xor("a").alias("__a"), F.bit_xor("b").alias("__b"),
            *[F.sum(F.col(v) + F.col(f"link_{v}")).alias(f"__{v}") for v in values],
        )
        left = state.join(given, ["a", "b"], "left").fillna(0, ["__k", "__a", "__b", *[f"__{v}" for v in values]])
        left = left.select(
            "a", "b", "up_a", "up_b", (F.col("k") == 0).alias("raked"), *[(F.col(v) + F.col(f"__{v}")).alias(v) for v in values], *links,
            (F.col("k") - F.col("__k")).alias("k"), F.col("kid_a").bitwiseXOR(F.col("__a")).alias("kid_a"), F.col("kid_b").bitwiseXOR(F.col("__b")).alias("kid_b"),
        )
        # Compress.
        mine = _priority(a, b, turn)
        above = (mine > _priority(F.col("up_a"), F.col("up_b"), turn)) & (mine > _priority(F.col("kid_a"), F.col("kid_b"), turn))
        out = up & ~F.col("raked") & (F.col("k") == 1) & above
        seen = Observation()
        table = left.withColumn("out", out).observe(seen, F.count_if(~F.col("raked")).alias("left"), F.count_if("out").alias("out"))
        table = materialise(table, "contraction")
        rounds.append((table, seen.get["out"]))
        if not seen.get["left"]:
            break
        gone, state = table.where("out"), table.where(~F.col("raked") & ~F.col("out")).drop("raked", "out")
        if seen.get["out"]:
            to_kid = gone.select(
                F.col("kid_a").alias("a"), F.col("kid_b").alias("b"), F.col("up_a").alias("to_a"), F.col("up_b").alias("to_b"),
                zero.alias("x_a"), zero.alias("x_b"), *[(F.col(v) + F.col(f"link_{v}")).alias(f"__{v}") for v in values],
            )
            to_parent = gone.select(
                F.col("up_a").alias("a"), F.col("up_b").alias("b"), none.alias("to_a"), none.alias("to_b"),
                a.bitwiseXOR(F.col("kid_a")).alias("x_a"), b.bitwiseXOR(F.col("kid_b")).alias("x_b"), *[zero.alias(f"__{v}") for v in values],
            )
            told = to_kid.unionByName(to_parent).groupBy("a", "b").agg(
                F.max("to_a").alias("to_a"), F.max("to_b").alias("to_b"), F.bit_xor("x_a").alias("x_a"), F.bit_xor("x_b").alias("x_b"),
                *[F.sum(f"__{v}").alias(f"__{v}") for v in values],
            )
            state = state.join(told, ["a", "b"], "left").fillna(0, ["x_a", "x_b", *[f"__{v}" for v in values]]).select(
                "a", "b", F.coalesce("to_a", "up_a").alias("up_a"), F.coalesce("to_b", "up_b").alias("up_b"), *values,
                *[(F.col(f"link_{v}") + F.col(f"__{v}")).alias(f"link_{v}") for v in values], "k",
                F.col("kid_a").bitwiseXOR(F.col("x_a")).alias("kid_a"), F.col("kid_b").bitwiseXOR(F.col("x_b")).alias("kid_b"),
            )
    # Expand. A spliced node's child ended in a later round; what rounds still hold shrinks by a constant factor, and so do these joins.
    totals = None
    for table, n in reversed(rounds):
        if n:
            kid = [F.col("a").alias("kid_a"), F.col("b").alias("kid_b")]
            below = totals.select(*kid, *[F.col(v).alias(f"__{v}") for v in values])
            link = table.select(*kid, *[F.col(link).alias(f"__{link}") for link in links])
            held = table.where("out").select("a", "b", "kid_a", "kid_b", *values).join(link, ["kid_a", "kid_b"]).join(below, ["kid_a", "kid_b"])
            back = held.select("a", "b", *[(F.col(v) + F.col(f"__link_{v}") + F.col(f"__{v}")).alias(v) for v in values])
            totals = totals.unionByName(materialise(back, "expanded"))
        raked = table.where("raked").select("a", "b", *values)
        totals = raked if totals is None else totals.unionByName(raked)
    return totals


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's pieces, which come in order."""
    current, state, out = None, None, []

    def rows() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))], names=["a", "b", "ends_sha256"])
        out.clear()
        return made

    for batch in batches:
        for a, b, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if current != (a, b):
                if current:
                    out.append((*current, state.hexdigest()))
                current, state = (a, b), hashlib.sha256(piece.encode())
            else:
                state.update(f",{piece}".encode())
        yield rows()
    if current:
        out.append((*current, state.hexdigest()))
    yield rows()


def ends_of(steps: DataFrame, ids: DataFrame) -> DataFrame:
    """a, b and the digest of the sorted, comma-joined ids of the conversations that end at a node.

    A node's ids are ranged over partitions, joined to pieces there, and only pieces stream, in order, through one digest.
    """
    last = steps.groupBy("conv_id").agg(F.max(F.struct("depth", "a", "b")).alias("last"))
    zero = F.lit(0).cast("bigint")
    ended = ids.join(last, "conv_id", "left").select("conv_id", F.coalesce("last.a", zero).alias("a"), F.coalesce("last.b", zero).alias("b"))
    ended = materialise(ended, "ends")
    slices = max(1, -(-ended.count() // PIECE_IDS))
    ranged = materialise(ended.repartitionByRange(slices, "a", "b", "conv_id").withColumn("slice", F.spark_partition_id()), "end-slices")
    ordered = F.array_sort(F.collect_list("conv_id"))
    pieces = ranged.groupBy("a", "b", "slice").agg(F.array_join(F.transform(ordered, lambda c: c.cast("string")), ",").alias("piece"))
    stream = pieces.repartition("a", "b").sortWithinPartitions("a", "b", "slice").select("a", "b", "piece")
    return stream.mapInArrow(_digests, "a bigint, b bigint, ends_sha256 string")


def trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per node of the prefix trie of conversations, the textless root included.

    ``turns`` has conv_id, place (from 0, without gaps), digest and bytes, as ``numbered_turns`` gives them; ``ids`` has
    every conv_id once, those without turns too. A node of depth d is a distinct sequence of first d turns. Its
    text is that of turn d - 1 of conversation ``conv_id``.

    Returns conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. Subtree totals
    (leaves, and bytes that all but one of a node's conversations share) come from ``subtree_totals``.
    Without conversations there is no root and no row.
    """
    steps = materialise(prefixes(turns), "prefixes")
    nodes = nodes_of(steps, ids)
    children = nodes.where(F.col("up_a").isNotNull()).groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["a", "b"], "left").fillna(0, ["n_children"])
    own = nodes.withColumn("n_leaves", (F.col("n_children") == 0).cast("bigint")).withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("bytes"))
    own = materialise(own, "valued-nodes")
    values = ["n_leaves", "saved_tokens"]
    totals = subtree_totals(own.select("a", "b", "up_a", "up_b", *values), values)
    whole = own.drop(*values).join(totals, ["a", "b"]).join(ends_of(steps, ids), ["a", "b"], "left")
    whole = materialise(whole, "totals")
    parents = own.where(F.col("n_children") > 0).select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("parent_conv_id"))
    return whole.join(parents, ["up_a", "up_b"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", *values, F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256")
    )

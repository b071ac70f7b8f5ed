"""Vector indexes and exact top-k similarity search.

Similarity is the cosine, rounded to ``DIGITS`` places; equal similarities go by lower id, so
a result does not depend on the order in which floating-point sums were taken. Vectors without
length, or with entries that are NULL, NaN or infinite, have no cosine and are neither indexed
nor searched for.

Two ways, chosen by the checked number of queries:

* few queries: their matrix goes to every task, each task scans its share of the index once
  and returns its k best per query. The index is not shuffled.
* many queries: a tree of pivot vectors, which grows with the table, cuts the index into leaves.
  A query first searches the leaf that the nearest pivots lead to; the k-th similarity found
  there bounds the distance of any better match, and the query then goes only to leaves that can
  hold one (triangle inequality, as in published pivot-based k-nearest-neighbour joins). Leaves
  are packed into regions of bounded size. A query goes once to each region in which it must visit
  a leaf, with a bit for each of the region's leaves, and meets it by an equi-join; so what is shuffled
  is queries by regions and the index by blocks of queries, and not queries by leaves. A tree too large to be sent
  to every task gives visits of single leaves instead, as ids and bounds that vectors join later.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps
from pyspark.sql.window import Window

from rowloom.functions.text import let
from rowloom.session import materialise
from rowloom.sources.tables import save_table, swap_table, table_is_filled

DIGITS = 6
# Queries sent to every task: at most this many, and at most this many vector entries.
BROADCAST_QUERIES = 4_096
BROADCAST_ENTRIES = 8_000_000
# Vectors in a leaf of the tree of pivots: about this many; up to twice as many are not split.
LEAF_ROWS = 4_096
# A node has fewer children than this, and is numbered by its parent's number times this; so many levels fit 64 bits.
FANOUT_STEP = 1_024
MAX_LEVELS = 6
# A cell whose vectors are all this close to its pivot is not split.
SPLIT_RADIUS = 1e-3
_CELL = ["parent", "node", "pivot", "count", "near", "far"]
# Rows compared with the cells of a node at a time.
STEP_ROWS = 256
# Vectors, or queries, in one piece of a cell: about this many, and about this many vector entries.
PIECE_ROWS = 20_000
PIECE_ENTRIES = 8_000_000
# Pieces in a region of leaves, about, as far as PIECE_ENTRIES allows; fewest queries of a block that meets it, for which smaller blocks are not cut.
REGION_PIECES = 6
BLOCK_ROWS = 1_024
# Meetings of a block and a region for each core, where queries are enough, and shuffle partitions for each of them, so that few share one: cores end together.
TASKS_A_CORE = 3
PARTITIONS_A_MEETING = 8
# Similarities held at a time when two pieces meet.
TILE_ENTRIES = 4_000_000
# Slack on distances; above the rounding step of a similarity near any bound.
SLACK = 4e-6


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two array columns; NULL if either has no length."""

    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)

    return F.round(F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))), DIGITS)


def unit_vector(vector: Column) -> Column:
    """The vector scaled to length one; NULL if it has none (NaN counts as above all numbers)."""
    squares = F.transform(vector, lambda x: x.cast("double") * x.cast("double"))
    length = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, v: acc + v))
    return let(length, lambda n: F.when((n > 0) & (n < float("inf")), F.transform(vector, lambda x: x.cast("double") / n)))


def build_index(vectors: DataFrame, id_column: str, vector: str, dim: int) -> DataFrame:
    """The index table ``id, embedding``, unit vectors of a checked width.

    A vector of another width fails the job; one without length, or NULL, is left out.
    """
    fits = F.col(vector).isNull() | (F.size(vector) == dim)
    checked = vectors.where(F.assert_true(fits, F.concat(F.lit(f"expected {dim} entries, found "), F.size(vector))).isNull())
    return checked.select(F.col(id_column).alias("id"), unit_vector(F.col(vector)).alias("embedding")).where(
        "embedding IS NOT NULL"
    )


# --- matrices inside tasks ----------------------------------------------------------------


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column of equal widths as a matrix of doubles with rows of length one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    widths = np.unique(column.value_lengths().to_numpy(zero_copy_only=False))
    if len(widths) > 1:
        raise ValueError(f"vectors of different widths: {widths.tolist()}")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    matrix = flat.reshape(rows, -1) if rows else flat.reshape(0, 0)
    return _unit(matrix)


def _rounded(sims: np.ndarray) -> np.ndarray:
    """Half away from zero, as SQL rounds."""
    scale = 10.0**DIGITS
    return np.copysign(np.floor(np.abs(sims) * scale + 0.5) / scale, sims)


def _unit(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; rows without length become NaN."""
    with np.errstate(invalid="ignore", divide="ignore"):
        return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def _slack(dim: int) -> float:
    """How far the inner product of two vectors of length one may be off when worked out in single precision."""
    return (dim + 8) * 2.0**-24


def _places(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns where a matrix is true, row by row; reads eight entries at a time, as few are."""
    flat = mask.ravel()
    whole = len(flat) // 8 * 8
    words = np.flatnonzero(flat[:whole].view(np.uint64))
    at = np.concatenate(((words[:, None] * 8 + np.arange(8)).ravel(), np.arange(whole, len(flat))))
    return np.divmod(at[flat[at]], max(1, mask.shape[1]))


class _Best:
    """The k best ids per query so far."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.sims = np.full((queries, k), -np.inf)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)

    def offer(self, rows: np.ndarray, sims: np.ndarray, ids: np.ndarray) -> None:
        """Take candidates ``(query row, similarity, id)`` into account."""
        touched, local = np.unique(rows, return_inverse=True)
        row = np.concatenate([local, np.repeat(np.arange(len(touched)), self.k)])
        sim = np.concatenate([sims, self.sims[touched].ravel()])
        ident = np.concatenate([ids, self.ids[touched].ravel()])
        order = np.lexsort((ident, -sim, row))
        row = row[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        keep = order[rank < self.k]
        # Each touched query has at least k entries, so the kept ones fill its row exactly.
        self.sims[touched] = sim[keep].reshape(len(touched), self.k)
        self.ids[touched] = ident[keep].reshape(len(touched), self.k)

    def scan(
        self,
        queries: np.ndarray,
        query_ids: np.ndarray,
        items: np.ndarray,
        item_ids: np.ndarray,
        skip_self: bool,
        bound: np.ndarray | None = None,
        at: np.ndarray | None = None,
    ) -> None:
        """Compare all queries with all items, a tile at a time.

        Products in single precision tell which similarities may still count: those within a rounding step, and what such
        products may be off, of the k-th best so far or, at the start, of the k-th best of the tile. Only these are worked out in
        double precision and rounded. ``bound`` is a similarity per query below which nothing counts, where one is known.
        ``at`` has the queries' places where these are not all.
        """
        own = slice(None) if at is None else at
        step = max(self.k + 1, TILE_ENTRIES // max(1, len(queries)))
        slack = 10.0**-DIGITS + 2 * _slack(queries.shape[1])
        queries_32 = queries.astype(np.float32)
        for start in range(0, len(items), step):
            ids, some = item_ids[start : start + step], items[start : start + step]
            sims = queries_32 @ some.astype(np.float32).T
            worst = self.sims[own, -1:]
            floor = worst if bound is None else np.maximum(worst, bound[:, None])
            need = self.k + int(skip_self)
            if sims.shape[1] > need and np.isneginf(floor).any():
                floor = np.maximum(floor, np.partition(sims, -need, axis=1)[:, -need, None])
            rows, columns = _places(sims >= (floor - slack).astype(np.float32))
            if skip_self:
                other = query_ids[rows] != ids[columns]
                rows, columns = rows[other], columns[other]
            if len(rows):
                exact = self._exact(queries, some, rows, columns)
                self.offer(rows if at is None else at[rows], _rounded(exact), ids[columns])

    @staticmethod
    def _exact(queries: np.ndarray, items: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Similarities of pairs; of all where the pairs are a good share of them."""
        if len(rows) * 32 > len(queries) * len(items):
            return (queries @ items.T)[rows, columns]
        step = max(1, TILE_ENTRIES // (8 * queries.shape[1]))
        return np.concatenate([(queries[rows[at : at + step]] * items[columns[at : at + step]]).sum(axis=1) for at in range(0, len(rows), step)])

    def frame(self, query_ids: np.ndarray) -> pd.DataFrame:
        found = np.isfinite(self.sims)
        return pd.DataFrame(
            {
                "query_id": np.repeat(query_ids, self.k)[found.ravel()],
                "id": self.ids[found],
                "sim": self.sims[found],
            }
        )


_MATCH = "query_id bigint, id bigint, sim double"
_PREDICTED = "id bigint, predicted bigint, sim double"
_RANKED = "query_id bigint, rank int, id bigint, sim double"


def _usable(vectors: DataFrame, *more: str) -> DataFrame:
    """``id, embedding`` and ``more`` of the vectors that have a length; the limits keep squares within range."""
    in_range = F.forall("embedding", lambda x: F.abs(x) < 1e150)
    return vectors.select(F.col("id").cast("bigint").alias("id"), "embedding", *more).where(
        in_range & F.exists("embedding", lambda x: F.abs(x) > 1e-150)
    )


def _ranked(matches: DataFrame, k: int) -> DataFrame:
    """The k best of all matches per query: ``query_id, rank, id, sim``. Ranks are cut before the shuffle too."""
    best = Window.partitionBy("query_id").orderBy(F.desc("sim"), F.asc("id"))
    return matches.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "id", "sim")


# --- few queries --------------------------------------------------------------------------


def _scan_with_broadcast(queries: list[Row], index: DataFrame, k: int, skip_self: bool) -> DataFrame:
    query_ids = np.array([row["id"] for row in queries], np.int64)
    matrix = _unit(np.array([row["embedding"] for row in queries], np.float64))
    shared = index.sparkSession.sparkContext.broadcast((query_ids, matrix))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix = shared.value
        best = _Best(len(ids), k)
        for batch in batches:
            if batch.num_rows:
                items = _matrix(batch.column("embedding"))
                best.scan(matrix, ids, items, batch.column("id").to_numpy().astype(np.int64), skip_self)
        yield pa.RecordBatch.from_pandas(best.frame(ids), preserve_index=False)

    return _ranked(index.mapInArrow(scan, _MATCH), k)


# --- many queries -------------------------------------------------------------------------


class Level(NamedTuple):
    """One level of a tree of pivots, a row per cell: ``parent, node, pivot, count, near, far``.

    A cell's vectors are those of its parent that are nearest to ``pivot``; ``near`` and ``far`` are
    the least and greatest distance of its vectors from it. ``local`` holds the same rows where they
    are few enough to be sent to every task.
    """

    cells: DataFrame
    local: pa.Table | None


class Tree(NamedTuple):
    """An index cut into leaves: ``items(id, embedding, node)``, ``leaves(node, count)`` and the levels from the root.

    ``small`` says that no level was too large to be sent to every task, so that all leaves' numbers may be too.
    """

    items: DataFrame
    leaves: DataFrame
    levels: list[Level]
    small: bool


def _distances(matrix: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (matrix @ pivots.T)))


def _to_all(df: DataFrame, small: bool) -> DataFrame:
    """A hint to broadcast a frame whose size was checked; frames made from local rows have no size that Spark knows."""
    return F.broadcast(df) if small else df


def _pieces(count: Column, piece_rows: int) -> Column:
    return F.ceil(count / piece_rows).cast("int")


def _per_parent(
    rows: DataFrame, key: str, level: Level, step: Callable[[pa.Table, pa.Table], pa.Table], schema: str, piece_rows: int
) -> DataFrame:
    """``step(rows of one node, cells of that node)`` for all ``rows``, which have a ``node``, in pieces.

    A level of a checked size goes to every task, and rows stay where they are. Else the rows of
    a node are cut into pieces of about ``piece_rows`` that meet the node's cells by an equi-join.
    """
    columns = rows.columns
    if level.local is not None:
        shared = rows.sparkSession.sparkContext.broadcast(level.local)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cells = shared.value
            starts = {}
            parents = cells["parent"].to_numpy()
            for parent in np.unique(parents):  # sorted by parent
                low, high = np.searchsorted(parents, [parent, parent + 1])
                starts[int(parent)] = cells.slice(low, high - low)
            for batch in batches:
                table = pa.Table.from_batches([batch])
                nodes = table["node"].to_numpy()
                for node in np.unique(nodes):
                    part = table.take(pa.array(np.flatnonzero(nodes == node)))
                    # Small steps: a query may go to every cell.
                    for at in range(0, part.num_rows, STEP_ROWS):
                        yield from step(part.slice(at, STEP_ROWS), starts[int(node)]).to_batches()

        return rows.mapInArrow(scan, schema)
    sizes = rows.groupBy("node").agg(_pieces(F.count("*"), piece_rows).alias("pieces"))
    left = rows.join(sizes, "node").withColumn("piece", F.pmod(F.xxhash64(key), F.col("pieces"))).select(*columns, "piece")
    right = (
        level.cells.join(sizes, level.cells["parent"] == sizes["node"])
        .select(level.cells["*"], F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pieces").cast("bigint") - 1)).alias("piece"))
    )

    def meet(rows: pa.Table, cells: pa.Table) -> pa.Table:
        if not rows.num_rows:  # a piece that no row's hash fell into
            rows = empty.slice(0, 0)
        cells = cells.drop_columns(["piece"]).sort_by("node")
        done = [step(rows.slice(at, STEP_ROWS), cells) for at in range(0, max(1, rows.num_rows), STEP_ROWS)]
        return pa.concat_tables(done)

    from pyspark.sql.pandas.types import to_arrow_schema

    empty = to_arrow_schema(left.schema).empty_table()
    return left.groupBy("node", "piece").cogroup(right.groupBy("parent", "piece")).applyInArrow(meet, schema)


def _draw_pivots(items: DataFrame, full: DataFrame, level: int, fanout: int, leaf_rows: int) -> DataFrame:
    """``parent, node, pivot``: for each node of ``full(node, count)`` some of its different vectors, those that hash lowest.

    One for each ``leaf_rows`` vectors, ``fanout`` at most. Copies hash alike and give one pivot. A filter on
    the hash leaves about twice as many as wanted, so that ranking them is small work. A node in which
    fewer than two vectors are found is left as it is.
    """
    wanted = full.withColumn("n", F.least(F.lit(fanout), F.ceil(F.col("count") / leaf_rows)))
    scale = 1 << 40
    place = F.pmod(F.xxhash64(F.lit(level), "embedding"), F.lit(scale))
    drawn = (
        items.join(wanted, "node")
        .withColumn("place", place)
        .where(F.col("place") < F.col("n") * 2.0 * scale / F.col("count"))
        .groupBy("node", "n", "place")
        .agg(F.min("embedding").alias("pivot"))
    )
    lowest = Window.partitionBy("node").orderBy("place")
    return (
        drawn.withColumn("rank", F.row_number().over(lowest))
        .withColumn("found", F.count("*").over(Window.partitionBy("node")))
        .where((F.col("rank") <= F.col("n")) & (F.col("found") > 1))
        .select(
            F.col("node").alias("parent"),
            (F.col("node") * FANOUT_STEP + F.col("rank")).alias("node"),
            F.col("pivot").cast("array<double>").alias("pivot"),
        )
    )


def _nearest_cell(rows: pa.Table, cells: pa.Table) -> pa.Table:
    """Each vector into the cell of its nearest pivot, with the distance to it."""
    far = _distances(_matrix(rows["embedding"]), _matrix(cells["pivot"])) if rows.num_rows else np.zeros((0, cells.num_rows))
    cell = far.argmin(axis=1)
    return pa.table(
        {
            "id": rows["id"],
            "embedding": rows["embedding"],
            "node": pa.array(cells["node"].to_numpy()[cell], pa.int64()),
            "dist": pa.array(far[np.arange(len(cell)), cell], pa.float64()),
        }
    )


def grow_tree(index: DataFrame, dim: int, rows: int, leaf_rows: int = LEAF_ROWS, piece_rows: int = PIECE_ROWS) -> Tree:
    """Cut the index into leaves of about ``leaf_rows`` vectors: nodes are split around pivots of their own, level by level.

    The number of leaves grows with the table, that of levels with its logarithm. A node is left
    whole if its vectors all but coincide. Leaves beyond ``leaf_rows`` are searched in pieces, so that
    this changes the work and not the result.
    """
    spark = index.sparkSession
    fanout = max(2, min(FANOUT_STEP - 1, BROADCAST_ENTRIES // dim))
    items = index.withColumn("node", F.lit(0).cast("bigint"))
    whole, counts, levels = [], [], []
    sizes = spark.createDataFrame([(0, rows)], "node bigint, count bigint")
    cells_to_split, rows_to_split = int(rows > 2 * leaf_rows), rows
    full = sizes
    while cells_to_split and len(levels) < MAX_LEVELS:
        most = min(cells_to_split * fanout, -(-rows_to_split // leaf_rows) + cells_to_split)
        full = _to_all(full, cells_to_split <= BROADCAST_ENTRIES // dim)
        pivots = _draw_pivots(items, full, len(levels), fanout, leaf_rows)
        if most * dim <= BROADCAST_ENTRIES:
            local = pivots.toArrow().sort_by([("parent", "ascending"), ("node", "ascending")])
            if not local.num_rows:
                break
            if levels:
                pivots = spark.createDataFrame(local)
        else:
            local, pivots = None, materialise(pivots, "pivots")
            if pivots.isEmpty():
                break
        if levels:
            parents = _to_all(pivots.select(F.col("parent").alias("node")).distinct(), local is not None)
            whole.append(items.join(parents, "node", "left_anti"))
            counts.append(sizes.join(parents, "node", "left_anti"))
            items = items.join(parents, "node", "left_semi").select("id", "embedding", "node")
        kind = items.schema["embedding"].dataType.simpleString()
        schema = f"id bigint, embedding {kind}, node bigint, dist double"
        assigned = materialise(_per_parent(items, "id", Level(pivots, local), _nearest_cell, schema, piece_rows), "cells")
        stats = assigned.groupBy("node").agg(F.count("*").alias("count"), F.min("dist").alias("near"), F.max("dist").alias("far"))
        if local is None:
            cells = materialise(pivots.join(stats, "node").select(*_CELL), "level")
        else:  # at most as many rows as pivots
            found = stats.toArrow()
            at = pc.index_in(local["node"], found["node"].combine_chunks())
            used = pc.is_valid(at)
            local, found = local.filter(used), found.take(at.filter(used))
            for name in ("count", "near", "far"):
                local = local.append_column(name, found[name])
            local = local.select(_CELL).combine_chunks()
            cells = spark.createDataFrame(local)
        levels.append(Level(cells, local))
        items = assigned.select("id", "embedding", "node")
        sizes = cells.select("node", "count")
        too_full = (F.col("count") > 2 * leaf_rows) & (F.col("far") > SPLIT_RADIUS)
        full = cells.where(too_full).select("node", "count")
        if local is None:
            cells_to_split, rows_to_split = full.agg(F.count("*"), F.coalesce(F.sum("count"), F.lit(0))).first()
        else:
            count = local["count"].to_numpy()
            large = (count > 2 * leaf_rows) & (local["far"].to_numpy() > SPLIT_RADIUS)
            cells_to_split, rows_to_split = int(large.sum()), int(count[large].sum())
    for more in whole:
        items = items.unionByName(more.select("id", "embedding", "node"))
    for more in counts:
        sizes = sizes.unionByName(more)
    return Tree(items, sizes, levels, all(level.local is not None for level in levels))


def _home_step(need: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Each query into the nearest cell that has at least ``need`` vectors or, where none has, the most vectors."""

    def step(rows: pa.Table, cells: pa.Table) -> pa.Table:
        count = cells["count"].to_numpy()
        home = np.zeros(0, np.int64)
        if rows.num_rows:
            far = _distances(_matrix(rows["embedding"]), _matrix(cells["pivot"]))
            home = np.where(count >= min(need, count.max()), far, np.inf).argmin(axis=1)
        return pa.table({"query_id": rows["query_id"], "node": pa.array(cells["node"].to_numpy()[home], pa.int64())})

    return step


def _reached(matrix: np.ndarray, kth: np.ndarray, pivots: np.ndarray, near: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows, and cells of one node that may hold a match as good as their ``kth``; see ``_visit_step``."""
    # The plane between two pivots is no use where they all but coincide.
    apart = _distances(pivots, pivots)
    apart[apart < 1e-3] = np.inf
    to_pivot = _distances(matrix, pivots)
    nearest = to_pivot.argmin(axis=1)
    reach = np.where(np.isnan(kth), np.inf, np.sqrt(np.maximum(0.0, 2.0 - 2.0 * kth + SLACK)) + SLACK)
    ring = np.maximum(to_pivot - far, near - to_pivot)
    plane = (to_pivot**2 - to_pivot[np.arange(len(nearest)), nearest, None] ** 2) / (2.0 * apart[nearest])
    return np.nonzero(np.maximum(ring, plane) <= reach[:, None])


def _visit_step(rows: pa.Table, cells: pa.Table) -> pa.Table:
    """``query_id, home, kth_sim, node``: the cells that may hold a match as good as ``kth_sim``.

    A cell's vectors lie between ``near`` and ``far`` from its pivot and no closer to any other
    pivot of their parent; both bound their distance from the query from below.
    """
    row = cell = np.zeros(0, np.int64)
    if rows.num_rows:
        kth = rows["kth_sim"].to_numpy().astype(np.float64)
        near, far = cells["near"].to_numpy(), cells["far"].to_numpy()
        row, cell = _reached(_matrix(rows["embedding"]), kth, _matrix(cells["pivot"]), near, far)
    found = rows.select(["query_id", "home", "kth_sim"]).take(pa.array(row))
    return found.append_column("node", pa.array(cells["node"].to_numpy()[cell], pa.int64()))


def _descend(asked: DataFrame, queries: DataFrame, tree: Tree, step, schema: str, piece_rows: int) -> DataFrame:
    """``asked(query_id, ...)`` taken from the root to leaves by ``step``. Vectors join at each level and are not kept."""
    state = asked.withColumn("node", F.lit(0).cast("bigint"))
    done = []
    for depth, level in enumerate(tree.levels):
        with_vectors = state.join(queries, "query_id")
        state = _per_parent(with_vectors, "query_id", level, step, schema, piece_rows)
        if depth + 1 < len(tree.levels):
            state = materialise(state, "descent")
            below = tree.levels[depth + 1]
            inner = _to_all(below.cells.select(F.col("parent").alias("node")).distinct(), below.local is not None)
            done.append(state.join(inner, "node", "left_anti"))
            state = state.join(inner, "node", "left_semi")
    for more in done:
        state = state.unionByName(more)
    return state


def _search_leaves(visits: DataFrame, queries: DataFrame, tree: Tree, k: int, skip_self: bool, piece_rows: int) -> DataFrame:
    """The k best matches per query and piece of the leaves it visits. ``visits`` holds ``node, query_id, kth_sim``."""
    asked = visits.groupBy("node").agg(_pieces(F.count("*"), piece_rows).alias("query_pieces"))
    sizes = asked.join(_to_all(tree.leaves, tree.small), "node").select(
        "node", "query_pieces", _pieces(F.col("count"), piece_rows).alias("item_pieces")
    )
    sizes = _to_all(sizes, tree.small)  # at most one row per leaf

    def numbered(df: DataFrame, key: str, own: str, other: str, *more: str) -> DataFrame:
        """Each row into one piece of its own side, and a copy for each piece of the other side."""
        mine = F.pmod(F.xxhash64(key), F.col(f"{own}_pieces")).cast("int").alias(f"{own}_piece")
        theirs = F.explode(F.sequence(F.lit(0), F.col(f"{other}_pieces") - 1)).alias(f"{other}_piece")
        return df.join(sizes, "node").select("node", mine, theirs, F.col(key).alias("key"), "embedding", *more)

    left = numbered(visits.join(queries, "query_id"), "query_id", "query", "item", "kth_sim")
    right = numbered(tree.items, "id", "item", "query")
    names = ["node", "item_piece", "query_piece"]

    def meet(queries: pa.Table, items: pa.Table) -> pa.Table:
        if not queries.num_rows or not items.num_rows:
            return pa.Table.from_pandas(_Best(0, k).frame(np.zeros(0, np.int64)), preserve_index=False)
        ids = queries["key"].to_numpy().astype(np.int64)
        best = _Best(len(ids), k)
        bound = np.nan_to_num(queries["kth_sim"].to_numpy().astype(np.float64), nan=-np.inf)
        item_ids = items["key"].to_numpy().astype(np.int64)
        best.scan(_matrix(queries["embedding"]), ids, _matrix(items["embedding"]), item_ids, skip_self, bound)
        return pa.Table.from_pandas(best.frame(ids), preserve_index=False)

    return left.groupBy(*names).cogroup(right.groupBy(*names)).applyInArrow(meet, _MATCH)


class _Cells:
    """The cells of one level inside a task; ``children`` has the places of a node's."""

    def __init__(self, local: pa.Table):
        self.nodes, self.near, self.far = (local[name].to_numpy() for name in ("node", "near", "far"))
        self.pivots = _matrix(local["pivot"])
        parents = local["parent"].to_numpy()  # sorted
        starts = np.flatnonzero(np.diff(parents, prepend=-1))
        self.children = dict(zip(parents[starts].tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(parents)], strict=True), strict=True))


def _leaves_reached(matrix: np.ndarray, kth: np.ndarray, levels: list[_Cells]) -> Iterator[tuple[int, np.ndarray]]:
    """Each leaf with the rows that must visit it, from the root down."""
    state = {0: np.arange(len(matrix))}
    for cells in levels:
        below = {}
        for node, rows in state.items():
            if node not in cells.children:
                yield node, rows
                continue
            own = slice(*cells.children[node])
            row, cell = _reached(matrix[rows], kth[rows], cells.pivots[own], cells.near[own], cells.far[own])
            if not len(cell):
                continue
            order = np.argsort(cell, kind="stable")
            starts = np.flatnonzero(np.diff(cell[order], prepend=-1))
            for start, stop in zip(starts, [*starts[1:], len(order)], strict=True):
                below[int(cells.nodes[own][cell[order[start]]])] = rows[row[order[start:stop]]]
        state = below
    yield from state.items()


def _descents(asked: DataFrame, tree: Tree, found: Callable, schema: str) -> DataFrame:
    """``found(rows, leaves)`` of all ``asked(query_id, home, kth_sim, embedding)``, some at a time: ``leaves`` gives the leaves to visit beside home with their rows.

    Levels go to every task; nothing is shuffled.
    """
    shared = asked.sparkSession.sparkContext.broadcast([level.local for level in tree.levels])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = [_Cells(local) for local in shared.value]
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = pa.Table.from_batches([batch.slice(at, BLOCK_ROWS)])
                home, kth = part["home"].to_numpy(), part["kth_sim"].to_numpy().astype(np.float64)
                every = _leaves_reached(_matrix(part["embedding"]), kth, levels)
                away = ((node, rows[home[rows] != node]) for node, rows in every)
                yield from found(part, ((node, rows) for node, rows in away if len(rows)))

    return asked.mapInArrow(run, schema)


def _each_visit(rows: pa.Table, leaves: Iterator[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    for node, at in leaves:
        some = rows.select(["query_id", "home", "kth_sim"]).take(pa.array(at))
        yield from some.append_column("node", pa.array(np.full(len(at), node), pa.int64())).to_batches()


def _search_regions(asked: DataFrame, tree: Tree, dim: int, k: int, skip_self: bool, piece_rows: int) -> DataFrame:
    """The k best matches of ``asked`` per region in the leaves that it must visit beside its home.

    Leaves, those beyond ``piece_rows`` in pieces, fill regions in the order of their numbers, which is that of the tree. The index goes
    to each block of queries once, a query to a region once.
    """
    spark = asked.sparkSession
    most = max(piece_rows, min(REGION_PIECES * piece_rows, PIECE_ENTRIES // dim))
    units, places, region, filled, unit = [], {}, 0, 0, 0
    for node, count in sorted(zip(*tree.leaves.toArrow().to_pydict().values(), strict=True)):  # a tree whose leaves' numbers may go to every task
        pieces = -(-count // piece_rows)
        for piece in range(pieces):
            if filled and filled + count // pieces > most:
                region, filled, unit = region + 1, 0, 0
            units.append((node, pieces, piece, region, unit))
            places.setdefault(node, []).append((region, unit))
            filled, unit = filled + count // pieces, unit + 1
    regions = region + 1
    queries = asked.count()
    wanted = -(-TASKS_A_CORE * spark.sparkContext.defaultParallelism // regions)
    blocks = max(-(-2 * queries // most), min(wanted, -(-queries // BLOCK_ROWS)), 1)
    # Sizes of regions, and their units by leaf.
    width = [0] * regions
    for _, _, _, region, unit in units:
        width[region] = unit + 1
    sent = spark.sparkContext.broadcast((places, width))

    def packed(rows: pa.Table, leaves: Iterator[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        places, width = sent.value
        marks: dict[int, np.ndarray] = {}
        for node, at in leaves:
            for region, unit in places[node]:
                if region not in marks:
                    marks[region] = np.zeros((rows.num_rows, width[region]), bool)
                marks[region][at, unit] = True
        for region, marked in marks.items():
            at = np.flatnonzero(marked.any(axis=1))
            bits = [line.tobytes() for line in np.packbits(marked[at], axis=1)]
            some = rows.select(["query_id", "kth_sim", "embedding"]).take(pa.array(at))
            some = some.append_column("units", pa.array(bits, pa.binary())).append_column("region", pa.array(np.full(len(at), region), pa.int32()))
            yield from some.combine_chunks().to_batches()

    kind = asked.schema["embedding"].dataType.simpleString()
    left = _descents(asked, tree, packed, f"query_id bigint, kth_sim double, embedding {kind}, units binary, region int")
    left = left.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    of_unit = F.broadcast(spark.createDataFrame(units, "node bigint, pieces int, piece int, region int, unit int"))
    of_leaf = F.broadcast(spark.createDataFrame(sorted({u[:2] for u in units}), "node bigint, pieces int"))
    piece = F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int")
    right = tree.items.join(of_leaf, "node").withColumn("piece", piece).join(of_unit.drop("pieces"), ["node", "piece"])
    right = right.select("region", "unit", "id", "embedding", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def meet(asked: pa.Table, items: pa.Table) -> pa.Table:
        ids = asked["query_id"].to_numpy().astype(np.int64)
        best = _Best(len(ids), k)
        if len(ids) and items.num_rows:
            matrix, bound = _matrix(asked["embedding"]), np.nan_to_num(asked["kth_sim"].to_numpy().astype(np.float64), nan=-np.inf)
            marks = np.frombuffer(b"".join(asked["units"].to_pylist()), np.uint8).reshape(len(ids), -1)
            unit = items["unit"].to_numpy()
            order = np.argsort(unit, kind="stable")
            vectors, item_ids = _matrix(items["embedding"])[order], items["id"].to_numpy().astype(np.int64)[order]
            starts = np.flatnonzero(np.diff(unit[order], prepend=-1))
            for start, stop in zip(starts, [*starts[1:], len(order)], strict=True):
                number = int(unit[order[start]])
                at = np.flatnonzero(marks[:, number >> 3] & (128 >> (number & 7)))
                # A step of queries at a time, whose matrix is a copy.
                for low in range(0, len(at), BLOCK_ROWS):
                    some = at[low : low + BLOCK_ROWS]
                    best.scan(matrix[some], ids[some], vectors[start:stop], item_ids[start:stop], skip_self, bound[some], some)
        return pa.Table.from_pandas(best.frame(ids), preserve_index=False)

    return _meetings(left, right, regions * blocks).applyInArrow(meet, _MATCH)


def _meetings(left: DataFrame, right: DataFrame, number: int) -> PandasCogroupedOps:
    """Rows of both by ``region`` and ``block``; ``number`` such pairs in all."""
    names = ["region", "block"]
    left, right = (df.repartition(PARTITIONS_A_MEETING * number, *names) for df in (left, right))
    return left.groupBy(*names).cogroup(right.groupBy(*names))


class Search(NamedTuple):
    """A search by cells: the tree, matches in home leaves, and the further leaves that each query must visit.

    ``asked`` has the queries with their vectors, homes and bounds, where ``visits`` follow from them inside tasks.
    """

    tree: Tree
    first: DataFrame
    visits: DataFrame | None
    asked: DataFrame | None = None


def plan_visits(
    queries: DataFrame, index: DataFrame, dim: int, rows: int, k: int, skip_self: bool, leaf_rows: int, piece_rows: int
) -> Search:
    """Grow the tree, search each query's home leaf, and find which other leaves may hold a better match.

    ``visits`` holds ``node, query_id, kth_sim, home``: ids and bounds, no vectors. It is None if the home leaf is the whole index. It is
    written only where a level of the tree is too large for every task; else it is worked out by whoever reads it.
    """
    tree = grow_tree(index, dim, rows, leaf_rows, piece_rows)
    unknown = F.lit(None).cast("double").alias("kth_sim")
    ids = queries.select("query_id")
    if not tree.levels:
        homes = ids.select("query_id", F.lit(0).cast("bigint").alias("node"), unknown)
        return Search(tree, _ranked(_search_leaves(homes, queries, tree, k, skip_self, piece_rows), k), None)
    homes = _descend(ids, queries, tree, _home_step(k + int(skip_self)), "query_id bigint, node bigint", piece_rows)
    homes = materialise(homes, "home-visits")
    found = _search_leaves(homes.select("query_id", "node", unknown), queries, tree, k, skip_self, piece_rows)
    first = materialise(_ranked(found, k), "home-matches")
    # A query with fewer than k matches so far has no bound and visits all cells.
    bound = first.where(F.col("rank") == k).select("query_id", F.col("sim").alias("kth_sim"))
    asked = homes.select("query_id", F.col("node").alias("home")).join(bound, "query_id", "left")
    schema = "query_id bigint, home bigint, kth_sim double, node bigint"
    if tree.small:
        asked = materialise(asked.join(queries, "query_id"), "asked")
        return Search(tree, first, _descents(asked, tree, _each_visit, schema), asked)
    visits = _descend(asked, queries, tree, _visit_step, schema, piece_rows).where("node <> home")
    return Search(tree, first, materialise(visits, "visits"))


def _search_by_cells(
    queries: DataFrame, index: DataFrame, k: int, skip_self: bool, piece_rows: int, leaf_rows: int
) -> DataFrame:
    index = materialise(index, "index")
    rows, dim = index.agg(F.count("*"), F.max(F.size("embedding"))).first()
    if not rows:
        return queries.sparkSession.createDataFrame([], _RANKED)
    piece_rows = max(1, min(piece_rows, PIECE_ENTRIES // dim))
    queries = queries.withColumnRenamed("id", "query_id")
    search = plan_visits(queries, index, dim, rows, k, skip_self, leaf_rows, piece_rows)
    if search.visits is None:
        return search.first
    if search.asked is not None:
        more = _search_regions(search.asked, search.tree, dim, k, skip_self, piece_rows)
    else:
        more = _search_leaves(search.visits, queries, search.tree, k, skip_self, piece_rows)
    return _ranked(search.first.drop("rank").unionByName(more), k)


def visited_share(queries: DataFrame, index: DataFrame, k: int, skip_self: bool = False, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """What a search by cells reads, home leaves included: ``queries, leaves, visits, share`` of all pairs of query and leaf."""
    queries = materialise(_usable(queries), "queries").withColumnRenamed("id", "query_id")
    index = materialise(_usable(index), "index")
    rows, dim = index.agg(F.count("*"), F.max(F.size("embedding"))).first()
    spark, asked = queries.sparkSession, queries.count()
    schema = "queries bigint, leaves bigint, visits bigint, share double"
    if not rows or not asked:
        return spark.createDataFrame([(asked, 0, 0, None)], schema)
    search = plan_visits(queries, index, dim, rows, k, skip_self, leaf_rows, max(1, min(PIECE_ROWS, PIECE_ENTRIES // dim)))
    leaves = search.tree.leaves.count()
    visits = asked + (search.visits.count() if search.visits is not None else 0)
    return spark.createDataFrame([(asked, leaves, visits, visits / (asked * leaves))], schema)


# --- the operators ------------------------------------------------------------------------


def top_k(
    queries: DataFrame,
    index: DataFrame,
    k: int,
    skip_self: bool = False,
    broadcast_queries: int = BROADCAST_QUERIES,
    piece_rows: int = PIECE_ROWS,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """The ``k`` most similar index rows of each query: ``query_id, rank, id, sim``.

    Both frames hold ``id bigint, embedding array``; ids are unique within a frame.
    ``skip_self`` leaves out the index row of the query's own id.
    """
    # Written once: a model that embeds the queries answers each of them once, whichever way follows.
    queries = materialise(_usable(queries), "queries")
    index = _usable(index)
    # ``take`` stops at the first input partitions that hold enough.
    few = queries.take(broadcast_queries + 1)
    if not few:
        return index.sparkSession.createDataFrame([], _RANKED)
    if len(few) <= broadcast_queries and len(few) * len(few[0]["embedding"]) <= BROADCAST_ENTRIES:
        return _scan_with_broadcast(few, index, k, skip_self)
    return _search_by_cells(queries, index, k, skip_self, piece_rows, leaf_rows)


def retrieve(queries: DataFrame, index: DataFrame, documents: DataFrame, columns: list[str], k: int) -> DataFrame:
    """``query_id, rank, sim`` and the named columns of the ``k`` nearest documents.

    ``documents`` holds the columns by ``id``; only matched rows are fetched, after the ranking.
    """
    # Written first, so that Spark knows how few or many rows will meet the documents.
    matches = materialise(top_k(queries, index, k), "matches")
    return matches.join(documents.select("id", *[c for c in columns if c != "id"]), "id").select(
        "query_id", "rank", "sim", *columns
    )


def centroids(vectors: DataFrame, label: str, vector: str) -> DataFrame:
    """Mean vector per label: ``label, embedding``. Sums are kept per label and task before the shuffle."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    dense = array_to_vector(F.col(vector).cast("array<double>"))
    return vectors.groupBy(F.col(label).alias("label")).agg(vector_to_array(Summarizer.mean(dense)).alias("embedding"))


def classify_nearest(vectors: DataFrame, id_column: str, vector: str, label: str) -> DataFrame:
    """The label whose centroid is most similar to each vector, ties by lower label: ``id, predicted, sim``.

    Labels are whole numbers.
    """
    named = vectors.select(F.col(id_column).alias("id"), F.col(vector).alias("embedding"), F.col(label).alias("label"))
    labelled = _usable(named, "label")
    rows = labelled.drop("label")
    means = _usable(centroids(labelled, "label", "embedding").withColumnRenamed("label", "id"))
    means = materialise(means, "centroids")
    known = means.orderBy("id").take(BROADCAST_QUERIES + 1)
    if not known:
        return rows.sparkSession.createDataFrame([], _PREDICTED)
    if len(known) > BROADCAST_QUERIES or len(known) * len(known[0]["embedding"]) > BROADCAST_ENTRIES:
        best = top_k(rows, means, 1)
        return best.select(F.col("query_id").alias("id"), F.col("id").alias("predicted"), "sim")
    labels = np.array([row["id"] for row in known], np.int64)
    matrix = _unit(np.array([row["embedding"] for row in known], np.float64))
    shared = rows.sparkSession.sparkContext.broadcast((labels, matrix))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, matrix = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            sims = _rounded(_matrix(batch.column("embedding")) @ matrix.T)
            best = sims.argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(labels[best]), pa.array(sims[np.arange(len(best)), best])],
                ["id", "predicted", "sim"],
            )

    return rows.mapInArrow(score, _PREDICTED)


# --- keeping an index in step with its source ---------------------------------------------


def content_hash(*columns: str) -> Column:
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def index_changes(known: DataFrame, source: DataFrame) -> DataFrame:
    """``id, action``: what turns ``known`` into ``source``; both hold ``id, content_hash``.

    Only keys and hashes are shuffled. ``insert``, ``update`` or ``delete``; unchanged ids do not appear.
    """
    old = known.select("id", F.col("content_hash").alias("_old"))
    new = source.select("id", F.col("content_hash").alias("_new"))
    action = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .when(F.col("_old") != F.col("_new"), "update")
    )
    return old.join(new, "id", "full").select("id", action.alias("action")).where("action IS NOT NULL")


def sync_index(index: DataFrame, source: DataFrame, embed: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The next version of an index ``id, content_hash, embedding`` for ``source(id, content_hash, <columns>)``.

    ``embed(frame)`` turns source rows into index rows; it sees changed rows only. Write the
    result to a new name, then swap: the old version is still being read.
    """
    changes = materialise(index_changes(index, source), "changes")
    stale = changes.where("action <> 'insert'").select("id")
    fresh = changes.where("action <> 'delete'").select("id")
    columns = ["id", "content_hash", "embedding"]
    return (
        index.join(stale, "id", "left_anti")
        .select(*columns)
        .unionByName(embed(source.join(fresh, "id", "left_semi")).select(*columns))
    )


def create_or_sync(spark: SparkSession, name: str, source: DataFrame, embed: Callable[[DataFrame], DataFrame]) -> bool:
    """Create the index table ``name`` from ``source`` if it is missing or empty, else bring it up to date.

    Takes what ``sync_index`` takes. True when the index was created.
    """
    if not table_is_filled(spark, name):
        save_table(embed(source).select("id", "content_hash", "embedding"), name)
        return True
    swap_table(spark, name, sync_index(spark.table(name), source, embed))
    return False

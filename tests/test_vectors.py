import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from rowloom.operators import vectors


def frame(spark, matrix, first=0):
    rows = [(first + i, [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, "id long, embedding array<float>")


def brute(queries, items, k, skip_self):
    """``{(query, rank): (id, sim)}`` by comparing everything."""

    def unit(m):
        m = m.astype(np.float32).astype(np.float64)
        return m / np.sqrt((m * m).sum(axis=1, keepdims=True))

    sims = unit(queries) @ unit(items).T
    sims = np.copysign(np.floor(np.abs(sims) * 1e6 + 0.5) / 1e6, sims)
    out = {}
    for q in range(len(queries)):
        order = sorted((-s, i) for i, s in enumerate(sims[q]) if not (skip_self and i == q))
        for rank, (s, i) in enumerate(order[:k], 1):
            out[q, rank] = (i, -s)
    return out


def found(result):
    return {(r["query_id"], r["rank"]): (r["id"], r["sim"]) for r in result.collect()}


WAYS = [{}, {"broadcast_queries": 0}, {"broadcast_queries": 0, "piece_rows": 30, "leaf_rows": 40}]


def close(got, want):
    assert got.keys() == want.keys()
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert all(abs(got[k][1] - want[k][1]) < 1e-9 for k in want)


@pytest.mark.parametrize("how", WAYS)
def test_top_k_clustered(spark, how):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 8)) * 4
    items = centres[rng.integers(0, 12, 300)] + rng.normal(size=(300, 8)) * 0.3
    index = frame(spark, items)
    close(found(vectors.top_k(index, index, 4, skip_self=True, **how)), brute(items, items, 4, True))
    queries = rng.normal(size=(40, 8))
    close(found(vectors.top_k(frame(spark, queries), index, 3, **how)), brute(queries, items, 3, False))


@pytest.mark.parametrize("how", WAYS)
def test_top_k_with_a_third_copies(spark, how):
    rng = np.random.default_rng(6)
    items = rng.normal(size=(150, 6))
    items[::3] = items[0]
    index = frame(spark, items)
    close(found(vectors.top_k(index, index, 5, skip_self=True, **how)), brute(items, items, 5, True))


@pytest.mark.parametrize("how", WAYS)
def test_top_k_with_copies_of_other_lengths(spark, how):
    """Multiples of a vector differ by rounding only once scaled, so pivots may all but coincide."""
    rng = np.random.default_rng(9)
    items = rng.normal(size=(5, 6))[rng.integers(0, 5, 200)] * rng.integers(1, 50, 200)[:, None]
    index = frame(spark, items)
    close(found(vectors.top_k(index, index, 7, skip_self=True, **how)), brute(items, items, 7, True))


@pytest.mark.parametrize("how", WAYS)
def test_k_larger_than_the_index(spark, how):
    rng = np.random.default_rng(7)
    items, queries = rng.normal(size=(3, 4)), rng.normal(size=(5, 4))
    result = found(vectors.top_k(frame(spark, queries), frame(spark, items), 10, **how))
    close(result, brute(queries, items, 10, False))
    assert len(result) == 15


@pytest.mark.parametrize("how", WAYS)
def test_equal_scores_go_by_id_and_no_length_is_left_out(spark, how):
    items = np.array([[0, 0], [1, 0], [2, 0], [0, 1], [3, 0]])
    queries = np.array([[1, 0], [0, 0]])
    result = found(vectors.top_k(frame(spark, queries), frame(spark, items), 2, **how))
    assert result == {(0, 1): (1, 1.0), (0, 2): (2, 1.0)}


@pytest.mark.parametrize("how", WAYS)
def test_entries_that_are_no_numbers(spark, how):
    """Vectors with NULL, NaN or infinite entries take no part, and do not disturb the others."""
    rng = np.random.default_rng(11)
    items = rng.normal(size=(60, 4))
    bad = [[None, 1.0, 0.0, 0.0], [float("nan"), 1.0, 0.0, 0.0], [float("inf"), 0.0, 0.0, 0.0]] * 5
    broken = spark.createDataFrame([(1000 + i, v) for i, v in enumerate(bad)], "id long, embedding array<float>")
    index = frame(spark, items).unionByName(broken)
    close(found(vectors.top_k(index, index, 5, skip_self=True, **how)), brute(items, items, 5, True))
    assert vectors.build_index(index, "id", "embedding", 4).count() == 60
    labelled = index.withColumn("label", (F.col("id") % 2).cast("int"))
    assert vectors.classify_nearest(labelled, "id", "embedding", "label").count() == 60


@pytest.mark.parametrize("how", WAYS)
def test_nothing_to_search(spark, how):
    empty = spark.createDataFrame([], "id long, embedding array<float>")
    some = frame(spark, np.ones((2, 2)))
    assert vectors.top_k(some, empty, 2, **how).count() == 0
    assert vectors.top_k(empty, some, 2, **how).count() == 0


def test_bounds_spare_cells(spark):
    """Far clusters are not visited in the second round; visits carry ids and bounds only."""
    rng = np.random.default_rng(8)
    centres = np.eye(10) * 50
    items = np.repeat(centres, 40, axis=0) + rng.normal(size=(400, 10)) * 0.1
    index = vectors._usable(frame(spark, items))
    search = vectors.plan_visits(index.withColumnRenamed("id", "query_id"), index, 10, 400, 3, True, 20, 1000)
    assert search.visits.columns == ["query_id", "home", "kth_sim", "node"]
    assert search.tree.leaves.agg(F.sum("count")).first()[0] == 400
    share = vectors.visited_share(frame(spark, items), frame(spark, items), 3, True, leaf_rows=20).first()
    assert share["queries"] == 400 and share["leaves"] == search.tree.leaves.count() and share["share"] < 0.25


@pytest.mark.parametrize("broadcast", [True, False])
def test_tree_grows_with_the_table(spark, monkeypatch, broadcast):
    """Nodes are split level by level; the same vectors are found whether levels are broadcast or joined."""
    monkeypatch.setattr(vectors, "FANOUT_STEP", 6)
    rng = np.random.default_rng(12)
    items = rng.normal(size=(20, 5))[rng.integers(0, 20, 600)] * 3 + rng.normal(size=(600, 5)) * 0.4
    items[::3] = items[0]
    index = vectors._usable(frame(spark, items))
    if not broadcast:
        monkeypatch.setattr(vectors, "BROADCAST_ENTRIES", 25)
    tree = vectors.grow_tree(index, 5, 600, leaf_rows=10, piece_rows=64)
    assert len(tree.levels) > 2 and [level.local is None for level in tree.levels][-1] is not broadcast
    placed = {r["id"]: r["node"] for r in tree.items.collect()}
    assert len(placed) == tree.items.count() == 600
    sizes = {r["node"]: r["count"] for r in tree.leaves.collect()}
    assert sizes == {n: list(placed.values()).count(n) for n in set(placed.values())}
    # Copies stay together however many they are; the other leaves are small.
    assert len({placed[i] for i in range(0, 600, 3)}) == 1
    how = {"broadcast_queries": 0, "leaf_rows": 10, "piece_rows": 64}
    close(found(vectors.top_k(index, index, 4, skip_self=True, **how)), brute(items, items, 4, True))


@pytest.mark.parametrize("skip_self", [True, False])
def test_queries_meet_regions_and_not_single_leaves(spark, skip_self):
    """On vectors that no bound tells apart a query visits nearly all leaves, but goes once to a region."""
    items = np.random.default_rng(14).normal(size=(900, 24))
    index = vectors._usable(frame(spark, items))
    queries = index.withColumnRenamed("id", "query_id")
    search = vectors.plan_visits(queries, index, 24, 900, 3, skip_self, 10, 50)
    assert search.visits.count() > 900 * search.tree.leaves.count() / 2
    met = vectors._search_regions(search.asked, search.tree, 24, 3, skip_self, 50)
    assert met.count() <= 900 * 3 * -(-900 // 200)
    how = {"broadcast_queries": 0, "leaf_rows": 10, "piece_rows": 50}
    close(found(vectors.top_k(index, index, 3, skip_self=skip_self, **how)), brute(items, items, 3, skip_self))


def test_centroid_classes(spark):
    rows = spark.createDataFrame(
        [(1, [1.0, 0.0], 5), (2, [0.9, 0.1], 5), (3, [0.0, 1.0], 2), (4, [0.5, 0.5], 2), (5, [0.0, 0.0], 2)],
        "i long, v array<float>, label int",
    )
    result = {r["id"]: r["predicted"] for r in vectors.classify_nearest(rows, "i", "v", "label").collect()}
    assert result == {1: 5, 2: 5, 3: 2, 4: 2}


def test_no_centroids(spark):
    rows = spark.createDataFrame([(1, [0.0, 0.0], 2)], "i long, v array<float>, label int")
    assert vectors.classify_nearest(rows, "i", "v", "label").count() == 0


def test_index_rejects_another_width(spark):
    rows = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "id long, v array<float>")
    with pytest.raises(Exception, match="expected 2 entries, found 1"):
        vectors.build_index(rows, "id", "v", 2).collect()


def test_index_sync(spark):
    hashed = lambda rows: spark.createDataFrame(rows, "id long, text string").withColumn("content_hash", vectors.content_hash("text"))
    old, new = hashed([(1, "a"), (2, "b"), (3, "c")]), hashed([(1, "a"), (2, "B"), (4, "d")])
    assert {tuple(r) for r in vectors.index_changes(old, new).collect()} == {(4, "insert"), (2, "update"), (3, "delete")}
    index = old.withColumn("embedding", F.array(F.lit(0.0)))
    embed = lambda rows: rows.withColumn("embedding", F.array(F.lit(1.0)))
    result = {r["id"]: r["embedding"] for r in vectors.sync_index(index, new, embed).collect()}
    assert result == {1: [0.0], 2: [1.0], 4: [1.0]}


def test_create_or_sync(spark):
    seen = []

    def source(rows):
        return spark.createDataFrame(rows, "id long, text string").withColumn("content_hash", vectors.content_hash("text"))

    def embed(rows):
        seen.append(rows.count())
        return rows.withColumn("embedding", F.array(F.length("text").cast("double")))

    assert vectors.create_or_sync(spark, "kept_index_t", source([(1, "a"), (2, "bb"), (3, "c")]), embed)
    assert not vectors.create_or_sync(spark, "kept_index_t", source([(1, "a"), (2, "bbbb"), (4, "dd")]), embed)
    rows = {r["id"]: r["embedding"] for r in spark.table("kept_index_t").collect()}
    assert rows == {1: [1.0], 2: [4.0], 4: [2.0]} and seen == [3, 2]
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("kept_index_t")] == ["kept_index_t"]


def test_cosine_and_unit(spark):
    rows = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    out = rows.select(vectors.cosine(F.col("a"), F.col("b")).alias("s"), vectors.unit_vector(F.col("a")).alias("u")).collect()
    assert [(r["s"], r["u"]) for r in out] == [(0.96, [0.6, 0.8]), (None, None)]


def test_retrieve(spark):
    index = frame(spark, np.array([[1, 0], [0, 1]]))
    stored = spark.createDataFrame([(0, "u0", "c0"), (1, "u1", "c1")], "id long, url string, content string")
    rows = vectors.retrieve(frame(spark, np.array([[0, 2]]), 7), index, stored, ["id", "url", "content"], 1).collect()
    assert [tuple(r) for r in rows] == [(7, 1, 1.0, 1, "u1", "c1")]


def test_index_leaves_null_vectors_out(spark):
    frame = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "id long, v array<double>")
    assert [r["id"] for r in vectors.build_index(frame, "id", "v", 2).collect()] == [1]


def test_search_rejects_ragged_vectors(spark):
    index = spark.createDataFrame([(1, [1.0, 0.0, 2.0]), (2, [1.0])], "id long, embedding array<double>").coalesce(1)
    queries = spark.createDataFrame([(7, [1.0, 0.0])], "id long, embedding array<double>")
    with pytest.raises(Exception, match="different widths"):
        vectors.top_k(queries, index, 1).collect()


@pytest.mark.parametrize("dim", [3, 64])
def test_similarities_that_single_precision_cannot_tell_apart(dim):
    """Products in single precision only choose; what is ranked and returned comes from double precision."""
    rng = np.random.default_rng(11)
    items = np.concatenate((rng.normal(size=dim) + rng.normal(size=(3000, dim)) * 10.0 ** rng.uniform(-9, -2, 3000)[:, None], rng.normal(size=(500, dim))))
    items = vectors._unit(items[rng.permutation(len(items))])
    ids = rng.permutation(len(items)).astype(np.int64)
    sims = vectors._rounded(items @ items.T)
    best = vectors._Best(len(items), 6)
    best.scan(items, ids, items, ids, True)
    for q in range(0, len(items), 7):
        order = np.lexsort((ids, -sims[q]))
        assert best.ids[q].tolist() == ids[order[order != q][:6]].tolist()


def test_a_scan_holds_similarities_in_single_precision():
    rng = np.random.default_rng(12)
    queries, items = (vectors._unit(rng.normal(size=(n, 16))) for n in (1000, 4000))
    best = vectors._Best(1000, 5)
    tracemalloc.start()
    best.scan(queries, np.arange(1000), items, np.arange(4000), False, np.full(1000, 0.7))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 28_000_000  # 1,000 x 4,000 of four bytes, and which of them count


def test_meetings_of_regions_and_blocks_share_few_tasks(spark):
    """However few shuffle partitions the session has, here 8."""
    rows = spark.range(24).selectExpr("id", "int(id % 4) AS region", "int(id div 4) AS block")

    def run(left, right):
        return pa.table({"id": left["id"], "task": pa.array([TaskContext.get().partitionId()], pa.int32()), "beside": right["id"]})

    got = vectors._meetings(rows, rows, 24).applyInArrow(run, "id bigint, task int, beside bigint").collect()
    assert sorted((r["id"], r["beside"]) for r in got) == [(i, i) for i in range(24)]
    assert len({r["task"] for r in got}) >= 20

import numpy as np
import pyarrow as pa
import pytest

from rowloom.operators import approximate, vectors
from tests.test_vectors import brute, found, frame

WAYS = [{}, {"broadcast_queries": 0}]


def share(got, want):
    """The share of the exact neighbours that were found, whatever their rank."""
    hits = {(q, i) for (q, _), (i, _) in got.items()}
    return np.mean([(q, i) in hits for (q, _), (i, _) in want.items()])


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 18)) * 3
    items = centres[rng.integers(0, 30, 3000)] + rng.normal(size=(3000, 18))
    index = frame(spark, items).repartition(6).cache()
    return items, index, approximate.build(index, recall=0.95, k=5)


@pytest.mark.parametrize("how", WAYS)
def test_recall_and_exact_similarities(spark, clustered, how, monkeypatch):
    monkeypatch.setattr(approximate, "LIST_PIECE", 60)
    monkeypatch.setattr(approximate, "QUERY_PIECE", 400)
    items, index, coded = clustered
    want = brute(items, items, 5, True)
    exact = {(q, i): sim for (q, _), (i, sim) in want.items()}
    got = found(approximate.search(index, index, coded, 5, skip_self=True, **how))
    assert len(got) == 5 * len(items) and share(got, want) >= 0.93
    assert all(abs(sim - exact[q, i]) < 2e-6 for (q, _), (i, sim) in got.items() if (q, i) in exact)
    # Fewer lists are read than there are, and few ids of the 3,000 are compared.
    assert coded.quantizer.probes < len(coded.quantizer.centres) / 2 and coded.quantizer.depth < 300


def test_both_ways_agree_and_recall_is_counted(spark, clustered):
    items, index, coded = clustered
    queries = frame(spark, items[:80])
    one, other = (found(approximate.search(queries, index, coded, 4, **how)) for how in WAYS)
    assert {k: v[0] for k, v in one.items()} == {k: v[0] for k, v in other.items()}
    exact = approximate.search(queries, index, coded, 4, exact=True)
    row = approximate.recall(approximate.search(queries, index, coded, 4), exact).first()
    assert row["queries"] == 80 and row["recall"] == pytest.approx(share(one, brute(items[:80], items, 4, False)), abs=1e-3)


def test_every_usable_row_is_coded(spark):
    rng = np.random.default_rng(3)
    items = rng.normal(size=(400, 7))
    items[::3] = items[0]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(items)]
    rows += [(900, None), (901, [0.0] * 7), (902, [float("nan")] * 7), (903, [1.0, None] + [1.0] * 5)]
    index = spark.createDataFrame(rows, "id bigint, embedding array<double>")
    coded = approximate.build(index, k=5)
    assert sorted(r["id"] for r in coded.rows.collect()) == list(range(400))
    # A third are copies; ties go to smaller ids while the kept ids hold them.
    got = found(approximate.search(index.where("id = 0"), index, coded, 5, depth=200, probes=10**6))
    assert [got[0, r][0] for r in range(1, 6)] == [0, 3, 6, 9, 12]


def test_all_lists_and_all_ids_are_the_exact_search(spark):
    rng = np.random.default_rng(4)
    index = frame(spark, rng.normal(size=(300, 9)))
    coded = approximate.build(index, k=3)
    want = found(vectors.top_k(index, index, 3, skip_self=True))
    for how in WAYS:
        got = found(approximate.search(index, index, coded, 3, skip_self=True, probes=10**6, depth=300, **how))
        assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}


def test_small_and_empty(spark):
    one = frame(spark, [[1.0, 2.0]])
    coded = approximate.build(one)
    assert [tuple(r) for r in approximate.search(one, one, coded, 5).collect()] == [(0, 1, 0, 1.0)]
    assert approximate.search(one, one, coded, 5, skip_self=True).collect() == []
    none = one.limit(0)
    assert approximate.build(none).rows.collect() == []
    assert approximate.search(one, none, approximate.build(none), 5).collect() == []
    assert approximate.search(none, one, coded, 5).collect() == []


def test_a_query_brings_only_its_best_rows_of_a_region(spark):
    """On vectors that codes hardly tell apart many ids are kept for a query; they meet their vectors where they are found."""
    items = np.random.default_rng(6).normal(size=(1500, 24))
    index = frame(spark, items)
    coded = approximate.build(index, k=5)
    assert coded.quantizer.depth > 10
    queries = vectors._usable(index)
    got = approximate._found_by_regions(queries, index, coded, 5, coded.quantizer.probes, coded.quantizer.depth, True)
    assert got.count() <= 5 * 1500
    ways = [found(approximate.search(index, index, coded, 5, skip_self=True, **how)) for how in WAYS]
    assert {k: v[0] for k, v in ways[0].items()} == {k: v[0] for k, v in ways[1].items()}


def _coded_rows(matrix, ids, lists_for):
    """A quantizer fitted on ``matrix`` and its rows as a region holds them."""
    unit = vectors._unit(matrix.astype(np.float64))
    quantizer = approximate.fit(unit, lists_for)
    lists, codes = quantizer.encode(unit)
    codes = pa.array([c.tobytes() for c in codes], pa.binary())
    columns = {"id": pa.array(ids), "list": pa.array(lists.astype(np.int32)), "codes": codes, "embedding": pa.array(matrix.tolist(), pa.list_(pa.float64()))}
    return quantizer, unit, pa.table(columns)


def _by_all_codes(quantizer, rows, query, vector, probes, depth, k):
    """One query of a region: every code of its lists compared, the ``depth`` that look nearest by their vectors."""
    ids, lists = rows["id"].to_numpy(), rows["list"].to_numpy()
    some = vector[None].astype(np.float32)
    codes = approximate._codes(rows["codes"], quantizer.books.shape[0])
    near = approximate._near(np.zeros(1, np.float32), quantizer.products(some), codes)[0] + quantizer.centres[lists] @ some[0]
    near = np.round(near, 5)
    near[~np.isin(lists, quantizer.order(some)[0, :probes]) | (ids == query)] = -np.inf
    best = approximate._keep(near, ids, depth)
    sims = vectors._rounded(vectors._matrix(rows["embedding"])[best] @ vector)
    top = np.lexsort((ids[best], -sims))[:k]
    return list(zip(ids[best[top]].tolist(), sims[top].tolist(), strict=True))


@pytest.mark.parametrize("depth", [5, 40, 10**6])
@pytest.mark.parametrize("guess", [4, 32, "far too high"])
def test_a_region_keeps_what_all_codes_would(monkeypatch, depth, guess):
    """Products with decoded rows, guessed bounds and left-out copies change the work and not the rows found."""
    rng = np.random.default_rng(7)
    matrix = rng.normal(size=(2400, 14))
    matrix[300:700] = matrix[3]  # more copies than are kept
    matrix[700:1000] = matrix[9] + rng.normal(size=(300, 14)) * 0.05
    ids = rng.permutation(2400).astype(np.int64)
    ids[50:60] = ids[60:70]  # ids that come twice
    quantizer, unit, rows = _coded_rows(matrix, ids, 2400)
    probes = len(quantizer.centres) * 2 // 3
    if guess == "far too high":
        monkeypatch.setattr(approximate._Region, "_guess", lambda self, some, read: np.full(len(some), 0.99))
    else:
        monkeypatch.setattr(approximate, "GUESS_STEP", guess)
    region = approximate._Region(quantizer, rows, 5, probes, depth, True)
    asked = np.concatenate((np.arange(0, 60), np.arange(290, 330), np.arange(690, 730)))
    got = {}
    for at in range(0, len(asked), region.step):
        some = asked[at : at + region.step]
        for query, item, sim in zip(*region.search(ids[some], unit[some]), strict=True):
            got.setdefault(int(query), []).append((-sim, int(item)))
    near = 0
    for q in asked:
        if (ids[asked] == ids[q]).sum() == 1 or (ids == ids[q]).sum() == 1:
            want = _by_all_codes(quantizer, rows, ids[q], unit[q], probes, depth, 5)
            found = sorted(got[int(ids[q])])[:5]
            # Sums in another order may tell rows apart that tie in the fifth place of their similarity by codes.
            near += [i for _, i in found] == [i for i, _ in want]
            assert np.allclose([-s for s, _ in found], [s for _, s in want], atol=2e-2)
    assert near >= 0.98 * len(asked)


def test_few_similarities_by_codes_are_worked_out_again():
    rng = np.random.default_rng(8)
    query, place = np.repeat(np.arange(50), 2000), np.tile(np.arange(2000), 50)
    true = np.round(rng.normal(size=100_000), 5)
    true[:2000] = 0.5  # one query to which all rows are alike
    raw = (true + rng.uniform(-4e-6, 4e-6, 100_000)).astype(np.float32)
    asked = []

    def exact(q, p):
        asked.append(len(q))
        return true[q * 2000 + p]

    ids = rng.permutation(2000)
    mixed = rng.permutation(100_000)
    got_query, got_place, _, floor = approximate._best(query[mixed], place[mixed], raw[mixed], 50, 100, 1e-5, exact, ids)
    assert sum(asked) < 2000 + 50 * 5
    for q in range(50):
        own = true[q * 2000 : (q + 1) * 2000]
        want = np.lexsort((ids, -own))[:100]
        assert sorted(got_place[got_query == q]) == sorted(want) and floor[q] <= own[want].min()


def test_copies_beyond_the_depth_are_no_work():
    rng = np.random.default_rng(9)
    matrix = rng.normal(size=(3000, 8))
    matrix[1000:] = matrix[0]
    quantizer, _, rows = _coded_rows(matrix, np.arange(3000)[::-1].copy(), 3000)
    region = approximate._Region(quantizer, rows, 5, len(quantizer.centres), 50, True)
    assert 1000 <= len(region.ids) <= 1000 + 51 and set(range(51)) <= set(region.ids.tolist())

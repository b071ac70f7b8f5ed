"""The registered queries without SQL, on whole tables, beside brute force by their contracts."""

import collections
import itertools
import math
import struct
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from rowloom.llm.queries import QUERIES, vocabulary
from tests.llm.test_operators import brute_secrets, brute_similarity

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return {r["doc_id"]: r for r in pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()}


def run(spark, name):
    return QUERIES[name](spark, FOLDER).collect()


def test_near_duplicates(spark, docs):
    ids = sorted(docs)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    size = {i: len((docs[i]["text"] or "").split()) for i in ids}
    for i, j in itertools.combinations(ids, 2):
        a, b = docs[i]["text"] or "", docs[j]["text"] or ""
        # Texts of much different length cannot be alike enough.
        if a == b or min(size[i], size[j]) > 0.75 * max(size[i], size[j]) - 5 and brute_similarity(a, b) >= 0.8:
            parent[max(root(i), root(j))] = min(root(i), root(j))
    got = run(spark, "op1_dart_minhash")
    assert {r.doc_id: r.class_id for r in got} == {i: root(i) for i in ids} and len(got) == len(ids)
    sizes = collections.Counter(root(i) for i in ids)
    assert all(r.class_size == sizes[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in got)


def test_packing(spark, docs):
    library = tokenizers.Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    got = collections.defaultdict(list)
    bins = collections.defaultdict(list)
    for r in run(spark, "op2_swap_packing"):
        got[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    total = 0
    for key, doc in docs.items():
        ids = [*library.encode(doc["text"] or "", add_special_tokens=False).ids, 1]
        total += len(ids)
        pieces = sorted(got.pop(key), key=lambda r: r.piece)
        starts = range(0, len(ids), 4096)
        assert [(r.piece, r.start, r.length) for r in pieces] == [(n, s, min(4096, len(ids) - s)) for n, s in enumerate(starts)]
        assert [r.ids_crc32 for r in pieces] == [zlib.crc32(struct.pack(f"<{r.length}I", *ids[r.start : r.start + r.length])) for r in pieces]
    assert not got
    for places in bins.values():
        places.sort()
        assert [at for at, _ in places] == list(itertools.accumulate([n for _, n in places[:-1]], initial=0)) and sum(n for _, n in places) <= 4096
    assert math.ceil(total / 4096) <= len(bins) <= 1.05 * math.ceil(total / 4096) + 1


def test_shards(spark, docs):
    got = run(spark, "op3_kd_shards")
    assert sorted(r.doc_id for r in got) == sorted(docs)
    loads, slots = collections.Counter(), collections.defaultdict(list)
    for r in got:
        raw = (docs[r.doc_id]["text"] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None) and 0 <= r.shard < 16
        loads[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest, mean = max(r["size"] for r in got), sum(loads.values()) / 16
    assert all(abs(load - mean) <= 2 * largest for load in loads.values())


def test_secrets(spark, docs):
    got = run(spark, "op4_blob_ledger")
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        found = brute_secrets(docs[r.doc_id]["text"] or "")
        kinds = collections.Counter(kind for kind, _, _ in found)
        assert (r.n_assign, r.n_access, r.n_hex) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert r.spans == ",".join(f"{k}:{s}:{e}" for k, s, e in found)


def test_mix(spark, docs):
    def words(text):
        return len([w for w in (text or "").translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if w])

    sizes, totals = {i: words(d["text"]) for i, d in docs.items()}, collections.Counter()
    for i, d in docs.items():
        totals[d["source"]] += sizes[i]
    sources = sorted(totals, key=lambda s: (s is None, s or ""))
    weights = {s: 1 + n % 3 for n, s in enumerate(sources)}
    targets, full = {}, set()
    while True:
        left = sum(totals.values()) - sum(3 * totals[s] for s in full)
        share = sum(weights[s] for s in sources if s not in full)
        targets = {s: 3 * totals[s] if s in full else left * weights[s] / share for s in sources}
        over = {s for s in sources if s not in full and targets[s] > 3 * totals[s]}
        if not over:
            break
        full |= over
    got = run(spark, "op5_pareto_mix")
    assert sorted(r.doc_id for r in got) == sorted(docs)
    taken = collections.Counter()
    for r in got:
        source = docs[r.doc_id]["source"]
        assert r["size"] == sizes[r.doc_id] and r.source_size == totals[source] and r.target == pytest.approx(targets[source])
        assert 0 <= r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        taken[source] += r.taken
    for s in sources:
        assert abs(taken[s] - targets[s]) <= max(sizes[i] for i, d in docs.items() if d["source"] == s)
    assert {r.doc_id: r.taken for r in run(spark, "op5_pareto_mix")} == {r.doc_id: r.taken for r in got}


def test_neighbours(spark):
    rows = pq.read_table(f"{FOLDER}/embeddings.parquet").to_pylist()
    ids, matrix = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64)
    got, hits = collections.defaultdict(list), 0
    for r in run(spark, "op6_multi_index"):
        got[r.query_id].append(r)
    assert sorted(got) == sorted(i for i in ids.tolist() if i % 100 == 0)
    for query, found in got.items():
        apart = np.sqrt(((matrix - matrix[ids == query]) ** 2).sum(axis=1))
        exact = dict(zip(ids.tolist(), apart.tolist(), strict=True))
        found.sort(key=lambda r: r.rank)
        assert [r.rank for r in found] == list(range(1, 11)) and query not in {r.vec_id for r in found}
        assert all(r.score == pytest.approx(exact[r.vec_id], abs=1e-12) for r in found)
        assert [(r.score, r.vec_id) for r in found] == sorted((r.score, r.vec_id) for r in found)
        best = sorted((d, i) for i, d in exact.items() if i != query)[:10]
        hits += len({i for _, i in best} & {r.vec_id for r in found})
    assert hits >= 0.9 * 10 * len(got)


def test_every_row_is_compared_within_the_widest_radius(spark):
    from rowloom.llm import ann

    rng = np.random.default_rng(8)
    matrix = rng.normal(size=(300, 10))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(matrix)] + [(None, [1.0] * 10)] * 400, "vec_id bigint, embedding array<double>")
    got = ann.search(frame, F.col("vec_id") % 30 == 0, k=5, radius=ann.BITS).collect()
    for query in range(0, 300, 30):
        apart = np.sqrt(((matrix - matrix[query]) ** 2).sum(axis=1))
        apart[query] = np.inf
        assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == query] == np.argsort(apart)[:5].tolist()


def test_languages(spark, docs):
    got = run(spark, "op7_word_field")
    assert sorted(r.doc_id for r in got) == sorted(docs)
    learned = {d["lang"] for i, d in docs.items() if d["lang"] is not None and zlib.crc32(str(i).encode()) % 5}
    right = []
    for r in got:
        doc = docs[r.doc_id]
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
        if not any(c.isalpha() for c in doc["text"] or ""):
            assert r.lang_pred == "und"
        else:
            assert r.lang_pred in learned
            if r.held_out and doc["lang"] is not None:
                right.append(r.lang_pred == doc["lang"])
    assert len(right) > 20 and np.mean(right) >= 0.95


def test_token_counts(spark, docs):
    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    got = run(spark, "op8_whole_tokens")
    want = {}
    for i, d in docs.items():
        n = len(library.encode(d["text"] or ""))
        want[i] = (len((d["text"] or "").encode()), n, n > 4096)
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in got} == want and len(got) == len(want)

"""The corpus operators beside brute force, on small fixtures with nulls, ties, repeats and odd columns."""

import collections
import hashlib
import itertools
import random
import re
import sys
import types
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from rowloom.llm import ann, chat, common, exact, language, mixing, near, packing, queries, secrets, sharding, tokens
from rowloom.llm.common import connected, weighted_cut
from rowloom.session import scratch_path
from tests.compare import differences

SCHEMA = "doc_id bigint, text string, lang string, source string, key string, row bigint, shard int"
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def prose(rng, n):
    return " ".join("".join(rng.choice("abdeinorst") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Documents with nulls, empty and long texts, equal texts, repeated rows and columns named like inner ones."""
    rng = random.Random(4)
    found = []
    for i in range(160):
        text = prose(rng, rng.choice([1, 4, 30, 120]))
        found.append([i, text, rng.choice(["en", "de", None]), rng.choice(["a", "b", "b", "b", None]), "k", 1, 2])
    found[3][1] = None
    found[4][1] = ""
    found[5][1] = prose(rng, 9000)
    for i in range(20, 60):
        found[i][1] = found[19][1]
    found[70][0] = None
    found.append(list(found[80]))
    found.append(list(found[70]))
    return [tuple(r) for r in found]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def crc(text):
    return zlib.crc32((text or "").encode())


# Exact duplicates


def brute_groups(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    return groups


@pytest.mark.parametrize("block_bytes", [2, 2048])
def test_exact_groups(docs, rows, block_bytes):
    got = exact.exact_groups(docs, block_bytes=block_bytes).collect()
    groups = brute_groups(rows)
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    want = sorted(str((r[0], best[r[1] or ""], len(groups[r[1] or ""]), hashlib.sha256((r[1] or "").encode()).hexdigest())) for r in rows)
    assert sorted(str((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in got) == want
    assert collections.Counter(r.text_sha256 for r in got if r.kept) == {hashlib.sha256(t.encode()).hexdigest(): 1 for t in groups}
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_blocks_with_equal_hashes_are_told_apart(docs, rows):
    weak = lambda block, attempt: F.octet_length(block).cast("bigint") if attempt == 0 else exact.block_hash(block, attempt)
    names = exact.identities(docs, hashed=weak).select("sha256", "blocks", "name").distinct().collect()
    assert len(names) == len({r.sha256 for r in names}) == len(brute_groups(rows))


def test_without_copies_keeps_columns_and_rows(docs, rows):
    kept = exact.without_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.text or "" for r in kept.collect()) == sorted(brute_groups(rows))


# Mixing


def test_mix_targets_and_repeats(docs, rows):
    got = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted(r.size for r in got) == sorted(size(r[1]) for r in rows)
    sums = collections.Counter()
    for r in rows:
        sums[r[3]] += size(r[1])
    order = sorted(sums, key=lambda s: (s is None, s or ""))
    left, target, capped = float(sum(sums.values())), {}, set()
    while True:
        weights = {s: i % 3 + 1 for i, s in enumerate(order) if s not in capped}
        share = {s: left * w / sum(weights.values()) for s, w in weights.items()}
        over = {s for s in share if share[s] > 3 * sums[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3.0 * sums[s]
            left -= target[s]
        capped |= over
    for r in got:
        assert r.source_size == sums[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.copies <= 3
    for s in order:
        taken = sum(r.copies * r.size for r in got if r.source == s)
        assert abs(taken - target[s]) <= max(r.size for r in got if r.source == s)


def test_mix_weights_lean_towards_heavy_documents(spark):
    rows = [(i, f"w{i} x y z", "s" if i < 2000 else "t", 4.0 if i % 2 else 1.0) for i in range(4000)] + [(9999, "never", "s", None)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string, weight double"), weight="weight")
    taken = {r["odd"]: r["n"] for r in got.where("source = 's'").groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.avg("copies").alias("n")).collect()}
    assert taken[1] > 2 * taken[0]
    assert got.where("doc_id = 9999").first().copies == 0


def test_mix_inclusion_equals_the_expected_copies(spark):
    # 360 sources with like documents are as many draws.
    weights = [1.0, 1.0, 2.0, 2.0, 3.0, 4.0, 6.0, 8.0]
    rows = [(i, "a b c d", f"{s:04}", w) for s in range(360) for i, w in enumerate(weights)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string, weight double"), weight="weight").collect()
    for kind in range(3):
        part = [r for r in got if int(r.source) % 3 == kind]
        target, level = part[0].target / 4, 0.0
        for _ in weights:
            full = [w for w in weights if w * level >= 3]
            level = (target - 3 * len(full)) / sum(weights[: len(weights) - len(full)])
        for i, w in enumerate(weights):
            taken = [r.copies for r in part if r.doc_id == i]
            assert abs(sum(taken) / len(taken) - min(3.0, w * level)) < 0.13, (kind, i)


def test_mixed_keeps_sources_apart(spark):
    rows = [(i, "a b c", s) for i in range(40) for s in ("x", "y", None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("__llm_key", F.lit(1)).withColumn("__LLM_n", F.lit("z"))
    counts = {(r.doc_id, r.source): r.copies for r in mixing.mix(frame).collect() if r.copies}
    assert collections.Counter((r.doc_id, r.source) for r in mixing.mixed(frame).collect()) == counts
    assert mixing.mixed(frame.limit(0)).count() == 0


def test_mixed_rows(docs):
    counts = {r.doc_id: r.copies for r in mixing.mix(docs.where("doc_id < 150 and doc_id <> 80")).collect()}
    out = mixing.mixed(docs.where("doc_id < 150 and doc_id <> 80"))
    assert out.columns == docs.columns
    assert collections.Counter(r.doc_id for r in out.collect()) == {k: v for k, v in counts.items() if v}


def test_weighted_cut_is_nearest(spark):
    rng = random.Random(2)
    rows = [(g, rng.random() ** 4, rng.randint(0, 9)) for g in ("a", "b") for _ in range(3000)]
    frame = spark.createDataFrame(rows, "g string, k double, w bigint")
    targets = spark.createDataFrame([("a", 4000.0), ("b", 1e9)], "g string, target double")
    for few in (5, 20_000):
        cuts = {r.g: r for r in weighted_cut(frame, ["g"], "k", "w", targets, few=few).collect()}
        upto = cuts["a"].upto if cuts["a"].upto is not None else -1
        taken = sum(w for g, k, w in rows if g == "a" and (k < cuts["a"].below or k <= upto))
        sums = [0, *itertools.accumulate(w for g, k, w in sorted(rows) if g == "a")]
        assert abs(taken - 4000) == min(abs(s - 4000) for s in sums)
        assert cuts["b"].below > 1


# Sharding


@pytest.mark.parametrize("leaves", [1, 3, 16])
def test_shards(docs, rows, leaves):
    got = sharding.shards(docs, leaves=leaves).collect()
    want = sorted((str(r[0]), len((r[1] or "").encode()) + 1, crc(r[1])) for r in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == want
    for s in range(leaves):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))


def test_shards_near_equal_though_all_dimensions_tie(spark):
    frame = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text"), F.col("id") % 10).alias("text"), F.lit(None).cast("string").alias("lang"), F.lit("s").alias("source"))
    sizes = [r.s for r in sharding.shards(frame, target_bytes=6 * 3000 // 8).groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 0.05 * max(sizes)


def test_splits_are_weighted_medians_of_the_widest_dimension(spark):
    rng = random.Random(8)
    rows = [(i, rng.uniform(0, 1000), rng.uniform(0, 1) + 999 * (i == 0), rng.randint(1, 50), i / 5000) for i in range(5000)]
    frame = spark.createDataFrame(rows, "i bigint, x double, y double, w bigint, u double")
    side = {r.i: r.leaf for r in sharding.kd_leaves(frame, ["x", "y"], "w", "u", 2).collect()}
    half, total, median = sum(r[3] for r in rows) / 2, 0, None
    for _, x, _, w, _ in sorted(rows, key=lambda r: r[1]):
        total += w
        if total >= half:
            median = x
            break
    assert sum((side[i] == 1) != (x > median) for i, x, *_ in rows) <= 5


@pytest.mark.parametrize("names", [[None, *[f"src{i}" for i in range(20)]], ["hot", *[f"src{i}" for i in range(20)]], [f"web-crawl-{2000 + i}" for i in range(21)]])
def test_sources_are_split_at_the_median_of_whole_values(spark, names):
    rows = [(i, "same text", "en", names[i % 21]) for i in range(2100)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").withColumn("doc_id", F.lit(1).cast("long"))
    leaf = collections.defaultdict(set)
    placed = sharding.kd_leaves(
        sharding.with_text_rank(frame.withColumn("w", F.lit(1)).withColumn("u", F.rand(3)).withColumn("name", F.col("source")), "source", "d").withColumn("same", F.lit(0.0)), ["same", "d"], "w", "u", 2
    )
    for r in placed.collect():
        leaf[r.name].add(r.leaf)
    order = sorted(names, key=lambda n: (n is not None, n or ""))
    assert [leaf[n] for n in order[:10]] == [{0}] * 10 and [leaf[n] for n in order[11:]] == [{1}] * 10


def test_one_outlying_value_does_not_decide_the_dimension(spark):
    rows = [(i, float(i), 1e6 if i == 0 else i % 2 / 10, 1, (i * 7919 % 3000) / 3000) for i in range(3000)]
    frame = spark.createDataFrame(rows, "i bigint, x double, y double, w bigint, u double")
    side = {r.i: r.leaf for r in sharding.kd_leaves(frame, ["y", "x"], "w", "u", 2).collect()}
    assert sum(side[i] != (i >= 1500) for i in range(3000)) <= 2


@pytest.mark.parametrize("rows", [1, 7])
def test_text_ranks_over_several_slices(spark, rows, monkeypatch):
    monkeypatch.setattr(sharding, "RANKED_ROWS", rows)
    values = [None, "", "a", "ab", "web-crawl-2019", "web-crawl-2024", "é", "中"]
    frame = spark.createDataFrame([(v,) for v in values * 3], "s string")
    assert {r.s: r.d for r in sharding.text_ranks(frame, "s", "d").collect()} == {v: float(i) for i, v in enumerate(values)}


# Packing


def test_packing_of_all_pieces(docs, rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    got = packing.pack(docs, WORDS).collect()
    want = []
    for r in rows:
        ids = [*library.encode(r[1] or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at : at + 4096], dtype="<u4")
            want.append((str(r[0]), k, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    by = collections.defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for spans in by.values():
        spans.sort()
        assert [o for o, _ in spans] == [0, *itertools.accumulate(n for _, n in spans)][:-1]
        assert sum(n for _, n in spans) <= 4096
    assert len(by) == -(-sum(r.length for r in got) // 4096)


def test_sequences_hold_the_tokens(docs, rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    made, texts = packing.sequences(docs, WORDS).collect(), collections.Counter()
    for r in made:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.n_tokens == sum(p.length for p in r.pieces) <= 4096
        for p in r.pieces:
            texts[p.doc_id, p.piece, tuple(ids[p.offset : p.offset + p.length])] += 1
    want = collections.Counter()
    for r in rows:
        ids = [*library.encode(r[1] or "", add_special_tokens=False).ids, 1]
        want.update((r[0], k, tuple(ids[at : at + 4096])) for k, at in enumerate(range(0, len(ids), 4096)))
    assert texts == want and len({r.sequence_id for r in made}) == len(made)


def test_swaps_empty_bins_that_best_fit_leaves():
    rng = random.Random(1)
    lengths = [6, 5, 5, 4, 4, 3, 3] * 20
    first = packing.best_fit(lengths, 10)
    better = packing.swap_search(first, lengths, 10)
    assert len(better) < len(first)
    for lengths in (lengths, [rng.randint(900, 2600) for _ in range(300)], [10], []):
        bins = packing.pack_lengths(lengths, 4096)
        assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in b) <= 4096 for b in bins)


def test_ids_are_narrowed_without_loss():
    for ids in ([1], [0, 65_535], [0, 65_536], [2**32 - 1] * 3):
        plain = np.array(ids, "<u4").tobytes()
        narrow = packing._narrow(plain)
        assert packing._wide(narrow, len(ids)) == plain and len(narrow) == (2 if max(ids) < 65_536 else 4) * len(ids)


def steps_left(bins, lengths, capacity):
    """Pairs of underfull bins between which a move or a swap of one for one, one for two or two for one is left."""
    bins = [[lengths[i] for i in b] for b in bins]
    found = 0
    for source, target in itertools.permutations([b for b in bins if sum(b) < capacity], 2):
        room = capacity - sum(target)
        gives = [source, [a + b for a, b in itertools.combinations(source, 2)]]
        takes = [[0, *target], [a + b for a, b in itertools.combinations(target, 2)]]
        gains = {a - b for i, j in ((0, 0), (0, 1), (1, 0)) for a in gives[i] for b in takes[j]}
        found += sum(target) >= sum(source) and any(0 < g <= room for g in gains)
    return found


@pytest.mark.parametrize("low, high", [(1100, 1600), (900, 2600), (2049, 2300), (10, 1500)])
def test_the_search_ends_only_where_no_step_is_left(low, high):
    rng = random.Random(1)
    lengths = [rng.randint(low, high) for _ in range(400)]
    first = packing.best_fit(lengths, 4096)
    bins = packing.swap_search(first, lengths, 4096)
    assert sorted(i for b in bins for i in b) == list(range(400)) and all(sum(lengths[i] for i in b) <= 4096 for b in bins)
    least = -(-sum(lengths) // 4096)
    assert len(bins) <= len(first) and (len(bins) == least or steps_left(bins, lengths, 4096) == 0)


def odd_texts():
    rng = random.Random(3)
    letters = "ab  \n\t'sdéß中文١²ªº ▁<|endoftext|>İΣς​\x1c\x85\xa0　é🎉don't WE'LL 1234 $$$ <s>"
    fixed = ["", "  ", "\n", " a", "a ", "▁", "<|endoftext|>", "x<|startoftext|>y", "'said we'll", "a\n\nb", "\n a", "a \n b", "  \n  ", "\x00"]
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(1500)] + fixed


def test_word_ids_equal_the_library():
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(WORDS), packing.WordTokens(WORDS)
    for text in odd_texts():
        assert np.frombuffer(own.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


# Token counts


def test_piece_counts_equal_the_library(spark, docs, rows):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = odd_texts()
    assert tokens.PieceCounts(PIECES, tokens.whole_tokens(PIECES)).counts(texts) == [len(library.encode(t)) for t in texts]
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in tokens.count_tokens(docs, PIECES).collect())
    assert got == sorted((str(r[0]), len((r[1] or "").encode()), len(library.encode(r[1] or ""))) for r in rows)


def test_whole_tokens_are_one_token():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    behind, alone = tokens.whole_tokens(PIECES)
    assert len(behind) > 10_000 and len(alone) > 10_000
    assert all(len(library.encode(w)) == 1 for w in random.Random(1).sample(sorted(behind), 500))


# Secrets


def brute_secrets(text):
    found = []
    for m in re.finditer(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, m.end(), "assign"))
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(s, e, k) for s, _, e, k in sorted(found)]


def secret_texts():
    rng = random.Random(5)
    bits = ["token=", "secret : ", "PassWord='", "apikey:", "api_key = \"", "passwd", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "é", " ", "\n", "xyz", "ſecret=abcdefghij", "="]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(800)]


def test_secrets_equal_brute_force():
    for text in secret_texts():
        assert secrets.find_secrets(text) == brute_secrets(text), text


def test_ledger_scans_only_what_is_unseen(spark):
    texts = [*secret_texts()[:50], None, ""]
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts + texts)], "doc_id bigint, text string, address string")
    path = scratch_path(spark, "ledger")
    distinct = len({t or "" for t in texts})
    half = len({t or "" for t in texts[:20]})
    assert secrets.scan_new(frame.where("doc_id < 20"), path) == half
    assert secrets.scan_new(frame, path) == distinct - half
    assert secrets.scan_new(frame, path) == 0
    assert secrets.scan_new(frame, path, version="other") == distinct
    got = secrets.findings(frame, path, ["doc_id"]).collect()
    assert len(got) == len(frame.collect())
    for r in got:
        spans = ",".join(f"{k}:{s}:{e}" for s, e, k in brute_secrets((texts + texts)[r.doc_id] or ""))
        assert r.spans == spans and r.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()


# Near duplicates


def brute_similarity(a, b):
    def runs(text):
        words = text.split()
        n = min(5, len(words))
        return collections.Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else collections.Counter()

    x, y = runs(a), runs(b)
    return sum((x & y).values()) / max(sum((x | y).values()), 1)


def test_dart_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(120):
        n = int(rng.integers(3, 300))
        elements = rng.integers(0, 2**62, 2 * n).astype(np.uint64)
        cut = int(rng.integers(0, n))
        pair = []
        for lo in (0, cut):
            order = np.argsort(elements[lo : lo + n])
            pair.append((elements[lo : lo + n][order], rng.integers(1, 9, n)))
        a, b = near.signatures(pair)
        errors.append((a == b).mean() - near.similarity(*pair))
    assert abs(np.mean(errors)) < 0.012 and np.std(errors) < 0.05


def test_near_groups_equal_brute_force(spark):
    rng = random.Random(6)
    texts = [None, "", "   ", "one two", "one two", "one  two", "one two three"]
    for _ in range(12):
        base = prose(rng, rng.choice([40, 150])).split()
        for _ in range(rng.randint(1, 14)):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = "changed" + str(rng.random())
            texts.append(" ".join(copy))
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, part string, row int")
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        a, b = texts[i] or "", texts[j] or ""
        if a == b or brute_similarity(a, b) >= 0.8:
            parent[max(root(i), root(j))] = min(root(i), root(j))
    got = near.near_groups(frame).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: root(i) for i in range(len(texts))}
    assert sorted(r.doc_id for r in got if r.kept) == sorted({root(i) for i in range(len(texts))})
    kept = near.without_near_copies(frame)
    assert kept.columns == frame.columns and kept.count() == len({root(i) for i in range(len(texts))})


def test_connected_parts(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(60)] + [(500, 600 + i) for i in range(50)]
    parent = list(range(700))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    got = {r.node: r.part for r in connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {n: root(n) for e in edges if e[0] != e[1] for n in e}


# Search


def test_search_equals_brute_force_where_it_must(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(600, 12)).astype(np.float32)
    vectors[50:250] = vectors[50]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(1000, None), (1100, [0.0] * 12), (1200, [1.0, None] * 6), (1300, [float("nan")] * 12), (1400, [1.0]), (None, [1.0] * 12), (7, rows[7][1])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("code", F.lit("x"))
    got = collections.defaultdict(list)
    for r in ann.search(frame, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert sorted(got) == [0, 100, 200, 300, 400, 500]
    hits = 0
    for q, found in got.items():
        apart = np.sqrt(((vectors.astype(np.float64) - vectors[q].astype(np.float64)) ** 2).sum(axis=1))
        apart[q] = np.inf
        order = np.lexsort((np.arange(600), apart))[:10]
        assert len(found) == 10 and [s for _, s in found] == sorted(s for _, s in found)
        assert all(s == pytest.approx(apart[i], abs=1e-12) for i, s in found)
        hits += len({i for i, _ in found} & set(order.tolist()))
    assert hits >= 54
    assert [i for i, _ in got[100]] == [i for i in range(50, 61)][:10]


def test_search_of_few_or_no_vectors(spark):
    frame = spark.createDataFrame([(i * 100, [1.0 + i, 2.0]) for i in range(3)], "vec_id bigint, embedding array<double>")
    assert ann.search(frame, F.lit(True)).count() == 6
    assert ann.search(frame.limit(0), F.lit(True)).collect() == []


# Languages


def test_languages(spark):
    rng = random.Random(7)
    words = {"aa": "the of that and with from".split(), "bb": "der die und nicht ein mit".split()}
    say = lambda lang, n: " ".join(rng.choice(words[lang]) + rng.choice(["", "", "x" if lang == "aa" else "ß"]) for _ in range(n))
    rows = [(i, say(lang, rng.randint(5, 60)), lang) for i in range(300) for lang in [rng.choice(["aa", "bb"])]]
    rows += [(1000, None, "aa"), (1001, "12 ² !!", "bb"), (1002, "", None), (1003, say("aa", 30) + " " + say("bb", 5), None), (None, say("bb", 9), "bb")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("score", F.lit(1))
    model = language.train(frame)
    found = {r["doc_id"]: (r["__llm_lang"], r["__llm_score"]) for r in language.predict(frame, model).collect()}
    assert [found[i] for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert found[1003][0] == "aa" and 0.7 < found[1003][1] < 0.95
    held = [i for i, _, lang in rows[:300] if zlib.crc32(str(i).encode()) % 5 == 0]
    assert held and all(found[i][0] == rows[i][2] for i in held)
    kept = language.in_known_language(frame)
    assert kept.columns == frame.columns and kept.count() == len(rows) - 3


@pytest.mark.parametrize("learned", [1, 3, 5])
def test_unlearned_languages_and_noise_are_rejected(spark, learned):
    rng = random.Random(13)
    sounds = [["the", "ing", "and", "ou", "er"], ["sch", "ung", "ein", "ü", "tz"], ["eau", "é", "le", "qui", "oi"], ["ción", "ñ", "os", "ue", "la"], ["zione", "gli", "che", "ò", "tt"], ["kk", "ää", "yö", "ssa", "nen"]]
    lexicons = [["".join(rng.choice(s) for _ in range(rng.randint(1, 4))) for _ in range(300)] for s in sounds]
    say = lambda i, n: " ".join(rng.choice(lexicons[i]) for _ in range(n))
    noise = lambda n: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(n))
    clean = [(i, say(i % learned, rng.randint(5, 200)), f"l{i % learned}" if i % 7 else None) for i in range(400)]
    clean += [(1000 + i, say(0, 40) + " " + say(learned - 1, 30), None) for i in range(20)]
    strange = [(2000 + i, say(5, rng.randint(20, 200)), None) for i in range(20)] + [(3000 + i, noise(rng.randint(20, 200)), None) for i in range(20)]
    frame = spark.createDataFrame(clean + strange, "doc_id bigint, text string, lang string")
    assert sorted(r.doc_id for r in language.in_known_language(frame).collect()) == [i for i, *_ in clean]


def test_languages_are_learned_from_every_labelled_text(spark, monkeypatch):
    """Words, weights and what is usual rest on all texts to their ends, in one share or several, and not on some thousand documents."""
    rng = random.Random(21)
    lexicons = {x: ["".join(rng.choice(letters) for _ in range(rng.randint(3, 8))) for _ in range(80)] for x, letters in {"aa": "abcdefgh", "bb": "hijklmno"}.items()}
    rows = [(i, " ".join(rng.choice(lexicons[lang]) for _ in range(12)), lang) for i in range(3200) for lang in [("aa", "bb")[i % 2]]]
    # A word beyond 2,000 letters of sixty long texts.
    rows += [(5000 + i, " ".join([*(rng.choice(lexicons["aa"]) for _ in range(600)), "zyzzyva"]), "aa") for i in range(60)]
    frame = spark.createDataFrame([*rows, *rows[:50], (9000, "qqq " * 9, None)], "doc_id bigint, text string, lang string").repartition(3)
    learned = [(t, lang) for i, t, lang in rows if zlib.crc32(str(i).encode()) % 5]
    kept = language.labelled(frame)
    counts = language.counted(kept)
    assert kept.count() == len(learned) and counts.agg(F.sum("n")).first()[0] == sum(len(t.split()) for t, _ in learned)
    usual = language.familiar(kept, counts)
    every = collections.Counter(w for t, _ in learned for w in t.split())
    assert usual.total == sum(every.values()) and all(usual.words.get(w) == n for w, n in every.items()) and every["zyzzyva"] > 30
    runs = collections.Counter(f"^{w}$"[i : i + size] for w in every.elements() for size in (1, 2, 3) for i in range(len(w) + 3 - size))
    assert usual.grams == runs
    met = []
    for size in (language.SHARE_BYTES, 20_000):
        monkeypatch.setattr(language, "SHARE_BYTES", size)
        model = language.learn(kept, counts)
        assert model.languages == ["aa", "bb"] and model.lexicon.get("zyzzyva", -1) == 0
        met.append(set(np.flatnonzero(model.weights.any(axis=1)).tolist()))
        assert language.label_texts(model, ["zyzzyva", rows[1][1]])[0] == ["aa", "bb"]
    assert met[0] == met[1] and set(language.word_features("zyzzyva", model.lexicon)) <= met[0]


def test_texts_are_not_written_to_learn_languages(spark, monkeypatch):
    """Repeated documents are found by hashes, and shares are shuffled compressed; before, all labelled texts were written and shuffled twice."""
    rng = random.Random(3)
    lexicon = ["".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(300)]
    rows = [(i, " ".join(rng.choice(lexicon) for _ in range(40)), "aa") for i in range(400)]
    frame = spark.createDataFrame([*rows, *rows[:90], *rows[:30]], "doc_id bigint, text string, lang string").repartition(3)
    written = []
    monkeypatch.setattr(language, "materialise", lambda df, label, real=language.materialise: (written.append(df.columns), real(df, label))[1])
    kept = language.labelled(frame)
    assert sorted(r.text for r in kept.select("text").collect()) == sorted(t for i, t, _ in rows if zlib.crc32(str(i).encode()) % 5)
    assert written and not any("text" in columns for columns in written)
    packed = kept.select(F.lit(0).alias("share"), "text", "lang", "u", "v").coalesce(1).mapInArrow(language._packed, "share int, rows binary").toArrow()
    back = language._unpacked(packed["rows"])
    assert sorted(back["text"].to_pylist()) == sorted(r.text for r in kept.collect()) and packed["rows"].nbytes < 0.7 * back["text"].nbytes
    # Where very many repeat, their texts are moved once.
    monkeypatch.setattr(language, "BROADCAST_ROWS", 10)
    assert language.labelled(frame).count() == kept.count()


def test_words_and_their_features_are_found_for_many_texts_at_once():
    rng = random.Random(6)
    for _ in range(200):
        texts = ["".join(rng.choice("aB cÉdß\n_1²x日ΣσÀİ😀 ,") for _ in range(rng.choice([0, 1, 5, 80]))) + "Q" * rng.choice([0, 0, 24, 25, 120]) for _ in range(4)]
        distinct, ids, lengths = language.split_words(texts)
        words = [language.words_of(t) for t in texts]
        assert [distinct[i] for i in ids] == list(itertools.chain(*words)) and lengths.tolist() == list(map(len, words))
        assert distinct == list(dict.fromkeys(itertools.chain(*words)))
        slots, sizes = language.feature_slots(distinct, language.WordTable.of({w: i % 3 for i, w in enumerate(distinct[::2])})) if distinct else ([], [])
        at = 0
        for i, (word, size) in enumerate(zip(distinct, sizes, strict=True)):
            marked = f"^{word}$"
            parts = [f"w {word}", *[f"p {word[:n]}" for n in (1, 2, 3)], *[f"s {word[-n:]}" for n in (1, 2, 3)]]
            parts += [f"g {marked[k : k + n]}" for n in (2, 3) for k in range(len(marked) - n + 1)] + [f"l {-1 if i % 2 else i // 2 % 3}"]
            assert slots[at : at + size].tolist() == [zlib.crc32(p.encode()) % language.SLOTS for p in parts]
            at += size


def test_a_worker_keeps_only_what_its_operator_needs(monkeypatch):
    """The next operator's state replaces that of the one before, which used to stay for the life of the worker."""
    monkeypatch.setitem(sys.modules, "rowloom_worker_state", types.ModuleType("rowloom_worker_state"))
    kept = lambda: {x for x in vars(sys.modules["rowloom_worker_state"]) if not x.startswith("__")}
    first = common.worker_state("one", lambda: ["one"])
    assert common.worker_state("one", lambda: ["new"]) is first
    common.worker_state("two", list, beside=("one",))
    assert kept() == {"one", "two"}
    common.worker_state("three", list)
    assert kept() == {"three"}
    common.let_go()
    assert kept() == set()


def test_every_letter_of_a_long_run_counts():
    rng = random.Random(12)
    letters = {"aa": "的一是不了人我在有他", "bb": "のにはをたがでてとし"}
    say = lambda lang, n: "".join(rng.choice(letters[lang]) for _ in range(n))
    model = language.fit([(say(lang, rng.randint(5, 200)), lang) for _ in range(200) for lang in letters])
    for n in (1, 24, 25, 49, 1000):
        run = say("aa", n)
        words = language.words_of(run)
        assert "".join(words) == run and max(map(len, words)) <= 24 and min(map(len, words)) >= min(n, 12)
    found, shares, _ = language.label_texts(model, [say("aa", 30) + say("bb", 300), say("bb", 3000)])
    assert found == ["bb", "bb"] and 0.8 < shares[0] < 0.99
    assert language.words_of("short " + "ab" * 20) == ["short", "ab" * 10, "ab" * 10]


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(2)
    scores, moves = rng.normal(size=(5, 2, 3)).astype(np.float64), rng.normal(size=(3, 3))
    lengths = np.array([5, 3])
    got = language.marginals(*language.forward_backward(scores, lengths, moves)[:2])
    for s, n in enumerate(lengths):
        mass, total = np.zeros((n, 3)), 0.0
        for path in itertools.product(range(3), repeat=int(n)):
            weight = np.exp(sum(scores[t, s, y] for t, y in enumerate(path)) + sum(moves[a, b] for a, b in itertools.pairwise(path)))
            total += weight
            for t, y in enumerate(path):
                mass[t, y] += weight
        assert np.allclose(got[:n, s], mass / total) and not got[n:, s].any()


# Conversations


def test_branches_of_a_tree(spark):
    rng = random.Random(10)
    rows = []
    for tree in range(6):
        for node in range(40):
            rows.append((tree, node, rng.randrange(node) if node and rng.random() < 0.95 else None, rng.choice([None, rng.random()])))
    rows += [(9, 1, 2, 1.0), (9, 2, 1, 1.0), (9, 3, 77, 0.5)]
    got = collections.defaultdict(dict)
    for r in chat.branches(spark.createDataFrame(rows, "tree bigint, node bigint, parent bigint, score double"), best=2).collect():
        got[r.tree, r["rank"], r.leaf][r.place] = r.node
    for tree in range(6):
        parent = {n: p for t, n, p, _ in rows if t == tree}
        score = {n: s or 0.0 for t, n, _, s in rows if t == tree}
        paths = []
        for leaf in set(parent) - set(parent.values()):
            path = [leaf]
            while parent[path[-1]] is not None:
                path.append(parent[path[-1]])
            paths.append((-sum(score[n] for n in path) / len(path), -len(path), leaf, path[::-1]))
        for rank, (_, _, leaf, path) in enumerate(sorted(paths, key=lambda p: (round(p[0], 12), p[1], p[2]))[:2], 1):
            assert [got[tree, rank, leaf][i] for i in range(len(path))] == path
    assert {k for k in got if k[0] == 9} == {(9, 1, 3)}


def test_formatting_is_reversible(spark):
    texts = ["\\### Assistant: </turn> ok", None, "", "a\\hb<#:\n### user: x</turn>\n", "\\\\l", "é🎉"]
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)] + [(2, 0, "sys:tem", "x")]
    turns = spark.createDataFrame(rows, "tree bigint, turn bigint, role string, text string")
    messages = chat.reply_trees(turns, "tree", "turn").withColumn("score", F.lit(None).cast("double"))
    for part_chars in (1, 1_000_000):
        formatted = chat.conversations(messages, part_chars=part_chars)
        got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
        plain = [t or "" for t in texts]
        whole = "".join(f"{r[2]}\n{r[3] or ''}\n" for r in rows[:6])
        assert got[1].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest() and got[1].n_turns == 6
        learned = "".join(plain[1::2])
        assert got[1].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest() and got[1].loss_chars == len(learned)
        assert got[2].loss_chars == 0 and got[2].n_turns == 1


def test_the_null_conversation_is_kept(spark):
    rows = [(c, i, "user" if i % 2 == 0 else "assistant", f"{c} {i}") for c in (None, 0, 1) for i in range(9)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    messages = chat.reply_trees(frame, "conv_id", "turn").withColumnRenamed("conv_id", "tree").withColumn("score", F.lit(0.0))
    assert collections.Counter(r.tree for r in chat.branches(messages).collect()) == {None: 9, 0: 9, 1: 9}
    got = {r.conv_id: r for r in chat.read_back(chat.conversations(messages)).collect()}
    want = {r.conv_id: r for r in frame.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.when(F.col("role") == "assistant", F.length("text"))).alias("loss")).collect()}
    assert {c: (r.n_turns, r.loss_chars) for c, r in got.items()} == {c: (r.n, r.loss) for c, r in want.items()}
    for c in (None, 0, 1):
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for k, _, r, t in rows if k == c).encode()).hexdigest()


def test_query_with_a_null_conversation_beside_sql(spark, folder):
    rows = [(None if i < 30 else i // 10, i, "user" if i % 2 == 0 else "assistant", f"text {i}") for i in range(60)]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet/*.parquet'")
    assert differences(queries.QUERIES["op9_reply_trees"](spark, folder), connection, queries.ORACLES["op9_reply_trees"]) == []


# All of them


def test_empty_tables(spark, empty):
    assert exact.exact_groups(empty).collect() == []
    assert mixing.mix(empty).collect() == []
    assert sharding.shards(empty, leaves=16).collect() == []
    assert packing.pack(empty, WORDS).collect() == []
    assert tokens.count_tokens(empty, PIECES).collect() == []
    assert near.near_groups(empty).collect() == []
    assert language.languages(empty).collect() == []
    path = scratch_path(spark, "ledger")
    assert secrets.scan_new(empty, path) == 0 and secrets.findings(empty, path, ["doc_id"]).collect() == []
    none = spark.createDataFrame([], "tree bigint, turn bigint, role string, text string")
    messages = chat.reply_trees(none, "tree", "turn").withColumn("score", F.lit(0.0))
    assert chat.read_back(chat.conversations(messages)).collect() == []

"""The prefix trie beside a dictionary of prefixes."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from rowloom.llm import trie
from rowloom.llm.queries import ORACLES, QUERIES
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, place int, a string"


def expected(lists):
    """Nodes of {conv_id: [(role, text)]} by brute force."""
    members = {}
    for c, turns in lists.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    rows = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(lists[c]) == len(node)))
        rows.append((
            min(convs), len(node), min(members[node[:-1]]) if node else -1, len(convs), len(children.get(node, [])),
            sum(n not in children for n in below), sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows)


def found(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


@pytest.fixture()
def small_slices(monkeypatch):
    monkeypatch.setattr(trie, "SLICE_ROWS", 7)
    monkeypatch.setattr(trie, "PIECE_IDS", 3)


def test_rebuilt_conversations_with_nulls_ties_and_long_ones(spark, small_slices):
    rng = random.Random(5)
    rows = []
    for c in [*range(40), 72, 73, 1001]:
        for t in range(rng.choice([0, 1, 2, 5, 12, 40])):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(["a", "é", "", None, "x" * 50]), 1, "clash"))
    rows += rows[:9] + [(None, 1, "user", "lost", 1, "clash")]
    turns = spark.createDataFrame(rows, SCHEMA).repartition(6)
    numbered = trie.numbered_turns(turns)
    digest = lambda r, t: hashlib.sha256(f"{len(r)}:{r}{t}".encode()).digest()
    lists = {}
    for c, t, r, x, *_ in rows:
        if c is not None:
            lists.setdefault(c, []).append(((t is not None, t or 0, digest(r or "", x or "")), (r or "", x or "")))
    lists = {c: [turn for _, turn in sorted(found)] for c, found in lists.items()}
    rebuilt = {}
    for c, own in lists.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = lists.get(c - c % 5, [])[:h] + own[h:]
    got = trie.trie(*trie.grafted(numbered, F.col("conv_id") - F.col("conv_id") % 5, F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9))
    assert found(got) == expected(rebuilt)


def test_turnless_conversations_and_an_empty_table(spark):
    turns = spark.createDataFrame([(1, 0, "u", "x", 1, "z"), (2, 0, "u", "x", 1, "z"), (2, 1, None, None, 1, "z")], SCHEMA)
    ids = spark.createDataFrame([(1,), (2,), (3,), (-9,)], "conv_id long")
    numbered = trie.numbered_turns(turns)
    assert found(trie.trie(numbered, ids)) == expected({1: [("u", "x")], 2: [("u", "x"), ("", "")], 3: [], -9: []})
    assert trie.trie(numbered.limit(0), ids.limit(0)).count() == 0
    assert found(trie.trie(numbered.limit(0), ids)) == expected({1: [], 2: [], 3: [], -9: []})


def test_totals_of_a_deep_chain_and_a_wide_star(spark):
    rng = random.Random(2)
    up = {i: i - 1 for i in range(1, 300)} | {i: 0 for i in range(300, 420)} | {i: rng.randrange(i) for i in range(420, 700)}
    name = lambda i: (0, 0) if i == 0 else (i * 7919 - 3, i)
    value = {i: rng.randrange(50) for i in range(700)}
    rows = [(*name(i), *(name(up[i]) if i else (None, None)), value[i], 1) for i in range(700)]
    totals = trie.subtree_totals(spark.createDataFrame(rows, "a long, b long, up_a long, up_b long, v long, n long"), ["v", "n"])
    want = {i: [value[i], 1] for i in range(700)}
    for i in sorted(up, reverse=True):
        want[up[i]][0] += want[i][0]
        want[up[i]][1] += want[i][1]
    assert sorted(totals.collect()) == sorted((*name(i), *want[i]) for i in range(700))


def test_a_shared_name_is_an_error(spark):
    steps = trie.prefixes(spark.createDataFrame([(1, 0, bytearray(b"x"), 1), (2, 0, bytearray(b"y"), 1)], "conv_id long, place long, digest binary, bytes long"))
    clash = steps.withColumn("a", F.lit(5).cast("long")).withColumn("b", F.lit(6).cast("long"))
    with pytest.raises(Exception, match="share a name"):
        trie.nodes_of(clash, spark.range(1, 3).withColumnRenamed("id", "conv_id")).collect()


def test_query_beside_sql(spark):
    assert differences(QUERIES["op13_prefix_trie"](spark, FOLDER), connect(FOLDER), ORACLES["op13_prefix_trie"]) == []

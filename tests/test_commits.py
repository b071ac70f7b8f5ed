"""Committed tables and what rests on them: stream sinks, chunk numbers, the index in buckets, the ledger of answers."""

import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F

from rowloom.operators import chunking, index_store, inference, vectors
from rowloom.sources.commits import CommitLog, CommittedTable
from rowloom.sources.tables import create_chunk_table
from rowloom.streaming import ingest


def test_rows_count_from_their_commit_on(spark, folder):
    table = CommittedTable(spark, f"{folder}/t", "n BIGINT")
    assert table.read().columns == ["n"] and table.read().count() == 0
    assert table.append(spark.range(3).toDF("n"), key="a/0")
    assert not table.append(spark.range(5).toDF("n"), key="a/0")
    # A batch written whose writer died, and a commit that was not finished.
    spark.range(100).toDF("n").write.parquet(f"{folder}/t/data/{uuid.uuid4().hex}")
    open(f"{folder}/t/log/{2:012d}", "w").write('{"key": "b/0", "da')
    assert table.read().count() == 3
    assert table.append(spark.range(4).toDF("n"), key="b/0") and table.read().count() == 7
    assert [n for n, _ in table.log.commits()] == [1, 3]


def test_of_two_writers_of_a_number_one_fails(spark, folder):
    log = CommitLog(spark, folder)
    assert log.publish(1, {"who": 1}) and not log.publish(1, {"who": 2})
    assert log.commits() == [(1, {"who": 1})]
    table = CommittedTable(spark, folder)
    assert not table.append(spark.range(1), expected=0) and log.last_number() == 1


def test_a_stream_that_dies_before_its_commit(spark, folder, monkeypatch):
    spark.range(10).write.parquet(f"{folder}/in")
    stream = lambda: ingest.parquet_stream(spark, f"{folder}/in", spark.range(1).schema)
    assert ingest.read_table(spark, f"{folder}/out", "id BIGINT").columns == ["id", "origin", "batch"]
    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(Exception):
            ingest.append(stream(), f"{folder}/out", f"{folder}/checkpoint", "a")
    assert glob.glob(f"{folder}/out/origin=a/batch=0/*.parquet") and ingest.read_table(spark, f"{folder}/out", "id BIGINT").count() == 0
    for _ in range(2):
        ingest.append(stream(), f"{folder}/out", f"{folder}/checkpoint", "a")
        assert ingest.read_table(spark, f"{folder}/out").count() == 10


def test_chunk_numbers_stay_and_fit_table_and_search(spark, folder):
    numbers = CommittedTable(spark, f"{folder}/numbers", chunking.NUMBERS)
    rows = [(f"u{i % 40}", i // 40, f"text {i}", "z") for i in range(400)] + [(None, 0, "no address", "z"), ("u1", None, "no place", "z")]
    chunks = spark.createDataFrame(rows, "url string, pos int, content string, id string").repartition(9)
    first = chunking.with_chunk_number(chunks.where("url < 'u3'"), numbers)
    early = {(r["url"], r["pos"]): r["id"] for r in first.collect()}
    assert sorted(early.values()) == list(range(1, len(early) + 1))
    both = chunking.with_chunk_number(chunks, numbers)
    found = {(r["url"], r["pos"]): r["id"] for r in both.collect()}
    assert sorted(found.values()) == list(range(1, len(rows) + 1)) and early.items() <= found.items()
    assert both.columns == ["url", "pos", "content", "id"]
    assert numbers.log.last_number() == 2 and {r["id"] for r in chunking.with_chunk_number(chunks, numbers).collect()} == set(found.values())
    name = f"chunks_{uuid.uuid4().hex}"
    create_chunk_table(spark, name, embedding=True)
    vector = F.array(F.cos("id"), F.sin("id")).cast("array<float>")
    both.select("id", "url", "content", vector).write.insertInto(name)
    stored = spark.table(name)
    best = vectors.top_k(stored.where("id <= 5"), stored, 1).collect()
    assert {r["query_id"]: r["id"] for r in best} == {i: i for i in range(1, 6)}
    assert chunking.with_chunk_number(chunks.limit(0), numbers).count() == 0


def _version(spark, rows):
    return spark.createDataFrame(rows, "id long, v array<double>").withColumn("content_hash", vectors.content_hash("v"))


def test_one_changed_row_rewrites_one_bucket(spark, folder):
    seen = []

    def embed(rows):
        seen.append(rows.count())
        return rows.select("id", "content_hash", F.col("v").alias("embedding"))

    rows = [(i, [float(i), 1.0]) for i in range(300)]
    path = f"{folder}/index"
    with pytest.raises(ValueError):
        index_store.read_index(spark, path)
    assert index_store.sync(spark, path, _version(spark, rows), embed, buckets=16) == 1
    before = index_store.read_index(spark, path)
    files = CommitLog(spark, path).commits()[-1][1]["files"]
    assert len(files) == 16
    assert index_store.sync(spark, path, _version(spark, rows), embed) == 1
    rows[7] = (7, [7.0, 2.0])
    assert index_store.sync(spark, path, _version(spark, rows), embed) == 2
    changed = CommitLog(spark, path).commits()[-1][1]["files"]
    assert sum(files[b] != changed[b] for b in files) == 1 and seen == [300, 1]
    data = [f for f in glob.glob(f"{path}/data/*") if os.path.isdir(f)]
    assert len(data) == 2 and sorted(len(glob.glob(f"{f}/bucket=*")) for f in data) == [1, 16]
    # A reader of the first version still reads it.
    assert {r["id"]: r["embedding"] for r in before.collect()}[7] == [7.0, 1.0]
    rows = [r for r in rows if r[0] >= 150] + [(1000, [0.0, 3.0])]
    index_store.sync(spark, path, _version(spark, rows), embed)
    assert {r["id"]: r["embedding"] for r in index_store.read_index(spark, path).collect()} == dict(rows)
    index_store.sync(spark, path, _version(spark, rows).limit(0), embed)
    assert index_store.read_index(spark, path).count() == 0


def test_a_lost_race_is_done_again_on_top(spark, folder, monkeypatch):
    path, embed = f"{folder}/index", lambda rows: rows.select("id", "content_hash", F.col("v").alias("embedding"))
    index_store.sync(spark, path, _version(spark, [(1, [1.0])]), embed)
    publish, other = CommitLog.publish, _version(spark, [(1, [1.0]), (2, [2.0])])

    def late(self, number, content):
        monkeypatch.setattr(CommitLog, "publish", publish)
        index_store.sync(spark, path, other, embed)
        return publish(self, number, content)

    monkeypatch.setattr(CommitLog, "publish", late)
    assert index_store.sync(spark, path, _version(spark, [(1, [1.0]), (3, [3.0])]), embed) == 3
    assert sorted(r["id"] for r in index_store.read_index(spark, path).collect()) == [1, 3]


def test_each_prompt_is_asked_once_and_fails_alone(spark, folder):
    ledger = CommittedTable(spark, f"{folder}/ledger", inference.ANSWERS)
    calls = f"{folder}/calls"
    os.makedirs(calls)

    def model(prompts):
        if "bad" in prompts:
            raise ValueError("bad prompt")
        for p in prompts:
            open(f"{calls}/{uuid.uuid4().hex}", "w").write(p)
        return [p.upper() for p in prompts]

    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), ("bad", 5), ("", 6)], "p string, n int").withColumn("response", F.lit("old"))
    for batch in ("x", "y"):
        got = {r["n"]: r["response"] for r in inference.infer_once(df, F.col("p"), model, ledger, "m1", batch).collect()}
        assert got == {1: "A", 2: "A", 3: "B", 4: None, 5: None, 6: ""}
        assert sorted(open(f).read() for f in glob.glob(f"{calls}/*")) == ["", "a", "b"]
    inference.infer_once(df.where("n = 1"), F.col("p"), model, ledger, "m2", "z")
    assert len(glob.glob(f"{calls}/*")) == 4
    assert inference.infer_once(df.limit(0), F.col("p"), model, ledger, "m1", "w").count() == 0


def test_prompts_that_the_ledger_has_are_not_moved(spark, tmp_path, monkeypatch):
    """Keys say which prompts are open; whole prompts are written only for those."""
    written = []
    plain = inference.materialise
    monkeypatch.setattr(inference, "materialise", lambda df, label: written.append((label, df.columns)) or plain(df, label))
    ledger = CommittedTable(spark, str(tmp_path / "ledger"), inference.ANSWERS)
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None)], "n int, p string")
    ask = lambda rows, batch: inference.infer_once(rows, F.col("p"), lambda texts: [t * 2 for t in texts], ledger, "m", batch)
    for batch in ("x", "y"):
        assert {r["n"]: r["response"] for r in ask(df, batch).collect()} == {1: "aa", 2: "bb", 3: "aa", 4: None}
    assert [columns for _, columns in written] == [["prompt_key"], ["prompt_key", "prompt"], ["prompt_key"]]

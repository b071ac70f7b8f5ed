import os

import pytest
from pyspark.sql import functions as F

from rowloom.operators import conversations as conv
from rowloom.sources import tables
from rowloom.streaming import ingest


def test_csv_keeps_codes_as_text(spark, folder):
    path = os.path.join(folder, "franchises.csv")
    with open(path, "w") as out:
        out.write('id,name,zipcode\n1,"Alajuela, Costa",088532\n2,Paul\'s,V5T 3J7\n')
    tables.load_csv_table(spark, path, "id INT, name STRING, zipcode STRING", "franchises_t")
    want = [(1, "Alajuela, Costa", "088532"), (2, "Paul's", "V5T 3J7")]
    assert [tuple(r) for r in spark.table("franchises_t").orderBy("id").collect()] == want
    tables.load_csv_table(spark, path, "id INT, name STRING, zipcode STRING", "franchises_t")
    assert spark.table("franchises_t").count() == 2


def test_ensure_tables(spark):
    loads = []

    def load():
        loads.append(1)
        tables.save_table(spark.range(len(loads) - 1), "guarded_t")

    assert tables.ensure_tables(spark, ["guarded_t"], load)  # missing
    assert tables.ensure_tables(spark, ["guarded_t"], load)  # empty
    assert not tables.ensure_tables(spark, ["guarded_t"], load)  # filled
    assert tables.ensure_tables(spark, ["guarded_t", "other_t"], load)  # one of two missing
    assert len(loads) == 3


def test_schema(spark):
    before = spark.catalog.currentDatabase()
    try:
        assert tables.ensure_schema(spark, "demo_schema") == "spark_catalog.demo_schema"
        tables.save_table(spark.range(3), "t")
        assert tables.scan_named(spark, "spark_catalog", "demo_schema", "t").count() == 3
        tables.ensure_schema(spark, "demo_schema", reset=True)
        assert not spark.catalog.tableExists("t")
        for bad in ("hive_metastore", "nowhere"):
            with pytest.raises(ValueError):
                tables.ensure_schema(spark, "x", catalog=bad)
    finally:
        spark.catalog.setCurrentDatabase(before)


def test_chunk_table(spark):
    tables.create_chunk_table(spark, "chunks_t", embedding=True, properties={"purpose": "index"})
    tables.create_chunk_table(spark, "chunks_t", embedding=True)
    assert spark.table("chunks_t").dtypes == [("id", "bigint"), ("url", "string"), ("content", "string"), ("embedding", "array<float>")]
    shown = {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES chunks_t").collect()}
    assert shown["purpose"] == "index"


def test_session(spark):
    row = tables.session_info(spark).first()
    assert row["catalog"] == "spark_catalog" and row["user"]
    assert tables.preview(spark.range(10), 3, "id").count() == 3


def put(folder, name, text):
    with open(os.path.join(folder, name), "wb") as out:
        out.write(text)


def test_binary_ingest_and_restart(spark, folder):
    source, sink, checkpoint = (os.path.join(folder, x) for x in ("in", "out", "checkpoint"))
    os.mkdir(source)
    put(source, "a.pdf", b"one. two.")
    put(source, "b.txt", b"not asked for")
    run = lambda: ingest.append(ingest.binary_files(spark, source, "*.pdf", max_files=1), sink, checkpoint, "files")
    run()
    names = lambda: sorted(r[0].split("/")[-1] for r in ingest.read_table(spark, sink).select("path").collect())
    assert names() == ["a.pdf"]
    run()
    assert names() == ["a.pdf"]
    put(source, "c.pdf", b"three.")
    run()
    assert names() == ["a.pdf", "c.pdf"]
    content = {bytes(r[0]) for r in ingest.read_table(spark, sink).select("content").collect()}
    assert content == {b"one. two.", b"three."}


def test_files_to_chunks_as_a_stream(spark, folder):
    """Raw files, then texts and chunks, then web text from a table, into one sink; stream equals batch."""
    from rowloom.operators.chunking import file_texts, text_chunks

    source, raw, sink = (os.path.join(folder, x) for x in ("in", "raw", "sink"))
    os.mkdir(source)
    put(source, "a.pdf", b"one two|three")
    put(source, "bad.pdf", bytes([0xFF, 0xFE]))

    def chunks(files):
        texts = file_texts(files, lambda b: b.decode("utf-8"))
        return text_chunks(texts, lambda t: F.split(t, "[|]")).selectExpr("path AS url", "content")

    ingest.append(ingest.binary_files(spark, source, "*.pdf"), raw, os.path.join(folder, "c1"), "files")
    stored = ingest.read_table(spark, raw).drop("origin", "batch")
    stream = ingest.parquet_stream(spark, raw + "/origin=files", stored.schema).drop("batch")
    ingest.append(chunks(stream), sink, os.path.join(folder, "c2"), "files")
    assert ingest.table_stream(spark, "web_docs_t") is None
    tables.save_table(spark.createDataFrame([("u", "w x")], "url string, content string"), "web_docs_t")
    ingest.append(ingest.table_stream(spark, "web_docs_t"), sink, os.path.join(folder, "c3"), "web")
    found = sorted(r["content"] for r in ingest.read_table(spark, sink).collect())
    assert found == ["one two", "three", "w x"]
    assert sorted(r["content"] for r in chunks(stored).collect()) == ["one two", "three"]


def test_replayed_batch_counts_once(spark, folder):
    """A batch written but not recorded is written again, into the same place."""
    source, sink, checkpoint = (os.path.join(folder, x) for x in ("in", "out", "checkpoint"))
    spark.range(10).write.parquet(source)
    stream = lambda: ingest.parquet_stream(spark, source, spark.range(1).schema)
    ingest.append(stream(), sink, checkpoint, "a")
    # Without its commit file the batch looks unfinished.
    commits = os.path.join(checkpoint, "commits")
    again = os.path.join(folder, "again")
    import shutil

    shutil.copytree(checkpoint, again, ignore=lambda d, names: names if d == commits else [])
    ingest.append(stream(), sink, again, "a")
    assert ingest.read_table(spark, sink).count() == 10


def test_stream_into_named_table(spark, folder):
    source = os.path.join(folder, "in")
    spark.range(10).write.parquet(source)
    for _ in range(2):
        stream = ingest.parquet_stream(spark, source, spark.range(1).schema, max_files=2)
        ingest.append_to_table(stream, "streamed_t", os.path.join(folder, "checkpoint"))
        assert spark.table("streamed_t").count() == 10


def log(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a\nb"), (2, 0, "user", "x"), (3, 0, "assistant", "y")]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_route(spark):
    calls = F.when(F.col("conv_id") == 1, F.array(F.lit("f"))).when(F.col("conv_id") == 2, F.array().cast("array<string>"))
    assert {tuple(r) for r in conv.route(log(spark), calls).collect()} == {(1, "continue"), (2, "end"), (3, "end")}


def test_system_message(spark):
    for none in (None, ""):
        assert conv.with_system_message(log(spark), none).count() == 4
    rows = conv.with_system_message(log(spark), "S").orderBy("conv_id", "turn").collect()
    assert len(rows) == 7 and tuple(rows[0]) == (1, -1, "system", "S")


def test_assemble_in_parts(spark):
    rows = [(1, t, "user", str(t)) for t in range(25)] + [(2, 0, "user", "x")]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = conv.assemble(messages, max_turns=10)
    assert {(r["conv_id"], r["part"]): len(r["messages"]) for r in whole.collect()} == {(1, 0): 10, (1, 1): 10, (1, 2): 5, (2, 0): 1}
    assert sorted(tuple(r) for r in conv.explode_messages(whole).collect()) == rows


def test_system_message_is_first_in_the_same_part(spark):
    whole = conv.assemble(conv.with_system_message(log(spark), "S")).collect()
    assert {r["part"] for r in whole} == {0}
    assert all(r["messages"][0]["role"] == "system" for r in whole)


def test_parts_of_any_size_hold_the_same_whole(spark):
    messages = conv.with_system_message(spark.range(25).selectExpr("1L AS conv_id", "int(id) AS turn", "'user' AS role", "string(id) AS text"), "S")
    links = F.array(F.lit("u"))

    def whole(max_turns):
        parts = sorted(conv.transcript(conv.assemble(messages, max_turns), links).select("part", "transcript").collect())
        return len(parts), "".join(r["transcript"] for r in parts)

    assert whole(1000)[0] == 1 and whole(10)[0] == 3
    assert whole(10)[1] == whole(1000)[1]


def test_transcript(spark):
    assembled = conv.assemble(log(spark)).where("conv_id = 1")
    plain = conv.transcript(assembled).first()["transcript"]
    assert plain == '<div class="user">q</div><div class="assistant">a<br/>b</div>'
    linked = conv.transcript(assembled, F.array(F.lit("u"))).first()["transcript"]
    assert linked == plain + '<strong>Sources:</strong><ul><li><a href="u">u</a></li></ul>'
    assert conv.transcript(assembled, F.array().cast("array<string>")).first()["transcript"] == plain


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from rowloom import session

    conf = {"spark.master": "spark://host:7077"}
    cluster = SimpleNamespace(conf=SimpleNamespace(get=conf.get))
    with pytest.raises(RuntimeError):
        session.scratch_path(cluster, "x")
    conf["spark.checkpoint.dir"] = "hdfs://shared/"
    assert session.scratch_path(cluster, "x").startswith("hdfs://shared/rowloom-x-")

"""Streams run until caught up; each must give what the batch form gives."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowloom.operators import chunking
from rowloom.plans.documents import WINDOWS_SQL, windows
from rowloom.plans.registry import query, table
from rowloom.plans.vectors import embed
from rowloom.session import materialise, scratch_path, spread
from rowloom.sources import web
from rowloom.streaming import ingest


def _stream(spark, folder, name):
    # A pattern, since a stream's plain path must be a folder and a table may be one file.
    return ingest.parquet_stream(spark, f"{folder}/{name}.parque[t]", table(spark, folder, name).schema)


def _embedded(docs):
    return ingest.chunk_and_embed(docs, windows, lambda chunks: embed(chunks, 16, "content"))


@query(f"SELECT doc_id, pos, n_words, md5(content) AS h, 16 AS dim FROM ({WINDOWS_SQL})")
def stream_chunk_embed(spark, folder):
    """Documents as a stream, chunked, embedded and appended."""
    sink, checkpoint = scratch_path(spark, "chunks"), scratch_path(spark, "chunks-checkpoint")
    docs = _stream(spark, folder, "documents").select("doc_id", "text")
    ingest.append(docs, sink, checkpoint, "documents", lambda batch: _embedded(spread(batch, "doc_id")))
    return ingest.read_table(spark, sink).select(
        "doc_id", "pos", "n_words", F.md5("content").alias("h"), F.size("embedding").alias("dim")
    )


# Rows in each file that the next query writes: a file's bytes are one value of a row.
_FILE_ROWS = 1_000


@query("SELECT doc_id, length(text) AS n, md5(text) AS h FROM documents")
def stream_binary_ingest(spark, folder):
    """The documents written as files, their bytes ingested by a binary stream, decoded and taken apart again."""
    files, sink, checkpoint = (scratch_path(spark, label) for label in ("files", "files-table", "files-checkpoint"))
    docs = table(spark, folder, "documents").select("doc_id", "text")
    docs.write.option("maxRecordsPerFile", _FILE_ROWS).json(files)
    read = lambda batch: chunking.file_texts(batch.select("path", "length", "content"), bytes.decode)
    ingest.append(ingest.binary_files(spark, files, "*.json"), sink, checkpoint, "files", read)
    lines = ingest.read_table(spark, sink).select(F.explode(F.split("text", "\n")).alias("line")).where("line <> ''")
    rows = lines.select(F.from_json("line", "doc_id BIGINT, text STRING").alias("row")).select("row.*")
    return rows.select("doc_id", F.length("text").cast("long").alias("n"), F.md5("text").alias("h"))


@query(
    """SELECT 'documents' AS origin, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS total_chars FROM documents
       UNION ALL SELECT 'pages', count(*), CAST(sum(length(html)) AS BIGINT) FROM pages"""
)
def stream_two_sources(spark, folder):
    """Two streams, one after the other, into one table."""
    sink = scratch_path(spark, "two")
    docs = _stream(spark, folder, "documents").select(
        F.concat(F.lit("doc/"), F.col("doc_id")).alias("url"), F.col("text").alias("content")
    )
    pages = _stream(spark, folder, "pages").select("url", F.col("html").alias("content"))
    ingest.append(docs, sink, scratch_path(spark, "two-documents"), "documents")
    ingest.append(pages, sink, scratch_path(spark, "two-pages"), "pages")
    return (
        ingest.read_table(spark, sink)
        .groupBy("origin")
        .agg(F.count("*").alias("n"), F.sum(F.length("content")).alias("total_chars"))
    )


@query("SELECT run, n FROM (SELECT count(*) AS n FROM documents), (SELECT unnest([1, 2]) AS run)")
def stream_restart_noop(spark, folder):
    """Rows in the table after a run, and after a second one with nothing new."""
    sink, checkpoint = scratch_path(spark, "again"), scratch_path(spark, "again-checkpoint")
    counts = []
    for run in (1, 2):
        ingest.append(_stream(spark, folder, "documents").select("doc_id"), sink, checkpoint, "documents")
        # Counted now, before the next run may add to the table.
        counts.append(materialise(ingest.read_table(spark, sink).agg(F.lit(run).alias("run"), F.count("*").alias("n")), "counts"))
    return counts[0].unionByName(counts[1])


@query(
    """SELECT page_id, length(regexp_extract(html, '(?is)<article(?:\\s[^>]*)?>(.*?)</article>', 1)) > 0 AS found FROM pages"""
)
def stream_articles(spark, folder):
    """Pages as a stream, articles taken out by the batch function."""
    sink, checkpoint = scratch_path(spark, "articles"), scratch_path(spark, "articles-checkpoint")
    articles = lambda batch: web.extract_articles(spread(batch, "page_id"))
    ingest.append(_stream(spark, folder, "pages"), sink, checkpoint, "pages", articles)
    return ingest.read_table(spark, sink).select("page_id", (F.length("text") > 0).alias("found"))

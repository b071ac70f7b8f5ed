"""Documents to chunk rows."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.functions import text as text_fn
from rowloom.operators.groups import turn_part
from rowloom.session import materialise
from rowloom.sources.commits import CommittedTable


def window_chunks(
    docs: DataFrame, text: str = "text", size: int = 1000, overlap: int = 50, min_tokens: int = 20
) -> DataFrame:
    """One row per word window: the other columns and ``pos, n_words, content``."""
    others = [c for c in docs.columns if c != text]
    windows = text_fn.word_windows(text_fn.words(F.col(text)), size, overlap, min_tokens)
    return docs.where(F.col(text).isNotNull()).select(*others, F.inline(windows))


def text_chunks(docs: DataFrame, chunks: Callable[[Column], Column], text: str = "text") -> DataFrame:
    """One row per element of ``chunks(text)``: the other columns and ``pos, content``.

    ``chunks`` is any rule from text to ``array<string>``: a column expression of
    ``functions.text`` or a Python splitter made by ``inference.chunk_function``.
    """
    others = [c for c in docs.columns if c != text]
    return docs.where(F.col(text).isNotNull()).select(
        *others, F.posexplode(chunks(F.col(text))).alias("pos", "content")
    )


def file_texts(files: DataFrame, decode: Callable[[bytes], str], content: str = "content", out: str = "text") -> DataFrame:
    """Replace the bytes of each file by its text; NULL, with a warning in the log, where ``decode`` fails.

    Spark bounds a batch by its bytes as well as its rows, so large files come few at a time.
    """

    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def one(raw):
            if raw is None:
                return None
            try:
                return decode(raw)
            except Exception as error:  # an unreadable file is a missing text
                warnings.warn(f"a file could not be read: {error}", stacklevel=2)
                return None

        for batch in batches:
            yield pa.array([one(raw) for raw in batch.to_pylist()], pa.string())

    others = [c for c in files.columns if c not in (content, out)]
    return files.select(*others, texts.asNondeterministic()(content).alias(out))


def with_chunk_id(chunks: DataFrame, url: str = "url", pos: str = "pos", out: str = "id") -> DataFrame:
    """Add a 128-bit key in hex that depends on ``(url, pos)`` alone, so a re-run gives each chunk the same key.

    A NULL address counts as empty. Index upkeep takes such keys as they are; chunk tables and searches take the numbers
    of ``with_chunk_number``.
    """
    return chunks.withColumn(out, F.md5(F.concat_ws("\n", F.coalesce(F.col(url), F.lit("")), F.col(pos))))


# What a table of given numbers holds.
NUMBERS = "url STRING, pos BIGINT, id BIGINT"


def with_chunk_number(chunks: DataFrame, numbers: CommittedTable, url: str = "url", pos: str = "pos", out: str = "id") -> DataFrame:
    """Add a dense 64-bit number that stays with ``(url, pos)``: the key of chunk tables, indexes and searches.

    ``numbers`` (schema ``NUMBERS``) keeps what was given. Known places keep their number; new ones are ranged by address and position over
    tasks, numbered in each, and shifted by the sizes of the slices before and the highest number given so far. Of two
    runs at once, the one that commits second numbers its new places again. A NULL address counts as empty, a NULL position as -1;
    rows of one place share its number.
    """
    place = [F.coalesce(F.col(url).cast("string"), F.lit("")).alias("_url"), F.coalesce(F.col(pos).cast("bigint"), F.lit(-1)).alias("_pos")]
    keys = chunks.select(*place).distinct()
    while True:
        last, commits = numbers.log.last_number(), numbers.log.commits()
        high = commits[-1][1]["high"] if commits else 0
        known = numbers.read().select(F.col("url").alias("_url"), F.col("pos").alias("_pos"), "id")
        new = keys.join(known, ["_url", "_pos"], "left_anti")
        # Written, so that a row keeps its slice when a task is repeated.
        ranged = materialise(new.repartitionByRange("_url", "_pos").withColumn("_slice", F.spark_partition_id()), "new-places")
        sizes = ranged.groupBy("_slice").agg(F.count("*").alias("_n"))
        # One row per slice.
        before = F.sum("_n").over(Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))
        starts = materialise(sizes.select("_slice", "_n", F.coalesce(before, F.lit(0)).alias("_before")), "slices")
        count = starts.agg(F.sum("_n")).first()[0] or 0
        if count == 0:
            break
        inside = F.row_number().over(Window.partitionBy("_slice").orderBy("_url", "_pos"))
        given = ranged.withColumn("_at", inside).join(F.broadcast(starts), "_slice")
        given = given.select(F.col("_url").alias("url"), F.col("_pos").alias("pos"), (F.col("_before") + F.col("_at") + high).alias("id"))
        if numbers.append(given, expected=last, high=high + count):
            known = numbers.read().select(F.col("url").alias("_url"), F.col("pos").alias("_pos"), "id")
            break
    named = known.withColumnRenamed("id", "_number")
    joined = chunks.select("*", *place).join(named, ["_url", "_pos"])
    return joined.select(*[F.col(f"`{c}`") for c in chunks.columns if c != out], F.col("_number").alias(out))


def assemble_pages(pages: DataFrame, doc: str, page: str, text: str, max_pages: int = 10_000) -> DataFrame:
    """Pages of a document joined by newline in order of page: ``doc, part, n_pages, text``.

    ``page`` counts up from 0 and is unique in a document. A document of more than
    ``max_pages`` pages comes in parts of that many, so no task gathers more. A page that could
    not be read (NULL) is left out; a part without a readable page is NULL. Parts count from 0 in order of page.
    """
    item = F.struct(F.col(page).alias("page"), F.col(text).alias("text"))
    return (
        pages.groupBy(doc, turn_part(F.col(page), max_pages).alias("part"))
        .agg(F.count("*").alias("n_pages"), F.array_sort(F.collect_list(F.when(F.col(text).isNotNull(), item))).alias("_items"))
        .select(
            doc,
            "part",
            "n_pages",
            F.when(F.size("_items") > 0, F.array_join(F.transform("_items", lambda x: x["text"]), "\n")).alias("text"),
        )
    )

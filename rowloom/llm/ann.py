"""Nearest neighbours by multi-index hashing of learned binary codes."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.common import small, uniform
from rowloom.session import materialise

BITS = 64
# Rows on which rotation and radius are fitted, about; all rows are indexed.
SAMPLE_ROWS = 20_000
# Rows of that sample whose exact neighbours in it set the radius, and the share of these that must be within.
SAMPLE_QUERIES = 300
SAMPLE_RECALL = 0.97
# Rows of the index, and queries, that one task compares at a time, about.
SHARD_ROWS = 8_192
QUERY_ROWS = 4_096


@dataclass(frozen=True)
class Coder:
    """Learned codes: a vector's bits are the signs of its centred, rotated components.

    ``radius`` is the Hamming distance within which neighbours are looked for.
    """

    centre: np.ndarray
    planes: np.ndarray
    radius: int

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        bits = (vectors - self.centre) @ self.planes > 0
        return (bits.astype(np.uint64) << np.arange(BITS, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def fit(sample: np.ndarray, k: int, seed: int = 3) -> Coder:
    """Fit rotations so that components lie far from 0, as iterative quantisation does, and the radius.

    Narrower vectors than ``BITS`` get several rotations, wider ones their main components. The radius
    is the least that holds ``SAMPLE_RECALL`` of the k nearest of some sample rows within the sample;
    in the whole table neighbours are nearer.
    """
    rng = np.random.default_rng(seed)
    centre = sample.mean(axis=0)
    centred = sample - centre
    _, _, axes = np.linalg.svd(centred.T @ centred)
    width = min(sample.shape[1], BITS)
    main = centred @ axes[:width].T
    planes: list[np.ndarray] = []
    while sum(p.shape[1] for p in planes) < BITS:
        turn, _ = np.linalg.qr(rng.normal(size=(width, width)))
        for _ in range(40):
            left, _, right = np.linalg.svd(np.sign(main @ turn).T @ main)
            turn = (left @ right).T
        planes.append(axes[:width].T @ turn)
    coder = Coder(centre, np.concatenate(planes, axis=1)[:, :BITS], BITS)
    queries = rng.permutation(len(sample))[:SAMPLE_QUERIES]
    codes = coder.codes(sample)
    apart = []
    for q in queries:
        distance = ((sample - sample[q]) ** 2).sum(axis=1)
        distance[q] = np.inf
        near = np.argsort(distance, kind="stable")[: min(k, len(sample) - 1)]
        apart.extend(np.bitwise_count(codes[near] ^ codes[q]).tolist())
    radius = int(np.quantile(apart, SAMPLE_RECALL, method="higher")) if apart and len(sample) > 10 * k else BITS
    return Coder(centre, coder.planes, radius)


def _usable(rows: pa.RecordBatch, width: int, kind: str) -> Iterator[tuple[list, np.ndarray]]:
    """Ids and vectors of the rows that take part; see ``search``."""
    ids, vectors = [], []
    for key, vector in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
        if vector is not None and len(vector) == width and None not in vector and key is not None:
            ids.append(key)
            vectors.append(vector)
    if ids:
        matrix = np.array(vectors, dtype=kind)
        good = np.isfinite(matrix).all(axis=1) & (matrix != 0).any(axis=1)
        yield [i for i, g in zip(ids, good.tolist(), strict=True) if g], matrix[good]


def encode(rows: DataFrame, coder: Coder, kind: str) -> DataFrame:
    """id, code and vector (bytes of ``kind``) of the rows that take part."""
    width = len(coder.centre)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, matrix in _usable(batch, width, kind):
                codes = coder.codes(matrix.astype(np.float64)).view(np.int64)
                columns = [pa.array(ids, pa.int64()), pa.array(codes), pa.array([v.tobytes() for v in matrix], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "code", "vector"])

    return rows.mapInArrow(run, "id bigint, code bigint, vector binary")


def _parts(count: int) -> list[tuple[int, int]]:
    """Offset and width of ``count`` substrings of a code."""
    ends = np.linspace(0, BITS, count + 1).round().astype(int).tolist()
    return [(a, b - a) for a, b in zip(ends, ends[1:], strict=False)]


def _compare(found_by: list[tuple[int, int]], within: int, radius: int, k: int, kind: str):
    """Compares queries with the index rows of one bucket range of one substring."""

    def run(key: tuple, index: pa.Table, queries: pa.Table) -> pa.Table:
        part = key[0].as_py()
        ids, codes = index.column("id").to_numpy(), index.column("code").to_numpy().view(np.uint64)
        vectors = np.frombuffer(b"".join(index.column("vector").to_pylist()), dtype=kind).reshape(len(ids), -1).astype(np.float64) if len(ids) else None
        asked = queries.column("id").to_numpy()
        asked_codes = queries.column("code").to_numpy().view(np.uint64)
        out_q, out_i, out_s = [], [], []
        for q, code, raw in zip(asked.tolist(), asked_codes, queries.column("vector").to_pylist(), strict=True):
            if not len(ids):
                break
            apart = codes ^ code
            near = np.bitwise_count(apart) <= radius
            for j, (offset, width) in enumerate(found_by[: part + 1]):
                sub = np.bitwise_count((apart >> np.uint64(offset)) & np.uint64((1 << width) - 1)) <= within
                # A row is reranked where the first of its matching substrings is looked up, so only once.
                near &= sub if j == part else ~sub
            at = np.flatnonzero(near & (ids != q))
            if not len(at):
                continue
            score = np.sqrt(((vectors[at] - np.frombuffer(raw, dtype=kind).astype(np.float64)) ** 2).sum(axis=1))
            if len(at) > k:
                close = np.flatnonzero(score <= np.partition(score, k - 1)[k - 1])
                at, score = at[close], score[close]
            order = np.lexsort((ids[at], score))[:k]
            out_q.extend([q] * len(order))
            out_i.extend(ids[at[order]].tolist())
            out_s.extend(score[order].tolist())
        return pa.table({"query_id": pa.array(out_q, pa.int64()), "vec_id": pa.array(out_i, pa.int64()), "score": pa.array(out_s, pa.float64())})

    return run


def _probe(index: DataFrame, queries: DataFrame, rows: int, radius: int, k: int, kind: str) -> DataFrame:
    """The k nearest of each query within each looked-up part of the index.

    Codes within ``radius`` agree up to floor(radius / m) bits in at least one of m substrings, so
    for each substring a query looks up the buckets whose value is that near. Buckets lie in ranges
    of a common beginning, about ``SHARD_ROWS`` each; larger ones, as copies share their bucket, are cut into pieces,
    and so are the queries of a range, which then meets each piece with each piece.
    """
    length = min(max(round(math.log2(max(rows, 2))), 8), 16)
    parts = _parts(BITS // length)
    within = radius // len(parts)
    ahead = min(max(math.ceil(math.log2(max(rows, 1) / SHARD_ROWS)), 0), min(w for _, w in parts))

    def begins(code: Column) -> Column:
        """Per substring its number and its value's beginning."""
        values = []
        for j, (offset, width) in enumerate(parts):
            value = F.shiftrightunsigned(code, offset).bitwiseAND(F.lit((1 << width) - 1))
            values.append(F.struct(F.lit(j).alias("part"), F.shiftright(value, width - ahead).cast("int").alias("head")))
        return F.inline(F.array(*values))

    held = index.select("*", begins(F.col("code")))
    every = F.sequence(F.lit(0), F.lit((1 << ahead) - 1))
    looked = queries.select("*", begins(F.col("code")))
    looked = looked.withColumn("other", F.explode(F.filter(every, lambda p: F.bit_count(p.bitwiseXOR(F.col("head"))) <= within)))
    looked = looked.drop("head").withColumnRenamed("other", "head")
    sizes = held.groupBy("part", "head").agg(F.ceil(F.count("*") / SHARD_ROWS).cast("int").alias("pieces"))
    asked = looked.groupBy("part", "head").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("blocks"))
    ranges = small(sizes.join(asked, ["part", "head"]), "code-ranges")
    cell = ["part", "head", "piece", "block"]
    held = held.join(ranges, ["part", "head"]).withColumn("piece", F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int"))
    held = held.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(*cell, "id", "code", "vector")
    looked = looked.join(ranges, ["part", "head"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    looked = looked.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).select(*cell, "id", "code", "vector")
    found = held.groupBy(*cell).cogroup(looked.groupBy(*cell)).applyInArrow(
        _compare(parts, within, radius, k, kind), "query_id bigint, vec_id bigint, score double"
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(vectors: DataFrame, asked: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding", seed: int = 3, radius: int | None = None) -> DataFrame:
    """The k nearest rows found for each row for which ``asked`` holds: query_id, rank, vec_id, score.

    Nearness is Euclidean distance in double precision, ties go to the smaller id; a row is not its own
    neighbour. All rows are candidates by their codes; those within the fitted radius are
    compared exactly, so what is returned is exact and only recall is not certain. Queries that find
    fewer than k rows within it are asked again without one. ``radius`` replaces the fitted one; with ``BITS`` every row is
    compared, and the result is the exact one.

    Rows without id, and vectors that are null, of another width than most of the sample, all zero, or with null or
    non-finite entries take no part. Rows with equal id and vector count once; an id with several vectors is a candidate with each. Fewer
    candidates than k give fewer rows; an empty table gives an empty result.
    """
    kind = "<f4" if "array<float>" in vectors.schema[vector].dataType.simpleString() else "<f8"
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("id"), F.col(vector).alias("vector"), asked.alias("asked"))
    rate = SAMPLE_ROWS / max(rows.count(), 1)
    # Rows that take no part must not fill the sample.
    fit_for = F.col("id").isNotNull() & F.exists("vector", lambda x: x != 0) & F.forall("vector", lambda x: F.abs(x) < float("inf"))
    sample = rows.where(fit_for & (uniform(F.lit(seed), "id", "vector") < rate)).select("id", "vector").limit(2 * SAMPLE_ROWS).toArrow()
    widths = Counter(len(v) for v in sample.column("vector").to_pylist() if v)
    empty = "query_id bigint, rank int, vec_id bigint, score double"
    if not widths:
        return vectors.sparkSession.createDataFrame([], empty)
    width = min(widths, key=lambda w: (-widths[w], w))
    used = [m for b in sample.combine_chunks().to_batches() for _, m in _usable(b, width, kind)]
    if not sum(len(m) for m in used):
        return vectors.sparkSession.createDataFrame([], empty)
    coder = fit(np.concatenate(used).astype(np.float64), k, seed)
    radius = coder.radius if radius is None else radius
    index = materialise(encode(rows.select("id", "vector"), coder, kind), "codes")
    queries = materialise(rows.where("asked").select(F.col("id").alias("asked_id")).distinct().join(index, F.col("asked_id") == F.col("id")).select("id", "code", "vector").dropDuplicates(["id"]), "queries")
    total = index.count()
    first = materialise(_probe(index, queries, total, radius, k, kind), "neighbours")
    enough = first.groupBy(F.col("query_id").alias("id")).count().where(F.col("count") >= min(k, max(total - 1, 0)))
    short = materialise(queries.join(enough, "id", "left_anti"), "queries")
    if short.limit(1).count():
        again = _probe(index, short, total, BITS, k, kind)
        first = first.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(again)
    return first.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

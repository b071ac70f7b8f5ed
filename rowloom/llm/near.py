"""Near duplicates by DartMinHash signatures, bands and exact comparison."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import connected, empty_if_null, free_name, give_back, let_go
from rowloom.session import materialise

SHINGLE_WORDS = 5
SIMILARITY = 0.8
# A pair at the similarity bound shares a band with probability 1 - (1 - 0.8 ** 5) ** 25, over 0.9999.
BANDS, BAND_ROWS = 25, 5
COORDINATES = BANDS * BAND_ROWS
# The first interval of ranks, and the widest interval of ranks or weights that darts are thrown into at once.
FIRST_RANKS, WIDEST = 0.125, 64.0
# Documents whose darts are thrown together.
TOGETHER = 64
# Members of an open bucket that are compared at a time, and the share of equal coordinates from which a pair is compared exactly:
# about four standard deviations below the similarity bound.
PIECE_ROWS = 512
LEAST_AGREEMENT = 0.66

# Most addresses, of 16 bytes each, that are sent to every executor.
BROADCAST_TEXTS = 500_000

_MIX_A, _MIX_B, _STEP = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit sways every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_A
    x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


def _cell_hash(*numbers: int) -> np.uint64:
    found = np.zeros(1, np.uint64)
    for n in numbers:
        found = _mix(found + _STEP * np.array([n + 1], np.uint64))
    return found[0]


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def shingles(text: str, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct runs of ``size`` words, and how often each occurs.

    Words are what blanks separate. A text of fewer words is one shingle of all of them; one without
    words has none.
    """
    words = text.split()
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    width = min(size, len(words))
    runs = np.zeros(len(words) - width + 1, np.uint64) + np.uint64(width)
    for i in range(width):
        runs = _mix(runs * _STEP + hashed[i : len(hashed) - width + 1 + i])
    return np.unique(runs, return_counts=True)


@cache
def _poisson(mean: float) -> np.ndarray:
    """Cumulative probabilities of 0, 1, 2 ... darts."""
    terms, n, total = [math.exp(-mean)], 0, math.exp(-mean)
    while total < 1 - 1e-15 and n < 8 * mean + 64:
        n += 1
        terms.append(terms[-1] * mean / n)
        total += terms[-1]
    return np.cumsum(terms)


def _intervals(first: float, end: float) -> list[tuple[float, float]]:
    """[0, first), then doubling widths up to ``WIDEST``, as far as ``end``."""
    at, found = first, [(0.0, first)]
    while at < end:
        width = min(at, WIDEST)
        found.append((at, at + width))
        at += width
    return found


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], coordinates: int = COORDINATES, seed: int = 1) -> np.ndarray:
    """One row of dart hashes per weighted set; two agree in a coordinate with the probability of their weighted Jaccard similarity.

    The plane of weights and ranks of each element is hit by hashed darts, one per unit of area on
    average; each has a coordinate. How many fall into a cell and where depends on element and cell alone, so
    sets see the same darts. Those below an element's weight are the set's; per coordinate the one of
    least rank counts. Only ranks below a bound are looked at, chosen so that about
    n log n + 2 n darts are the set's; it is doubled for sets in which a coordinate stays empty.
    """
    result = np.zeros((len(sets), coordinates), np.uint64)
    todo = [i for i, (elements, _) in enumerate(sets) if len(elements)]
    goal = coordinates * (math.log(coordinates) + 2)
    bound = {i: goal / float(sets[i][1].sum()) for i in todo}
    while todo:
        owner = np.repeat(np.arange(len(todo)), [len(sets[i][0]) for i in todo])
        element = np.concatenate([sets[i][0] for i in todo])
        weight = np.concatenate([sets[i][1] for i in todo]).astype(np.float64)
        limits = np.array([bound[i] for i in todo])
        limit = limits[owner]
        owners, places, ranks, darts = [], [], [], []
        for v, (w_lo, w_hi) in enumerate(_intervals(1.0, weight.max())):
            heavy = np.flatnonzero(weight > w_lo) if w_lo else np.arange(len(weight))
            if not len(heavy):
                continue
            for r, (r_lo, r_hi) in enumerate(_intervals(FIRST_RANKS, limits.max())):
                at = heavy[limit[heavy] > r_lo] if r_lo else heavy
                if not len(at):
                    continue
                start = _mix(element[at] + _cell_hash(seed, v, r))
                many = np.searchsorted(_poisson((w_hi - w_lo) * (r_hi - r_lo)), _unit(start), side="right")
                total = int(many.sum())
                if not total:
                    continue
                of = np.repeat(np.arange(len(at)), many)
                nth = np.arange(total) - np.repeat(np.cumsum(many) - many, many)
                dart = _mix(start[of] + _STEP * (nth.astype(np.uint64) + np.uint64(1)))
                rank = r_lo + (r_hi - r_lo) * _unit(dart)
                second = _mix(dart + _STEP)
                mine = (rank < limit[at[of]]) & (w_lo + (w_hi - w_lo) * _unit(second) < weight[at[of]])
                third = _mix(second[mine] + _STEP)
                owners.append(owner[at[of[mine]]])
                places.append((third % np.uint64(coordinates)).astype(np.int64))
                ranks.append(rank[mine])
                darts.append(dart[mine])
        cell = np.concatenate(owners) * coordinates + np.concatenate(places)
        rank, dart = np.concatenate(ranks), np.concatenate(darts)
        least = np.full(len(todo) * coordinates, np.inf)
        np.minimum.at(least, cell, rank)
        first = rank == least[cell]
        found = np.zeros(len(todo) * coordinates, np.uint64)
        found[cell[first]] = dart[first]
        found, filled = found.reshape(len(todo), -1), np.isfinite(least).reshape(len(todo), -1).all(axis=1)
        result[np.array(todo)[filled]] = found[filled]
        todo = [i for i, full in zip(todo, filled.tolist(), strict=True) if not full]
        for i in todo:
            bound[i] *= 2
    return result


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two weighted sets with sorted elements; 0 if either is empty."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    same = b[0][at] == a[0]
    shared = np.minimum(a[1][same], b[1][at[same]]).sum()
    return float(shared / (a[1].sum() + b[1].sum() - shared))


def address(text: Column) -> Column:
    """The first 128 bits of a text's SHA-256."""
    return F.substring(F.unhex(F.sha2(empty_if_null(text), 256)), 1, 16)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Address, band hashes and short coordinates of each text; equal texts of a stretch are signed once."""
    let_go()
    for batch in batches:
        for at in range(0, batch.num_rows, TOGETHER):
            part = batch.slice(at, TOGETHER)
            texts = [t or "" for t in part.column(1).to_pylist()]
            distinct = list(dict.fromkeys(texts))
            sets = [shingles(t) for t in distinct]
            signed = signatures(sets)
            bands = np.zeros((len(distinct), BANDS), np.uint64)
            for i in range(BAND_ROWS):
                bands = _mix(bands * _STEP + signed[:, i::BAND_ROWS])
            bands = _mix(bands + np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX_A).view(np.int64)
            short = (signed >> np.uint64(40)).astype("<u2")
            rows = {}
            for text, elements, band, coordinates in zip(distinct, sets, bands, short, strict=True):
                key = hashlib.sha256(text.encode()).digest()[:16]
                rows[text] = (key, band.tolist() if len(elements[0]) else [], coordinates.tobytes())
            keys, band_rows, coordinates = zip(*(rows[t] for t in texts), strict=True)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(keys, pa.binary()), pa.array(band_rows, pa.list_(pa.int64())), pa.array(coordinates, pa.binary())],
                names=["doc_id", "address", "bands", "coordinates"],
            )
    give_back()


def signed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_sign, "doc_id bigint, address binary, bands array<bigint>, coordinates binary")


def _compare_texts(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """The pairs whose texts are at least that similar. A text met again right away is not cut anew."""
    let_go()
    last: tuple = (None, None)
    for batch in batches:
        keep = []
        for key, a, b in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3), strict=True):
            if last[0] != key:
                last = (key, shingles(a.as_py()))
            keep.append(similarity(last[1], shingles(b.as_py())) >= least)
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _texts(addresses: DataFrame, texts: DataFrame) -> DataFrame:
    """Each of the distinct addresses with its text; other texts are not moved if few are asked for."""
    needed = materialise(addresses, "near-texts")
    if needed.count() <= BROADCAST_TEXTS:
        needed = F.broadcast(needed)
    return materialise(texts.join(needed, "address", "left_semi").dropDuplicates(["address"]), "near-texts")


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The distinct pairs of addresses (a, b) whose texts are at least ``least`` similar, by all their shingles."""
    pairs = materialise(pairs.distinct(), "near-pairs")
    ends = pairs.select(F.col("a").alias("address")).unionByName(pairs.select(F.col("b").alias("address")))
    some = _texts(ends.distinct(), texts)
    left = some.select(F.col("address").alias("a"), F.col("text").alias("a_text"))
    right = some.select(F.col("address").alias("b"), F.col("text").alias("b_text"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "a_text", "b_text")
    return materialise(both.mapInArrow(lambda batches: _compare_texts(batches, least), "a binary, b binary"), "near-links")


def _linking(agreement: float, least: float):
    """In a piece of a bucket, or between two pieces: links between members of different parts, until they join all they can.

    Pairs whose coordinates mostly agree are compared by all their shingles, unless links found here
    join them already.
    """

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        let_go()
        i, j = key[1].as_py(), key[2].as_py()
        piece = rows.column("piece").to_numpy()
        ids, parts, texts = (rows.column(c).to_pylist() for c in ("address", "part", "text"))
        number = {p: n for n, p in enumerate(dict.fromkeys(parts))}
        part = np.array([number[p] for p in parts])
        joined = list(range(len(number)))
        signed_rows = np.frombuffer(b"".join(rows.column("coordinates").to_pylist()), dtype="<u2").reshape(len(ids), -1)
        ones, others = np.flatnonzero(piece == i), np.flatnonzero(piece == j)
        cut = cache(lambda n: shingles(texts[n]))

        def root(n: int) -> int:
            while joined[n] != n:
                joined[n] = joined[joined[n]]
                n = joined[n]
            return n

        a, b = [], []
        for x in ones.tolist():
            rest = others[others > x] if i == j else others
            rest = rest[part[rest] != part[x]]
            if not len(rest):
                continue
            agree = (signed_rows[rest] == signed_rows[x]).mean(axis=1)
            order = np.argsort(-agree, kind="stable")
            for y in rest[order[agree[order] >= agreement]].tolist():
                rx, ry = root(part[x]), root(part[y])
                if rx != ry and similarity(cut(x), cut(y)) >= least:
                    joined[rx] = ry
                    a.append(ids[x])
                    b.append(ids[y])
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return run


def links(rows: DataFrame, texts: DataFrame, least: float = SIMILARITY, agreement: float = LEAST_AGREEMENT) -> DataFrame:
    """Links (a, b) between different texts, enough to join all that a chain of pairs of at least ``least`` joins.

    ``rows`` are distinct signed texts. Texts that share a band hash are in a bucket. First each
    bucket's members are compared with one of them, its leader: the one that shares the most buckets with the most
    others, as the original of a family of copies does. That is one pair per member and no more. Linked texts form
    parts. What may be missing are links between members that are not the leader, in buckets that
    hold several parts: there all members of different parts whose coordinates mostly agree are compared,
    ``PIECE_ROWS`` by ``PIECE_ROWS`` at a time, and only the links that join parts come out. No bucket is
    dropped or capped. An ``agreement`` of 0 compares all members of different parts there by their shingles.
    """
    members = rows.select("address", F.explode("bands").alias("bucket"))
    crowded = members.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    crowd = materialise(members.join(crowded, "bucket"), "near-buckets")
    degrees = crowd.groupBy("address").agg(F.sum("n").alias("degree"))
    order = F.struct((-F.col("degree")).alias("d"), F.xxhash64("address").alias("o"), "address")
    leaders = materialise(crowd.join(degrees, "address").groupBy("bucket").agg(F.min(order).alias("leader")), "near-leaders")
    crowd = crowd.where(F.col("n") > 1).join(leaders, "bucket").select("bucket", "n", "address", F.col("leader.address").alias("leader"))
    crowd = materialise(crowd.where(F.col("address") != F.col("leader")), "near-buckets")
    found = verified(crowd.select(F.col("leader").alias("a"), F.col("address").alias("b")), texts, least)
    parts = materialise(connected(found).select(F.col("node").alias("address"), "part"), "near-parts")
    # In a bucket of two, the pair was compared.
    placed = crowd.where(F.col("n") > 2).join(parts, "address", "left").select("bucket", "address", F.coalesce("part", "address").alias("part"))
    mixed = placed.groupBy("bucket").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.ceil(F.count("*") / PIECE_ROWS).cast("int").alias("pieces"))
    mixed = materialise(mixed.where(F.col("lo") != F.col("hi")).select("bucket", "pieces"), "near-open")
    open_rows = materialise(placed.join(mixed, "bucket"), "near-open")
    needed = open_rows.select("address").distinct()
    some = _texts(needed, texts).join(rows.select("address", "coordinates"), "address")
    open_rows = open_rows.join(some, "address")
    open_rows = open_rows.withColumn("piece", F.pmod(F.xxhash64("address"), F.col("pieces")).cast("int"))
    cells = F.transform(F.sequence(F.lit(0), F.col("pieces") - 1), lambda other: F.struct(F.least(F.col("piece"), other).alias("i"), F.greatest(F.col("piece"), other).alias("j")))
    open_rows = open_rows.select("bucket", "address", "part", "coordinates", "text", "piece", F.inline(cells))
    more = open_rows.groupBy("bucket", "i", "j").applyInArrow(_linking(agreement, least), "a binary, b binary")
    return materialise(found.unionByName(more), "near-links")


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = SIMILARITY, agreement: float = LEAST_AGREEMENT) -> DataFrame:
    """Classes of documents joined by chains of near duplicates, the one of the smallest id kept in each.

    Two texts are near duplicates if the weighted Jaccard similarity of their shingles of five words
    is at least ``least``; equal texts always are. Null texts count as empty; texts without words are near only to
    equal ones. Null ids come after all others; among equal ids any one row is kept.

    Returns one row per input row: doc_id, class_id (the smallest id of its class), class_size, kept, address.
    An empty table gives an empty result. Pairs are never written out in full, and no class passes
    through one task: rows get their class by joins on addresses.
    """
    rows = materialise(signed(docs, doc_id, text).withColumn("row", F.monotonically_increasing_id()), "near-signed")
    distinct = rows.select("address", "bands", "coordinates").dropDuplicates(["address"])
    distinct = materialise(distinct, "near-signed")
    texts = docs.select(address(F.col(text)).alias("address"), empty_if_null(F.col(text)).alias("text"))
    parts = connected(links(distinct, texts, least, agreement)).select(F.col("node").alias("address"), "part")
    placed = rows.select("row", "doc_id", "address").join(parts, "address", "left").withColumn("part", F.coalesce("part", "address"))
    placed = materialise(placed, "near-classes")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    # Written, so that the join sees two plain inputs, of which a crowded class's rows can be split.
    classes = materialise(placed.groupBy("part").agg(first.alias("first"), F.count("*").alias("class_size")), "near-classes")
    joined = placed.join(classes, "part")
    return joined.select("doc_id", F.col("first.doc_id").alias("class_id"), "class_size", (F.col("row") == F.col("first.row")).alias("kept"), "address")


def without_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that ``near_groups`` keeps, with all their columns.

    Of rows equal in id and text one stays. Null texts count as empty, and of all rows with empty ones one stays; null ids come after all
    others; an empty table stays empty. Columns may have any names.
    """
    kept = near_groups(docs, doc_id, text, least).where("kept")
    mark = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lower(F.hex("address")))
    key = free_name(docs, "__llm_key")
    wanted = kept.select(mark.alias(key)).distinct()
    own = F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.lower(F.hex(address(F.col(text)))))
    once = docs.withColumn(key, own).dropDuplicates([key])
    return once.join(wanted, key, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])

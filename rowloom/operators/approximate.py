"""Approximate top-k search: inverted lists over product-quantised residuals, reranked by the vectors themselves.

Every usable row of an index gets the number of its nearest list centre and one byte for each stretch of what is left
after taking that centre away. A query reads the codes of some lists only, keeps the ids that look nearest by the codes, and
compares those with their vectors, so similarities that are returned are exact and only recall is not certain. How many lists
are read and how many ids kept is set on the whole index (``calibrate``), for a recall that the caller names.
``search(exact=True)`` leaves lists and codes aside and compares with every row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowloom.operators import vectors
from rowloom.operators.vectors import BLOCK_ROWS, BROADCAST_ENTRIES, BROADCAST_QUERIES, PIECE_ENTRIES, TILE_ENTRIES
from rowloom.session import materialise

# The fit's bounds: rows of the sample, about, and their entries; centres of lists; entries of a code book.
SAMPLE_ROWS = 16_384
SAMPLE_ENTRIES = 16_000_000
MAX_LISTS = 4_096
BOOK = 256
# Entries of a vector that share a byte, and most bytes of a code.
STRETCH = 4
MAX_PARTS = 64
ROUNDS = 8
# Queries on which lists to read and ids to keep are set.
CALIBRATION_QUERIES = 100
# Rows, as far as PIECE_ENTRIES allows, and queries that meet in one task, about.
LIST_PIECE = 131_072
QUERY_PIECE = 65_536
# Queries whose tables of products are held at a time.
TILE = 128
# Most queries that a region's rows meet at a time, and similarities of them worked out at a time.
REGION_QUERIES = 1_024
STEP_ENTRIES = 524_288
# One of so many rows of a region is looked at first, for a guess of what a query's last kept similarity will be.
GUESS_STEP = 32

_CODED = "id bigint, list int, codes binary"
_LIKELY = "query_id bigint, id bigint, near double"


class Quantizer(NamedTuple):
    """List centres (lists x dim), code books (parts x entries x stretch), lists to read and ids to keep for a query."""

    centres: np.ndarray
    books: np.ndarray
    probes: int
    depth: int

    @property
    def dim(self) -> int:
        return self.centres.shape[1]

    def stretches(self, matrix: np.ndarray) -> np.ndarray:
        """Rows cut into parts (rows x parts x stretch), the last one filled up with zeros."""
        parts, _, width = self.books.shape
        padded = np.zeros((len(matrix), parts * width), np.float32)
        padded[:, : matrix.shape[1]] = matrix
        return padded.reshape(len(matrix), parts, width)

    def encode(self, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The list of each row of length one, and its code."""
        lists = _nearest(matrix, self.centres)
        rest = self.stretches(matrix - self.centres[lists])
        codes = np.stack([_nearest(rest[:, p], book) for p, book in enumerate(self.books)], axis=1)
        return lists, codes.astype(np.uint8)

    def decode(self, lists: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The vectors that lists and codes stand for; a query's inner product with one is its similarity by the codes."""
        parts, _, width = self.books.shape
        rest = np.empty((len(codes), parts, width), np.float32)
        for part in range(parts):
            rest[:, part] = self.books[part][codes[:, part]]
        return self.centres[lists] + rest.reshape(len(codes), -1)[:, : self.dim]

    def products(self, matrix: np.ndarray) -> np.ndarray:
        """Inner products of the queries' stretches with all entries of the books (queries x parts x entries)."""
        return np.einsum("qpw,psw->qps", self.stretches(matrix), self.books)

    def order(self, matrix: np.ndarray) -> np.ndarray:
        """The lists of each query, the one whose centre is most similar first."""
        return np.argsort(-(matrix.astype(np.float32) @ self.centres.T), axis=1, kind="stable")


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each row, the first of equally near ones."""
    sizes = (centres * centres).sum(axis=1)
    step = max(1, 4_000_000 // len(centres))
    found = [np.argmin(sizes - 2 * (rows[at : at + step] @ centres.T), axis=1) for at in range(0, len(rows), step)]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _centres(rows: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """``n`` centres by Lloyd's rounds; one that loses all its rows starts anew at some row."""
    centres = rows[rng.permutation(len(rows))[:n]].astype(np.float32)
    for _ in range(ROUNDS):
        nearest = _nearest(rows, centres)
        counts = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros(centres.shape, np.float64)
        np.add.at(sums, nearest, rows)
        centres = (sums / np.maximum(counts, 1)[:, None]).astype(np.float32)
        lost = np.flatnonzero(counts == 0)
        centres[lost] = rows[rng.integers(0, len(rows), len(lost))]
    return centres


def fit(sample: np.ndarray, rows: int, seed: int = 5) -> Quantizer:
    """Centres and books from rows of length one, for an index of ``rows`` rows: about as many lists as rows in each.

    Reads half of the lists and keeps a hundred ids until ``calibrate`` sets both.
    """
    rng = np.random.default_rng(seed)
    sample = sample.astype(np.float32)
    n = int(min(max(round(rows**0.5), 1), MAX_LISTS, max(len(sample) // 8, 1)))
    centres = _centres(sample, n, rng)
    parts = min(-(-sample.shape[1] // STRETCH), MAX_PARTS)
    width = -(-sample.shape[1] // parts)
    shell = Quantizer(centres, np.zeros((parts, 1, width), np.float32), max(1, n // 2), 100)
    rest = shell.stretches(sample - centres[_nearest(sample, centres)])
    books = np.stack([_centres(rest[:, p], min(BOOK, len(sample)), rng) for p in range(parts)])
    return shell._replace(books=books)


class Coded(NamedTuple):
    """A fitted quantizer and the index's rows by it: ``id, list, codes``."""

    quantizer: Quantizer | None
    rows: DataFrame


def _drawn(index: DataFrame, most: int, rows: int, seed: int) -> list:
    """About ``most`` rows, drawn by a hash of the id; never more than twice as many."""
    draw = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 30)) / float(1 << 30)
    return index.where(draw < most / max(rows, 1)).limit(2 * most).collect()


def build(index: DataFrame, recall: float = 0.95, k: int = 10, seed: int = 5) -> Coded:
    """Lists and codes of all usable rows of ``index`` (``id bigint, embedding array``, ids unique), set for a recall at ``k``.

    Fitted on about ``SAMPLE_ROWS`` rows, fewer where vectors are wide; every usable row is coded. Rows that ``top_k``
    leaves out (NULL, without length, with entries that are no numbers) are left out here too; vectors of another width
    than the sample's fail the job. An index without usable rows gives no quantizer and no rows.
    """
    usable = vectors._usable(index)
    rows = usable.count()
    first = usable.take(1)
    if not first:
        return Coded(None, index.sparkSession.createDataFrame([], _CODED))
    most = max(256, min(SAMPLE_ROWS, SAMPLE_ENTRIES // len(first[0]["embedding"])))
    drawn = _drawn(usable, most, rows, seed) or first
    sample = vectors._unit(np.array([row["embedding"] for row in drawn], np.float64))
    quantizer = fit(sample, rows, seed)
    coded = materialise(encode(usable, quantizer), "coded")
    return Coded(calibrate(usable, coded, quantizer, rows, recall, k, seed), coded)


def encode(index: DataFrame, quantizer: Quantizer) -> DataFrame:
    """``id, list, codes`` of each row; nothing is shuffled."""
    shared = index.sparkSession.sparkContext.broadcast(quantizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quantizer = shared.value
        for batch in batches:
            if batch.num_rows:
                lists, codes = quantizer.encode(vectors._matrix(batch.column("embedding")))
                columns = [batch.column("id"), pa.array(lists.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "list", "codes"])

    return index.select("id", "embedding").mapInArrow(run, _CODED)


def _codes(column: pa.Array | pa.ChunkedArray, parts: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, parts)


def _near(base: np.ndarray, products: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Similarities by the codes (queries x rows), rounded so that equal codes tie in every task."""
    sums = np.repeat(base[:, None], len(codes), axis=1)
    for part in range(codes.shape[1]):
        sums += products[:, part][:, codes[:, part]]
    return np.round(sums, 5)


def calibrate(index: DataFrame, coded: DataFrame, quantizer: Quantizer, rows: int, recall: float, k: int, seed: int = 5) -> Quantizer:
    """Sets how many lists are read and ids kept, so that both together should miss at most ``1 - recall``.

    Some rows of the index are asked for their exact neighbours, in one scan; a second one counts, for each neighbour, the
    rows that look at least as near by their codes. Both numbers are those that hold for a share of
    the neighbours half way between ``recall`` and all. So they are measured on the whole index, whatever its size.
    """
    asked = _drawn(index, CALIBRATION_QUERIES, rows, seed + 1) or index.take(1)
    spark = index.sparkSession
    queries = spark.createDataFrame([(row["id"], row["embedding"]) for row in asked], "id bigint, embedding array<double>")
    truth = vectors.top_k(queries, index, k, skip_self=True).select("query_id", "id")
    known = {(r["query_id"], r["id"]): (r["list"], r["codes"]) for r in truth.join(coded, "id").collect()}
    if not known:
        return quantizer._replace(probes=len(quantizer.centres))
    ids = [row["id"] for row in asked]
    matrix = vectors._unit(np.array([row["embedding"] for row in asked], np.float64)).astype(np.float32)
    place = np.argsort(quantizer.order(matrix), axis=1)
    base, products = matrix @ quantizer.centres.T, quantizer.products(matrix)
    levels: list[list[float]] = [[] for _ in ids]
    depths = []
    number = {key: q for q, key in enumerate(ids)}
    for (query, _), (cell, codes) in known.items():
        q = number[query]
        code = np.frombuffer(codes, np.uint8)[None]
        levels[q].append(float(_near(base[q : q + 1, cell], products[q : q + 1], code)[0, 0]))
        depths.append(int(place[q, cell]) + 1)
    shared = spark.sparkContext.broadcast((base, products, levels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, products, levels = shared.value
        counts = [np.zeros(len(level), np.int64) for level in levels]
        for batch in batches:
            codes, lists = _codes(batch.column("codes"), products.shape[1]), batch.column("list").to_numpy()
            for q, level in enumerate(levels):
                near = np.sort(_near(np.zeros(1, np.float32), products[q : q + 1], codes)[0] + np.round(base[q, lists], 5))
                counts[q] += len(near) - np.searchsorted(near, np.array(level) - 2e-5, side="left")
        flat = [(q, i, int(n)) for q, found in enumerate(counts) for i, n in enumerate(found)]
        yield pa.RecordBatch.from_pylist([{"q": q, "i": i, "n": n} for q, i, n in flat], pa.schema([("q", pa.int32()), ("i", pa.int32()), ("n", pa.int64())]))

    counted = coded.mapInArrow(run, "q int, i int, n bigint").groupBy("q", "i").agg(F.sum("n").alias("n")).collect()
    share = (1 + recall) / 2
    probes = int(np.quantile(depths, share, method="higher"))
    depth = int(np.quantile([r["n"] for r in counted], share, method="higher"))
    return quantizer._replace(probes=probes, depth=max(depth, k + 1))


def _keep(near: np.ndarray, ids: np.ndarray, depth: int) -> np.ndarray:
    """Places of the ``depth`` that look nearest; of equal ones the smaller ids."""
    at = np.flatnonzero(np.isfinite(near))
    if len(at) > depth:
        at = at[near[at] >= np.partition(near[at], len(at) - depth)[len(at) - depth]]
    return at[np.lexsort((ids[at], -near[at]))[:depth]]


def _first_copies(ids: np.ndarray, lists: np.ndarray, codes: np.ndarray, depth: int) -> np.ndarray:
    """Places of all rows, by list, without those that equal codes of ``depth`` smaller ids, besides a query's own, always keep out."""
    words = np.zeros((len(codes), -(-codes.shape[1] // 8) * 8), np.uint8)
    words[:, : codes.shape[1]] = codes
    words = words.view(np.uint64)
    order = np.lexsort((ids, *words.T, lists))
    ids, lists, words = ids[order], lists[order], words[order]
    other = np.ones(len(order), bool)
    other[1:] = (lists[1:] != lists[:-1]) | (words[1:] != words[:-1]).any(axis=1)
    number = np.cumsum(other | (np.diff(ids, prepend=ids[:1]) != 0))
    return order[number - number[np.flatnonzero(other)][np.cumsum(other) - 1] <= depth]


def _best(
    query: np.ndarray, place: np.ndarray, raw: np.ndarray, queries: int, most: int, slack: float, exact: Callable, ids: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The pairs of query and row that are the query's ``most`` best by ``exact``, of equal ones the smaller ids; and for each query a ``raw`` below which no better pair lies.

    ``raw`` is within ``slack`` of ``exact``, which is worked out only for pairs that ``raw`` leaves in doubt.
    """
    order = np.argsort(query, kind="stable")
    query, place, raw = query[order], place[order], raw[order]
    stops = np.cumsum(np.bincount(query, minlength=queries))
    starts = np.concatenate(([0], stops[:-1]))
    last = np.full(queries, -np.inf)
    for q in np.flatnonzero(stops - starts > most):
        own = raw[starts[q] : stops[q]]
        last[q] = np.partition(own, len(own) - most)[len(own) - most]
    floor = last - 2 * slack
    sure = raw > (last + 2 * slack)[query]
    doubt = np.flatnonzero(~sure & (raw >= floor[query]))
    free = most - np.bincount(query[sure], minlength=queries)
    doubt = doubt[np.lexsort((ids[place[doubt]], -exact(query[doubt], place[doubt]), query[doubt]))]
    asked = query[doubt]
    kept = np.concatenate((np.flatnonzero(sure), doubt[np.arange(len(asked)) - np.searchsorted(asked, asked) < free[asked]]))
    return query[kept], place[kept], raw[kept], floor


def _dots(left: np.ndarray, right: np.ndarray, query: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Inner products of pairs of rows, some at a time."""
    step = max(1, STEP_ENTRIES // left.shape[1])
    kind = np.result_type(left, right)
    parts = [(left[query[at : at + step]] * right[place[at : at + step]]).sum(axis=1, dtype=kind) for at in range(0, len(query), step)]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


class _Region:
    """Rows of a region inside a task: the ``k`` best of those ``depth`` that look nearest by the codes, for some queries at a time."""

    def __init__(self, quantizer: Quantizer, rows: pa.Table, k: int, probes: int, depth: int, skip_self: bool):
        self.quantizer, self.k, self.probes, self.skip_self = quantizer, k, probes, skip_self
        ids, lists = rows["id"].to_numpy().astype(np.int64), rows["list"].to_numpy()
        codes = _codes(rows["codes"], quantizer.books.shape[0])
        at = _first_copies(ids, lists, codes, depth)
        self.ids, self.lists, codes = ids[at], lists[at], codes[at]
        starts = np.flatnonzero(np.diff(self.lists, prepend=-1))
        self.stretches = list(zip(self.lists[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(at)], strict=True))
        self.decoded, self.items = quantizer.decode(self.lists, codes), vectors._matrix(rows["embedding"].take(pa.array(at)))
        self.items_32 = self.items.astype(np.float32)
        # How far sums of single precision may be from those of double precision, and these from rounded ones.
        length = max(1.0, float(np.sqrt((self.decoded * self.decoded).sum(axis=1).max())))
        self.slack, self.near_slack = vectors._slack(quantizer.dim) + 0.5 * 10.0**-vectors.DIGITS, vectors._slack(quantizer.dim) * length + 0.5e-5
        self.depth = min(depth, len(at))
        self.step = max(1, min(REGION_QUERIES, TILE_ENTRIES // (4 * self.depth)))

    def search(self, query_ids: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``query_id, id, sim`` of at most ``step`` queries, rows of length one."""
        some = matrix.astype(np.float32)
        query, place = self._likely(query_ids, some)
        raw = _dots(some, self.items_32, query, place)
        exact = lambda q, p: vectors._rounded(_dots(matrix, self.items, q, p))
        query, place, _, _ = _best(query, place, raw, len(matrix), self.k, self.slack, exact, self.ids)
        return query_ids[query], self.ids[place], exact(query, place)

    def _likely(self, query_ids: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of query and row that look nearest, ``depth`` for each query where its lists hold as many.

        Queries whose guessed bound may have been too high are asked again without one.
        """
        read = _lists_read(self.quantizer, some, self.probes)
        guess = self._guess(some, read)
        query, place, floor = self._above(query_ids, some, read, guess)
        short = np.flatnonzero(floor < guess)
        if len(short):
            fine = ~np.isin(query, short)
            again, more, _ = self._above(query_ids[short], some[short], read[short], np.full(len(short), -np.inf))
            query, place = np.concatenate((query[fine], short[again])), np.concatenate((place[fine], more))
        return query, place

    def _guess(self, some: np.ndarray, read: np.ndarray) -> np.ndarray:
        """For each query a similarity that more than ``depth`` rows should have, by some rows of all lists; none where these are few."""
        at = np.arange(0, len(self.ids), GUESS_STEP)
        share = self.depth / GUESS_STEP
        last = int(share + 3 * share**0.5) + 2
        if len(at) <= last:
            return np.full(len(some), -np.inf)
        near = some @ self.decoded[at].T
        near[~read[:, self.lists[at]]] = -np.inf
        return np.partition(near, len(at) - last, axis=1)[:, len(at) - last].astype(np.float64)

    def _above(self, query_ids: np.ndarray, some: np.ndarray, read: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same among rows above ``floor``, and for each query the bound that these give; products with decoded rows tell which, and bounds rise as rows come in."""
        exact = lambda q, p: np.round(_dots(some.astype(np.float64), self.decoded, q, p), 5)
        best = lambda held: _best(*map(np.concatenate, zip(*held, strict=True)), len(some), self.depth, self.near_slack, exact, self.ids)
        held, size = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32))], 0
        for cell, start, stop in self.stretches:
            reading = np.flatnonzero(read[:, cell])
            if not len(reading):
                continue
            asking, step = some[reading], max(1, STEP_ENTRIES // len(reading))
            for at in range(start, stop, step):
                near = asking @ self.decoded[at : min(at + step, stop)].T
                row, column = vectors._places(near >= floor[reading, None].astype(np.float32))
                query, place = reading[row], column + at
                if self.skip_self:
                    other = query_ids[query] != self.ids[place]
                    row, column, query, place = row[other], column[other], query[other], place[other]
                held.append((query, place, near[row, column]))
                size += len(query)
                if size > 3 * self.depth * len(some):
                    *kept, risen = best(held)
                    floor = np.maximum(floor, risen)
                    held, size = [tuple(kept)], len(kept[0])
        query, place, _, risen = best(held)
        return query, place, risen


def _likely_by_broadcast(queries: list, coded: Coded, probes: int, depth: int, skip_self: bool) -> DataFrame:
    """Every task reads its share of the codes once, for all queries; lists that no query reads are skipped."""
    quantizer = coded.quantizer
    query_ids = np.array([row["id"] for row in queries], np.int64)
    matrix = vectors._unit(np.array([row["embedding"] for row in queries], np.float64)).astype(np.float32)
    shared = coded.rows.sparkSession.sparkContext.broadcast((quantizer, query_ids, matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quantizer, query_ids, matrix = shared.value
        read = _lists_read(quantizer, matrix, probes)
        held = [(np.zeros(0, np.float32), np.zeros(0, np.int64)) for _ in query_ids]
        for batch in batches:
            ids, lists = batch.column("id").to_numpy(), batch.column("list").to_numpy()
            codes = _codes(batch.column("codes"), quantizer.books.shape[0])
            order = np.argsort(lists, kind="stable")
            starts = np.flatnonzero(np.diff(lists[order], prepend=-1))
            stretches = list(zip(lists[order[starts]].tolist(), starts.tolist(), [*starts[1:].tolist(), len(order)], strict=True))
            for tile in range(0, len(matrix), TILE):
                some = matrix[tile : tile + TILE]
                products = quantizer.products(some)
                near = np.full((len(some), len(ids)), -np.inf, np.float32)
                for cell, start, stop in stretches:
                    asking = np.flatnonzero(read[tile : tile + TILE, cell])
                    if len(asking):
                        rows = order[start:stop]
                        near[np.ix_(asking, rows)] = _near(some[asking] @ quantizer.centres[cell], products[asking], codes[rows])
                if skip_self:
                    near[query_ids[tile : tile + TILE, None] == ids] = -np.inf
                for q, found in enumerate(near, tile):
                    best = _keep(found, ids, depth)
                    if len(held[q][0]):
                        both, both_ids = np.concatenate((held[q][0], found[best])), np.concatenate((held[q][1], ids[best]))
                        best = _keep(both, both_ids, depth)
                        held[q] = both[best], both_ids[best]
                    else:
                        held[q] = found[best], ids[best]
        for query, (near, ids) in zip(query_ids.tolist(), held, strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), query, np.int64)), pa.array(ids), pa.array(near.astype(np.float64))], names=["query_id", "id", "near"])

    return coded.rows.mapInArrow(run, _LIKELY)


def _found_by_regions(queries: DataFrame, index: DataFrame, coded: Coded, k: int, probes: int, depth: int, skip_self: bool) -> DataFrame:
    """The k best per query and region among the ``depth`` that look nearest there, by their vectors.

    Lists, those beyond a region in pieces, fill regions in order. Codes and vectors of a region meet each block of queries
    once, and a query goes once to each region that holds a list which it reads; so neither lists read nor ids kept for a query are shuffled.
    """
    spark, quantizer = queries.sparkSession, coded.quantizer
    most = max(1, min(LIST_PIECE, PIECE_ENTRIES // quantizer.dim))
    counts = sorted(tuple(row) for row in coded.rows.groupBy("list").count().collect())  # at most one row for each of the quantizer's lists
    units, region, filled = [], 0, 0
    for cell, count in counts:
        pieces = -(-count // most)
        for piece in range(pieces):
            if filled and filled + count // pieces > most:
                region, filled = region + 1, 0
            units.append((cell, pieces, piece, region))
            filled += count // pieces
    regions = region + 1
    asked = queries.count()
    wanted = -(-vectors.TASKS_A_CORE * spark.sparkContext.defaultParallelism // regions)
    blocks = max(-(-asked // max(1, min(QUERY_PIECE, PIECE_ENTRIES // quantizer.dim))), min(wanted, -(-asked // BLOCK_ROWS)), 1)
    shared = spark.sparkContext.broadcast((quantizer, [(cell, region) for cell, _, _, region in units]))

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quantizer, held = shared.value
        holds = np.zeros((len(quantizer.centres), regions), np.float32)
        for cell, region in held:
            holds[cell, region] = 1
        for batch in batches:
            for at in range(0, batch.num_rows, TILE):
                part = batch.slice(at, TILE)
                read = _lists_read(quantizer, vectors._matrix(part.column("embedding")).astype(np.float32), probes)
                rows, places = np.nonzero(read.astype(np.float32) @ holds)
                part = part.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("embedding"), pa.array(places.astype(np.int32))], names=["query_id", "embedding", "region"])

    def run(rows: pa.Table, asking: pa.Table) -> pa.Table:
        if not rows.num_rows or not asking.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "sim": pa.array([], pa.float64())})
        region, out = _Region(shared.value[0], rows, k, probes, depth, skip_self), []
        for at in range(0, asking.num_rows, region.step):
            part = asking.slice(at, region.step)
            out.append(region.search(part["query_id"].to_numpy().astype(np.int64), vectors._matrix(part["embedding"])))
        return pa.table({name: np.concatenate(c) for name, c in zip(("query_id", "id", "sim"), zip(*out, strict=True), strict=True)})

    kind = queries.schema["embedding"].dataType.simpleString()
    left = queries.select("id", "embedding").mapInArrow(sent, f"query_id bigint, embedding {kind}, region int")
    left = left.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    of_unit = F.broadcast(spark.createDataFrame(units, "list int, pieces int, piece int, region int"))
    of_list = F.broadcast(spark.createDataFrame(sorted({u[:2] for u in units}), "list int, pieces int"))
    piece = F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int")
    right = coded.rows.join(of_list, "list").withColumn("piece", piece).join(of_unit.drop("pieces"), ["list", "piece"])
    right = right.select("region", "list", "id", "codes").join(vectors._usable(index), "id")
    right = right.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return vectors._meetings(right, left, regions * blocks).applyInArrow(run, vectors._MATCH)


def _lists_read(quantizer: Quantizer, matrix: np.ndarray, probes: int) -> np.ndarray:
    """Which lists each query reads (queries x lists): the most similar centres, of equal ones the first."""
    far = -(matrix.astype(np.float32) @ quantizer.centres.T)
    read = far <= np.partition(far, probes - 1, axis=1)[:, probes - 1, None]
    tied = np.flatnonzero(read.sum(axis=1) > probes)
    read[tied] = False
    read[tied[:, None], np.argsort(far[tied], axis=1, kind="stable")[:, :probes]] = True
    return read


def _rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            sims = (vectors._matrix(batch.column("asked")) * vectors._matrix(batch.column("embedding"))).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("id"), pa.array(vectors._rounded(sims))], names=["query_id", "id", "sim"])


def search(
    queries: DataFrame,
    index: DataFrame,
    coded: Coded,
    k: int,
    skip_self: bool = False,
    probes: int | None = None,
    depth: int | None = None,
    exact: bool = False,
    broadcast_queries: int = BROADCAST_QUERIES,
) -> DataFrame:
    """The ``k`` rows found most similar to each query: ``query_id, rank, id, sim``, like ``vectors.top_k``.

    ``index`` is the table that ``coded`` was built of. ``probes`` lists are read and ``depth`` ids compared for a query; the calibrated
    numbers if not given; where many queries meet more rows than one task holds, ``depth`` ids of each region of the index. ``exact`` compares with all rows instead, by ``vectors.top_k``. Ids are
    cut to ``depth`` before vectors join them; equal codes go by smaller id, so copies tie as in an exact search
    while there are fewer of them than ``depth``.
    """
    if exact or coded.quantizer is None:
        return vectors.top_k(queries, index, k, skip_self)
    lists = len(coded.quantizer.centres)
    probes, depth = min(probes or coded.quantizer.probes, lists), max(depth or coded.quantizer.depth, k)
    queries = materialise(vectors._usable(queries), "queries")
    few = queries.take(broadcast_queries + 1)
    if few and len(few) <= broadcast_queries and len(few) * max(coded.quantizer.dim, 2 * depth, lists) <= BROADCAST_ENTRIES:
        likely = _likely_by_broadcast(few, coded, probes, depth, skip_self)
    else:
        return vectors._ranked(_found_by_regions(queries, index, coded, k, probes, depth, skip_self), k)
    best = Window.partitionBy("query_id").orderBy(F.desc("near"), F.asc("id"))
    kept = likely.withColumn("place", F.row_number().over(best)).where(F.col("place") <= depth).select("query_id", "id")
    asked = queries.select(F.col("id").alias("query_id"), F.col("embedding").alias("asked"))
    pairs = kept.join(vectors._usable(index), "id").join(asked, "query_id")
    return vectors._ranked(pairs.select("query_id", "id", "asked", "embedding").mapInArrow(_rerank, vectors._MATCH), k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: ``queries``, and the share of the exact rows that were ``found``, as ``recall``; both are results of a search."""
    hits = exact.select("query_id", "id").join(found.select("query_id", "id", F.lit(1).alias("hit")), ["query_id", "id"], "left")
    return hits.agg(F.count_distinct("query_id").alias("queries"), F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))

"""Best-fit packing of tokenised documents into sequences, polished by swaps."""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import give_back, let_go, slices, worker_state
from rowloom.session import materialise

CAPACITY = 4096
END_ID = 1
# Pieces that one task packs at a time. A block wastes less than one sequence, of some thousands.
BLOCK_PIECES = 16_384
# Pre-tokens and chunks whose ids a worker remembers; others are encoded anew.
REMEMBERED = 500_000
# Bytes of ids after which a task hands on what it has made.
HELD_BYTES = 8_000_000

# The pre-token pattern of the vocabulary file, for texts of the characters below.
_PRE_TOKEN = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
_UNUSUAL = re.compile(r"[^\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]|<\|")


class _Known(dict):
    """Ids, as bytes, by string; asks ``find`` for what it does not hold."""

    def __init__(self, find):
        self.find = find

    def __missing__(self, key):
        value = np.array(self.find(key), dtype="<u4").tobytes()
        if len(self) < REMEMBERED:
            self[key] = value
        return value


class WordTokens:
    """Ids of whole texts by the lower-casing word vocabulary, equal to those of the library.

    In texts of printable ASCII and Latin-1 letters the pre-tokens are found by a pattern and each
    distinct one is merged once by the library's model. Any other text is cut at blanks and line ends, which no
    token spans, and its unusual chunks go through the library's whole encoder.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        whole.no_padding()
        whole.no_truncation()
        model = whole.model
        alphabet = _byte_letters()
        self.words = _Known(lambda w: [t.id for t in model.tokenize("".join(alphabet[b] for b in w.encode()))])
        self.chunks = _Known(lambda c: whole.encode(c, add_special_tokens=False).ids)

    def _usual(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, _PRE_TOKEN.findall(text.lower())))

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not _UNUSUAL.search(text):
            return self._usual(text)
        parts = text.replace("\n", " ").split(" ")
        return b"".join(self.chunks[p] if _UNUSUAL.search(p) else self._usual(p) for p in parts if p)


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (chr(n) for n in range(256, 512))
    return [chr(b) if b in plain else next(others) for b in range(256)]


def _narrow(ids: bytes) -> bytes:
    """Little-endian unsigned 32-bit ids, as 16-bit ones where all are below 65,536: half the bytes to write and shuffle."""
    values = np.frombuffer(ids, "<u4")
    return values.astype("<u2").tobytes() if values.max() < 1 << 16 else ids


def _wide(ids: bytes, length: int) -> bytes:
    """The 32-bit ids that ``_narrow`` was given."""
    return np.frombuffer(ids, "<u2").astype("<u4").tobytes() if len(ids) == 2 * length else ids


def pieces(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Token pieces of whole texts: doc_id, piece, start, length, ids (see ``_narrow``), and the task and its row that made them.

    A document's ids are those of its text (null: empty) and ``end_id``. Only documents of over
    ``capacity`` ids are cut, all pieces but the last being full. Tokenises without moving texts.
    """
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids binary, task int, row bigint"
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
    names = ["doc_id", "piece", "start", "length", "ids", "task", "row"]
    end = np.array([end_id], dtype="<u4").tobytes()
    width = capacity * 4

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = worker_state("word_tokens", lambda: WordTokens(tokenizer))
        row, task = 0, TaskContext.get().partitionId()
        for batch in batches:
            out, held = [], 0
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = tokens.ids(value.as_py() or "") + end
                for k, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    out.append((key, k, at // 4, len(part) // 4, _narrow(part), task, row))
                    held += len(part)
                    if held > HELD_BYTES:
                        yield made(out)
                        out, held = [], 0
                row += 1
            yield made(out)
        give_back()

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut, schema)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indexes, longest items first, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms: list[int] = []  # the distinct free spaces at hand, ascending
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need = lengths[i]
        at = bisect_left(rooms, need)
        if at == len(rooms):
            bins.append([i])
            room, b = capacity - need, len(bins) - 1
        else:
            free = rooms[at]
            b = by_room[free].pop()
            if not by_room[free]:
                rooms.pop(at)
            bins[b].append(i)
            room = free - need
        if room:
            if not by_room[room]:
                insort(rooms, room)
            by_room[room].append(b)
    return bins


class _Underfull:
    """The items of underfull bins by length, and their pairs within a bin, in flat arrays that are searched at once.

    An entry is a length, or sum of two, that its bin can give back; every bin has one of 0, for nothing.
    """

    def __init__(self, bins: list[list[int]], lengths: list[int], capacity: int):
        self.capacity, self.nobody = capacity, len(bins)
        self.items: list[dict[int, list[int]]] = []
        for members in bins:
            sizes: dict[int, list[int]] = {}
            for i in members:
                sizes.setdefault(lengths[i], []).append(i)
            self.items.append(sizes)
        fill = [sum(lengths[i] for i in members) for members in bins]
        # What is not in the search has more room than any giver, so that no step finds it.
        self.room = np.array([capacity - f if 0 < f < capacity else 2 * capacity for f in fill] + [2 * capacity])
        self.changed = np.zeros(len(bins) + 1, dtype=np.int64)
        self._rebuild()

    def open_bins(self) -> list[int]:
        """Bins in the search, the emptiest first."""
        found = np.flatnonzero(self.room < self.capacity)
        return found[np.argsort(-self.room[found], kind="stable")].tolist()

    def values(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array(sorted(self.items[b]), dtype=np.int64)
        low, high = np.triu_indices(len(sizes), 1)
        twice = np.array([s for s in sizes.tolist() if len(self.items[b][s]) > 1], dtype=np.int64)
        return sizes, np.unique(np.concatenate([sizes[low] + sizes[high], 2 * twice]))

    def _rebuild(self) -> None:
        self.flat, self.owner, self.used, self.spans = [], [], [0, 0], {}
        made = {b: self.values(b) for b in np.flatnonzero(self.room < self.capacity).tolist()}
        for kind in (0, 1):
            room = 2 * sum(len(v[kind]) + 1 for v in made.values()) + 4 * self.capacity
            self.flat.append(np.zeros(room, dtype=np.int64))
            self.owner.append(np.full(room, self.nobody))
        for b, values in made.items():
            self._add(b, values)

    def _add(self, b: int, values: tuple[np.ndarray, np.ndarray]) -> None:
        spans = []
        for kind, more in enumerate((np.concatenate([[0], values[0]]), values[1])):
            at = self.used[kind]
            self.flat[kind][at : at + len(more)] = more
            self.owner[kind][at : at + len(more)] = b
            self.used[kind] = at + len(more)
            spans.append((at, at + len(more)))
        self.spans[b] = spans

    def _renew(self, b: int) -> None:
        for kind, (lo, hi) in enumerate(self.spans.pop(b)):
            self.owner[kind][lo:hi] = self.nobody
        if self.room[b] < self.capacity:
            values = self.values(b)
            if any(self.used[kind] + len(v) + 1 > len(self.flat[kind]) for kind, v in enumerate(values)):
                self._rebuild()
            else:
                self._add(b, values)

    def step(self, source: int, since: int) -> tuple[int, int, int, int, int] | None:
        """The target, what it gets and gives back, and of how many items: of the fullest bin with a step, the largest one.

        Only bins that changed after step ``since`` are looked at.
        """
        singles, pairs = self.values(source)
        near, best, found = 4 * self.capacity, None, None
        for kind in (0, 1):
            flat, owner = self.flat[kind][: self.used[kind]], self.owner[kind][: self.used[kind]]
            room = self.room[owner]
            there = np.flatnonzero((room <= self.room[source]) & (owner != source) & (self.changed[owner] > since))
            if not len(there):
                continue
            flat, room = flat[there], room[there]
            # Two items are given for nothing or for one, one item also for two.
            for given, values in ((1, singles), (2, pairs))[: 2 - kind]:
                for value in values.tolist():
                    gain = value - flat
                    fits = np.flatnonzero((gain > 0) & (gain <= room))
                    if len(fits):
                        rank = room[fits] * near - gain[fits]
                        at = int(rank.argmin())
                        if best is None or rank[at] < best:
                            best, back = int(rank[at]), int(flat[fits[at]])
                            found = int(owner[there[fits[at]]]), value, back, given, kind + 1 if back else 0
        return found

    def _take(self, b: int, value: int, count: int) -> list[tuple[int, int]]:
        """Items of bin ``b``, as lengths and indexes, that together are ``value`` long."""
        sizes, wanted = self.items[b], [value][:count]
        if count == 2:
            low = next(x for x in sizes if value - x in sizes and (2 * x != value or len(sizes[x]) > 1))
            wanted = [low, value - low]
        taken = []
        for size in wanted:
            taken.append((size, sizes[size].pop()))
            if not sizes[size]:
                del sizes[size]
        return taken

    def apply(self, source: int, step: tuple[int, int, int, int, int], number: int) -> None:
        target, given, back, n_given, n_back = step
        give, take = self._take(source, given, n_given), self._take(target, back, n_back)
        for b, more in ((target, give), (source, take)):
            for size, i in more:
                self.items[b].setdefault(size, []).append(i)
        self.room[target] -= given - back
        self.room[source] += given - back
        for b in (source, target):
            if self.room[b] in (0, self.capacity):
                self.room[b] = 2 * self.capacity
            self.changed[b] = number
        for b in (source, target):
            if b in self.spans:
                self._renew(b)


def swap_search(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Empty bins by moves and swaps between underfull ones that raise the sum of squared fills.

    Takes the bins from the emptiest on and looks in all other underfull bins that are at least as full, the
    fullest first, for a move (the item fits), a swap of one item for a smaller one of the other
    bin that then is fuller, of one item for two that together are smaller, or of two for one. Each step makes the
    fuller bin fuller and the emptier one emptier, so the sum of squares grows and the search ends: when
    no bin has a step left, or the sum of all lengths needs every bin. A bin without items is gone; a full one is
    never touched. A bin that had no step is held only against bins that have changed since.
    """
    held = _Underfull(bins, lengths, capacity)
    least = -(-sum(lengths[i] for b in bins for i in b) // capacity)
    alive, number, seen, going = sum(1 for b in bins if b), 1, {}, True
    held.changed[:] = 1
    while alive > least and going:
        going = False
        for source in held.open_bins():
            while alive > least and held.room[source] < capacity:
                # What a bin that has changed itself was held against does not count.
                since = seen.get(source, 0)
                found = held.step(source, since if held.changed[source] <= since else 0)
                if found is None:
                    seen[source] = number
                    break
                number, going = number + 1, True
                held.apply(source, found, number)
                alive -= not held.items[source]
    return [[i for group in sizes.values() for i in group] for sizes in held.items if sizes]


def pack_lengths(lengths: list[int], capacity: int) -> list[list[int]]:
    return swap_search(best_fit(lengths, capacity), lengths, capacity)


_PLACED = "task int, row bigint, piece int, length bigint, sequence bigint, offset bigint, fill bigint"


def _pack_blocks(rows: DataFrame, blocks: int, capacity: int, *dealt: str) -> DataFrame:
    """Each block's rows in sequences of their own: adds sequence (within a block), offset and fill. Blocks are dealt by a hash of ``dealt``."""

    def pack(key: tuple, batch: pa.Table) -> pa.Table:
        let_go()
        lengths = batch.column("length").to_pylist()
        sequence, offset, fill = (np.zeros(len(lengths), dtype=np.int64) for _ in range(3))
        for b, members in enumerate(pack_lengths(lengths, capacity)):
            at = 0
            for i in members:
                sequence[i], offset[i] = b, at
                at += lengths[i]
            fill[members] = at
        kept = batch.select(["task", "row", "piece", "length"])
        for name, values in (("sequence", sequence + (key[0].as_py() << 32)), ("offset", offset), ("fill", fill)):
            kept = kept.append_column(name, pa.array(values))
        return kept

    block = F.pmod(F.xxhash64(*dealt), F.lit(blocks))
    return rows.withColumn("block", block).groupBy("block").applyInArrow(pack, _PLACED)


def placements(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Where each of the ``pieces`` goes: task, row, piece, sequence_id, offset. Their ids are not read.

    Pieces are dealt by hash into blocks of about ``BLOCK_PIECES``, so no task holds more, however
    large the corpus or a group of equal rows. Each block is packed by best fit, then by swaps
    (``swap_search``). What is left in sequences under 15/16 full goes into a second round of
    blocks, so that the blocks' remainders share sequences.
    """
    rows = cut.select("task", "row", "piece", "length")
    first = materialise(_pack_blocks(rows, max(1, -(-rows.count() // BLOCK_PIECES)), capacity, "task", "row", "piece"), "packed")
    loose = F.col("fill") < capacity * 15 // 16
    rest = first.where(loose)
    again = _pack_blocks(rest, max(1, -(-rest.count() // BLOCK_PIECES)), capacity, "task", "row", "piece", "sequence")
    # Numbers of the second round are odd, those of the first even.
    both = first.where(~loose).withColumn("sequence_id", F.col("sequence") * 2).unionByName(again.withColumn("sequence_id", F.col("sequence") * 2 + 1))
    return both.select("task", "row", "piece", "sequence_id", "offset")


_SEQUENCE = "sequence_id bigint, n_tokens bigint, ids binary, pieces array<struct<doc_id: bigint, piece: int, start: bigint, length: bigint, offset: bigint>>"


def _join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces, sorted by sequence and offset, to one row per sequence."""
    spans = pa.list_(pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("offset", pa.int64())]))
    types, names = [pa.int64(), pa.int64(), pa.binary(), spans], ["sequence_id", "n_tokens", "ids", "pieces"]
    current, parts, places, held, out = None, [], [], 0, []

    def made() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * 4
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    def close() -> None:
        ids = b"".join(parts)
        if [p["offset"] for p in places] != [0, *accumulate(p["length"] for p in places)][:-1] or len(ids) != 4 * sum(p["length"] for p in places):
            raise ValueError(f"the pieces of sequence {current} do not follow each other")
        out.append((current, len(ids) // 4, ids, list(places)))

    let_go()
    parted = (batch.slice(at, stop - at) for batch in batches for at, stop in slices(pc.binary_length(batch.column("ids")).to_pylist(), HELD_BYTES))
    for batch in parted:
        for sequence, offset, key, piece, start, length, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if sequence != current:
                if current is not None:
                    close()
                    if held > HELD_BYTES:
                        yield made()
                        held = 0
                current, parts, places = sequence, [], []
            parts.append(_wide(ids, length))
            places.append({"doc_id": key, "piece": piece, "start": start, "length": length, "offset": offset})
            held += len(ids)
    if current is not None:
        close()
    yield made()
    give_back()


def sequences(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Whole documents in sequences of at most ``capacity`` tokens, as few as the search finds (see ``placements``).

    Returns one row per sequence: sequence_id, n_tokens, ids (little-endian unsigned 32-bit) and pieces, which in order of their
    offsets make up the ids. Texts that are null or empty are one id long; repeated rows are packed one by one; an
    empty table gives an empty result. A task sorts pieces and holds one sequence and a batch of them.
    """
    cut = materialise(pieces(docs, tokenizer, doc_id, text, capacity, end_id), "pieces")
    placed = cut.join(placements(cut, capacity), ["task", "row", "piece"])
    ordered = placed.repartition("sequence_id").sortWithinPartitions("sequence_id", "offset")
    return ordered.select("sequence_id", "offset", "doc_id", "piece", "start", "length", "ids").mapInArrow(_join_up, _SEQUENCE)


def sequence_pieces(packed: DataFrame) -> DataFrame:
    """The pieces of ``sequences`` with their ids, cut out of the sequences' own: doc_id, piece, start, length, ids_crc32, sequence_id, offset, ids."""

    def cut_out(p: Column) -> Column:
        ids = F.col("ids").substr((p["offset"] * 4 + 1).cast("int"), (p["length"] * 4).cast("int"))
        return F.struct(p["doc_id"], p["piece"], p["start"], p["length"], F.crc32(ids).alias("ids_crc32"), p["offset"], ids.alias("ids"))

    rows = packed.select("sequence_id", F.explode(F.transform("pieces", cut_out)).alias("p"))
    return rows.select("p.doc_id", "p.piece", "p.start", "p.length", "p.ids_crc32", "sequence_id", "p.offset", "p.ids")


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """What ``sequences`` hold, read back from their ids: the columns of ``sequence_pieces`` but ids."""
    return sequence_pieces(sequences(docs, tokenizer, doc_id, text, capacity, end_id)).drop("ids")

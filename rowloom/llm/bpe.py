"""Byte-level BPE of whole texts by a file of ranks: ids with offsets, and back to bytes and pieces of text."""

from __future__ import annotations

import base64
import codecs
import os
import re
import zlib
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import slices, worker_state

# Characters that one call of the library gets, but for a longer stretch without a blank.
CALL_CHARS = 500_000
# Stretches that a worker remembers, and their length at most; others are encoded anew in each batch.
REMEMBERED = 150_000
SHORT_CHARS = 40
# A blank or line end begins a new stretch unless it follows another white space.
_STRETCH = re.compile(r"\s*\S+(?:[^\S \n]\s*\S+)*(?:[^\S \n]\s*\Z)?|\s+")


def byte_chars() -> list[str]:
    """The character that stands for each byte: itself if it is printed, else the next free one from 256 on."""
    printed = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b if b in printed else next(hidden)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks, which are their ids, of a file with base64 and a number per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def spellings(ranks: dict[bytes, int]) -> dict[bytes, str]:
    """Each token as the library knows it, a character for a byte."""
    shown = byte_chars()
    return {token: "".join([shown[b] for b in token]) for token in ranks}


def token_bytes(spelled: dict[str, int]) -> list[bytes]:
    """The bytes of every id, by the reversed byte table."""
    back = {c: b for b, c in enumerate(byte_chars())}
    table = [b""] * (max(spelled.values()) + 1)
    for word, i in spelled.items():
        table[i] = bytes([back[c] for c in word])
    return table


def tokenizer(ranks: dict[bytes, int], pattern: str):
    """The library's model that merges what the ranks merge: any two neighbours that together have one, the lowest first."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"the ranks lack the bytes {missing}")
    spelled = spellings(ranks)
    merges = [
        (spelled[token[:i]], spelled[token[i:]])
        for token in sorted(ranks, key=ranks.__getitem__)
        for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks
    ]
    made = Tokenizer(models.BPE({spelled[t]: r for t, r in ranks.items()}, merges))
    made.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    return made


class Encoder:
    """Ids and offsets of whole texts, equal to those of the library over each of them.

    A text is cut before blanks and line ends that follow something else. Patterns of this kind never
    match across such a place, since blanks stand only at the start of a match or in a run of
    blanks. The library gets each distinct stretch of a batch once, many in one text where they may follow each other; short
    ones are remembered.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        # A task has one core; the library must not start a thread per core in each.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.model = tokenizer(ranks, pattern)
        spelled = spellings(ranks)
        self.sizes = np.array([len(t) for t in token_bytes({word: ranks[token] for token, word in spelled.items()})], np.int64)
        self.known: dict[str, bytes] = {}

    def _look_up(self, stretches: set[str]) -> dict[str, bytes]:
        """The ids of the stretches that are not remembered."""
        missing, found = list(stretches.difference(self.known)), {}
        # Behind a letter, digit or ASCII sign, a blank or line end is a place to cut; such stretches go to the library as one text.
        plain = [s for s in missing if s[0] in " \n" and (s[-1].isalnum() or "!" <= s[-1] <= "~")]
        others = [s for s in missing if not (s[0] in " \n" and (s[-1].isalnum() or "!" <= s[-1] <= "~"))]
        for at, stop in slices(list(map(len, plain)), CALL_CHARS):
            part = plain[at:stop]
            ids = np.array(self.model.encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids, dtype="<u4")
            stops = np.cumsum(np.fromiter((len(s.encode()) for s in part), np.int64, len(part)))
            ends = np.cumsum(self.sizes[ids])
            last = np.searchsorted(ends, stops)
            if not np.array_equal(ends[last], stops):
                raise ValueError("a token crosses a place to cut")
            raw, begin = ids.tobytes(), 0
            for stretch, end in zip(part, ((last + 1) * 4).tolist(), strict=True):
                found[stretch] = raw[begin:end]
                begin = end
        for at, stop in slices(list(map(len, others)), CALL_CHARS):
            made = self.model.encode_batch_fast(others[at:stop], add_special_tokens=False)
            for stretch, encoded in zip(others[at:stop], made, strict=True):
                found[stretch] = np.array(encoded.ids, dtype="<u4").tobytes()
        return found

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each token in code points, by the character that each byte of the text belongs to."""
        character = np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80, dtype=np.int32)
        ends = np.cumsum(self.sizes[ids])
        return character[ends - self.sizes[ids]] - 1, character[ends - 1]

    def encode(self, texts: list[str]) -> list[tuple[bytes, np.ndarray, np.ndarray]]:
        """Per text its ids (little-endian unsigned 32-bit) and the offsets, start and end, of each token in code points."""
        cut = [_STRETCH.findall(t) for t in texts]
        known, fresh = self.known, self._look_up(set(chain.from_iterable(cut)))
        before = len(known)
        known.update(fresh)
        out = []
        for text, stretches in zip(texts, cut, strict=True):
            raw = b"".join(map(known.__getitem__, stretches))
            out.append((raw, *self.offsets(text, np.frombuffer(raw, "<u4"))))
        full = before + len(fresh) > REMEMBERED
        for stretch in fresh:
            if full or len(stretch) > SHORT_CHARS:
                del known[stretch]
        return out


def decode_ids(tokens: list[bytes], ids: np.ndarray) -> bytes:
    """The bytes of a sequence of ids."""
    return b"".join([tokens[i] for i in ids.tolist()])


def pieces_of(tokens: list[bytes], ids: np.ndarray) -> list[str]:
    """The text of each token; a character split among tokens belongs to the one that ends it.

    Joined, the pieces are the text. Bytes that are no UTF-8, as of a sequence cut inside a character,
    become U+FFFD.
    """
    reader = codecs.getincrementaldecoder("utf-8")("replace")
    pieces = [reader.decode(tokens[i]) for i in ids.tolist()]
    if pieces:
        pieces[-1] += reader.decode(b"", True)
    return pieces


def _version(ranks: dict[bytes, int]) -> int:
    return zlib.crc32(repr(sorted(ranks.items())).encode())


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays) if arrays else np.empty(0, np.int32), pa.int32()))


def _encode(batches: Iterator[pa.RecordBatch], sent, pattern: str) -> Iterator[pa.RecordBatch]:
    encoder = worker_state("byte_bpe", lambda: Encoder(sent.value[1], pattern), (sent.value[0], pattern), ("byte_tokens",))
    for batch in batches:
        sizes = pc.binary_length(batch.column(1)).fill_null(0).to_pylist()
        for at, stop in slices(sizes, CALL_CHARS):
            part = batch.slice(at, stop - at)
            found = encoder.encode([t or "" for t in part.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([len(starts) for _, starts, _ in found], pa.int64()),
                    pa.array([ids for ids, _, _ in found], pa.binary()),
                    _lists([starts for _, starts, _ in found]),
                    _lists([ends for _, _, ends in found]),
                ],
                names=["doc_id", "n_tokens", "ids", "starts", "ends"],
            )


def encode(docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit), starts and ends of the tokens of every whole text.

    Each match of ``pattern`` is encoded separately, by the library over batches of texts, without special
    tokens. Starts and ends are code points; a token that holds a part of a character spans all of it.

    Null texts count as empty and have no tokens; repeated rows come back one by one, null ids as null; an empty
    table gives an empty result; other columns are not read. Texts are encoded in stretches
    that give the same tokens (see ``Encoder``). Nothing is shuffled; the ranks, of fixed size, are sent to
    each executor once.
    """
    ranks = read_ranks(ranks_path)
    sent = docs.sparkSession.sparkContext.broadcast((_version(ranks), ranks))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids binary, starts array<int>, ends array<int>"
    return rows.mapInArrow(partial(_encode, sent=sent, pattern=pattern), schema)


def _decode(batches: Iterator[pa.RecordBatch], sent, with_pieces: bool) -> Iterator[pa.RecordBatch]:
    tokens = worker_state("byte_tokens", lambda: token_bytes(sent.value[1]), sent.value[0], ("byte_bpe",))
    for batch in batches:
        column = batch.column("ids")
        sizes = pc.binary_length(column).fill_null(0).to_pylist()
        for at, stop in slices(sizes, 2 * CALL_CHARS):
            part = batch.slice(at, stop - at)
            ids = [np.frombuffer(i, dtype="<u4") if i else np.empty(0, "<u4") for i in part.column("ids").to_pylist()]
            made = [*part.columns, pa.array([decode_ids(tokens, i) for i in ids], pa.binary())]
            if with_pieces:
                made.append(pa.array([pieces_of(tokens, i) for i in ids], pa.list_(pa.string())))
            yield pa.RecordBatch.from_arrays(made, names=[*part.schema.names, "decoded", "pieces"][: len(made)])


def decode(encoded: DataFrame, ranks_path: str, pieces: bool = False) -> DataFrame:
    """All rows and columns of ``encoded`` with ``decoded``, the bytes of its ``ids``, and if asked the ``pieces`` of text of each token.

    Ids may come from anywhere, so the bytes need not be whole characters; see ``pieces_of`` for
    characters split among tokens. Null ids give no bytes. An id that the ranks lack fails the task.
    Columns named ``decoded`` or ``pieces`` are replaced.
    """
    ranks = read_ranks(ranks_path)
    spelled = {word: ranks[token] for token, word in spellings(ranks).items()}
    sent = encoded.sparkSession.sparkContext.broadcast((_version(ranks), spelled))
    rows = encoded.drop("decoded", "pieces")
    added = [("decoded", "binary")] + ([("pieces", "array<string>")] if pieces else [])
    schema = ", ".join(f"`{name}` {kind}" for name, kind in [*((f.name, f.dataType.simpleString()) for f in rows.schema), *added])
    return rows.mapInArrow(partial(_decode, sent=sent, with_pieces=pieces), schema)

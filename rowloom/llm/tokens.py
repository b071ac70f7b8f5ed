"""Token counts by a piece vocabulary, with a shortcut for strings that are one token."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import worker_state

# Pre-tokens whose count a worker remembers; others are merged anew.
REMEMBERED = 900_000
_BLANK = "▁"
_RUNS = re.compile(r" *[^ ]+| +")


def whole_tokens(path: str) -> tuple[frozenset[str], frozenset[str]]:
    """Vocabulary strings proven to encode alone as one token: behind a blank, and without one.

    The library itself encodes each candidate. Also proves what the pre-tokens rest on, and raises
    if the vocabulary does not allow it: in no piece does a blank follow another character, and no
    piece holds a line end, so no merge crosses the place before a blank or beside a line end; blanks and line ends are kept as they are, and one blank is
    put before a text.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    names = [model.id_to_piece(i) for i in range(size)]
    special = {i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)}
    usual = {names[i]: i for i in range(size) if i not in special}
    if any(_BLANK in p.lstrip(_BLANK) or "\n" in p for p in usual):
        raise ValueError("pieces of this vocabulary cross blanks or line ends")
    line = model.encode("\n")
    if "".join(model.encode(" a  b \u00a0\ufb01 c ", out_type=str)) != f"{_BLANK * 2}a{_BLANK * 2}b{_BLANK}\u00a0\ufb01{_BLANK}c{_BLANK}":
        raise ValueError("this vocabulary changes texts")
    if len(line) != 2 or model.id_to_piece(line[0]) != _BLANK:
        raise ValueError("a line end must be one token")
    behind = [p[1:] for p in usual if p.startswith(_BLANK) and _BLANK not in p[1:]]
    proven = frozenset(p for p, ids in zip(behind, model.encode(behind), strict=True) if p and ids == [usual[_BLANK + p]])
    alone = [p for p in usual if _BLANK not in p]
    found = model.encode(["\n" + p for p in alone])
    return proven, frozenset(p for p, ids in zip(alone, found, strict=True) if ids == [*line, usual[p]])


class PieceCounts:
    """Numbers of tokens of whole texts, equal to the library's.

    A text is cut before blanks and beside line ends into pre-tokens. Those proven to be whole tokens
    count one; the others are merged by the library, each distinct one once per worker and batch.
    """

    def __init__(self, path: str, proven: tuple[frozenset[str], frozenset[str]]):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.behind = dict.fromkeys(proven[0], 1) | {"": 1}
        self.alone = dict.fromkeys(proven[1], 1) | {"": 0}
        self.line = len(self.model.encode("\n"))

    def _words(self, text: str) -> list[str]:
        """Pre-tokens without the first of their blanks. Texts get a blank in front."""
        text = text.replace(_BLANK, " ") if _BLANK in text else text
        if "  " in text or text[:1] == " " or text[-1:] == " ":
            return [run[1:] for run in _RUNS.findall(" " + text)]
        return text.split(" ")

    def _lookup(self, known: dict, lines: str, keys: list[str], extra: int) -> dict[str, int]:
        """The counts of ``keys`` that ``known`` does not hold; keeps them while there is room."""
        missing = [k for k in set(keys) if k not in known]
        found = dict(zip(missing, (len(ids) - extra for ids in self.model.encode([lines + k for k in missing], num_threads=1)), strict=True))
        if len(known) + len(found) <= REMEMBERED:
            known.update(found)
        return found

    def counts(self, texts: list[str]) -> list[int]:
        words, heads, tails, ends = [], [], [], [0]
        for text in texts:
            parts = self._words(text) if text else []
            for part in parts:
                if "\n" in part:
                    head, *rest = part.split("\n")
                    heads.append(head)
                    tails.extend((len(words), r) for r in rest)
                    words.append(head)
                else:
                    words.append(part)
            ends.append(len(words))
        behind, alone = self.behind, self.alone
        fresh = self._lookup(behind, "", words, 0)
        numbers = np.fromiter((behind.get(w) or fresh[w] for w in words), dtype=np.int64, count=len(words))
        if tails:
            fresh = self._lookup(alone, "\n", [t for _, t in tails], self.line)
            at = np.fromiter((i for i, _ in tails), dtype=np.int64, count=len(tails))
            more = np.fromiter(((alone[t] if t in alone else fresh[t]) + 1 for _, t in tails), dtype=np.int64, count=len(tails))
            np.add.at(numbers, at, more)
        sums = np.concatenate(([0], np.cumsum(numbers)))
        return (sums[ends[1:]] - sums[ends[:-1]]).tolist()


def _count(batches: Iterator[pa.RecordBatch], path: str, proven) -> Iterator[pa.RecordBatch]:
    counter = worker_state("piece_counts", lambda: PieceCounts(path, proven.value))
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            texts = [t or "" for t in part.column(1).to_pylist()]
            numbers = pa.array(counter.counts(texts), pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), numbers], names=["doc_id", "n_bytes", "n_tokens"])


def count_tokens(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of every row, whole texts, without begin or end tokens.

    Null texts count as empty: no bytes, no tokens. Repeated rows come back one by one, an empty
    table gives an empty result, other columns are not read. Nothing is shuffled; the proven
    strings, at most the vocabulary, are sent to each executor once.
    """
    proven = docs.sparkSession.sparkContext.broadcast(whole_tokens(vocabulary))
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes")
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), size)
    return rows.mapInArrow(partial(_count, path=vocabulary, proven=proven), "doc_id bigint, n_bytes bigint, n_tokens bigint")

"""Names of a dictionary masked in one reading of each text, by an automaton of all names."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

MASK = "[name]"


def _in_word(character: str) -> bool:
    """Whether it is a letter, a number or an underscore, as in ``text.NAME_WORD``."""
    return character == "_" or unicodedata.category(character)[0] in "LN"


def automaton(names: list[str]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for name in names:
        found.add_word(name)
    found.make_automaton()
    return found


def masked(text: str, names: ahocorasick.Automaton) -> str:
    """Names that no letter, digit or underscore touches become ``MASK``: the leftmost first, of those the longest."""
    ends: dict[int, int] = {}
    for last, length in names.iter(text):
        start, end = last + 1 - length, last + 1
        if (start == 0 or not _in_word(text[start - 1])) and (end == len(text) or not _in_word(text[end])):
            ends[start] = max(end, ends.get(start, 0))
    out, at = [], 0
    for start in sorted(ends):
        if start >= at:
            out += [text[at:start], MASK]
            at = ends[start]
    return "".join([*out, text[at:]]) if out else text


def masker(spark: SparkSession, names: list[str]):
    """``masked`` by these names as a Spark function; NULL stays NULL. The names go to each executor once."""
    shared = spark.sparkContext.broadcast(names)

    @F.arrow_udf("string")
    def mask(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held = automaton(shared.value)
        for texts in batches:
            yield pa.array((None if t is None else masked(t, held) for t in texts.to_pylist()), pa.string())

    return mask.asNondeterministic()

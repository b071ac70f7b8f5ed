"""Spelling variants of words: words one edit apart, found by pivotal grams, and the forms they lead to."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import empty_if_null
from rowloom.session import materialise

# Fixed value: the letters that runs are made of.
RUN = r"[A-Za-zÀ-ÿ]+"
LEAST_LETTERS = 5
LEAST_COUNT = 3
# Grams of a word's prefix: two for the one edit that may hit them, and one that it cannot.
PREFIX = 3
# Most distinct grams that are sent to every task: those of an alphabet of 1,000 letters.
MOST_GRAMS = 1_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and run: every maximal run of letters of whole texts, with A-Z in lower case. Null texts have none."""
    lower = F.translate(empty_if_null(F.col(text)), *_LOWER)
    return docs.select(F.col(doc_id).alias("doc_id"), F.explode(F.regexp_extract_all(lower, F.lit(f"({RUN})"), F.lit(1))).alias("run"))


def misspelled(doc_id: Column, run: Column, every: int = 97) -> Column:
    """``run``, in one of ``every`` cases by a hash of document and run without one of its letters. A null id counts as empty."""
    h = F.crc32(F.encode(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run), "UTF-8"))
    at = F.pmod(h, F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(F.pmod(h, F.lit(every)) == 0, cut).otherwise(run)


def counted(found: DataFrame, word: str = "word", least: int = LEAST_COUNT, letters: int = LEAST_LETTERS) -> DataFrame:
    """word and n of the words of at least ``letters`` letters that occur at least ``least`` times."""
    long = found.where(F.length(word) >= letters)
    return long.groupBy(F.col(word).alias("word")).agg(F.count("*").alias("n")).where(F.col("n") >= least)


def gram_ranks(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The grams of all words, sorted, and how many words' places hold each: one row per pair of letters."""
    places = F.sequence(F.lit(1), F.length("word") - 1)
    grams = words.select(F.explode(F.transform(places, lambda i: F.substring("word", i, F.lit(2)))).alias("gram"))
    found = grams.groupBy("gram").agg(F.count("*").alias("n")).limit(MOST_GRAMS + 1).collect()
    if len(found) > MOST_GRAMS:
        raise ValueError(f"over {MOST_GRAMS} pairs of letters: these are no words of an alphabet")
    pairs = sorted((ord(g) << 32 | ord(h), r["n"]) for r in found for g, h in [r["gram"]])
    return np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)


def two_pivots(places: np.ndarray, costs: np.ndarray) -> np.ndarray:
    """Per word, which two of its prefix grams are its pivots: no letter in common, and together the rarest.

    ``places`` and ``costs`` are (words, grams), by place. Dynamic programming from left to right: with
    ``one[j]`` the cheapest gram up to j, the best pair that ends with j is j and the cheapest of those
    that end before it begins. Of equal pairs the one further left is taken.
    """
    n, m = places.shape
    one = np.zeros((n, m), np.int64)
    for j in range(1, m):
        better = costs[np.arange(n), one[:, j - 1]] > costs[:, j]
        one[:, j] = np.where(better, j, one[:, j - 1])
    best, cost = np.zeros((n, 2), np.int64), np.full(n, np.iinfo(np.int64).max)
    for j in range(1, m):
        # Grams at neighbouring places share a letter.
        before = j - 1 - (places[:, j] - places[:, j - 1] < 2)
        first = one[np.arange(n), np.maximum(before, 0)]
        total = np.where(before >= 0, costs[np.arange(n), first] + costs[:, j], np.iinfo(np.int64).max)
        better = total < cost
        best[better] = np.stack([first, np.full(n, j)], axis=1)[better]
        cost = np.minimum(cost, total)
    return best


def _signatures(batches: Iterator[pa.RecordBatch], sent, pivots: bool) -> Iterator[pa.RecordBatch]:
    """Rows that must agree in ``key`` and ``size`` for two words to be one edit apart: those of pivots, or of prefixes.

    An edit that leaves a gram whole lies on one side of it. So the words agree up to the gram's end, or from its start on,
    and the key is a hash of that side; ``size`` is the length of the word looked for.
    """
    grams, counts = sent.value
    order = np.lexsort((grams, counts))
    rank_of = np.empty(len(grams), np.int64)
    rank_of[order] = np.arange(len(grams))
    for batch in batches:
        for at in range(0, batch.num_rows, 20_000):
            part = batch.slice(at, 20_000)
            words = part.column(0).to_pylist()
            if not words:
                continue
            points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(sizes)
            starts = ends - sizes
            owner = np.repeat(np.arange(len(words)), sizes)
            place = np.arange(len(points)) - starts[owner]
            # Hashes of the letters up to each place, and from it on, both counted from that end of the word.
            powers = np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(int(sizes.max()), _BASE))))
            letter = points * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9)
            ahead = np.cumsum(letter * powers[place])
            behind = np.cumsum((letter * powers[sizes[owner] - 1 - place])[::-1])[::-1]
            upto = ahead - np.where(starts > 0, ahead[starts - 1], 0)[owner].astype(np.uint64)
            onwards = behind - np.where(ends < len(points), behind[np.minimum(ends, len(points) - 1)], 0)[owner].astype(np.uint64)
            # Grams in the order of rank, then place, per word; the first ones are its prefix.
            gram = np.flatnonzero(place < sizes[owner] - 1)
            number = np.searchsorted(grams, (points[gram] << np.uint64(32) | points[gram + 1]).astype(np.int64))
            rank = rank_of[number]
            sort = np.lexsort((place[gram], rank, owner[gram]))
            gram, rank, number = gram[sort], rank[sort], number[sort]
            first = starts - np.arange(len(words))
            last = rank[first + PREFIX - 1]
            if pivots:
                three = first[:, None] + np.arange(PREFIX)
                three = np.take_along_axis(three, np.argsort(place[gram[three]], axis=1), axis=1)
                two = np.take_along_axis(three, two_pivots(place[gram[three]], counts[number[three]]), axis=1)
                # The left pivot stays whole if the edit is behind it, else the right one does and the edit is before it.
                use, side = two.reshape(-1), np.tile([0, 1], len(words))
            else:
                # Grams level with the last of the prefix belong to it.
                held = np.flatnonzero(rank <= last[owner[gram]])
                use, side = np.repeat(held, 2), np.tile([0, 1], len(held))
            here = gram[use]
            key = np.where(side == 0, upto[here + 1], onwards[here] ^ np.uint64(0x5851F42D4C957F2D)).astype(np.int64)
            who, size = owner[here], sizes[owner[here]]
            if pivots:
                key, who, size = np.repeat(key, 3), np.repeat(who, 3), np.repeat(size, 3) + np.tile([-1, 0, 1], len(size))
            picked = part.take(pa.array(who))
            yield pa.RecordBatch.from_arrays(
                [*picked.columns, pa.array(last[who]), pa.array(key), pa.array(size, pa.int32())], names=["word", "n", "last", "key", "size"]
            )


def near_words(words: DataFrame) -> DataFrame:
    """Each pair of words (columns ``word``, distinct, and ``n``) that differ by one inserted, deleted or replaced letter, once.

    Grams, pairs of neighbouring letters, are ordered from rare to frequent. A word's prefix are its three first grams, which
    hold two without a letter in common: the pivots, the rarest such pair by ``two_pivots``. One edit hits
    at most one of them, so of two near words the one whose prefix ends first has a pivot in the other's prefix; and at
    the same place, counted from the side of the word that the edit leaves whole. Pairs that agree
    there and differ by at most one in length are compared.

    Returns a, n_a, b, n_b in no set order. Words are of at least four letters, which is what three grams take; others raise an error.
    An empty table has no pairs. The index is one row per word and prefix gram, the search six
    rows per word; they meet by an equi-join that skew handling can split.
    """
    short = F.raise_error(F.lit("words of fewer than four letters have no three grams"))
    checked = words.select(F.when(F.length("word") > PREFIX, F.col("word")).otherwise(short).alias("word"), F.col("n").cast("bigint").alias("n"))
    checked = materialise(checked, "words")
    sent = words.sparkSession.sparkContext.broadcast(gram_ranks(checked))
    schema = "word string, n bigint, last bigint, key bigint, size int"
    search = checked.mapInArrow(partial(_signatures, sent=sent, pivots=True), schema)
    index = checked.mapInArrow(partial(_signatures, sent=sent, pivots=False), schema)
    search = search.select(F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("last").alias("last_a"), "key", "size")
    index = index.select(F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("last").alias("last_b"), "key", "size")
    met = search.join(index, ["key", "size"]).where((F.col("last_a") <= F.col("last_b")) & (F.col("a") != F.col("b")))
    near = met.where(F.levenshtein("a", "b", 1) == 1)
    ordered = near.select(
        F.least("a", "b").alias("a"),
        F.when(F.col("a") < F.col("b"), F.col("n_a")).otherwise(F.col("n_b")).alias("n_a"),
        F.greatest("a", "b").alias("b"),
        F.when(F.col("a") < F.col("b"), F.col("n_b")).otherwise(F.col("n_a")).alias("n_b"),
    )
    return ordered.distinct()


def roots(links: DataFrame) -> DataFrame:
    """word and root: where the links of ``links`` (word, form; no cycles) lead in the end.

    Each round doubles the distance that a word has gone; words whose target has no link are done.
    """
    state = materialise(links.select("word", F.col("form").alias("at")), "roots")
    while True:
        ahead = state.select(F.col("word").alias("at"), F.col("at").alias("next"))
        moved = materialise(state.join(ahead, "at", "left").select("word", F.coalesce("next", "at").alias("at"), F.col("next").isNotNull().alias("open")), "roots")
        if not moved.where("open").limit(1).count():
            return moved.select("word", F.col("at").alias("root"))
        state = moved.select("word", "at")


def variants(words: DataFrame, ratio: float = 2.0) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word: what it is most likely a spelling of.

    ``words`` has ``word`` (distinct) and ``n``. A word's form is its near word (see ``near_words``) of the
    largest n, of equals the first in code-point order, if that n is at least ``ratio`` times the word's own;
    else null. ``ratio`` above 1 keeps forms free of cycles. The root is where forms lead, the word itself if nowhere.
    """
    words = materialise(words, "words")
    pairs = materialise(near_words(words), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("m")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("m"))
    )
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), F.col("other").alias("form"))).alias("best"))
    found = words.join(best, "word", "left")
    led = -F.col("best.m") >= F.col("n") * ratio
    formed = materialise(
        found.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(led, F.col("best.form")).alias("form"), F.when(led, -F.col("best.m")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(formed.where(F.col("form").isNotNull()).select("word", "form"))
    rows = formed.join(ends, "word", "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

"""Spelling correction against a vocabulary.

Values within a few edits of a word meet it by equi-joins on signatures: on the text with one
character less at distance 1, and on pieces of the word beyond. Only values that are
far from every word, or too short for pieces, are compared with whole lengths of words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.session import materialise

# Most words of one length that a row of the vocabulary holds.
BLOCK_WORDS = 512
# Most vocabulary rows that are broadcast.
BROADCAST_BLOCKS = 2_000
# Distances that are tried one after the other by pieces of words, and the least characters of a piece.
PIECE_EDITS = (2, 4, 8)
PIECE_CHARS = 3
# Up to this many vocabulary rows every value is compared with whole lengths of words at once.
SCAN_BLOCKS = 16


def _blocks(words: DataFrame) -> DataFrame:
    """The words in rows of about ``BLOCK_WORDS`` of one length: ``length, words``."""
    sized = words.withColumn("length", F.length("word"))
    sizes = sized.groupBy("length").agg(F.ceil(F.count("*") / BLOCK_WORDS).cast("int").alias("blocks"))
    return (
        sized.join(sizes, "length")
        .groupBy("length", F.pmod(F.xxhash64("word"), F.col("blocks")).alias("block"))
        .agg(F.collect_list("word").alias("words"))
        .drop("block")
    )


def _best_of_words() -> Column:
    return F.array_min(
        F.transform("words", lambda w: F.struct(F.levenshtein("value", w).alias("dist"), w.alias("best")))
    )


def _best_per_value(joined: DataFrame) -> DataFrame:
    return joined.select("value", _best_of_words().alias("match")).groupBy("value").agg(F.min("match").alias("match"))


def _one_less(text: Column) -> Column:
    """The text and all texts made by deleting one character."""
    cut = F.transform(
        F.sequence(F.lit(1), F.length(text)), lambda i: F.concat(F.left(text, i - 1), F.substr(text, i + 1))
    )
    return F.array_distinct(F.concat(F.array(text), F.when(F.length(text) > 0, cut).otherwise(F.array().cast("array<string>"))))


def _within_one(values: DataFrame, words: DataFrame) -> DataFrame:
    """``value, match`` for values at most one edit from a word, and for some at two.

    Texts one edit apart become equal when each loses at most one character, so all matches at
    distance 0 and 1 meet in an equi-join. The words that share such a remainder differ by one
    character inserted somewhere, which bounds their number.
    """
    by_rest = (
        words.select("word", F.explode(_one_less(F.col("word"))).alias("rest"))
        .groupBy("rest")
        .agg(F.collect_list("word").alias("words"))
    )
    probes = values.select("value", F.explode(_one_less(F.col("value"))).alias("rest"))
    return _best_per_value(probes.join(by_rest, "rest"))


def _piece_start(i: Column, length: Column, edits: int) -> Column:
    """Where piece ``i`` of ``edits`` + 1 of a word of ``length`` begins: equal pieces, the last ones longer by one."""
    even = F.lit(edits + 1) - length % (edits + 1)
    return i * F.floor(length / (edits + 1)) + F.greatest(F.lit(0), i - even)


def _long_enough(length: Column, edits: int) -> Column:
    """Of a value's length: every word within ``edits`` has pieces of ``PIECE_CHARS`` characters."""
    return length - edits >= PIECE_CHARS * (edits + 1)


def _within(values: DataFrame, words: DataFrame, edits: int) -> DataFrame:
    """``value, match`` for each value that is at most ``edits`` from a word, the best word of all.

    A word is cut into ``edits`` + 1 pieces. One of them stands unchanged in any text within
    that many edits, at a place shifted by no more than the edits before it, and no fewer than the difference
    in length less the edits after it leave (published as partition-based similarity joins). So each value
    probes, per length of word, few substrings for each piece, and matches are verified.
    """
    pieces = F.sequence(F.lit(0), F.lit(edits))
    length = F.length("word")

    def piece(i: Column) -> Column:
        start = _piece_start(i, length, edits)
        return F.struct(
            length.cast("bigint").alias("length"),
            i.cast("bigint").alias("piece"),
            F.substr("word", (start + 1).cast("int"), (_piece_start(i + 1, length, edits) - start).cast("int")).alias("gram"),
        )

    indexed = words.where(length >= PIECE_CHARS * (edits + 1)).select("word", F.inline(F.transform(pieces, piece)))

    sizes = values.select("value", F.explode(F.sequence(F.lit(-edits), F.lit(edits))).alias("less")).select(
        "value", F.length("value").cast("bigint").alias("n"), (F.length("value") - F.col("less")).cast("bigint").alias("length")
    )
    # The second explode gives one row per piece, the third one per place.
    by_piece = sizes.select("*", F.explode(pieces).alias("i")).withColumns(
        {"start": _piece_start(F.col("i"), F.col("length"), edits), "end": _piece_start(F.col("i") + 1, F.col("length"), edits)}
    )
    shift, after = F.col("n") - F.col("length"), edits - F.col("i")
    size = F.col("end") - F.col("start")
    low = F.greatest(F.lit(0), F.col("start") - F.col("i"), F.col("start") + shift - after)
    high = F.least(F.col("n") - size, F.col("start") + F.col("i"), F.col("start") + shift + after)
    probes = (
        by_piece.withColumns({"low": low, "high": high})
        .where("low <= high")
        .select("value", "length", F.col("i").cast("bigint").alias("piece"), size.alias("size"), F.explode(F.sequence("low", "high")).alias("at"))
        .select("value", "length", "piece", F.substr("value", (F.col("at") + 1).cast("int"), F.col("size").cast("int")).alias("gram"))
    )
    dist = F.levenshtein("value", "word", edits)
    return (
        probes.join(indexed, ["length", "piece", "gram"])
        .select("value", F.struct(dist.alias("dist"), F.col("word").alias("best")).alias("match"))
        .where("match.dist >= 0")
        .groupBy("value")
        .agg(F.min("match").alias("match"))
    )


def _of_length(probes: DataFrame, blocks: DataFrame, salts: int) -> DataFrame:
    """Best match of each ``(value, length)`` probe among the words of that length: ``value, match``.

    ``salts`` 0 broadcasts the blocks; else each length is spread over that many join keys.
    """
    if not salts:
        return _best_per_value(probes.join(F.broadcast(blocks), "length"))
    spread = blocks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = probes.withColumn("salt", F.pmod(F.xxhash64("value"), F.lit(salts)).cast("int"))
    return _best_per_value(salted.join(spread, ["length", "salt"]))


def fuzzy_correct(
    df: DataFrame,
    column: str,
    vocabulary: DataFrame,
    word: str,
    broadcast_blocks: int = BROADCAST_BLOCKS,
    scan_blocks: int = SCAN_BLOCKS,
) -> DataFrame:
    """Add ``best`` and ``dist``: the vocabulary word of least edit distance, ties by name.

    Each distinct value is looked up once. With a large vocabulary, values within one edit of a
    word are settled by an equi-join, and then, as the allowed distance grows, those within it by
    equi-joins on pieces of words. What remains (values far from every word, and short ones) meets the words
    of the nearest length, and then those of each length that differs by no more than the distance found,
    since a difference in length is a lower bound of the distance.
    """
    words = materialise(
        vocabulary.select(F.col(word).alias("word")).where(F.col(word).isNotNull()).distinct(), "vocabulary"
    )
    blocks = materialise(_blocks(words), "vocabulary-blocks")
    n_blocks = blocks.count()
    if not n_blocks:
        return df.withColumn("best", F.lit(None).cast("string")).withColumn("dist", F.lit(None).cast("int"))
    salts = 0 if n_blocks <= broadcast_blocks else 64
    values = df.select(F.col(column).alias("value")).where(F.col(column).isNotNull()).distinct()
    settled = []
    if n_blocks > scan_blocks:
        values = materialise(values, "values")
        settled = [materialise(_within_one(values, words).where("match.dist <= 1"), "within-one")]
        values = materialise(values.join(settled[0], "value", "left_anti"), "values")
        for edits in PIECE_EDITS:
            probing = values.where(_long_enough(F.length("value"), edits))
            if probing.isEmpty():
                break
            settled.append(materialise(_within(probing, words, edits), f"within-{edits}"))
            values = materialise(values.join(settled[-1], "value", "left_anti"), "values")

    # As many entries as the vocabulary has different word lengths.
    known = F.array(*[F.lit(n) for n in sorted(row[0] for row in blocks.select("length").distinct().collect())])

    def gap(n: Column) -> Column:
        return F.abs(n - F.length("value"))

    closest = F.array_min(F.transform(known, lambda n: F.struct(gap(n).alias("gap"), n.alias("n"))))["n"]
    first = materialise(_of_length(values.withColumn("length", closest), blocks, salts), "first-match")
    reachable = F.filter(known, lambda n: (gap(n) <= F.col("match.dist")) & (n != closest))
    later = first.select("value", F.explode(reachable).alias("length"))
    found = first.unionByName(_of_length(later, blocks, salts)).groupBy("value").agg(F.min("match").alias("match"))
    for done in settled:
        found = found.unionByName(done)
    # Written first, so that Spark knows its size and need not shuffle ``df`` for a small one.
    best = materialise(
        found.select(F.col("value").alias(column), F.col("match.best").alias("best"), F.col("match.dist").alias("dist")),
        "corrections",
    )
    return df.join(best, column, "left")

"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.common import before_cut, copies_of, empty_if_null, row_key, small, uniform, weighted_cut
from rowloom.session import materialise

# Most copies of a document in a mix.
MOST_COPIES = 3
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """The number of words of a text; null has none."""
    return F.regexp_count(empty_if_null(text), F.lit(WORD)).cast("long")


def targets(sources: DataFrame, weight: Column, budget: Column, most: int = MOST_COPIES) -> DataFrame:
    """Share ``budget`` among sources by weight, none above ``most`` times its size.

    ``sources`` has one row per source with ``source_size``; adds ``target``. With sources in order of
    cap per unit of weight, those that reach their cap come first, and the level of the others
    follows from what is left. That is where resharing the excess by weight again and again ends.
    """
    ready = sources.withColumn("__w", weight.cast("double")).withColumn("__cap", F.col("source_size") * F.lit(float(most)))
    ready = ready.withColumn("__t", budget.cast("double")).withColumn("__r", F.col("__cap") / F.col("__w"))
    # One row per source goes through these windows.
    before = Window.orderBy("__r", "source").rowsBetween(Window.unboundedPreceding, -1)
    onwards = Window.orderBy("__r", "source").rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("__t") - F.coalesce(F.sum("__cap").over(before), F.lit(0.0))) / F.sum("__w").over(onwards)
    levels = ready.withColumn("__level", level)
    found = F.min(F.when(F.col("__level") <= F.col("__r"), F.struct("__r", "__level"))).over(Window.partitionBy())["__level"]
    target = F.least(F.col("__cap"), F.coalesce(F.col("__w") * found, F.col("__cap")))
    return levels.withColumn("target", target).drop("__w", "__cap", "__t", "__r", "__level")


def _levels(rows: DataFrame, shares: DataFrame) -> DataFrame:
    """Per source (``place``) the factor by which weights become expected copies: none above the most, words near the target.

    The factor is what the target leaves beside the documents at the most, by the weighted words of the others.
    Each pass adds the documents that the last factor lifts to the most; the passes end when none is added.
    """
    none = F.lit(None).cast("double")
    state = small(shares.select("place", "target", none.alias("level"), F.lit(0).cast("long").alias("full"), F.lit(False).alias("done")), "mix-levels")
    able = F.col("weight") > 0
    while True:
        weighed = rows.join(state, "place")
        top = able & F.coalesce(F.col("weight") * F.col("level") >= MOST_COPIES, F.lit(False))
        sums = weighed.groupBy("place").agg(
            F.first("target").alias("target"), F.first("full").alias("before"), F.first("level").alias("last"), F.count_if(top).alias("full"),
            F.sum(F.when(top, F.col("size")).otherwise(0)).alias("at_most"), F.sum(F.when(able, F.col("size")).otherwise(0)).alias("able"),
            F.sum(F.when(top, 0.0).otherwise(F.col("weight") * F.col("size"))).alias("open"),
        )
        whole = (F.col("at_most") > 0) | (F.col("target") >= MOST_COPIES * F.col("able") * (1 - 1e-9))
        level = F.when((F.col("open") > 0) & ((F.col("at_most") > 0) | ~whole), F.greatest(F.lit(0.0), (F.col("target") - MOST_COPIES * F.col("at_most")) / F.col("open")))
        level = level.when(whole & (F.col("able") > 0), F.lit(float("inf"))).otherwise(0.0)
        settled = F.col("last").isNotNull() & (F.col("full") <= F.col("before")) | (level == float("inf"))
        state = small(sums.select("place", "target", level.alias("level"), "full", settled.alias("done")), "mix-levels")
        if not state.where(~F.col("done")).limit(1).count():
            return state.select("place", "level")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weight: str | None = None, seed: int = 17) -> DataFrame:
    """How often each document goes into a mix that holds each source near its target of words.

    Sources in order of code points, null last, weigh 1, 2, 3 in turn and share the words of the whole
    corpus; see ``targets`` for their caps. ``weight``, a column, makes documents of a source
    more or less likely (null or not above 0: never); without it those of a source are equally likely.

    A document's expected copies are its weight times a factor of its source, at most 3; with the factor
    the expected words are the source's target, as far as documents with a weight can give it. Documents without words
    are taken in whole copies only. Their whole
    part is certain. Of the rest, the inclusion probability p, the documents are ranked by the random
    odds u / (1 - u) divided by the inclusion odds p / (1 - p), and taken in that order until the
    source has the words that its target still lacks, as near as whole documents allow; u is a hash of
    id and text, so reruns agree.

    Returns one row per input row: ``key`` (see ``row_key``), doc_id, source, size (words, null text
    0), source_size, target, copies. Rows equal in id, source and text are told apart by a counter, so
    repeated rows may get different numbers of copies. An empty table gives an empty result;
    other columns of the input are not read.
    """
    tall = F.col(weight).cast("double") if weight else F.lit(1.0)
    plain = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        row_key(F.col(doc_id), F.col(text), F.col(source)).alias("key"),
        F.when(tall > 0, tall).otherwise(0.0).alias("weight"),
    )
    # Equal rows are counted before the shuffle and numbered after it, so none of them is a hot key.
    rows = plain.groupBy("doc_id", "source", "size", "key", "weight").agg(F.count("*").alias("n"))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    rows = materialise(rows.drop("n").withColumn("u", uniform(F.lit(seed), "key", "copy")), "mix-rows")

    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    ranked = sizes.withColumn("__place", place).withColumn("__total", F.sum("source_size").over(Window.partitionBy()))
    shares = targets(ranked, F.pmod(F.col("__place") - 1, F.lit(3)) + 1, F.col("__total")).drop("__total")
    shares = small(shares.withColumnRenamed("__place", "place"), "mix-sources")

    named = shares.withColumnRenamed("source", "__source")
    joined = rows.join(named, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    joined = joined.join(_levels(joined.select("place", "weight", "size"), shares), "place")
    expected = F.when(F.col("weight") > 0, F.least(F.lit(float(MOST_COPIES)), F.col("weight") * F.col("level"))).otherwise(0.0)
    joined = joined.withColumn("whole", F.floor(expected + 1e-12)).withColumn("p", F.greatest(F.lit(0.0), expected - F.floor(expected + 1e-12)))
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    ranking = joined.withColumn("rank", F.when(F.col("p") > 0, odds / (1 + odds)))
    certain = ranking.groupBy("place").agg((F.first("target") - F.sum(F.col("whole") * F.col("size"))).alias("target"))
    open_rows = ranking.where((F.col("p") > 0) & (F.col("size") > 0)).select("place", "rank", "size")
    cut = small(weighted_cut(open_rows, ["place"], "rank", "size", certain), "mix-cut")
    chosen = ranking.join(cut, "place", "left")
    extra = F.coalesce(F.col("rank").isNotNull() & (F.col("size") > 0) & before_cut("rank"), F.lit(False)).cast("long")
    return chosen.select("key", "doc_id", "source", "size", "source_size", "target", (F.col("whole") + extra).alias("copies"))


def mixed(docs: DataFrame, **names) -> DataFrame:
    """The documents of the mix, each as often as ``mix`` says, with all columns of ``docs``.

    ``names`` as for ``mix``. Null texts have no words; rows equal in id, text and source, null or not, give
    their copies together, and which of their other columns stay is open. An empty table stays empty.
    """
    counts = mix(docs, **names).groupBy("key").agg(F.sum("copies").alias("n"))
    return copies_of(docs, counts, **{"source": "source"} | {k: v for k, v in names.items() if k in ("doc_id", "text", "source")})

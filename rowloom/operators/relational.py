"""Joins, counts, rankings and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowloom.functions.names import masker
from rowloom.functions.sql import create_table_function
from rowloom.functions.text import NAME_WORD, mask_listed


def purchase_location_function(
    spark: SparkSession,
    purchases: str,
    places: str,
    name: str = "purchase_location",
    n: int = 10,
    weight: str | None = None,
) -> None:
    """Create the table function ``name() -> (name, purchases)``: the ``n`` places bought most.

    ``purchases(destination_id)`` holds a row per purchase, or, with ``weight``, rows that stand
    for that many. Purchases are counted per place key before the join, so a place that holds a large share
    of them reaches the join as one row per input partition. Ties go by name.
    """
    counted = f"sum({weight})" if weight else "count(destination_id)"
    create_table_function(
        spark,
        name,
        "name STRING, purchases INTEGER",
        f"""SELECT place.name AS destination, sum(counted.n) AS total
            FROM (SELECT destination_id, {counted} AS n FROM {purchases} GROUP BY destination_id) counted
            JOIN {places} place ON counted.destination_id = place.destination_id
            GROUP BY place.name
            ORDER BY total DESC, place.name
            LIMIT {int(n)}""",
        "The places with the most purchases, most first.",
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """How often each value occurs, most frequent first; NULL is not counted."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "value")
    )


def confusion_matrix(df: DataFrame, truth: str, predicted: str, values: list | None = None) -> DataFrame:
    """Rows are true values, columns ``pred_<value>``, cells counts; rows with a NULL on either side do not count.

    Give ``values`` to fix the columns and save the job that looks for them; other predictions then count in ``pred_other``.
    """
    known = df.where(F.col(truth).isNotNull() & F.col(predicted).isNotNull())
    if values is not None:
        is_value = [F.col(predicted).eqNullSafe(F.lit(v)) for v in values]
        counts = [F.count_if(same).alias(f"pred_{v}") for v, same in zip(values, is_value)]
        other = F.count_if(~F.col(predicted).isin(*values)) if values else F.count("*")
        return known.groupBy(truth).agg(*counts, other.alias("pred_other"))
    cells = known.groupBy(truth).pivot(predicted).agg(F.count(F.lit(1))).na.fill(0)
    return cells.select(truth, *[F.col(f"`{c}`").alias(f"pred_{c}") for c in cells.columns if c != truth])


def latest_version(df: DataFrame, name: str, version: str, default: int | None = 1) -> DataFrame:
    """Highest version per name, compared as whole numbers; ``default`` for a name without one."""
    top = F.max(F.col(version).try_cast("long"))
    return df.groupBy(name).agg((top if default is None else F.coalesce(top, F.lit(default))).alias("latest"))


def latest_row(df: DataFrame, name: str, version: str, tie: str) -> DataFrame:
    """The whole row of the highest version per name."""
    newest = Window.partitionBy(name).orderBy(F.col(version).try_cast("long").desc_nulls_last(), tie)
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def hash_bucket(key: Column, buckets: int) -> Column:
    """A stable bucket number that depends on the key alone."""
    return F.conv(F.substr(F.md5(key.cast("string")), F.lit(1), F.lit(8)), 16, 10).cast("long") % buckets


def split_train_val(df: DataFrame, key: str, val_tenths: int = 2) -> DataFrame:
    """Add ``split``: ``val`` for that many tenths of the keys, else ``train``."""
    return df.withColumn("split", F.when(hash_bucket(F.col(key), 10) < val_tenths, "val").otherwise("train"))


def first_keys(df: DataFrame, key: str, n: int, *order: Column | str) -> DataFrame:
    """The rows of the ``n`` first keys in the given order; keys are unique and ``n`` is small.

    Keys alone are sorted, and the ``n`` found then pick their rows, so long rows do not move.
    """
    keys = df.select(key).orderBy(*order, key).limit(n)
    return df.join(F.broadcast(keys), key, "left_semi")


def stable_sample(df: DataFrame, key: str, one_in: int, n: int | None = None) -> DataFrame:
    """One key in ``one_in``, the same rows whatever the partitioning; then at most ``n``, lowest keys first."""
    drawn = df.where(hash_bucket(F.col(key), one_in) == 0)
    return drawn if n is None else first_keys(drawn, key, n)


def seeded_sample(df: DataFrame, fraction: float, seed: int, n: int | None = None) -> DataFrame:
    """Spark's own Bernoulli sample; which rows come depends on how the input is partitioned."""
    drawn = df.sample(fraction=fraction, seed=seed)
    return drawn if n is None else drawn.limit(n)


def union_sources(sources: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    """Frames of a common shape as one, each row marked with its ``origin``."""
    frames = [df.select(*columns, F.lit(origin).alias("origin")) for origin, df in sources.items()]
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def label_in_set(df: DataFrame, column: str, labels: list[str], out: str = "ok") -> DataFrame:
    return df.withColumn(out, F.array_contains(F.array(*[F.lit(x) for x in labels]), F.col(column)))


def exists_in(df: DataFrame, column: str, names: DataFrame, name: str) -> DataFrame:
    """The rows whose value occurs among ``names``, each once however often it occurs there."""
    return df.join(names.select(F.col(name).alias(column)), column, "left_semi")


def guard(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """``df`` itself, failing with ``message`` on the first row that breaks ``condition``."""
    return df.where(F.assert_true(condition, message).isNull())


# Characters of all names that one automaton holds, some 50 bytes each in a worker.
AUTOMATON_CHARS = 1_000_000


def mask_names(df: DataFrame, text: str, key: str, names: DataFrame, name: str, automaton_chars: int = AUTOMATON_CHARS) -> DataFrame:
    """``df`` with every name of a dictionary of any size masked in ``text`` by ``[name]``, longer names first.

    ``key`` is unique in ``df``. Names count as whole words; those without a letter or digit are left out. Up to
    ``automaton_chars`` characters of names go to each executor, and a text is read once; nothing is shuffled. With more, runs of as many
    words as names have meet the dictionary by an equi-join on the words, each distinct run of a text once, so only
    keys and short runs are shuffled; then a text is read once with the names found for it. Both give the same texts.
    """
    found_words = lambda c: F.regexp_extract_all(c, F.lit(NAME_WORD), F.lit(0))
    listed = names.select(F.col(name).alias("_name")).where(F.col("_name").isNotNull()).distinct()
    listed = listed.withColumn("_words", found_words(F.col("_name"))).where(F.size("_words") > 0)
    chars = listed.agg(F.sum(F.length("_name"))).first()[0] or 0
    if chars <= automaton_chars:
        return df.withColumn(text, masker(df.sparkSession, [row[0] for row in listed.select("_name").collect()])(text)) if chars else df
    widths = [row[0] for row in listed.select(F.size("_words")).distinct().sort(F.size("_words")).collect()]
    if not widths:
        return df
    listed = listed.select("_name", F.array_join("_words", " ").alias("_run"))
    rows = df.select(F.col(key).alias("_key"), found_words(F.col(text)).alias("_words"))
    runs = F.flatten(F.array(*[_runs(F.col("_words"), width) for width in widths]))
    asked = rows.select("_key", F.explode(F.array_distinct(runs)).alias("_run"))
    found = asked.join(listed, "_run").groupBy("_key").agg(F.collect_set("_name").alias("_names"))
    masked = df.join(found, F.col(key) == F.col("_key"), "left").withColumn(
        text, F.when(F.col("_names").isNull(), F.col(text)).otherwise(mask_listed(F.col(text), F.col("_names")))
    )
    return masked.select(*df.columns)


def _runs(words: Column, width: int) -> Column:
    """All runs of ``width`` neighbouring words, joined by blanks."""
    if width == 1:
        return words
    starts = F.when(F.size(words) >= width, F.sequence(F.lit(1), F.size(words) - width + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda at: F.array_join(F.slice(words, at, width), " "))

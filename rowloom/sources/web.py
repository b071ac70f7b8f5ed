"""Web pages: URL lists, page text, and extraction of articles."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowloom.functions import text as text_fn
from rowloom.session import materialise
from rowloom.sources.commits import CommittedTable


def sitemap_urls(sitemaps: DataFrame, xml: str = "xml", key: str = "sitemap_id", max_urls: int | None = None) -> DataFrame:
    """One row per URL of each sitemap file: ``key, pos, url``.

    ``max_urls`` keeps the first ones in the order of the files.
    """
    locations = F.xpath(F.col(xml), F.lit("//*[local-name()='loc']/text()"))
    urls = sitemaps.select(key, F.posexplode(locations).alias("pos", "url"))
    return urls if max_urls is None else urls.orderBy(key, "pos").limit(max_urls)


def fetch_from_archive(frontier: DataFrame, pages: DataFrame) -> DataFrame:
    """Each URL of the frontier with its stored page, or NULL where the archive has none.

    Versions are ranked without their pages, and only those of the frontier's URLs; then the pages of the newest are fetched.
    """
    asked = pages.select("url", "page_id").join(frontier.select("url"), "url", "left_semi")
    newest = asked.groupBy("url").agg(F.max("page_id").alias("page_id"))
    found = newest.join(pages.select("url", "page_id", "html"), ["url", "page_id"]).select("url", "html")
    return frontier.join(found, "url", "left")


class TooManyRequests(Exception):
    """Raised by a fetcher or a model when the service asks to slow down."""


def with_backoff(call: Callable, attempts: int = 3, wait: float = 3.0, sleep: Callable[[float], None] = time.sleep) -> Callable:
    """``call`` repeated up to ``attempts`` more times, each after a longer wait, when told to slow down."""

    def run(argument):
        for attempt in range(attempts + 1):
            try:
                return call(argument)
            except TooManyRequests:
                if attempt == attempts:
                    raise
                sleep(wait * 2**attempt)

    return run


def fetch_live(
    frontier: DataFrame,
    fetch: Callable[[str], str | None],
    out: str = "html",
    concurrency: int = 16,
    attempts: int = 3,
    wait: float = 3.0,
) -> DataFrame:
    """Add the page of each ``url``, by a fetcher the caller supplies; NULL when it fails.

    ``concurrency`` requests run at a time in each task, so the whole cluster makes
    ``tasks x concurrency``; choose both with the site in mind.
    """

    @F.arrow_udf("string")
    def pages(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        patient = with_backoff(fetch, attempts, wait)

        def one(url):
            if url is None:
                return None
            try:
                return patient(url)
            except Exception:  # any failure of one page is a missing page
                return None

        with ThreadPoolExecutor(concurrency) as pool:
            for urls in batches:
                yield pa.array(list(pool.map(one, urls.to_pylist())), pa.string())

    # Not deterministic, so that a later filter on the page does not fetch it again.
    return frontier.withColumn(out, pages.asNondeterministic()("url"))


# What a store of fetched pages holds; an outcome is ``page``, ``failed`` or ``later``.
FETCHED = "url STRING, host STRING, html STRING, outcome STRING, batch STRING"


def host_of(url: Column) -> Column:
    """The lower-case host of an address; empty if it names none."""
    return F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _ask_in_turns(fetch: Callable[[str], str | None], batch: str, pause: float, concurrency: int, sleep: Callable[[float], None]):
    """Fetches rows ``url, host, turn`` that come in order of turns: hosts of one turn side by side, turns at least ``pause`` apart."""

    def one(url: str) -> tuple[str | None, str]:
        try:
            page = fetch(url)
        except TooManyRequests:
            return None, "later"
        except Exception:  # any failure of one page is a missing page
            return None, "failed"
        return page, "failed" if page is None else "page"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, began, busy = None, 0.0, set()
        with ThreadPoolExecutor(concurrency) as pool:
            for rows in batches:
                for at in range(0, rows.num_rows, concurrency):
                    asked = rows.slice(at, concurrency).to_pylist()
                    while asked:
                        # As far as the turn goes; a host that asked to slow down is left alone for the round.
                        if asked[0]["turn"] != turn:
                            if turn is not None and pause:
                                sleep(max(0.0, began + pause - time.monotonic()))
                            turn, began = asked[0]["turn"], time.monotonic()
                        same = next((i for i, row in enumerate(asked) if row["turn"] != turn), len(asked))
                        now, asked = [row for row in asked[:same] if row["host"] not in busy], asked[same:]
                        found = list(pool.map(one, [row["url"] for row in now]))
                        busy.update(row["host"] for row, (_, outcome) in zip(now, found, strict=True) if outcome == "later")
                        made = [(row["url"], row["host"], *answer, batch) for row, answer in zip(now, found, strict=True)]
                        columns = list(zip(*made, strict=True)) or [()] * 5
                        names = ["url", "host", "html", "outcome", "batch"]
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=names)

    return run


def fetch_by_host(
    frontier: DataFrame,
    fetch: Callable[[str], str | None],
    store: CommittedTable,
    per_round: int = 100,
    pause: float = 1.0,
    attempts: int = 3,
    wait: float = 3.0,
    concurrency: int = 16,
    sleep: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """Add the page of each ``url`` as ``html``, fetched in rounds with one rate for each host; NULL when there is none.

    In a round a host is dealt to one task, whatever the size of the cluster, and asked for at most ``per_round`` pages, one
    at a time and at least ``pause`` seconds apart. A host with more pages takes more rounds, and holds up no other. One that raises
    ``TooManyRequests`` is left alone until the next round, which waits longer each time in a row; such a page is asked
    for up to ``attempts`` times more, others that fail are not. A round's outcomes are committed to ``store`` (schema
    ``FETCHED``) together, so a run that died goes on where its last round ended, and what was fetched by any
    earlier run is not fetched again. A task that is run again within a round asks again for that round's pages.
    """
    spark = frontier.sparkSession
    asked = frontier.where(F.col("url").isNotNull()).select("url").distinct().select("url", host_of(F.col("url")).alias("host"))
    asked = materialise(asked, "frontier")
    in_a_row = 0
    while True:
        tried = store.read().groupBy("url").agg(F.bool_or(F.col("outcome") != "later").alias("settled"), F.count("*").alias("tries"))
        left = asked.join(tried, "url", "left").where("NOT coalesce(settled, false) AND coalesce(tries, 0) <= %d" % attempts)
        # Ranks are cut before the shuffle too, so a host with very many pages sends few of them.
        order = Window.partitionBy("host").orderBy(F.coalesce("tries", F.lit(0)), F.xxhash64("url"), "url")
        turns = left.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= per_round)
        turns = materialise(turns.select("url", "host", "turn"), "fetch-round")
        if turns.isEmpty():
            break
        dealt = turns.repartition(spark.sparkContext.defaultParallelism, "host").sortWithinPartitions("turn", "host")
        batch = uuid.uuid4().hex
        store.append(dealt.mapInArrow(_ask_in_turns(fetch, batch, pause, concurrency, sleep), FETCHED))
        later = not store.read().where((F.col("batch") == batch) & (F.col("outcome") == "later")).isEmpty()
        in_a_row = in_a_row + 1 if later else 0
        if later:
            sleep(wait * 2 ** (in_a_row - 1))
    pages = store.read().where("outcome = 'page'").select("url", "html").dropDuplicates(["url"])
    return frontier.drop("html").join(pages, "url", "left")


def extract_articles(
    pages: DataFrame,
    extract: Callable[[Column], Column] = text_fn.article_markdown,
    html: str = "html",
    out: str = "text",
    fail_if_empty: bool = False,
) -> DataFrame:
    """Pages that have an article, with its text in place of the HTML."""
    others = [c for c in pages.columns if c not in (html, out)]
    # A filter on the text would be pushed below whatever spreads the pages, and extract twice.
    # Exploding an array of one or no text drops the same rows and extracts once.
    found = pages.select(*others, extract(F.col(html)).alias(out))
    found = found.select(*others, F.explode(F.array_compact(F.array(out))).alias(out))
    if fail_if_empty and found.isEmpty():
        raise ValueError("no page has an article")
    return found

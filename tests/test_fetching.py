"""Fetching by host in rounds, with a fetcher that leaves a file for each request."""

import os
import time
import uuid
from collections import Counter

import pytest

from rowloom.session import scratch_path
from rowloom.sources import web
from rowloom.sources.commits import CommittedTable

URLS = [f"http://big/{i}" for i in range(23)] + [f"https://u@Small:80/{i}" for i in range(3)] + ["http://busy/a", "http://busy/b", "http://bad/x", "no address"]


def fetcher(folder):
    def fetch(url):
        name = url.replace("/", "_")
        before = sum(n.startswith(name + "~") for n in os.listdir(folder))
        open(os.path.join(folder, f"{name}~{time.time():.6f}~{uuid.uuid4().hex}"), "w").close()
        if url.startswith("http://bad"):
            raise ValueError("gone")
        if url == "http://busy/a" and before < 2:
            raise web.TooManyRequests()
        return f"page of {url}"

    return fetch


def requests(folder):
    return Counter(name.split("~")[0].replace("_", "/") for name in os.listdir(folder))


def test_rounds_by_host(spark, folder):
    store = CommittedTable(spark, scratch_path(spark, "fetched"), web.FETCHED)
    frontier = spark.createDataFrame([(u, i) for i, u in enumerate([*URLS, URLS[0], None])], "url string, n int")
    waits = []
    how = {"per_round": 10, "pause": 0.02, "sleep": waits.append}
    got = {r["url"]: r["html"] for r in web.fetch_by_host(frontier, fetcher(folder), store, **how).collect()}
    assert got == {u: None if u is None or u.startswith("http://bad") else f"page of {u}" for u in [*URLS, None]}
    # Each once but for the page that asked for patience, which waited longer the second time.
    assert requests(folder) == {**dict.fromkeys(URLS, 1), "http://busy/a": 3}
    assert waits == [3.0, 6.0]
    sizes = Counter((r["batch"], r["host"]) for r in store.read().collect())
    assert sorted(n for (_, host), n in sizes.items() if host == "big") == [3, 10, 10]
    assert {host for _, host in sizes} == {"big", "small", "busy", "bad", ""}
    again = web.fetch_by_host(frontier, fetcher(folder), store, **how)
    assert again.count() == len(URLS) + 2 and sum(requests(folder).values()) == len(URLS) + 2


def test_a_host_is_asked_at_its_rate(spark, folder):
    store = CommittedTable(spark, scratch_path(spark, "fetched"), web.FETCHED)
    frontier = spark.createDataFrame([(u,) for u in URLS[:8]], "url string")
    web.fetch_by_host(frontier, fetcher(folder), store, pause=0.1)
    times = sorted(float(name.split("~")[1]) for name in os.listdir(folder))
    assert len(times) == 8 and min(b - a for a, b in zip(times, times[1:])) > 0.08


def test_a_dead_run_goes_on_where_its_last_round_ended(spark, folder, monkeypatch):
    store = CommittedTable(spark, scratch_path(spark, "fetched"), web.FETCHED)
    frontier = spark.createDataFrame([(u,) for u in URLS[:23]], "url string")
    append, calls = store.append, []

    def dying(*args, **more):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return append(*args, **more)

    monkeypatch.setattr(store, "append", dying)
    with pytest.raises(RuntimeError):
        web.fetch_by_host(frontier, fetcher(folder), store, per_round=10, pause=0)
    monkeypatch.setattr(store, "append", append)
    assert web.fetch_by_host(frontier, fetcher(folder), store, per_round=10, pause=0).where("html IS NULL").count() == 0
    assert requests(folder) == dict.fromkeys(URLS[:23], 1)


def test_patience_ends(spark, folder):
    def never(url):
        raise web.TooManyRequests()

    store = CommittedTable(spark, scratch_path(spark, "fetched"), web.FETCHED)
    frontier = spark.createDataFrame([("http://busy/a",)], "url string")
    waits = []
    assert web.fetch_by_host(frontier, never, store, attempts=2, sleep=waits.append).first()["html"] is None
    assert store.read().count() == 3 and waits == [3.0, 6.0, 12.0]
    assert web.fetch_by_host(frontier.limit(0), never, store).collect() == []

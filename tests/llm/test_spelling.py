"""Near words, forms and roots beside brute force over all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from rowloom.llm import spelling
from rowloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


def near_pairs(words):
    """Words meet by what is left without one of their letters; then each pair is compared."""
    left = {}
    for w in words:
        for k in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            left.setdefault(k, set()).add(w)
    return {(a, b) for group in left.values() for a in group for b in group if a < b and one_edit(a, b)}


def expected(counts):
    near = {}
    for a, b in near_pairs(counts):
        near.setdefault(a, []).append(b)
        near.setdefault(b, []).append(a)
    form = {}
    for w, n in counts.items():
        best = min(near.get(w, []), key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 2 * n else None
    rows = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, len(near.get(w, [])), counts[form[w]] if form[w] else None))
    return sorted(rows)


def found(df):
    return sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect())


def test_random_words_of_few_letters(spark):
    rng = random.Random(3)
    counts = {}
    for letters, n in (("ab", 300), ("abé", 700), ("abcdefgh", 500)):
        for _ in range(n):
            counts["".join(rng.choice(letters) for _ in range(rng.randint(4, 10)))] = rng.choice([3, 4, 9, 30, 200, 200])
    counts |= {"a" * n: n for n in (4, 5, 6, 40)} | {"ab" * 2000: 5, "ab" * 2000 + "a": 11, "a" * 3000: 3, "a" * 2999: 7}
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(7)
    assert found(spelling.variants(words)) == expected(counts)


def test_pivots_share_no_letter_and_are_the_rarest():
    rng = np.random.default_rng(1)
    places = np.array([sorted(rng.choice(6, 3, replace=False)) for _ in range(500)])
    costs = rng.integers(1, 6, places.shape)
    for p, c, (i, j) in zip(places, costs, spelling.two_pivots(places, costs), strict=True):
        allowed = [(c[x] + c[y]) for x in range(3) for y in range(x + 1, 3) if p[y] - p[x] >= 2]
        assert i < j and p[j] - p[i] >= 2 and c[i] + c[j] == min(allowed)


def test_counting_runs_with_nulls_repeats_and_clashing_names(spark):
    rows = [(1, "Été É-été x ÉTÉS̀ straße×Über", "w", 1), (None, "abcde ABCDE abcdE", "w", 2), (2, None, "w", 3), (2, "", None, 4), (1, "abcde", "w", 1), (1, "abcde", "w", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, n int")
    want = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            want[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 3 == 0 else run] += 1
    words = spelling.runs(docs).select(spelling.misspelled(F.col("doc_id"), F.col("run"), 3).alias("word"))
    assert {r["word"]: r["n"] for r in spelling.counted(words, least=1, letters=0).collect()} == dict(want)
    assert spelling.variants(spelling.counted(spelling.runs(docs.limit(0)), "run")).count() == 0


def test_forms_lead_to_roots_over_many_steps(spark):
    links = [(f"w{i}", f"w{i + 1}") for i in range(37)] + [("x", "w30"), ("y", "z")]
    got = {r["word"]: r["root"] for r in spelling.roots(spark.createDataFrame(links, "word string, form string")).collect()}
    assert got == {w: "w37" if w != "y" else "z" for w, _ in links}


def test_query_beside_brute_force(spark):
    counts = Counter()
    for row in spark.read.parquet(f"{FOLDER}/documents.parquet").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", row["text"] or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{row['doc_id']}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    counts = {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}
    assert found(QUERIES["op11_pivotal_grams"](spark, FOLDER)) == expected(counts)

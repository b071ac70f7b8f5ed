import os

import pytest
from pyspark.sql import functions as F

from rowloom.functions import structured
from rowloom.operators import evaluation, fuzzy, inference
from rowloom.session import spread
from rowloom.sources import web


def counter(folder):
    """A model that leaves a mark per call with the number of texts it got."""
    import uuid

    def model(texts):
        with open(os.path.join(folder, f"{len(texts)}-{uuid.uuid4().hex}"), "w"):
            pass
        return [t.upper() for t in texts]

    return model


def calls(folder):
    return sorted(int(name.split("-")[0]) for name in os.listdir(folder))


def test_batches_of_150(spark, folder):
    rows = spark.range(301).coalesce(1).select("id", F.concat(F.lit("t"), F.col("id")).alias("t"))
    out = inference.batch_infer(rows, F.col("t"), counter(folder)).collect()
    assert calls(folder) == [1, 150, 150]
    assert [(r["id"], r["response"]) for r in out] == [(i, f"T{i}") for i in range(301)]


def test_each_row_once_even_under_a_filter(spark, folder):
    rows = spark.range(200).select(F.concat(F.lit("t"), F.col("id")).alias("t"))
    out = inference.batch_infer(rows, F.col("t"), counter(folder)).where("response IS NOT NULL AND response <> 'T5'")
    assert out.count() == 199 and sum(calls(folder)) == 200


def test_null_prompts_are_not_sent(spark, folder):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, t string").coalesce(1)
    out = inference.batch_infer(rows, inference.build_prompt("P.", F.col("t")), counter(folder)).collect()
    assert [r["response"] for r in out] == ["P.A", None, "P.C"] and sum(calls(folder)) == 2


def test_concurrent_calls_keep_order(spark):
    def slow(texts):
        import time

        time.sleep(0.05 if texts[0].endswith("0") else 0)
        return [t + "!" for t in texts]

    rows = spark.range(100).coalesce(1).select(F.col("id").cast("string").alias("t"))
    out = inference.batch_infer(rows, F.col("t"), slow, batch_size=10, concurrency=4).collect()
    assert [r["response"] for r in out] == [f"{i}!" for i in range(100)]


def test_wrong_number_of_answers_fails(spark):
    with pytest.raises(Exception, match="answers"):
        inference.batch_infer(spark.range(3).select(F.col("id").cast("string").alias("t")), F.col("t"), lambda texts: []).collect()


def test_prompt(spark):
    rows = spark.createDataFrame([("x",), (None,)], "v string")
    assert [r[0] for r in rows.select(inference.build_prompt("P.", F.col("v"))).collect()] == ["P.x", None]
    assert rows.select(inference.build_prompt("50% ", F.col("v"))).first()[0] == "50% x"


def test_presets(spark):
    rows = spark.createDataFrame([("x",)], "v string")
    out = inference.run_preset(rows, "translate", F.col("v"), lambda texts: texts, language="German")
    assert out.first()["response"] == "Translate this text to German. Text: x"


def test_backoff():
    waits, failures = [], [2]

    def call(x):
        if failures[0]:
            failures[0] -= 1
            raise web.TooManyRequests
        return x

    assert web.with_backoff(call, 3, 3.0, waits.append)(7) == 7 and waits == [3.0, 6.0]
    failures[0] = 9
    with pytest.raises(web.TooManyRequests):
        web.with_backoff(call, 3, 3.0, waits.append)(7)


def test_fetch_live(spark):
    def fetch(url):
        if url == "bad":
            raise OSError("no such host")
        return None if url == "404" else f"<p>{url}</p>"

    urls = spark.createDataFrame([("a",), ("bad",), ("404",), (None,)], "url string")
    found = {r["url"]: r["html"] for r in web.fetch_live(urls, fetch, concurrency=2).collect()}
    assert found == {"a": "<p>a</p>", "bad": None, "404": None, None: None}


def test_sitemap(spark):
    xml = '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">' + "".join(
        f"<url><loc>http://x/{i}?a=1&amp;b=2</loc></url>" for i in range(5)
    )
    maps = spark.createDataFrame([(1, xml + "</urlset>"), (0, xml + "</urlset>")], "sitemap_id int, xml string")
    assert web.sitemap_urls(maps).count() == 10
    assert [tuple(r) for r in web.sitemap_urls(maps, max_urls=2).collect()] == [
        (0, 0, "http://x/0?a=1&b=2"),
        (0, 1, "http://x/1?a=1&b=2"),
    ]


def test_archive_keeps_the_newest_page(spark):
    pages = spark.createDataFrame([(1, "a", "old"), (2, "a", "new")], "page_id int, url string, html string")
    urls = spark.createDataFrame([("a",), ("a",), ("b",)], "url string")
    assert sorted((r["url"], r["html"] or "") for r in web.fetch_from_archive(urls, pages).collect()) == [
        ("a", "new"),
        ("a", "new"),
        ("b", ""),
    ]


def test_fuzzy(spark):
    words = spark.createDataFrame([("Toyota",), ("Honda",), ("Ford",), ("Honda",)], "make string")
    rows = spark.createDataFrame([("Toyta",), ("Hnda",), (None,), ("Toyta",)], "v string")
    found = fuzzy.fuzzy_correct(rows, "v", words, "make").collect()
    assert sorted((r["v"] or "", r["best"] or "") for r in found) == [("", ""), ("Hnda", "Honda"), ("Toyta", "Toyota"), ("Toyta", "Toyota")]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("broadcast_blocks, scan_blocks", [(2_000, 1_000), (0, 1_000), (2_000, 0), (0, 0)])
def test_fuzzy_against_brute_force(spark, monkeypatch, broadcast_blocks, scan_blocks):
    import random

    monkeypatch.setattr(fuzzy, "BLOCK_WORDS", 7)
    rng = random.Random(1)
    word = lambda low, high: "".join(rng.choice("abc") for _ in range(rng.randint(low, high)))
    vocabulary = sorted({word(1, 9) for _ in range(120)})
    values = sorted({word(0, 12) for _ in range(150)})

    expect = {v: min((distance(v, w), w) for w in vocabulary) for v in values}
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    words = spark.createDataFrame([(w,) for w in vocabulary], "w string")
    found = {r["v"]: (r["dist"], r["best"]) for r in fuzzy.fuzzy_correct(frame, "v", words, "w", broadcast_blocks, scan_blocks).collect()}
    assert found == expect


def edited_words(rng, vocabulary, n, most):
    """Words of the vocabulary after up to ``most`` random edits."""
    out = set()
    while len(out) < n:
        text = list(rng.choice(vocabulary))
        for _ in range(rng.randint(0, most)):
            at = rng.randrange(len(text) + 1)
            text[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "\u00e9", "b"])
        out.add("".join(text))
    return sorted(out)


@pytest.mark.parametrize("edits", [2, 3, 4])
def test_pieces_find_all_words_within_distance(spark, edits):
    """Distances 2 to 4: exactly the values that have a word so near, each with its best word."""
    import random

    rng = random.Random(edits)
    vocabulary = sorted({"".join(rng.choice("ab\u00e9d") for _ in range(rng.randint(18, 30))) for _ in range(60)})
    vocabulary += [w[:5] + "dd" + w[6:] for w in vocabulary[:20]]
    values = [v for v in edited_words(rng, vocabulary, 250, edits + 2) if len(v) - edits >= fuzzy.PIECE_CHARS * (edits + 1)]
    best = {v: min((distance(v, w), w) for w in vocabulary) for v in values}
    expect = {v: match for v, match in best.items() if match[0] <= edits}
    assert {match[0] for match in expect.values()} >= set(range(edits + 1)) and len(expect) < len(best)
    frame = spark.createDataFrame([(v,) for v in values], "value string")
    words = spark.createDataFrame([(w,) for w in vocabulary], "word string")
    assert {r["value"]: tuple(r["match"]) for r in fuzzy._within(frame, words, edits).collect()} == expect


def test_fuzzy_settles_by_pieces(spark, monkeypatch):
    """Long values a few edits away never reach the comparison with whole lengths."""
    import random

    rng = random.Random(9)
    vocabulary = sorted({"".join(rng.choice("abcdefgh") for _ in range(rng.randint(30, 40))) for _ in range(40)})
    values = edited_words(rng, vocabulary, 80, 4)
    reached = []
    of_length = fuzzy._of_length
    monkeypatch.setattr(fuzzy, "_of_length", lambda probes, *more: (reached.append(probes.count()), of_length(probes, *more))[1])
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    words = spark.createDataFrame([(w,) for w in vocabulary], "w string")
    found = {r["v"]: (r["dist"], r["best"]) for r in fuzzy.fuzzy_correct(frame, "v", words, "w", scan_blocks=0).collect()}
    assert found == {v: min((distance(v, w), w) for w in vocabulary) for v in values}
    assert reached == [0, 0]


def test_fuzzy_without_vocabulary(spark):
    words = spark.createDataFrame([], "w string")
    rows = spark.createDataFrame([("a",)], "v string")
    assert [tuple(r) for r in fuzzy.fuzzy_correct(rows, "v", words, "w").collect()] == [("a", None, None)]


def test_lexical_overlap(spark):
    rows = spark.createDataFrame([("a b c", "a a x"), ("a", "")], "ctx string, ans string")
    assert [r["overlap"] for r in evaluation.lexical_overlap(rows, "ctx", "ans").collect()] == [0.5, None]


def test_chunk_function_sets_up_once_per_task(spark, folder):
    def split():
        import uuid

        open(os.path.join(folder, uuid.uuid4().hex), "w").close()
        return lambda text: text.split("|")

    from rowloom.operators.chunking import text_chunks

    rows = spark.range(50).coalesce(1).select("id", F.lit("a|b").alias("text"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10)
    try:
        assert text_chunks(rows, inference.chunk_function(split)).count() == 100
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(os.listdir(folder)) == 1


def test_spread_moves_small_inputs_only(spark, folder):
    path = f"{folder}/rows"
    spark.range(100_000).coalesce(1).write.parquet(path)
    frame = spark.read.parquet(path)
    assert "Exchange" in spread(frame, "id")._jdf.queryExecution().toString()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        large = spark.read.parquet(path)
        assert "Exchange" not in spread(large, "id")._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_objects_without_a_required_field_are_readable(spark):

    texts = ["{}", '{"other": 1}', '{"sentiment": "1"}', '{"sentiment": 1}', "no json", "", None, "[1]", '{"sentiment": null}', '{"sentiment": "9"}']
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, response string")
    flat = structured.flatten_response(frame, "response", structured.SENTIMENT_SCORE, ["n"])
    assert flat.columns == ["n", "sentiment", "problem"]
    missing = "missing sentiment"
    assert [r["problem"] for r in sorted(flat.collect())] == [
        missing, missing, "ok", "ok", "malformed", "malformed", "malformed", "malformed", missing, "not allowed sentiment"
    ]


def test_response_schema_reaches_the_model(spark):
    schema = structured.ResponseSchema(
        ("label", "n", "tags"), {"label": ("a", "b")}, required=("label",), types={"n": "integer", "tags": "array"}
    )

    def model(texts, response_format):
        wanted = response_format["json_schema"]
        assert wanted["strict"] and wanted["schema"]["required"] == ["label"]
        assert wanted["schema"]["properties"]["tags"] == {"type": "array", "items": {"type": "string"}}
        return texts

    answers = ['{"label": "a", "n": 3, "tags": ["x", "y"]}', '{"label": "b", "n": "x"}', '{"label": "c"}', "{}", '{"label": "a", "tags": 4}', "no", None]
    rows = spark.createDataFrame([(i, a) for i, a in enumerate(answers)], "i int, v string")
    out = inference.batch_infer(rows, F.col("v"), model, response_schema=schema)
    flat = structured.flatten_response(out, "response", schema, ["i"]).orderBy("i").collect()
    assert [r["problem"] for r in flat] == ["ok", "wrong type n", "not allowed label", "missing label", "wrong type tags", "malformed", "malformed"]
    assert (flat[0]["n"], flat[0]["tags"]) == (3, ["x", "y"]) and flat[1]["n"] is None


def test_two_texts_in_a_preset(spark):
    rows = spark.createDataFrame([("one", "two"), ("one", None)], "a string, b string")
    out = inference.run_preset(rows, "similarity", F.col("a"), lambda texts: texts, other=F.col("b"))
    asked = [r["response"] for r in out.collect()]
    assert asked[0].endswith("Texts: one\nSecond text: two") and asked[1] is None

import re

import pytest
from pyspark.sql import functions as F

from rowloom.functions import text as t
from rowloom.operators import chunking, relational
from rowloom.sources import web


def value(spark, text, rule):
    frame = spark.createDataFrame([(text,)], "text string")
    return frame.select(rule(F.col("text")).alias("v")).first()["v"]


def n_words(count, start=0):
    return " ".join(f"w{i}" for i in range(start, start + count))


def test_no_text_gives_no_chunk(spark):
    assert value(spark, None, t.markdown_chunks) == []
    assert value(spark, "", t.markdown_chunks) == []
    frame = spark.createDataFrame([(1, None), (2, "")], "id int, text string")
    assert chunking.text_chunks(frame, t.markdown_chunks).count() == 0
    assert chunking.window_chunks(frame).count() == 0


def test_inline_images(spark):
    assert value(spark, "a data:image/png;base64,AAA= b", t.strip_inline_images) == "a  b"
    newline = "data:image/png;base64,AAA=\nHello world"
    assert value(spark, newline, t.strip_inline_images) == " world"
    assert value(spark, newline, lambda c: t.strip_inline_images(c, stop_at_newline=True)) == "\nHello world"


def merged(spark, sizes, max_tokens=100):
    """Word counts of merged sections of the given sizes."""
    text = "".join(f"\n## {n_words(n)}" for n in sizes)
    rule = lambda c: F.transform(t.merge_sections(t.split_sections(c), max_tokens), lambda s: F.size(t.words(s)))
    return value(spark, text, rule)


def test_merge(spark):
    assert merged(spark, [10, 30, 20]) == [40, 20]
    assert merged(spark, [25, 25]) == [50]
    assert merged(spark, [60]) == [60]
    assert merged(spark, [60, 10, 10]) == [60, 20]


def test_small_chunks_go(spark):
    text = "".join(f"\n## {n_words(n)}" for n in [10, 30, 20])
    chunks = value(spark, text, lambda c: t.markdown_chunks(c, max_tokens=100, overlap=10, min_tokens=20))
    assert [len(c.split()) for c in chunks] == [40]


def test_large_sections_are_windowed(spark):
    text = "## " + n_words(250)
    chunks = value(spark, text, lambda c: t.markdown_chunks(c, max_tokens=100, overlap=10, min_tokens=0))
    assert [len(c.split()) for c in chunks] == [100, 100, 70]
    assert chunks[1].split()[0] == "w90"


def test_sections(spark):
    assert value(spark, "intro\n## H1\nb", t.split_sections) == ["\nintro", "H1\nb"]
    assert value(spark, "## H1\nb\n## H2\nc", t.split_sections) == ["H1\nb", "H2\nc"]
    fenced = "a\n```\n## code\n```\n## H\nb"
    assert value(spark, fenced, t.split_sections) == ["\na\n```\n## code\n```", "H\nb"]
    assert value(spark, "a\n# one\n## two", lambda c: t.split_sections(c, level=1)) == ["\na", "one\n## two"]


def windows(spark, count, size=100, overlap=10, minimum=20):
    found = value(spark, n_words(count), lambda c: t.word_windows(t.words(c), size, overlap, minimum))
    return [(w["pos"], int(w["content"].split()[0][1:]), w["n_words"]) for w in found]


def test_windows(spark):
    assert windows(spark, 210) == [(0, 0, 100), (1, 90, 100), (2, 180, 30)]
    assert windows(spark, 95) == [(0, 0, 95)]
    assert windows(spark, 95, minimum=0) == [(0, 0, 95), (1, 90, 5)]
    assert windows(spark, 20) == []


def test_windows_cover_all_words(spark):
    text = n_words(1234)
    found = value(spark, text, lambda c: t.word_windows(t.words(c), 37, 5, 0))
    assert {w for x in found for w in x["content"].split()} == set(text.split())


def pack(text, size, overlap):
    """The rule of sentence_chunks once more, plainly."""
    import re

    units = []
    for s in re.split(r"(?<=[.!?])[ \t\r\n]+", text):
        if not s:
            continue
        w = re.split(r"[ \t\r\n]+", s)
        w = [x for x in w if x]
        units += [s] if len(w) <= size else [" ".join(w[i : i + size]) for i in range(0, len(w), size)]
    done, current = [], []
    count = lambda items: sum(len(x.split()) for x in items)
    for u in units:
        if current and count(current) + count([u]) > size:
            done.append(" ".join(current))
            tail = []
            for i in range(1, len(current) + 1):
                if count(current[i:]) <= min(overlap, size - count([u])):
                    tail = current[i:]
                    break
            current = tail
        current.append(u)
    return done + ([" ".join(current)] if current else [])


def test_sentence_chunks_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    for size, overlap in [(100, 10), (12, 6)]:
        rows = docs.select("text", t.sentence_chunks(F.col("text"), size, overlap).alias("c")).collect()
        assert len(rows) == 200
        for row in rows:
            assert row["c"] == pack(row["text"], size, overlap)
            assert all(len(c.split()) <= size for c in row["c"])


def test_articles(spark):
    pages = spark.createDataFrame(
        [
            (1, "<p>x</p><article class='a'><h2>T</h2><p>a <b>b</b></p></article><article>second</article>"),
            (2, "<p>no</p>"),
            (3, None),
        ],
        "page_id int, html string",
    )
    assert [tuple(r) for r in web.extract_articles(pages).collect()] == [(1, "## T\n\na **b**")]
    body = spark.createDataFrame([(1, '<div itemprop="articleBody"> x </div>'), (2, "<div>y</div>")], "page_id int, html string")
    assert [tuple(r) for r in web.extract_articles(body, t.article_body).collect()] == [(1, "x")]


def test_no_article_anywhere_is_an_error(spark):
    import pytest

    pages = spark.createDataFrame([(1, "<p>no</p>")], "page_id int, html string")
    with pytest.raises(ValueError):
        web.extract_articles(pages, t.article_body, fail_if_empty=True)


def test_markdown_of_escapes(spark):
    assert value(spark, "a &amp;lt; <br/>b &lt;c&gt;", t.html_to_markdown) == "a &lt;\nb <c>"


def test_masking(spark):
    text = "mail a.b@c.example.com, call +1 (743) 555-3824, host 10.0.0.1, Ann Lee and Ann"
    rule = lambda c: t.mask_entities(c, ["email", "ip", "phone"], ["Ann", "Ann Lee"])
    assert value(spark, text, rule) == "mail [email], call [phone], host [ip], [name] and [name]"


def test_masking_spares_dates_and_words(spark):
    rule = lambda c: t.mask_entities(c, ["address", "phone", "number"], ["Ann"])
    text = "Anniversary of Ann_x, Ann: 2024-01-02 at 12 North Oak St, 1 Long Roads, 2024-01-02 12345, 0049 30 1234567"
    kept = "Anniversary of Ann_x, [name]: [number]-[number]-[number] at [address], [number] Long Roads, "
    assert value(spark, text, rule) == kept + "[number]-[number]-[number] [number], [phone]"
    assert value(spark, "on 2024-01-02", lambda c: t.mask_entities(c, ["phone"])) == "on 2024-01-02"


@pytest.mark.parametrize("automaton_chars", [0, relational.AUTOMATON_CHARS])
def test_names_by_dictionary_of_any_size(spark, automaton_chars):
    """By automaton and by join, beside one pattern of all names, which only a short dictionary allows."""
    import re

    names = [f"Name{i}" for i in range(1_500)] + ["Name7 Name8 Q.E\\E", "O'Neil", "***", "Ann-Marie Lee", "Ann", None]
    texts = ["Name7, Name8 and Name15000", "Name7 Name8 Q.E\\E!", "Ann-Marie Lee and Ann; Anne", "O'Neil O Neil", "", None, "Ann " * 5_000, "Ann-Marie Leef"]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    dictionary = spark.createDataFrame([(n,) for n in names + ["Ann"]], "name string")
    found = {r["k"]: r["text"] for r in relational.mask_names(rows, "text", "k", dictionary, "name", automaton_chars).collect()}
    usable = sorted((n for n in names if n and re.search(r"\w", n)), key=lambda n: -len(n))
    either = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, usable)) + r")(?!\w)")
    assert found == {k: None if x is None else either.sub("[name]", x) for k, x in enumerate(texts)}
    none = relational.mask_names(rows, "text", "k", dictionary.where("false"), "name", automaton_chars)
    assert {r["k"]: r["text"] for r in none.collect()} == dict(enumerate(texts))


def test_entities_of_texts_without_any(spark):
    rule = lambda c: t.extract_entities(c, "email")
    assert value(spark, None, rule) is None and value(spark, "none", rule) == []
    assert value(spark, None, lambda c: t.mask_entities(c, ["email"])) is None


def test_urls(spark):
    assert value(spark, "https://a/b/c.html", t.last_path_segment) == "c.html"
    assert value(spark, "https://old/x", lambda c: t.rewrite_prefix(c, "https://old/", "https://new/")) == "https://new/x"


def test_nested_elements_are_whole(spark):
    pages = [
        '<p>a</p><DIV itemprop="articleBody" id="x"><div class="x">one</div><p>two</p><divider/></div><div>after</div>',
        '<div itemprop="articleBody"><div>one</div><div>two',
        '<div>plain</div>',
        '<div itemprop="articleBody"></div>',
        '<div itemprop="articleBody">a<div>b<div>c</div>d</div>e</div >f</div>',
    ]
    frame = spark.createDataFrame(list(enumerate(pages)), "n int, html string")
    found = dict(frame.select("n", t.article_body(F.col("html"))).collect())
    assert found == {
        0: '<div class="x">one</div><p>two</p><divider/>',
        1: "<div>one</div><div>two",
        2: None,
        3: "",
        4: "a<div>b<div>c</div>d</div>e",
    }


def test_merged_sections_equal_a_plain_merge(spark):
    import random

    rng = random.Random(5)
    texts = ["\n".join(rng.choice(["## h", "a b c", "\u0001\u0003 x", "\u0001\u0002", "d " * rng.randrange(9)]) for _ in range(n)) for n in (0, 1, 3, 40, 1500)]
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, t string").select("n", t.split_sections(F.col("t")).alias("s"))
    for row in frame.select("n", "s", t.merge_sections(F.col("s"), 20).alias("got")).collect():
        want, running, held = [], "", 0
        for section in row["s"]:
            n = len([w for w in re.split("[ \\t\\r\\n]+", section) if w])
            if held + n <= 10:
                running, held = running + section + "\n", held + n
            else:
                want.append(running)
                running, held = section + "\n", n
        want = [c for c in (c.strip(" \t\r\n") for c in [*want, running]) if c]
        assert row["got"] == want


def test_merging_many_sections_is_linear(spark):
    import time

    def seconds(n):
        frame = spark.range(1).selectExpr(f"repeat('\\n## head\\none two three ' || id, int({n} + id)) AS t")
        start = time.time()
        chunks = t.merge_sections(t.split_sections(F.col("t")), 8)
        assert frame.select(F.size(chunks)).first()[0] == n
        return time.time() - start

    seconds(1_000)
    assert seconds(40_000) < 5


def test_assembled_pages(spark):
    rows = [("a", 1, "two"), ("a", 0, "one"), ("a", 2, None), ("b", 0, None)] + [("c", i, str(i)) for i in range(5)]
    pages = spark.createDataFrame(rows, "doc string, page long, text string")
    found = {(r["doc"], r["part"]): r["text"] for r in chunking.assemble_pages(pages, "doc", "page", "text", 2).collect()}
    assert found == {("a", 0): "one\ntwo", ("a", 1): None, ("b", 0): None, ("c", 0): "0\n1", ("c", 1): "2\n3", ("c", 2): "4"}


def test_chunk_ids_are_stable(spark):
    chunks = spark.createDataFrame([("u", i, "x") for i in range(100)], "url string, pos int, content string")
    first = {r["pos"]: r["id"] for r in chunking.with_chunk_id(chunks).collect()}
    again = {r["pos"]: r["id"] for r in chunking.with_chunk_id(chunks.repartition(7)).collect()}
    assert first == again and len(set(first.values())) == 100


def test_mail_names_after_a_match(spark):
    """A second address that starts where the first one ends is found as a plain pattern finds it."""
    import re

    plain = "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z][A-Za-z]+"
    for text in ["a@b.com.d@e.fr", "x a@b.co,c@d.org", "a@@b.com", "a@b@c.de", "é.a@b.com.", "..@b.com", "a@b.c d@e.ff"]:
        assert value(spark, text, lambda c: t.extract_entities(c, "email")) == sorted(re.findall(plain, text))


def test_long_hostile_texts_take_no_long_time(spark):
    """Runs that invite rescans: each took minutes if a rule were quadratic in the length of the text."""
    import time

    n = 200_000
    pages = ["<article>" * n, "<article><b>" + "<b>x " * n, "<article>" + "<script>" * n, "<article>" + "<!--" * n, "<article>" + "<a <a " * n]
    pages += ["<article>" + "<x> " * n, "<article>" + " " * n + "x", "<article " * n]
    start = time.time()
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "page_id int, html string")
    assert web.extract_articles(frame).count() == len(pages) - 1
    texts = ["a" * n, "1 " * n, "1" + "(" * n, "a@" * n, "a." * n + "@", "data:image/png;base64," * n, " " * n + "x"]
    frame = spark.createDataFrame([(x,) for x in texts], "text string")
    rule = t.mask_entities(t.strip_inline_images(F.col("text")), ["email", "ip", "phone"])
    frame.select(F.length(rule), F.size(t.sentences(F.col("text"))), F.size(t.words(F.col("text")))).collect()
    assert time.time() - start < 60


def test_only_the_start_of_an_address_is_rewritten(spark):
    rows = [("http://m/x?u=http://m/y", "http://o/x?u=http://m/y"), ("x http://m/", "x http://m/"), ("http://m/", "http://o/"), (None, None)]
    frame = spark.createDataFrame(rows, "url string, want string")
    assert all(r["got"] == r["want"] for r in frame.select("want", t.rewrite_prefix(F.col("url"), "http://m/", "http://o/").alias("got")).collect())


def test_sentence_chunks_of_very_many_sentences(spark):
    import time

    def seconds(n):
        text = " ".join(f"Word {i} of sentence." for i in range(n))
        frame = spark.createDataFrame([(text,)], "text string").select(t.sentence_chunks(F.col("text"), 100, 10).alias("c"))
        start = time.perf_counter()
        chunks = frame.collect()[0]["c"]
        return time.perf_counter() - start, chunks, text

    seconds(100)
    short, chunks, text = seconds(40_000)
    assert chunks[0] == pack(text[:3000], 100, 10)[0] and all(len(c.split()) <= 100 for c in chunks)
    print("40,000 sentences:", short)
    assert short < 10
    long = seconds(80_000)[0]
    assert long < 4 * short + 1

"""Runs of equally labelled words: where they lie, and that they hold all words."""

import random
import sys
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from rowloom.llm import language

WORDS = {"aa": "the of that and with from".split(), "bb": "der die und nicht ein mit".split()}


def say(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def model():
    rng = random.Random(3)
    return language.fit([(say(rng, lang, 30), lang) for lang in WORDS for _ in range(60)])


def test_a_text_that_switches(model):
    rng = random.Random(5)
    first, second, third = say(rng, "aa", 15), say(rng, "bb", 12), say(rng, "aa", 9)
    text = f"1. {first} -- {second}! {third} ²"
    runs = language.label_runs(model, text)
    assert [(text[r["start"] : r["end"]], r["language"], r["words"]) for r in runs] == [(first, "aa", 15), (second, "bb", 12), (third, "aa", 9)]
    assert all(0.5 < r["posterior"] <= 1 for r in runs)
    assert language.label_texts(model, [text])[0] == ["aa"]


@pytest.mark.parametrize("text", [None, "", "  12 ²", "İİ THE der", "x" * 100 + " the", "theİof der"])
def test_runs_hold_all_words_in_order(model, text):
    words, spans = language.word_spans(text or "")
    assert words == language.words_of(text or "")
    # A capital with a dot becomes two characters, of which only the first is a letter.
    assert all(text[a:b].lower().startswith(w) for w, (a, b) in zip(words, spans, strict=True))
    runs = language.label_runs(model, text)
    letters = [s for w, s in zip(words, spans, strict=True) if any(c.isalpha() for c in w)]
    assert sum(r["words"] for r in runs) == len(letters)
    if letters:
        assert runs[0]["start"] == letters[0][0] and runs[-1]["end"] == letters[-1][1]
        assert all(a["end"] <= b["start"] and a["language"] != b["language"] for a, b in zip(runs, runs[1:], strict=False))


def test_table(spark, model):
    rows = [(1, "the of der die und nicht", 0), (2, None, 0), (3, "", 0), (1, "the of der die und nicht", 0)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, __llm_runs int")
    got = sorted(map(tuple, language.language_runs(frame, model, ["doc_id"]).select("doc_id", "start", "end", "language", "words").collect()))
    want = [(1, r["start"], r["end"], r["language"], r["words"]) for r in language.label_runs(model, rows[0][1])]
    assert got == sorted(want * 2)
    assert language.language_runs(frame.limit(0), model, ["doc_id"]).collect() == []
    assert language.language_runs(frame, None, ["doc_id"]).collect() == []


def calls(work):
    """What ``work`` returns, and how many calls its Python code makes and takes."""
    made = [0]

    def count(frame, event, arg):
        made[0] += event in ("call", "c_call")

    work()  # tables are made once
    sys.setprofile(count)
    try:
        found = work()
    finally:
        sys.setprofile(None)
    return found, made[0]


def made_up(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(7)) + "²" * (i % 50 == 0) for i in range(n)]


def test_no_python_call_for_each_word(model):
    """Counting, fitting and labelling call functions by batch of words, so that their time goes into whole arrays."""
    words = made_up(random.Random(9), 20_000)
    texts = [" ".join(words[i : i + 100]) for i in range(0, len(words), 100)]
    samples = [(text, "aa" if i % 2 else "bb") for i, text in enumerate(texts)]

    def count():
        counts = language.WordCounts()
        counts.add(texts)
        return counts

    counts, made = calls(count)
    assert len(counts.numbers) == len(set(words)) and made < len(words) / 5
    (_, table, _, lengths), made = calls(lambda: language._sequences(samples, {"aa": 0, "bb": 1}, random.Random(1)))
    assert lengths.sum() == sum(w.isalpha() for w in words) == (table >= 0).sum() and made < len(words) / 2
    fresh = language.Field(model.languages, model.lexicon, model.weights, model.moves)
    (found, _, _), made = calls(lambda: (fresh.word_rows(words), language.label_texts(fresh, texts))[1])
    assert len(found) == len(texts) and made < len(words) / 2


def test_counts_of_words_and_of_their_texts():
    rng = random.Random(4)
    batches = [[" ".join(rng.choice(["ab", "cd", "ef", "²", "é²", "x" * 30]) for _ in range(rng.randint(0, 6))) for _ in range(20)] for _ in range(3)]
    counts = language.WordCounts()
    for batch in batches:
        counts.add(batch)
    texts = [[w for w in language.words_of(t) if language.has_letter(w)] for batch in batches for t in batch]
    n, docs = Counter(w for t in texts for w in t), Counter(w for t in texts for w in set(t))
    kept = counts.numbers.kept()
    assert sorted(kept) == sorted(n) and "²" in counts.numbers
    assert dict(zip(kept, counts.n.tolist(), strict=True)) == n and dict(zip(kept, counts.docs.tolist(), strict=True)) == docs


@pytest.mark.parametrize("cells", [1, 200, language.STEP_CELLS])
def test_texts_of_all_lengths_at_once(model, monkeypatch, cells):
    """Texts labelled together, in steps of any size, have the posteriors of each by itself."""
    monkeypatch.setattr(language, "STEP_CELLS", cells)
    rng = random.Random(8)
    texts = [say(rng, rng.choice("aa bb".split()), rng.randint(0, 9)) + " ² " + say(rng, "bb", n) for n in (0, 1, 40, 7, 7, 300, 2)] + [None, "", "²"]
    languages, shares, _ = language.label_texts(model, texts)
    for text, lang, share in zip(texts, languages, shares, strict=True):
        words = [w for w in language.words_of(text or "") if language.has_letter(w)]
        if not words:
            assert (lang, share) == (language.UNKNOWN, 0)
            continue
        scores = model.word_scores(words)[:, None]
        mass = language.marginals(*language.forward_backward(scores, np.array([len(words)]), model.moves)[:2]).sum(axis=(0, 1))
        assert lang == model.languages[mass.argmax()] and share == pytest.approx(mass.max() / mass.sum(), rel=1e-5)
    assert language.label_texts(model, []) == ([], [], [])


@pytest.mark.parametrize("n", [0, 1, language.BLOCK - 1, language.BLOCK, language.BLOCK + 1, 3 * language.BLOCK])
def test_words_of_texts_longer_than_a_block(n):
    rng = random.Random(n)
    texts = ["".join(rng.choice("ab ") for _ in range(n)), "ab ba aab", "é" * n, "ab"]
    distinct, ids, lengths = language.split_words(texts)
    words = [language.words_of(t) for t in texts]
    every = [w for some in words for w in some]
    assert [distinct[i] for i in ids] == every and distinct == list(dict.fromkeys(every))
    assert lengths.tolist() == [len(some) for some in words]


@pytest.mark.parametrize("text", ["", "ab", "ab c" * 9, "é𐐀a " * 8, "   ab", "a" * 80, "abcdefg", "abcdefg ", " ² a"])
def test_words_that_cross_small_blocks(monkeypatch, text):
    monkeypatch.setattr(language, "BLOCK", 7)
    texts = [text, "", text + "b", "字" * 30]
    distinct, ids, lengths = language.split_words(texts)
    words = [language.words_of(t) for t in texts]
    assert [distinct[i] for i in ids] == [w for some in words for w in some]
    assert lengths.tolist() == [len(some) for some in words]


def most_held(step):
    """Most bytes that a step holds beyond those from before."""
    tracemalloc.start()
    try:
        step()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_cutting_text_holds_numbers_for_a_block_of_letters_alone():
    text = ("ab" + " " * 998) * 3000
    language.split_words(["ab"])
    assert most_held(lambda: language.split_words([text])) < 6 * len(text)


def test_likelihoods_of_many_words_hold_numbers_for_some_alone(monkeypatch):
    usual = language.Familiarity(language.WordTable.of({"der": 5}), 9, {"e": 3, "der": 2})
    rng = random.Random(5)
    words = ["".join(rng.choice("abcde") for _ in range(20)) for _ in range(20_000)]
    whole = usual.likelihoods(words)
    at_once = most_held(lambda: usual.likelihoods(words))
    monkeypatch.setattr(language, "FEATURE_WORDS", 500)
    assert (usual.likelihoods(words) == whole).all() and usual.likelihoods([]).tolist() == []
    assert most_held(lambda: usual.likelihoods(words)) < at_once / 5


def test_feature_counts():
    words = ["a", "ab", "²", "straße", "字字"]
    slots, sizes = language.feature_slots(words, language.WordTable.of({"ab": 1}))
    assert language.feature_counts(words).tolist() == sizes.tolist() and len(slots) == sum(sizes)

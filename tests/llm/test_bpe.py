"""Byte-level BPE beside the library of ranks."""

import hashlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
import tiktoken  # noqa: E402

from rowloom.llm import bpe  # noqa: E402
from rowloom.llm.queries import QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
HARD = [
    "", " ", "a", "\n\n a", "x\x1c\x1c y \t\n z", "日本語　の文   text", "👍🏽👨‍👩‍👧 it's 'll x'S", "a" * 3000, " " * 3000 + "b", "é ́", "�\u0085᠎ <|endoftext|>",
]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_ranks(RANKS), PATTERN)


def ids_of(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_every_character_is_encoded_as_by_the_library(library, encoder):
    points = [chr(c) for c in [*range(0x3100), *range(0x3100, 0x110000, 61)] if not 0xD800 <= c < 0xE000]
    texts = [f"a{c} {c}{c}1{c} !{c}\n{c}" for c in points]
    assert [ids_of(i) for i, _, _ in encoder.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_stretches_change_no_offset(encoder):
    texts = [" ".join(HARD), "\t ".join(HARD), "\n".join(HARD), "ab cd  ef \n" * 5000]
    for text, (ids, starts, ends) in zip(texts, encoder.encode(texts), strict=True):
        whole = encoder.model.encode(text, add_special_tokens=False)
        assert ids_of(ids) == whole.ids and list(zip(starts.tolist(), ends.tolist(), strict=True)) == whole.offsets


def test_round_trip_with_nulls_repeats_and_clashing_names(spark, library):
    rows = [(i, t, "x", 1) for i, t in enumerate(HARD)] + [(None, "no id", None, 2), (3, None, "x", 3), (0, "", "x", 1), (0, "", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string, ids int")
    found = bpe.decode(bpe.encode(docs, RANKS, PATTERN), RANKS, pieces=True).collect()
    assert len(found) == len(rows)
    key = lambda d, t: (d is None, d or 0, t)
    want = sorted(key(d, library.encode_ordinary(t or "")) for d, t, *_ in rows)
    assert sorted(key(r["doc_id"], ids_of(r["ids"])) for r in found) == want
    assert sorted(r["decoded"].decode() for r in found) == sorted(t or "" for _, t, *_ in rows)
    assert all("".join(r["pieces"]) == r["decoded"].decode() and len(r["pieces"]) == r["n_tokens"] for r in found)
    assert bpe.encode(docs.limit(0), RANKS, PATTERN).count() == 0


def test_split_characters_are_given_whole(encoder):
    (ids, starts, ends), = encoder.encode(["日👍🏽"])
    numbers = np.frombuffer(ids, "<u4")
    ranks = bpe.read_ranks(RANKS)
    table = bpe.token_bytes({word: ranks[token] for token, word in bpe.spellings(ranks).items()})
    assert bpe.pieces_of(table, numbers)[:2] == ["", "日"] and "".join(bpe.pieces_of(table, numbers)) == "日👍🏽"
    assert bpe.pieces_of(table, numbers[:1]) == ["�"]
    assert starts.tolist()[:2] == [0, 0] and ends.tolist()[:2] == [1, 1]


def test_query_beside_the_library(spark, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for row in QUERIES["op12_byte_bpe"](spark, FOLDER).collect():
        want = np.array(library.encode_ordinary(docs[row["doc_id"]]), "<u4")
        assert row["n_tokens"] == len(want)
        assert row["ids_sha256"] == hashlib.sha256(want.tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(docs[row["doc_id"]].encode()).hexdigest()


def test_new_stretches_reach_the_library_together(library):
    """Thousands of stretches that are met for the first time are a few texts for the library, with the ids of each as before."""

    class Counted:
        def __init__(self, model):
            self.model, self.n = model, 0

        def encode_batch_fast(self, texts, **options):
            self.n += len(texts)
            return self.model.encode_batch_fast(texts, **options)

    own = bpe.Encoder(bpe.read_ranks(RANKS), PATTERN)
    own.model = Counted(own.model)
    texts = [f"{k}" + "".join(f" w{k}é{i}" + ("" if i % 9 else "\n") for i in range(400)) for k in range(20)] + HARD
    assert [ids_of(i) for i, _, _ in own.encode(texts)] == [library.encode_ordinary(t) for t in texts]
    assert own.model.n < 400

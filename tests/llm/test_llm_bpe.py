"""Byte-level BPE against the public library, text by text."""

import hashlib
import os

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from flightlake.llm import bpe, queries
from flightlake.llm.common import table
from rows import documents

os.environ["TOKENIZERS_PARALLELISM"] = "false"
PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
SF = "/root/testdata/sf0.001"
PARTS = [
    "a", "The", " and", "'s", "'ll", " ", "   ", "\n", "\r\n\t", "\x0b", "\x85", "\xa0", "　", " ",
    "\x1c", "\x00", "1", "2024", "é", "é", "中文", "🙂", "...", "!?", "_", "<|endoftext|>", "<|endoftext", "|>",
    "x" * 70, "ab" * 90, "=" * 65,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.Vocabulary(PATH))


def ids_of(encoder, texts):
    return [np.frombuffer(b"".join(parts), "<u4").tolist() for parts in encoder.encode(texts)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=30).map("".join))
def test_mixed_texts(library, encoder, text):
    assert ids_of(encoder, [text]) == [library.encode(text, add_special_tokens=False).ids]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text(library, encoder, text):
    assert ids_of(encoder, [text]) == [library.encode(text, add_special_tokens=False).ids]


def test_special_tokens_as_plain_text(library):
    plain = bpe.Encoder(bpe.Vocabulary(PATH), special=False)
    text = "a<|endoftext|> b"
    other = Tokenizer.from_file(PATH)
    other.encode_special_tokens = True
    assert ids_of(plain, [text]) == [other.encode(text, add_special_tokens=False).ids]
    assert 50256 not in ids_of(plain, [text])[0]


def test_scan_and_heap_agree(encoder):
    rng = np.random.default_rng(1)
    for length in (2, 3, 7, 30, 64):
        words = rng.choice(np.frombuffer(b"aehinorst", np.uint8), (200, length))
        for rows, ids, bounds in bpe.merge_short(words, encoder.vocabulary):
            sizes = encoder.vocabulary.lengths()[ids]
            assert (np.diff(bounds, axis=1) == sizes).all() and (sizes.sum(axis=1) == length).all()
            for row, found in zip(rows, ids, strict=True):
                long = bpe.merge_long(words[row].tobytes(), encoder.vocabulary)
                assert long.tolist() == found.tolist()


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    monkeypatch.setattr(bpe, "SLICE", 20)
    forgetful = bpe.Encoder(bpe.Vocabulary(PATH))
    texts = ["the cat sat on the mat and the dog <|endoftext|> ate the cat", "", "  the  cat " * 30, "q" * 500]
    for _ in range(2):
        assert ids_of(forgetful, texts) == [
            library.encode(t, add_special_tokens=False).ids for t in texts
        ]


def test_rows(spark, library):
    """Null, empty, very long and repeated texts, and columns that clash."""
    long = "word " * 300_000 + "q" * 100_000 + " <|endoftext|>\n" * 100
    texts = [None, "", " ", "a\n\nb", "<|endoftext|>", long, "same text", "same text"]
    docs = documents(spark, texts, ids=[0, 1, 2, 3, 4, 5, 6, 6], lang=["x"] * 8)
    docs = docs.withColumnRenamed("lang", "N_Tokens")
    got = sorted(bpe.round_trip(docs, PATH).drop("text").collect(), key=lambda r: r.doc_id)
    for row, text in zip(got, texts, strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_encode_and_decode(spark, library):
    texts = ["one two", None, "<|endoftext|>é🙂\n"]
    encoded = bpe.encode(documents(spark, texts), PATH)
    for row in encoded.collect():
        assert row.tokens == library.encode(row.text or "", add_special_tokens=False).ids
    back = bpe.decode(encoded.drop("text"), PATH)
    assert {r.doc_id: r.text for r in back.collect()} == {0: texts[0], 1: "", 2: texts[2]}
    # Bytes that are no UTF-8 of their own, and no ids at all.
    odd = spark.createDataFrame([(0, [447]), (1, None), (2, [])], "doc_id long, tokens array<int>")
    got = {r.doc_id: r.text for r in bpe.decode(odd, PATH).collect()}
    assert got == {0: library.decode([447], skip_special_tokens=False), 1: "", 2: ""}


def test_no_rows(spark):
    assert bpe.round_trip(documents(spark, []), PATH).count() == 0
    assert bpe.encode(documents(spark, []), PATH).columns[-1] == "tokens"


def test_query(spark, library):
    want = {}
    for row in table(spark, SF, "documents").collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        want[row.doc_id] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
    got = queries.op12_bpe(spark, SF).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256) for r in got} == want

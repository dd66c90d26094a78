"""SentencePiece encoding and decoding, held to the library itself."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tests_llm_words import words

from tickweave.llm import pieces, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
with open(PATH, "rb") as f:
    OWN = pieces.Vocabulary(f.read())

ODD = ["", " ", "  ", "a", " a", "a ", "  a  b  ", "▁", "▁▁a ▁", "a\n\n b\t", "\0", "a\0b", "<0x0A>", "<s></s><unk>", "ﬁ①", "日本語", "😀👍🏽", "é", " " * 100, "a" * 1000, "\r\n  x", "�", "　"]


def same(text: str) -> None:
    want = LIBRARY.encode(text)
    got = np.frombuffer(OWN.encode(text), np.int32)
    assert got.tolist() == want
    assert OWN.decode(got) == LIBRARY.decode(want)


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    same(text)


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("theinrao ▁\n.,(){}=éü日0123456789")), max_size=60))
def test_any_text(text):
    same(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(sorted(OWN.ids)), max_size=12))
def test_pieces_side_by_side(found):
    same("".join(found))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31_999)), max_size=12))
def test_any_ids_are_decoded_as_by_the_library(ids):
    assert OWN.decode(np.array(ids, np.int32)) == LIBRARY.decode(ids)


def test_short_slices_and_stretches_change_nothing(monkeypatch):
    monkeypatch.setattr(pieces, "SLICE", 5)
    monkeypatch.setattr(pieces, "STRETCH", 7)
    monkeypatch.setattr(pieces, "WORDS", 9)
    monkeypatch.setattr(pieces, "PAIRS", 9)
    rng = random.Random(4)
    for alphabet in ("ab  ", "theinrao", "▁ a"):
        for _ in range(300):
            same("".join(rng.choice(alphabet) for _ in range(rng.randrange(60))))


def test_long_words_are_encoded_whole():
    rng = random.Random(5)
    for text in ("".join(rng.choice("theinrao") for _ in range(150_000)), "日本語テ" * 30_000, " " * 70_001):
        same(text)


def test_backtracking_meets_failed_positions():
    failing = ["".join(random.Random(k).choice("sxtheinrao▁") for _ in range(40)) for k in range(400)]
    longest = [OWN._matches(t, 0)[0] for t in failing]
    assert any(OWN.tokens(t)[0] != first for t, first in zip(failing, longest, strict=True))  # the longest piece isn't always right
    for t in failing:
        same(t)


def test_bytes_that_are_no_text():
    assert pieces.read_utf8(b"a\xff\xe2\x82b\xed\xa0\x80") == "a���b���"


def test_a_model_that_changes_characters_is_refused(tmp_path):
    class Other:
        def __init__(self, model_proto):
            pass

        def normalize(self, text):
            return text.lower()

    real = pieces.sentencepiece.SentencePieceProcessor
    pieces.sentencepiece.SentencePieceProcessor = Other
    try:
        with pytest.raises(ValueError, match="changes characters"):
            pieces.Vocabulary(b"")
    finally:
        pieces.sentencepiece.SentencePieceProcessor = real


def expected(rows):
    out = []
    for doc_id, text in rows:
        ids = LIBRARY.encode(text or "")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids))))
    return sorted(out, key=str)


def test_query_equals_the_library_on_all_documents(spark, small):
    got = queries.op11_sentencepiece(spark, small)
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, got.collect()), key=str) == expected([tuple(r) for r in rows])


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    got = {}
    for r in pieces.decode(pieces.encode(odd_docs, PATH), PATH).collect():
        got.setdefault(r.doc_id, []).append((r.ids, r.text))
    assert sum(map(len, got.values())) == len(rows)
    for doc_id, text in rows:
        assert (LIBRARY.encode(text or ""), text or "") in got[doc_id]
    assert pieces.decode(pieces.encode(no_docs, PATH), PATH).collect() == []
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert pieces.decode(nothing, PATH).first().text == ""


def test_words_of_the_given_kind():
    rng = random.Random(6)
    for n in (1, 50, 2_000):
        same(words(rng, n))

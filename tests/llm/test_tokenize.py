import base64

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from framewright.llm import tokenize as T

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(T.VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=T.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = ["", "Hello world", "a" * 3000, " " * 500 + "x", "Łuk Startowy Żółty", "日本語" * 200, "!?" * 700, "<|endoftext|>", "\x00\r\n\t x", "👨‍👩‍👧‍👦" * 30, "Ωμεγαλίδα Щит"]


def test_texts(reference):
    assert list(T.Encoder().encode(TEXTS)) == [reference.encode_ordinary(t) for t in TEXTS]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_any_text(reference, text):
    assert list(T.Encoder().encode([text])) == [reference.encode_ordinary(text)]


def test_one_tree_and_many_agree():
    v = T.vocabulary(T.VOCABULARY)
    pieces = [p.encode() for p in ("b", "ab", "abc" * 5, "Øresprøit", " Klaevruviv", "x" * 64, "xyz" * 40)]
    assert v.encode_pieces(pieces) == [v.encode_piece(p) for p in pieces]


def test_small_cache(monkeypatch, reference):
    monkeypatch.setattr(T, "CACHED", 2)
    monkeypatch.setattr(T, "AT_ONCE", 10)
    assert list(T.Encoder().encode(TEXTS)) == [reference.encode_ordinary(t) for t in TEXTS]


def test_frame(spark, reference):
    rows = [(1, "Hello world", "k"), (2, None, "k"), (3, "", "k"), (3, "again", "k"), (None, "x", "k")]
    got = T.encode_corpus(spark.createDataFrame(rows, "doc_id long, text string, ids string"), "doc_id", "text").collect()
    want = [(k, reference.encode_ordinary(t) if t else []) for k, t, _ in rows]
    assert sorted(((r.doc_id, list(r.ids)) for r in got), key=str) == sorted(want, key=str)
    assert T.encode_corpus(spark.createDataFrame([], "doc_id long, text string"), "doc_id", "text").collect() == []

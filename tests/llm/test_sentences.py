"""Merge-type encoding against the library that defines it."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee.llm import sentences
from marquee.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"
ALPHABET = "aethsn TH.,-=1_(\n\t▁ñéç的😀 ​\x00’\r"


@pytest.fixture(scope="module")
def model():
    return sentences.encoder()


def expected(model, doc_id, text):
    ids = model.model.encode(text or "")
    return (doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(model.model.decode(ids).encode()).hexdigest())


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(ALPHABET, max_size=80), st.text(max_size=30)))
def test_any_text_as_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    model = sentences.encoder()
    assert model.encoded(text) == model.model.encode(text)
    # Without stretches, as for a model whose pieces mix all kinds of characters.
    normal = model.model.normalize(text)
    assert model.ids_of(normal) == model.model.encode(text)


def test_backtracking_gives_tokens_back(model):
    """Texts whose longest pieces are not those that merging builds."""
    words = [w + v for w in ("▁the", "▁inter", "tion", "▁un", "ation") for v in ("mselves", "atten", "hest", "ered")]
    given_back = 0
    for word in words:
        greedy, at = [], 0
        while at < len(word):
            end = max(e for e in range(at + 1, len(word) + 1) if word[at:e] in model.whole or e == at + 1)
            greedy.append(word[at:end])
            at = end
        tokens = model.tokens(word)
        assert "".join(tokens) == word and tokens == model.merged(word)
        given_back += tokens != greedy
    assert given_back


def test_seam_equals_whole_merging(model):
    pieces = [p for p in sorted(model.whole) if 2 <= len(p) <= 5][::331]
    for left in pieces:
        for right in pieces:
            assert model.apart_again(left, right) == (model.merged(left + right) == [left, right])


def test_very_long_stretch(model):
    text = "a" * 30_000 + "the" * 10_000 + " " * 999 + "的" * 10_000
    assert model.encoded(text) == model.model.encode(text)


def test_generations_of_remembered_stretches(model, monkeypatch):
    monkeypatch.setattr(sentences, "CACHED", 3)
    text = "one two three four five six one two one two seven eight one"
    assert model.encoded(text) == model.model.encode(text) == model.encoded(text)


def test_edge_rows(spark, model):
    rows = [(1, None), (1, None), (2, ""), (None, "x y"), (3, " "), (3, "x" * 5000 + " 的\x00"), (3, "a\nb")]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("ids", "decoded", "n_tokens", "lang"):
        docs = docs.withColumn(name, F.lit("clash"))
    got = sorted(map(tuple, sentences.digests(docs).collect()), key=repr)
    assert got == sorted((expected(model, i, t) for i, t in rows), key=repr)
    whole = sentences.encoded(docs).collect()
    assert sorted((r.ids, r.decoded) for r in whole) == sorted(
        (model.model.encode(t or ""), model.model.decode(model.model.encode(t or ""))) for _, t in rows)
    assert sentences.digests(docs.limit(0)).collect() == []


def test_query(spark, sf_dir, model):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {tuple(r) for r in QUERIES["op13_sentence_pieces"](spark, sf_dir).collect()}
    assert got == {expected(model, r.doc_id, r.text) for r in docs}

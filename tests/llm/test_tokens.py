import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import __spark_entry__ as E
from shelfline.llm import tokens as K
from tests.conftest import SF_SMALL

TOK = Tokenizer.from_file(P.path(K.VOCABULARY))
OWN = K.Counter(P.path(K.VOCABULARY), True)


def library(text):
    return len(TOK.encode(text, add_special_tokens=False))


ODD = ["", " ", "\n", "don't stop\tnow\r\nit's", "É éÉ x ́y", "a <|endoftext|> b<|startoftext|>", "<|endof text|> <|endoftext |>",
       "a\x1cb \x1d c\x85d\xa0e　f g", "ΣΑΣ ς Σ", "123 4 5²½", "日本 語", "!!??.. ,", "x" * 5000, "a\x00b", "̸ = ̸", " '\n s 're"]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts_equal_the_library(text):
    assert OWN.count([text]) == [library(text)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(" \n\t'sÁΣ<|>"), st.characters(exclude_categories=["Cs"])), max_size=40), max_size=4))
def test_any_text_equals_the_library(texts):
    assert OWN.count(texts) == [library(t) for t in texts]


def test_memory_and_batches_are_bounded(monkeypatch):
    monkeypatch.setattr(K, "KNOWN_MAX", 40)
    monkeypatch.setattr(K, "BATCH_BYTES", 100)
    c, texts = K.Counter(P.path(K.VOCABULARY), True), [" ".join(f"wörd{k * j}" for k in range(60)) for j in range(9)]
    for t in texts:
        assert c.count([t, t]) == [library(t)] * 2 and len(c.known) <= 100


def test_query_equals_the_library(spark):
    rows = {r.doc_id: r for r in E.queries()["op6_token_counts"](spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        n = library(d.text)
        assert tuple(rows[d.doc_id]) == (d.doc_id, len(d.text.encode()), n, n > 2048)


def test_sentencepiece_and_edges(spark, documents):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    long = "Some words, again. " * 60_000
    docs = documents([(1, None), (2, ""), (3, "two  words"), (3, "two  words"), (None, "x y"), (4, long)])
    got = K.token_counts(docs, path=P.path("piece_bpe_32k.model"), drops_blanks=False)
    assert {(r.doc_id, r.n_tokens) for r in got.collect()} == {(1, 0), (2, 0), (3, len(sp.encode("two  words"))), (None, len(sp.encode("x y"))),
                                                              (4, len(sp.encode(long)))}
    own = K.token_counts(docs)
    assert own.columns == ["doc_id", "lang", "source", "n_chars", "key", "n_tokens"]
    assert {(r.doc_id, r.n_tokens) for r in own.collect()} == {(1, 0), (2, 0), (3, 2), (None, 2), (4, library(long))} and own.count() == 6
    assert K.token_counts(documents([])).count() == 0

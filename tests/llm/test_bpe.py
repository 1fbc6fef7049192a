import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as E
from shelfline.llm import bpe as B
from tests.conftest import SF_SMALL


def library(name=B.VOCABULARY):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(name), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


ENC = library()
OWN = B.load(P.path(B.VOCABULARY))
ODD = ["", " ", "a", "\n\n  x", "don't  stop\t\tnow \n", "naïve ééé", "日本語テキスト", "x\x1c\x1d y\x85z\xa0  q​", "🙂🙂 ́a",
       "<|endoftext|>", "a" * 3000, "ab" * 1500, " " * 500 + "x", "١٢٣ Ⅳ ½", "\x00\x01\x7f", "a\u1680b \u2000 c\u200a\u200b\u2028d\u3000e\ufeff f\u180e\x0b\x0cg", "thnthndhain " * 50]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts_equal_the_library(text):
    [ids] = OWN.encode([text])
    assert np.frombuffer(ids, "<u4").tolist() == ENC.encode_ordinary(text)
    assert OWN.decode([ids]) == [text.encode()]


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_any_text_equals_the_library(text):
    assert np.frombuffer(OWN.encode([text])[0], "<u4").tolist() == ENC.encode_ordinary(text)


def test_perfect_hash_is_minimal():
    keys = [str(k).encode() for k in range(20_000)] + [b""]
    t = B.PerfectHash(keys)
    assert sorted(t.slots(keys).tolist()) == list(range(len(keys)))


def test_memory_is_bounded_and_long_texts_are_whole(monkeypatch):
    monkeypatch.setattr(B, "KNOWN_MAX", 50)
    monkeypatch.setattr(B, "WHOLE_CHARS", 1000)
    own, text = B.Bpe(P.path("byte_bpe_multi_50k.tiktoken")), " ".join(f"wörd{k * 7919 % 4001}" for k in range(3000))
    enc = library("byte_bpe_multi_50k.tiktoken")
    assert np.frombuffer(own.encode(['a b', text])[1], "<u4").tolist() == enc.encode_ordinary(text)
    assert np.frombuffer(own.encode(["a b c"])[0], "<u4").tolist() == enc.encode_ordinary("a b c")


def test_query_equals_the_library(spark):
    rows = {r.doc_id: r for r in E.queries()["op10_bpe_round_trip"](spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = ENC.encode_ordinary(d.text)
        assert tuple(rows[d.doc_id]) == (d.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                                         hashlib.sha256(d.text.encode()).hexdigest())


def test_edges_of_the_input(spark, documents):
    docs = documents([(1, None), (2, ""), (3, "same"), (3, "same"), (None, "x y"), (4, "long words " * 100_000)])
    got = B.decode(B.encode(docs)).collect()
    assert sorted((r.doc_id or 0, bytes(r.decoded)) for r in got) == sorted([(1, b""), (2, b""), (3, b"same"), (3, b"same"), (0, b"x y"),
                                                                            (4, b"long words " * 100_000)])
    assert B.encode(docs).columns == ["doc_id", "lang", "source", "n_chars", "key", "ids"]
    assert B.round_trip(documents([])).count() == 0

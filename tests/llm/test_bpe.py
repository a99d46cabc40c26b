import random

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from quillforge.llm import bpe
from quillforge.session import table


@pytest.fixture(scope="module")
def enc():
    return bpe.encoder()


@pytest.fixture(scope="module")
def reference(enc):
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=enc.ranks, special_tokens={})


def test_documents(spark, small, reference):
    docs = table(spark, small, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r.ids for r in bpe.encode_documents(docs).collect()}
    assert got == {i: reference.encode_ordinary(t) if t else [] for i, t in texts.items()}
    counts = {r.doc_id: r.n_tokens for r in bpe.token_counts(docs).collect()}
    assert counts == {i: len(x) for i, x in got.items()}


def test_edges(spark, reference):
    texts = [None, "", " ", "\n\n", "字" * 30_000, "a" * 30_000, "<|endoftext|>", "é" * 5, "👷🏽‍♀️x"]
    rows = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)] + [(0, None, 9)], "doc_id bigint, text string, ids int")
    got = sorted((r.doc_id, r.ids) for r in bpe.encode_documents(rows).collect())
    assert got[:2] == [(0, []), (0, [])]
    assert got[1:] == [(i, reference.encode_ordinary(t or "")) for i, t in enumerate(texts)]
    assert bpe.encode_documents(rows.limit(0)).count() == 0


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_any_text(enc, reference, text):
    assert enc.encode(text) == reference.encode_ordinary(text)
    assert b"".join({v: k for k, v in enc.ranks.items()}[i] for i in enc.encode(text[:3])) == text[:3].encode("utf-8", "replace")


def test_heap_merges_like_the_scan(enc):
    rng = random.Random(5)
    for _ in range(500):
        word = bytes(rng.choice(b"abcther\xe4\xb8\xad\xe5") for _ in range(rng.randint(1, 40)))
        assert enc.scan(word) == enc.heap(word)

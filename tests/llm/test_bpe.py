"""Byte-level BPE against the library."""

import hashlib

import public_tokenizers
import tiktoken

from tessera.llm import bpe
from tessera.llm.queries import QUERIES
from tests.llm.test_formats import ODD

RANKS = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def brute(doc, text):
    ids = LIBRARY.encode_ordinary(text or "")
    return doc, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_encode(spark):
    texts = ODD + [" \u0085 a b", "don't we'll 'S", "ааббвв приветмир", "ñandú übergrößenträger " * 30, "q" * 700, "\U0001f600‍\U0001f600", "a\r\n\r\n b"] + ["same text"] * 20
    df = spark.createDataFrame([*((i, t, 1) for i, t in enumerate(texts)), (None, "no id", 1)], "doc_id long, text string, ids int").repartition(3)
    want = sorted((brute(i, t) for i, t in [*enumerate(texts), (None, "no id")]), key=str)
    for most in (10**6, 40, 0):
        assert sorted((tuple(r) for r in bpe.encode_documents(df, RANKS, public_tokenizers.PATTERN, most_words=most, slice_words=50).collect()), key=str) == want
    for most in (10**6, 40):
        got = {(r.doc_id, tuple(r.ids)) for r in bpe.encode_documents(df, RANKS, public_tokenizers.PATTERN, most_words=most, slice_words=50, ids=True).collect()}
        assert got == {(i, tuple(LIBRARY.encode_ordinary(t or ""))) for i, t in [*enumerate(texts), (None, "no id")]}
    assert bpe.encode_documents(df.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_bpe_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert {tuple(r) for r in QUERIES["op10_bpe"](spark, sf).collect()} == {brute(r.doc_id, r.text) for r in docs}

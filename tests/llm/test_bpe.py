"""Byte-level BPE: equal to the public library's ids, by brute force over windows, and a round trip."""

from __future__ import annotations

import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from histora.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(PATH).read().splitlines())}
PUBLIC = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
PIECES = ["a", "b", "é", " ", "  ", "\n", "\t", "1", "23", "'", "'s", "'re", "r", "e", "ll", "don't", "!!", "日本", "ü", "the",
          " th", "🙂", "\r\n", "\x1c", "\x85", "\xa0", "\u2003", "²", "Ⅷ", "_", "\u200b", "a\u0301", "٣"]


@pytest.mark.parametrize("chars,size", [(8, 4), (20, 6), (64, 12), (8192, 12)])
def test_ids_equal_the_public_library(monkeypatch, chars, size):
    monkeypatch.setattr(bpe, "LEAF_CHARS", chars)
    monkeypatch.setattr(bpe, "LEAF_BYTES", size)
    own = bpe.ByteBpe(RANKS, P.PATTERN)
    rng, texts = random.Random(chars), []
    for k in range(800):
        text = "".join(rng.choices(PIECES if k % 3 else list("athens"), k=rng.randint(0, 120)))
        text += " " * rng.randint(0, 40) + text if k % 7 == 0 else ""
        ids = own.encode(text)
        assert ids == PUBLIC.encode_ordinary(text)
        assert own.decode(ids) == text.encode()
        texts.append(text)
    for most in (4, 600_000):
        fresh = bpe.ByteBpe(RANKS, P.PATTERN, most)
        assert list(fresh.encode_all(texts)) == [PUBLIC.encode_ordinary(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    assert bpe.ByteBpe(RANKS, P.PATTERN).encode(text) == PUBLIC.encode_ordinary(text)


def test_very_long_piece_and_long_white_space(monkeypatch):
    own = bpe.ByteBpe(RANKS, P.PATTERN, cache_pieces=3)
    for text in ("antidisestablishment" * 2000, "x" + " " * 20000 + "y", "\n" * 9000, "é" * 9000, "a b " * 9000):
        assert own.encode(text) == PUBLIC.encode_ordinary(text)


def test_join_of_neighbours_is_the_encoding_of_the_whole():
    own = bpe.ByteBpe(RANKS, P.PATTERN)
    rng = random.Random(3)
    for _ in range(500):
        data = "".join(rng.choices("the and ing tion er", k=rng.randint(2, 40))).replace(" ", "").encode()
        cut = rng.randint(0, len(data))
        assert own.join_tokens(own._merge(data[:cut]), own._merge(data[cut:])) == own._merge(data)


def test_documents_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, None, "x", 1), (2, "", "x", 1), (3, "Hello  world's end", "x", 1), (3, "Hello  world's end", "x", 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids_sha256 string, n_tokens int")
    got = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
           for r in bpe.encode_digests(docs, PATH, P.PATTERN).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    ids = PUBLIC.encode_ordinary("Hello  world's end")
    assert got == {(1, 0, empty, empty), (2, 0, empty, empty),
                   (3, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256(b"Hello  world's end").hexdigest())}
    assert bpe.encode_digests(docs.limit(0), PATH, P.PATTERN).count() == 0
    back = bpe.decode_documents(bpe.encode_documents(docs, PATH, P.PATTERN), PATH).collect()
    assert sorted((r["doc_id"], bytes(r["data"])) for r in back) == sorted((r[0], (r[1] or "").encode()) for r in rows)


def test_long_repetitive_pieces_take_seconds_at_most():
    """The heap merges in n log n steps, and equal blocks of a piece are encoded once."""
    import time
    own = bpe.ByteBpe(RANKS, P.PATTERN)
    for text in ("-=" * 20_000, "a" * 160_000, "".join(random.Random(5).choices("abc", k=60_000))):
        start = time.process_time()
        ids = own.encode(text)
        assert time.process_time() - start < 10
        assert ids == PUBLIC.encode_ordinary(text)


def test_decoding_up_the_tree(monkeypatch):
    monkeypatch.setattr(bpe, "LEAF_IDS", 3)
    own = bpe.ByteBpe(RANKS, P.PATTERN)
    for n in (0, 1, 3, 4, 50):
        text = "words é and 日本 " * n
        assert own.decode(own.encode(text)) == text.encode()

from __future__ import annotations

import random
import re

import pytest

from histora.llm.common import alnum_hasher, alnum_words, rows_with_ids, rows_without_ids


@pytest.mark.parametrize("bits", [64, 1 << 12, 1 << 24])
def test_id_filters(spark, bits):
    rows = spark.range(1000).selectExpr("if(id % 50 = 0, null, id) AS doc_id", "id AS _word", "'x' AS _bits")
    ids = spark.createDataFrame([(i,) for i in range(0, 2000, 3)], "doc_id bigint")
    want = {r["_word"] for r in rows.collect() if r["doc_id"] is None or r["doc_id"] % 3}
    out = rows_without_ids(rows, ids, bits=bits)
    assert out.columns == rows.columns and sorted(r["_word"] for r in out.collect()) == sorted(want)
    some = {r["doc_id"] for r in rows_with_ids(rows, ids, bits=bits).collect()}
    assert some >= {i for i in range(0, 1000, 3) if i % 50}
    assert rows_without_ids(rows, ids.limit(0), bits=bits).count() == 1000 and rows_with_ids(rows, ids.limit(0), bits=bits).count() == 0


def test_word_hashes_tell_words_apart_and_only_words():
    rng, hasher = random.Random(1), alnum_hasher()
    texts = ["".join(rng.choices(["a", "B", "é", "7", " ", ".", "\n", "long" * 30, "x" * 70], k=rng.randint(0, 30))) for _ in range(300)]
    word, first = alnum_words(texts, hasher)
    seen: dict[str, int] = {}
    for text, a, b in zip(texts, first[:-1], first[1:]):
        words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", text.lower())
        assert len(words) == b - a
        for w, h in zip(words, word[a:b].tolist()):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)

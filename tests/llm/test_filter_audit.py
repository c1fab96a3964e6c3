from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest

from histora.llm import filter_audit
from histora.llm.filter_audit import audit_filters, found_in, merged, text_bits

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, bits int, part string"


def plain_bits(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return ((len(words) < 100) | (100 * len(set(words)) < 80 * len(words)) << 1
            | (100 * len(re.findall(r"[A-Z]", text)) > 10 * len(text)) << 2 | bool(re.search(r"[#$%&*|]", text)) << 3)


def brute_force(docs, labels):
    docs = [(i, t or "", lang or "") for i, t, lang in docs]
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t] = min(i, least.get(t, i))
    fails = [plain_bits(t) | (i is not None and least[t] < i) << 4 for i, t, _ in docs]
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, x in labels if i is not None and x == 1}
    out = []
    for part in {d[2] for d in docs}:
        own = [(d[0], f) for d, f in zip(docs, fails) if d[2] == part]
        rows = []
        for order in itertools.permutations("ABCDE"):
            live = own
            for step, letter in enumerate(order):
                bit = 1 << "ABCDE".index(letter)
                gone = [x for x in live if x[1] & bit]
                live = [x for x in live if not x[1] & bit]
                rows.append((part, "".join(order), step + 1, len(live), len(gone),
                             sum(bool(f & bit) for _, f in own) - len(gone), sum(f == bit for _, f in own),
                             sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)))
        for r in rows:
            letter = r[1][r[2] - 1]
            out.append((*r, sum(x[4] for x in rows if x[1][x[2] - 1] == letter)))
    return sorted(out)


def texts(rng):
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choices(words[:rng.choice([40, 300])], k=rng.choice([5, 99, 100, 140]))) for _ in range(25)]
    return base + [x.upper() for x in base[:8]] + [f"{x} 5%" for x in base[:8]] + ["", None, "É" * 9 + "A", "\x1c a"]


@pytest.mark.parametrize("rows_a_range", [3, 1 << 16])
def test_equals_filtering_in_every_order(spark, monkeypatch, rows_a_range):
    monkeypatch.setattr(filter_audit, "RANGE_ROWS", rows_a_range)
    monkeypatch.setattr(filter_audit, "HOT_PARTS", 20)
    rng = random.Random(rows_a_range)
    pool = texts(rng)
    docs = [(rng.choice([i, i, i % 40, None]), rng.choice(pool), rng.choice(["en", "de", "", None])) for i in range(400)]
    docs += [(500 + i, pool[0], "en") for i in range(60)] + [(7, pool[1], "de")] * 30 + [(None, pool[2], "xx")] * 5
    labels = [(rng.choice([i, i % 50, None]), rng.choice([0, 1, None, 2]), rng.choice([0, 1, None])) for i in range(300)]
    df = spark.createDataFrame([(*d, "s", 1, 9, "p") for d in docs], DOCS).repartition(4)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    assert sorted(tuple(r) for r in audit_filters(df, marks).collect()) == brute_force(docs, labels)


def test_empty_tables_and_parts_without_failures(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert audit_filters(spark.createDataFrame([], DOCS), none).collect() == []
    clean = " ".join(f"w{i}" for i in range(120))
    docs = [(1, clean, "en"), (2, clean + " z", "en")]
    df = spark.createDataFrame([(*d, "s", 1, 9, "p") for d in docs], DOCS)
    found = sorted(tuple(r) for r in audit_filters(df, none).collect())
    assert found == brute_force(docs, []) and {r[3:] for r in found} == {(2, 0, 0, 0, 0, 0, 0)}


def test_words_and_limits_are_those_of_the_pattern():
    rng = random.Random(3)
    alphabet = ["a", "B", "é", " ", "\x1f", "\x0b", " ", "\n", "%", "\x85", "😀"]
    for _ in range(400):
        text = "".join(rng.choices(alphabet, weights=[5, 1, 1, 1, 1, 2, 4, 1, .05, 1, 1], k=rng.choice([0, 3, 260, 2000])))
        assert text_bits(text.encode()) == plain_bits(text)
    long_text = "word other " * 400_000
    assert text_bits(long_text.encode()) == 2


def test_sorted_lists():
    rng = np.random.default_rng(1)
    for n, m in [(0, 5), (5, 0), (3, 400), (400, 3), (200, 200)]:
        a, b = np.sort(rng.integers(0, 500, n)), np.unique(rng.integers(0, 500, m))
        assert found_in(a, b).tolist() == [x in set(b.tolist()) for x in a.tolist()]
        assert merged(np.unique(a), b).tolist() == sorted({*a.tolist(), *b.tolist()})

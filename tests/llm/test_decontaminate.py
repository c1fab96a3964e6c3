from __future__ import annotations

import random
import re

import numpy as np

from histora.llm.decontaminate import contaminated, latent_basis, lcs

SF = "/root/testdata/sf0.01"


def test_lcs_equals_the_table():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, 25))] for _ in range(2))
        t = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1, j + 1] = t[i, j] + 1 if x == y else max(t[i, j + 1], t[i + 1, j])
        assert lcs(np.array(a), np.array(b)) == t[-1, -1]


def test_basis_spans_the_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, sorted(rng.choice(60, 8, replace=False).tolist()), rng.uniform(1, 5, 8).tolist()) for i in range(30)]
    dense = np.zeros((30, 60))
    for i, at, w in rows:
        dense[i, at] = w
    basis = latent_basis(spark.createDataFrame(rows, "id bigint, at array<int>, weight array<double>").repartition(3), 60, 10)
    _, s, v = np.linalg.svd(dense, full_matrices=False)
    assert np.linalg.norm(dense @ basis, axis=0) == __import__("pytest").approx(s[:10], rel=1e-2)
    assert np.abs(v[:4] @ basis).max(axis=1).min() > 0.99


def test_planted_items_equal_brute_force(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    flat = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    known = {r["item_id"]: flat(r["text"]) for r in items.collect()}
    want = {(r["doc_id"], i) for r in docs.collect() for i, t in known.items() if t in flat(r["text"])}
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(docs, items).collect()}
    assert want and got == want


def test_paraphrases_and_near_misses(spark):
    rng = random.Random(5)
    words = [f"{a}{b}" for a in ("ba", "ko", "mi", "tu", "re", "sal", "ven") for b in ("lor", "nak", "pid", "sen", "tum", "vex")]
    common = ["the", "of", "and", "to", "in"]
    prose = lambda n: [rng.choice(common if rng.random() < 0.4 else words) + (str(rng.randrange(300)) if rng.random() < 0.4 else "")
                       for _ in range(n)]
    items = {i: prose(rng.choice((16, 30, 45, 90))) for i in range(30)}
    rows, want = [], set()
    for d in range(200):
        text = prose(rng.choice((5, 60, 400)))
        if d % 3 == 0:
            i = rng.randrange(30)
            item = list(items[i])
            for _ in range(len(item) // 8):      # one word in eight replaced, and one left out
                item[rng.randrange(len(item))] = rng.choice(words)
            del item[rng.randrange(len(item) - 6)]
            at = rng.randrange(len(text) + 1)
            text[at:at] = [w.upper() + ",;"[rng.randrange(2)] for w in item]
            want.add((d, i))
        elif d % 3 == 1:                          # the same words in another order are no leak
            item = list(items[rng.randrange(30)])
            rng.shuffle(item)
            text += item
        rows.append((d, " ".join(text), "x"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lcs string")
    bench = spark.createDataFrame([(i, " ".join(w) + ".", 1) for i, w in items.items()], "item_id bigint, text string, term int")
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(docs, bench).collect()}
    assert got == want


def test_paraphrases_whose_rare_words_are_replaced(spark):
    """What the checks would accept is found, at a rank below the number of passages: 6 of 21 words replaced, the rarest."""
    from histora.llm import decontaminate
    rng = random.Random(8)
    common = [f"c{i}" for i in range(150)]
    items, docs, want = {}, [], set()
    for i in range(400):
        rare = [f"r{i}x{j}" for j in range(9)]
        words = rare[:6] + [rng.choice(common) for _ in range(9)] + rare[6:] + [rng.choice(common) for _ in range(3)]
        rng.shuffle(words)
        items[i] = words
        if i % 4 == 0:
            gone = set(rare[:6])
            replaced = [f"n{i}y{j}" if w in gone else w for j, w in enumerate(words)]
            kept = sum(w in gone for w in words[-6:])
            docs.append((i, " ".join([rng.choice(common) for _ in range(rng.choice([0, 40]))] + replaced)))
            if kept <= 3:            # half of the answer, the last quarter, is there
                want.add((i, i))
    assert len(items) > decontaminate.RANK and len(want) > 70
    docs += [(1000 + i, " ".join(rng.choices(common, k=120))) for i in range(300)]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(spark.createDataFrame(docs, "doc_id bigint, text string"),
                                                             bench).collect()}
    assert len(got & want) >= 0.95 * len(want) and not got - {(i, i) for i in range(400)}


def test_copies_are_checked_once(spark, monkeypatch):
    from histora.llm import decontaminate
    items = decontaminate.Items.of([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa")])
    calls, real = [], decontaminate.common_length
    monkeypatch.setattr(decontaminate, "common_length", lambda *a: calls.append(1) or real(*a))
    search = decontaminate.Search(items, *[np.empty(0)] * 9)
    for _ in range(50):
        assert search.shares(0, items.words[0]) == (1.0, 1.0)
    assert len(calls) == 2


def test_edges(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [(1, None), (2, ""), (3, "..."), (4, f"x y {item} z"), (4, f"x y {item} z"), (5, "word " * 300_000 + item), (None, item),
            (6, "unrelated words only")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, item), (2, item.upper()), (3, None), (4, ""), (5, "?!"), (None, item)], "item_id bigint, text string")
    assert sorted((r["doc_id"], r["item_id"]) for r in contaminated(docs, bench).collect()) == [(4, 1), (4, 2), (5, 1), (5, 2)]
    assert contaminated(docs, bench.limit(0)).count() == 0 and contaminated(docs.limit(0), bench).count() == 0
    assert contaminated(docs, bench.where("item_id > 2")).count() == 0

from __future__ import annotations

import numpy as np
import pytest

from histora.llm import toxicity as tox


def test_block_max_search_is_exact():
    rng = np.random.default_rng(1)
    idf = rng.uniform(0.2, 6, 40)
    terms = [np.sort(rng.choice(40, rng.integers(1, 8), replace=False)) for _ in range(700)]
    counts = [rng.integers(1, 5, len(t)) for t in terms]
    index = tox.BlockMaxIndex.of(idf, np.arange(700), rng.integers(0, 2, 700).astype(float), terms, counts)
    dense = np.zeros((700, 40))
    for i, (t, c) in enumerate(zip(terms, counts)):
        dense[i, t] = tox.tf_weight(c) * idf[t]
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    for _ in range(60):
        t = np.sort(rng.choice(40, rng.integers(1, 9), replace=False))
        c = rng.integers(1, 4, len(t))
        q = np.zeros(40)
        q[t] = tox.tf_weight(c) * idf[t]
        cosine = (dense @ (q / np.linalg.norm(q))).round(12)
        want = [i for i in np.lexsort((np.arange(700), -cosine))[:15] if cosine[i] > 0]
        e, s = index.nearest(t, c, 15)
        assert list(s) == pytest.approx(cosine[want], abs=1e-9) and set(e) >= {i for i in want if cosine[i] > s.min() + 1e-9}


def test_isotonic_rises():
    at, score = tox.isotonic(np.array([0.1, 0.2, 0.3, 0.4, 0.4]), np.array([0, 1, 0, 1, 1]))
    assert list(at) == sorted(at) and list(score) == sorted(score)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = tox.score_toxicity(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    rows = got.join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    assert sum(r["predicted"] != r["toxic"] for r in rows) <= 0.06 * len(rows)
    assert sum(r["predicted"] == 1 and r["toxic"] == 0 for r in rows) <= 2
    assert all(0 <= r["score"] <= 1 for r in rows)


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, f"plain text number{i % 50} with nasty word" if i % 4 == 0 else f"plain text number{i % 50} with nice word")
            for i in range(400)]
    labels = [(i, 1 if i % 4 == 0 else 0) for i in range(400)]
    extra = [(1000, None), (1001, ""), (1002, "NASTY, " * 3), (1003, "x " * 200_000 + "nasty"), (1003, "x " * 200_000 + "nasty"), (None, "nasty")]
    return (spark.createDataFrame([(i, t, "en", 0.5) for i, t in rows + extra], "doc_id bigint, text string, terms string, score double"),
            spark.createDataFrame([(i, y, 1) for i, y in labels] + [(3, None, 1), (None, 1, 1)], "doc_id bigint, toxic int, quality int"))


def test_edges(table):
    got = {}
    for r in tox.score_toxicity(*table).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, got.values())) == 406
    assert got[1000][0]["predicted"] == got[1001][0]["predicted"] == 0
    assert [r["predicted"] for i in (1002, 1003, None) for r in got[i]] == [1, 1, 1, 1]
    assert all(got[i][0]["predicted"] == int(i % 4 == 0) for i in range(400))


def test_labels_of_held_out_rows_are_not_learned(spark, table):
    docs, labels = table
    flipped = labels.withColumn("toxic", tox.F.when(tox.held_out(), 1 - tox.F.col("toxic")).otherwise(tox.F.col("toxic")))
    one, two = (sorted((r["doc_id"] or -1, r["score"]) for r in tox.score_toxicity(docs, x).collect()) for x in (labels, flipped))
    assert one == two


def test_without_labels_or_rows(table):
    docs, labels = table
    assert {r["score"] for r in tox.score_toxicity(docs, labels.limit(0)).collect()} == {0.5}
    assert {r["predicted"] for r in tox.score_toxicity(docs, labels.where("toxic = 0")).collect()} == {0}
    assert tox.score_toxicity(docs.limit(0), labels).count() == 0

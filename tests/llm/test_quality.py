from __future__ import annotations

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from histora.llm import quality
from histora.llm.quality import (DIAGONAL, STATISTICS, Discriminant, Moments, _moments, described, fitted, held_out,
                                 score_quality, statistics, train)

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, x string, score double"


def some_text(rng, good):
    words = [rng.choice(["house", "tree", "walks", "the", "of", "Green", "sea", "and"]) + rng.choice(["", "", ",", "."])
             for _ in range(rng.randint(1, 80))]
    if good:
        return " ".join(words)
    return " ".join(w + rng.choice(["###", "$$", "%"]) for w in words) if rng.random() < 0.5 else " ".join(words[:1] * 60)


def corpus(spark, n=500, seed=1):
    rng = random.Random(seed)
    truth = {i: int(rng.random() < 0.7) for i in range(n)}
    docs = spark.createDataFrame([(i, some_text(rng, y), "en", "s", 1, "x", 0.5) for i, y in truth.items()], DOCS)
    labels = spark.createDataFrame([(i, y, 0) for i, y in truth.items()], "doc_id bigint, quality int, toxic int")
    return docs.repartition(5), labels, truth


def test_held_out_accuracy_and_split(spark):
    docs, labels, truth = corpus(spark)
    out = score_quality(docs, labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.collect()
    assert len(rows) == 500 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_held_out_labels_and_other_columns_change_nothing(spark):
    docs, labels, _ = corpus(spark)
    turned = labels.withColumn("quality", F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    changed = docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None).cast("string"))
    a = {r["doc_id"]: r["score"] for r in score_quality(docs, labels).collect()}
    b = {r["doc_id"]: r["score"] for r in score_quality(changed, turned).collect()}
    assert a.keys() == b.keys() and all(abs(a[i] - b[i]) < 1e-9 for i in a)


def test_moments_and_densities_equal_the_plain_formulas(spark):
    docs, labels, truth = corpus(spark, 120)
    rows = described(docs).join(labels, "doc_id").select("x", F.col("quality").alias("y"))
    found = _moments(rows.repartition(4))
    held = rows.collect()
    classes = []
    for c in (0, 1):
        x = np.array([r["x"] for r in held if r["y"] == c])
        assert found[c].n == len(x)
        np.testing.assert_allclose(found[c].mean, x.mean(axis=0), atol=1e-9)
        np.testing.assert_allclose(found[c].scatter / len(x), np.cov(x.T, bias=True), atol=1e-8)
        classes.append(x)
    shrinkage = 0.25
    model = fitted((found[0], found[1]), shrinkage)
    pooled = sum(np.cov(x.T, bias=True) * len(x) for x in classes) / 120
    x = np.vstack(classes)
    log_p = []
    for own in classes:
        cov = (1 - shrinkage) * np.cov(own.T, bias=True) + shrinkage * pooled
        cov = (1 - DIAGONAL) * cov + DIAGONAL * np.diag(np.diag(cov)) + quality._LEAST_VARIANCE * np.eye(len(cov))
        gap = x - own.mean(axis=0)
        log_p.append(-0.5 * np.einsum("ni,ij,nj->n", gap, np.linalg.inv(cov), gap) - 0.5 * np.linalg.slogdet(cov)[1])
    np.testing.assert_allclose(np.sinh(model.evidence(x)), log_p[1] - log_p[0], rtol=1e-6, atol=1e-5)


def test_statistics_of_odd_texts():
    for text in ["", " ", "\n\n", "a", "😀", "\x00", "É" * 3, "x" * 1_000_000, "word " * 300_000]:
        found = statistics(text)
        assert len(found) == len(STATISTICS) and np.isfinite(found).all()


def test_nulls_repeats_and_missing_classes(spark):
    docs, labels, _ = corpus(spark, 200)
    odd = spark.createDataFrame([(None, "a house", None, None, None, None, None), (900, None, None, None, None, None, None),
                                 (901, "", "en", "s", 0, "x", 0.1), (5, "a house", "en", "s", 1, "x", 0.1)], DOCS)
    noise = spark.createDataFrame([(None, 1, 0), (6, None, 0), (7, 9, 0), (8, 1, None), (8, 0, None)],
                                  "doc_id bigint, quality int, toxic int")
    rows = score_quality(docs.union(odd), labels.union(noise)).collect()
    assert len(rows) == 204 and all(0 <= r["score"] <= 1 for r in rows)
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [False]
    empty = {r["doc_id"]: r["score"] for r in rows if r["doc_id"] in (900, 901)}
    assert empty[900] == empty[901]
    ones = labels.where("quality = 1")
    n = ones.where(~held_out()).count()
    lone = {r["score"] for r in score_quality(docs, ones).collect()}
    assert len(lone) == 1 and 0.5 < lone.pop() <= (n + 1) / (n + 2)
    assert {r["score"] for r in score_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert score_quality(docs.limit(0), labels).count() == 0


def test_a_model_without_spread_is_finite():
    flat = Moments(10, np.ones(len(STATISTICS)) * 10, np.ones((len(STATISTICS),) * 2) * 10)
    model = fitted((flat, flat), 0.1)
    assert np.isfinite(model.score(np.ones((2, len(STATISTICS))))).all()
    assert Discriminant(0.25).score(np.ones((2, 3))).tolist() == [0.25, 0.25]

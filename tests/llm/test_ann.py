from __future__ import annotations

import numpy as np
import pytest

from histora.llm import ann

SCHEMA = "vec_id bigint, embedding array<float>, block string, cell int"


def brute(ids, x, q, k=20):
    s = x @ x[ids == q][0]
    s = np.where(ids == q, -np.inf, s)
    return [int(i) for i in ids[np.lexsort((ids, -s))][:min(k, len(ids) - 1)]]


@pytest.mark.parametrize("make", ["random", "clusters"])
def test_recall(spark, make):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((3000, 16))
    if make == "clusters":
        x = rng.standard_normal((20, 16))[rng.integers(0, 20, 3000)] * 3 + x * 0.5
    x = x.astype(np.float32).astype(float)
    ids = np.arange(3000)
    rows = ann.nearest_neighbours(spark.createDataFrame([(int(i), v.tolist(), "x", 1) for i, v in zip(ids, x)], SCHEMA)).toPandas()
    assert len(rows) == 150 * 20 and set(rows["query_id"]) == set(range(0, 3000, 20))
    met = 0
    for q, g in rows.groupby("query_id"):
        g = g.sort_values("rank")
        assert list(g["rank"]) == list(range(1, 21)) and q not in set(g["vec_id"])
        assert list(g["score"]) == sorted(g["score"], reverse=True)
        assert g["score"].to_numpy() == pytest.approx(x[g["vec_id"]] @ x[q], abs=1e-12)
        met += len(set(g["vec_id"]) & set(brute(ids, x, q)))
    assert met >= 0.9 * 3000


def test_cells_come_in_falling_order():
    rng = np.random.default_rng(4)
    index = ann.MultiIndex(rng.standard_normal((9, 4)), rng.standard_normal((7, 4)), np.ones(63, np.int64))
    q = rng.standard_normal(8)
    value = ((index.left @ q[:4])[:, None] + (index.right @ q[4:])[None, :]).ravel()
    walked = list(index.walk(q))
    assert sorted(walked) == list(range(63)) and np.all(np.diff(value[walked]) <= 1e-12)


def test_large_cells_are_split_and_small_ones_share(monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 10)
    index = ann.MultiIndex(np.zeros((1, 1)), np.zeros((1, 1)), np.array([3, 4, 35, 5, 6, 0, 10]))
    index.lay_out()
    rows: dict[int, float] = {}
    for c, n in enumerate(index.size):
        for s in range(index.splits[c]):
            b = index.block[c] + s
            rows[b] = rows.get(b, 0) + n / index.splits[c]
    assert max(rows.values()) <= 10 and sum(rows.values()) == 63


def test_split_cells_give_the_same_answer(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = np.round(rng.standard_normal((400, 4)), 1) + 0.05
    frame = spark.createDataFrame([(int(i), v.tolist(), "x", 1) for i, v in enumerate(x)], SCHEMA)
    want = sorted(map(tuple, ann.nearest_neighbours(frame).collect()))
    monkeypatch.setattr(ann, "BLOCK_ROWS", 16)
    monkeypatch.setattr(ann, "QUERY_ROWS", 3)
    assert sorted(map(tuple, ann.nearest_neighbours(frame).collect())) == want


def test_invalid_vectors_ties_and_few_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 0.0]), (40, None), (60, [nan, 1.0]), (80, [inf, 1.0]), (100, [None, 1.0]), (120, [1.0]),
            (3, [2.0, 0.0]), (2, [2.0, 0.0]), (1, [2.0, 5.0]), (None, [1.0, 1.0]), (140, [0.0, 1.0])]
    got = ann.nearest_neighbours(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 3, 2.0), (0, 4, 140, 0.0),
                                       (140, 1, 1, 5.0), (140, 2, 0, 0.0), (140, 3, 2, 0.0), (140, 4, 3, 0.0)]
    assert ann.nearest_neighbours(spark.createDataFrame([], SCHEMA)).count() == 0
    assert ann.nearest_neighbours(spark.createDataFrame([(7, [1.0], "x", 1)], SCHEMA)).count() == 0


def test_an_id_given_several_times_is_one_entry(spark):
    rng = np.random.default_rng(6)
    x = np.round(rng.standard_normal((60, 4)), 2) + 0.005
    one = [(i, v.tolist(), "x", 1) for i, v in enumerate(x)]
    want = sorted(map(tuple, ann.nearest_neighbours(spark.createDataFrame(one, SCHEMA)).collect()))
    assert len(want) == 3 * 20
    for rows in (one + one[:1], one * 2, one * 3 + one[40:]):
        frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
        assert sorted(map(tuple, ann.nearest_neighbours(frame).collect())) == want
    # ids with several vectors: the best row counts, the least vector asks
    mixed = one + [(i, (-x[i]).tolist(), "x", 1) for i in range(60)]
    got = ann.nearest_neighbours(spark.createDataFrame(mixed, SCHEMA).repartition(4)).toPandas()
    for q, g in got.groupby("query_id"):
        ask = np.float32(min(x[q].tolist(), (-x[q]).tolist())).astype(float)
        best = sorted((-abs(float(np.float32(x[i]).astype(float) @ ask)), i) for i in range(60) if i != q)[:20]
        g = g.sort_values("rank")
        assert list(g["vec_id"]) == [i for _, i in best]
        assert g["score"].to_numpy() == pytest.approx([-s for s, _ in best], abs=1e-12)

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from histora.llm.centroids import LARGEST, SCALE, Tournament, cluster_vectors

SCHEMA = "vec_id bigint, embedding array<float>, cluster string, Distance int"


def brute_force(rows, k, rounds, seed, dims):
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda i: "~" if i is None else hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
    cents = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for j, vs in groups.items():
            cents[j] = [sum(col) // len(vs) for col in zip(*vs)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    per, total = {}, 0
    for _, j, d in found:
        per[j] = per.get(j, 0) + d
        total += d
    return sorted(((i, j, d, per[j], total, hashlib.sha256(",".join(map(str, cents[j])).encode()).hexdigest())
                   for i, j, d in found), key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, "x", 0) for i, v in rows], SCHEMA).repartition(3)
    out = cluster_vectors(df, **kw)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("k,rounds", [(1, 2), (7, 0), (7, 3), (50, 2)])
def test_equals_all_distances(spark, k, rounds):
    rng = random.Random(k)
    rows = [(rng.choice([i, i % 5, None]), [rng.choice([-0.5, 0.25, 0.0, rng.random() - 0.5]) for _ in range(4)])
            for i in range(160)]
    rows += [(900, None), (901, []), (902, [0.1] * 3), (903, [0.1, None, 0.2, 0.3]), (904, [0.1, float("nan"), 0.2, 0.3]),
             (905, [float("inf"), 0.0, 0.0, 0.0]), (906, [0.5] * 5)] + [(7, [0.25] * 4)] * 20
    want = brute_force([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v])
                        for i, v in rows], k, rounds, 2, 4)
    assert run(spark, rows, k=k, rounds=rounds, dims=4) == want


def test_fewer_vectors_than_centroids_and_empty(spark):
    rows = [(1, [0.5, 0.5]), (2, [-0.5, 0.0])]
    assert run(spark, rows, k=40, dims=2) == brute_force(rows, 40, 5, 2, 2)
    assert run(spark, [], k=40, dims=2) == [] and run(spark, [(1, None)], k=40, dims=2) == []


def test_sign_tests_are_exact_for_large_components_and_ties_go_to_the_smaller_number():
    rng = np.random.default_rng(5)
    for size in (3, 1 << 20, LARGEST):
        x = rng.integers(-size, size + 1, (300, 64))
        x[:50] = x[50:100]
        c = x[rng.choice(300, 20)]
        c[7] = c[3]
        winner, distance = Tournament(c).nearest(x)
        for row, w, d in zip(x.tolist(), winner.tolist(), distance.tolist()):
            assert (d, w) == min((sum((a - b) ** 2 for a, b in zip(row, y)), j) for j, y in enumerate(c.tolist()))


def test_components_whose_distances_do_not_fit_are_an_error(spark):
    with pytest.raises(Exception, match="do not fit a long"):
        run(spark, [(1, [2.0 * LARGEST / SCALE, 0.0]), (2, [0.0, 0.0])], k=2, dims=2)

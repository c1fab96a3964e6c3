from __future__ import annotations

import random
import re

import numpy as np
import pytest

from histora.llm.components import connected_components
from histora.llm.near_dup import Sketcher, near_duplicates, near_dup_oracle, shingle_sets, word_hasher
from tools.compare_oracles import compare


def plain_sets(texts):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        out.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def plain(rows):
    sets = dict(zip([i for i, _ in rows], plain_sets([t for _, t in rows])))
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            both = len(sets[x] & sets[y])
            if x < y and both and 100 * both >= 75 * len(sets[x] | sets[y]):
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choices(words, k=rng.choice((1, 3, 4, 5, 6, 8, 12, 40, 150))) for _ in range(n // 6)]
    rows = []
    for i in range(n):
        text = list(rng.choice(base))
        for _ in range(rng.choice((0, 0, 1, 1, 2, 4, 8))):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i * 7 + 3, rng.choice((" ", "  ", "\n", "\t ")).join(text).upper() if i % 5 == 0 else " ".join(text)))
    return rows + [(9001, None), (9002, ""), (9003, " \n\t "), (9004, "  x"), (9005, "ÄÖ äö"), (9006, "äö ÄÖ")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id bigint, text string, a string, n_shingles int")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(docs).collect()}
    assert got == plain(rows)


def test_links_hidden_behind_a_failing_centre(spark):
    """A chain: the least document fails with most, while others link among themselves."""
    rng = random.Random(8)
    base = [f"v{i}" for i in range(300)]
    rows = []
    for i in range(60):
        text = list(base)
        for _ in range(rng.choice((4, 8, 9, 10, 11))):
            text[rng.randrange(300)] = f"r{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(docs).collect()}
    assert got == plain(rows)


def test_repeated_rows_null_ids_and_empty_table(spark):
    long = "word " * 50_000
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (7, "A B  C D E F"), (8, long), (9, long + "x")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in got) == [
        (0, 0, True), (5, 5, True), (5, 5, True), (7, 5, False), (8, 8, True), (9, 9, True)]
    assert near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_densified_bins_agree_as_often_as_sets_are_similar():
    rng, sketcher, same = np.random.default_rng(2), Sketcher(), []
    for n in (4, 20, 100, 800):
        for _ in range(60):
            x = rng.integers(0, 2 ** 63, n * 8 // 7, dtype=np.uint64) * np.uint64(2)
            a, b = np.sort(x[:n]), np.sort(x[-n:])
            j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            same.append((sketcher.bins(a) == sketcher.bins(b)).mean() - j)
    assert abs(np.mean(same)) < 0.02


def test_sets_have_the_contract_sizes():
    texts = ["", "a", "a b c d", "a b c d e", "a b c d e f", "a a a a a a a", "x\x00y \x1c z"]
    assert [len(s) for s in shingle_sets(texts, word_hasher())] == [len(s) for s in plain_sets(texts)]


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(10, 40)] + [(7, 8), (8, 9), (9, 7), (50, 50)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {i: 100 for i in range(101, 161)} | {i: 5 for i in range(10, 40)} | {8: 7, 9: 7}
    assert got == want


def test_oracle_on_the_given_table(spark):
    assert "RECURSIVE" in near_dup_oracle()
    assert compare(spark, "/root/testdata/sf0.001", ["op5_near_dup"])["op5_near_dup"]["match"]

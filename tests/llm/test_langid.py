from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest

from histora.llm import langid


def plain_model(texts: list[str], order: int):
    """Interpolated Kneser-Ney with dictionaries; returns log p(symbol | context)."""
    mark = (0,) * (order - 1)
    top: Counter = Counter()
    for text in texts:
        seq = list(mark)
        for ch in text.lower() + " ":
            s = int(langid.symbols()[ord(ch)])
            if s or seq[-1]:
                seq.append(s)
        for i in range(order - 1, len(seq)):
            top[tuple(seq[i - order + 1:i + 1])] += 1
    counts = {order: top}
    for m in range(order - 1, 0, -1):
        counts[m] = Counter(k[1:] for k in counts[m + 1])
    cut = {}
    for m, c in counts.items():
        one, two = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        cut[m] = min(0.95, max(0.1, one / (one + 2 * two) if one + two else 0.5))
    size, kinds = defaultdict(float), Counter()
    for m, c in counts.items():
        for k, v in c.items():
            size[m, k[:-1]] += v
            kinds[m, k[:-1]] += 1

    def p(gram):
        m = len(gram)
        if m == 0:
            return 2.0 ** -langid.BITS
        below = p(gram[1:])
        if (m, gram[:-1]) not in size:
            return below
        total = size[m, gram[:-1]]
        held = counts[m].get(gram, 0)
        return (max(held - cut[m], 0) if held else 0) / total + cut[m] * kinds[m, gram[:-1]] / total * below

    return p


def built(texts_by_lang: dict[str, list[str]], order: int) -> langid.LanguageModel:
    langs = sorted(texts_by_lang)
    code, key, n = [], [], []
    for i, lang in enumerate(langs):
        k, used, _ = langid.keys_of(texts_by_lang[lang], order)
        k, c = np.unique(k[used], return_counts=True)
        code.append(np.full(len(k), i))
        key.append(k)
        n.append(c)
    return langid.build_model(langs, np.concatenate(code), np.concatenate(key), np.concatenate(n), order)


TEXTS = {"aa": ["the cat and the dog", "then the thin hat", "...that 12 then"], "bb": ["über die brücke", "die katze und der hund"]}


@pytest.mark.parametrize("order", [2, 3, 5])
def test_scores_equal_the_plain_model(order):
    model = built(TEXTS, order)
    for i, lang in enumerate(sorted(TEXTS)):
        p = plain_model(TEXTS[lang], order)
        for text in ("the hat", "die 3 hunde!", "xyz", "cat", "日本語 text"):
            seq = [0] * (order - 1)
            total = 0.0
            for ch in text.lower() + " ":
                s = int(langid.symbols()[ord(ch)])
                if s or seq[-1]:
                    seq.append(s)
                    total += np.log(p(tuple(seq[-order:])))
            got, _ = model.totals([text])
            assert got[0, i] == pytest.approx(total, rel=1e-4)


def test_probabilities_of_a_context_sum_to_one():
    model = built(TEXTS, 3)
    symbols = np.arange(1 << langid.BITS, dtype=np.int64)
    context = langid.keys_of(["th"], 3)[0][3] >> 0
    p = np.exp(model.score_positions((context & 0xFFFFFF) << langid.BITS | symbols).astype(float))
    assert p.sum(axis=0) == pytest.approx([1.0, 1.0], abs=1e-3)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train_model(docs.where(~langid.held_out()).select("lang", "text"))
    got = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(langid.held_out()).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.98 * len(got) and len(got) > 150
    assert all(0 <= r["score"] <= 1 for r in got) and not any(r["rejected"] for r in got)


def test_foreign_and_letterless_texts_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train_model(docs.select("lang", "text"))
    rows = [(1, None, "x"), (2, "", "x"), (3, "123 !!! ...", "x"), (4, "Ωμέγα και άλφα " * 20, "x"), (5, "the and of that", "x"),
            (5, "the and of that", "x"), (6, "zqxjk " * 50, "x"), (7, "the " * 200_000, "x")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    got = {r["doc_id"]: r for r in langid.identify(frame, model).collect()}
    for i in (1, 2, 3):
        assert (got[i]["lang_pred"], got[i]["score"], got[i]["rejected"]) == ("und", 0.0, True)
    assert got[4]["rejected"] and got[6]["rejected"] and got[4]["lang_pred"] != "und"
    assert got[5]["lang_pred"] == "en" and not got[5]["rejected"]
    assert langid.identify(frame, model).count() == len(rows)


def test_no_training_rows(spark):
    docs = spark.createDataFrame([(1, "text", None)], "doc_id bigint, text string, lang string")
    assert langid.train_model(docs) is None and langid.train_model(docs.limit(0)) is None
    assert langid.identify(docs, None).first()["lang_pred"] == "und"



@pytest.mark.parametrize("cells", [8_000_000, 60])
def test_no_ngram_is_left_out_whatever_a_task_holds(spark, cells):
    small = ["the cat and the thin dog"] * 3 + ["der hund und die katze"]
    rows = [("aa", t) for t in small[:3]] + [("bb", small[3])] + [("cc", f"{w}ka {w}lo {w}mi") for w in
                                                                  ("ba", "be", "bi", "bo", "bu")] * 40
    docs = spark.createDataFrame(rows, "lang string, text string")
    model = langid.train_model(docs, cells=cells, calibration_rows=0)
    whole = built({x: [t for lang, t in rows if lang == x] for x in ("aa", "bb", "cc")}, langid.ORDER)
    assert len(model.parts) == 1 if cells > 60 else len(model.parts) > 4
    texts = ["der hund", "the cat", "baka belo", "xyz 日本語", "", "hund " * 50]
    got, count = model.totals(texts, model.parts)
    want, n = whole.totals(texts)
    assert got == pytest.approx(want, rel=1e-5) and list(count) == list(n)
    frame = spark.createDataFrame([(1, "der hund"), (2, "the cat"), (3, "baka")], "doc_id bigint, text string")
    assert {r["doc_id"]: r["lang_pred"] for r in langid.identify(frame, model).collect()} == {1: "bb", 2: "aa", 3: "cc"}


def test_mislabelled_calibration_rows_do_not_open_the_gate(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("lang", "text")
    strays = spark.createDataFrame([("en", "κείμενο άλλης γλώσσας " * 20 + f"{i}") for i in range(200)], "lang string, text string")
    strays = strays.where("pmod(xxhash64(text), 1000000) < 90000").limit(1)     # among the rows apart
    assert strays.count() == 1
    model = langid.train_model(docs.unionByName(strays))
    foreign = ["Ωμέγα και άλφα " * 20, "пример русского текста " * 20, "la casa è bella e il gatto dorme sul divano " * 10,
               "zqxjk " * 50]
    frame = spark.createDataFrame(list(enumerate(foreign)), "doc_id bigint, text string")
    assert all(r["rejected"] for r in langid.identify(frame, model).collect())
    assert langid.identify(docs.selectExpr("1 AS doc_id", "text"), model).where("rejected AND n_symbols > 0").count() <= 10

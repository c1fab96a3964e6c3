from __future__ import annotations

import random
import re

import pytest

from histora.llm import pii

P = pii.Permuter(pii.KEY)
TEXT = ("Call +1 (743) 555-3824, 743-555-1234 or mail hein.19@mail5.example.com from 70.23.22.57. Card 4111 1111 1111 1111, "
        'order 9807915762804490, token = "2321bac4d15ec8f90433955bf9d3cf61da5bdd1e", SSN 123-45-6789, Version 2.0.')


def test_every_entity_is_replaced_in_its_own_format():
    out, found = pii.replace(TEXT, P)
    assert [k for k, *_ in found] == ["phone", "phone", "email", "ip", "card", "secret", "ssn"]
    for kind, start, end, surrogate in found:
        original = TEXT[start:end]
        assert original not in out and surrogate in out and surrogate != original
        if kind != "ip":
            assert re.sub("[a-z]", "a", re.sub("[0-9]", "9", surrogate)) == re.sub("[a-z]", "a", re.sub("[0-9]", "9", original)) \
                or kind == "secret"
    card = next(s for k, _, _, s in found if k == "card")
    assert pii.passes_luhn(card) and card[0] == "4"
    assert "order 9807915762804490" in out and "Version 2.0." in out
    assert re.search(r"token = \"[0-9a-f]{40}\"", out)


@pytest.mark.parametrize("make,kind", [
    (lambda r: f"+1 ({r.randrange(1000):03d}) 555-{r.randrange(10000):04d}", "phone"),
    (lambda r: ".".join(str(r.randrange(256)) for _ in range(4)), "ip"),
    (lambda r: f"{r.choice('abc')}{r.choice('xyz')}.{r.randrange(100)}@mail{r.randrange(9)}.example.com", "email"),
    (lambda r: (lambda b: b + str(pii.luhn(b)))("4" + "".join(str(r.randrange(10)) for _ in range(14))), "card"),
    (lambda r: f"{r.choice('BCD')}{r.choice('ae')}{r.choice('lmn')} {r.choice(['Smith', 'Kowal', 'Braun'])}", "name"),
])
def test_distinct_entities_stay_distinct(make, kind):
    rng, seen = random.Random(4), {}
    for _ in range(1500):
        entity = make(rng)
        surrogate = P.surrogate(kind, entity)
        assert seen.setdefault(surrogate, entity) == entity and surrogate != entity
        assert P.surrogate(kind, entity) == surrogate


def test_whole_small_domain_is_permuted():
    for size in (2, 3, 10, 257):
        assert sorted(P._number("t", size, x) for x in range(size)) == list(range(size))
        assert all(P._number("t", size, x) != x for x in range(size))


def test_names_keep_gender_script_and_coreference():
    out, found = pii.replace("Mr. John Smith met Mrs. Anna Keller; Smith left. Госпожа Анна Петрова", P)
    names = [s for _, _, _, s in found]
    assert names[0].split()[0] in pii.FIRST_NAMES["latin", "m"] and names[1].split()[0] in pii.FIRST_NAMES["latin", "f"]
    assert names[2] == names[0].split()[1]
    assert names[3].split()[0] in pii.FIRST_NAMES["cyrillic", "f"] and re.fullmatch("[А-Яа-яё]+", names[3].split()[1])


def test_frame_keeps_columns_nulls_and_clean_texts(spark):
    rows = [(1, None, "a", 1), (2, "", "b", 2), (3, "clean text, 42 words", "c", 3), (4, TEXT, "d", 4), (4, TEXT, "d", 4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, surrogates string, entities int")
    out = pii.pseudonymise(docs)
    assert out.columns == docs.columns
    got = sorted(map(tuple, out.collect()))
    assert got[:3] == rows[:3] and got[3] == got[4] and got[3][1] == pii.replace(TEXT, P)[0]
    assert pii.pseudonymise(docs.limit(0)).count() == 0
    assert pii.surrogate_collisions(docs).count() == 0
    long = "x " * 300_000 + "a.b@example.com"
    assert pii.replace(long, P)[0].endswith("@" + pii.replace("a.b@example.com", P)[0].split("@")[1])


def test_corpus_has_no_collisions_and_nothing_left(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert pii.surrogate_collisions(docs).count() == 0
    left = re.compile(r"[a-z]+\.[0-9]+@|\+1 \([0-9]{3}\) 555|\b[0-9a-f]{40}\b")
    before = {x for r in docs.select("text").collect() for x in left.findall(r["text"])}
    after = {x for r in pii.pseudonymise(docs).select("text").collect() for x in left.findall(r["text"])}
    assert before and not {x for x in before & after if "@" in x or len(x) == 40}


def test_every_word_of_an_announced_name_is_followed():
    text = "Mrs Anna Weber spoke. Anna said that Weber and Annabel left; Anna Weber agreed. Frau Paul Martin: Martin, Paul."
    out, found = pii.replace(text, P)
    assert not re.search(r"\b(Anna|Weber|Martin|Paul)\b", out) and "Annabel" in out
    full = found[0][3].split()
    assert [s for _, _, _, s in found[1:4]] == [full[0], full[1], " ".join(full)]
    other = found[4][3].split()
    assert [s for _, _, _, s in found[5:]] == other[::-1]


def test_jobs_fail_on_colliding_surrogates(spark, monkeypatch):
    rows = [(1, "Mrs Anna Weber; Anna. a.b@example.com", "x"), (2, None, "y"), (3, "Mr John Keller, x.y@example.com", "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, digests string")
    out = pii.checked(docs, entities="entities")
    assert out.columns == [*docs.columns, "entities"]
    assert sorted(map(tuple, out.drop("entities").collect())) == sorted(map(tuple, pii.pseudonymise(docs).collect()))
    real = pii.pseudonymise

    def colliding(*args, entities=None, **more):
        made = real(*args, entities=entities, **more)
        same = f"transform(`{entities}`, e -> named_struct('kind', e.kind, 'start', e.start, 'end', e.end, 'surrogate', 'same'))"
        return made.withColumn(entities, pii.F.expr(same))

    monkeypatch.setattr(pii, "pseudonymise", colliding)
    with pytest.raises(ValueError, match="more than one entity"):
        pii.checked(docs)

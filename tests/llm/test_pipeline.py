from __future__ import annotations

import hashlib
import re

import public_tokenizers as P

import corpus_pipeline
from histora.llm.bpe import ByteBpe, read_ranks
from histora.llm.common import stored
from histora.llm.pii import KEY, Permuter, replace


def test_every_stage_on_its_own_input(spark):
    sf = "/root/testdata/sf0.001"
    given = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    docs = given
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, sf), "test-stage")
        kept[name] = {r["doc_id"]: r for r in out.collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == given.columns and dict(out.dtypes) == dict(given.dtypes)
        docs = out
    all_docs = {r["doc_id"]: r for r in given.collect()}
    assert set(kept["language_id"]) == {i for i, r in all_docs.items() if re.search(r"[^\W\d_]", r["text"] or "")}
    # near duplicates: exact copies of a kept text are gone, every text dropped is near a kept one of lower id
    texts = [r["text"] for r in kept["near_dedup"].values()]
    assert len(texts) == len(set(texts))
    bench = [" ".join(re.findall(r"[^\W_]+", r["text"].lower())) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    flat = {i: " ".join(re.findall(r"[^\W_]+", r["text"].lower())) for i, r in kept["near_dedup"].items()}
    assert set(kept["decontamination"]) == {i for i, t in flat.items() if not any(b in t for b in bench)}
    permuter, bpe = Permuter(KEY), ByteBpe(read_ranks(open(P.path("byte_bpe_50k.tiktoken")).read().splitlines()), P.PATTERN)
    for i, r in kept["decontamination"].items():
        text = replace(r["text"], permuter)[0]
        assert kept["pii_surrogates"][i]["text"] == text and kept["pii_surrogates"][i]["n_chars"] == len(text)
        assert kept["byte_bpe"][i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert kept["byte_bpe"][i]["n_tokens"] == len(bpe.encode(text))


def test_edges(spark, tmp_path):
    rows = [(1, None, "en", "s", 0, "x"), (2, "", "en", "s", 0, "x"), (3, "the and of that with a mail a.b@example.com", "en", "s", 43, "x"),
            (3, "the and of that with a mail a.b@example.com", "en", "s", 43, "x"), (None, "the cat and the dog", None, None, None, "x"),
            (4, "the and of that with a mail a.b@example.com", "en", "s", 43, "x"), (5, "12 34 !!", None, None, None, None)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, language string"
    bench = "item_id bigint, text string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/a/documents.parquet")
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/b/documents.parquet")
    for d in "ab":
        spark.createDataFrame([(1, None)] if d == "a" else [], bench).write.parquet(f"{tmp_path}/{d}/benchmark.parquet")
    got = corpus_pipeline.run(spark, f"{tmp_path}/a").collect()
    assert sorted(r["doc_id"] or 0 for r in got) == [0, 3, 3]
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").count() == 0

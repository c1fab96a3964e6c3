"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index, weighted votes.

1. Examples are a bounded sample of the labelled training rows (``EXAMPLES`` in expectation, equal texts once).
   Words that go with the label are the terms: those of which more examples are toxic than midway between the
   base rate and all, with a chi-square that of all words less than one in ten would reach by chance (the
   threshold grows with the number of words); at most ``TERMS``.
2. One pass over all whole texts keeps each document's terms and counts, and as one more term how many of them
   differ (1, 2, 3, or ``BREADTHS`` and more); inverse document frequencies are counted
   over all documents.
3. Examples that hold a term form an inverted index: per term the weights by example, cut into blocks of
   ``BLOCK`` examples with the greatest weight per block. For a document, blocks are visited by falling upper
   bound until the bound is no more than the k-th best cosine: the k nearest examples are exact.
4. Their votes, weighted by closeness, become a score by isotonic calibration on the examples' own votes, each
   without itself. A document without any term has no neighbour; its score is the examples' rate of that case.

Defined cases: null and empty texts are documents without a term. Without training rows the score is 0.5; with
one class only it is near that class. Labels that are null are not learned from. Several labels of one id count
each. Repeated rows are scored alike; columns other than id, text and label are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histora.llm.common import alnum_hasher, alnum_words, batched, crc_mod, ship, stored

EXAMPLES = 20_000
TERMS = 8_192
NEIGHBOURS = 15
BLOCK = 128
BREADTHS = 4
THRESHOLD = 0.7


def held_out(id_col: str = "doc_id"):
    """The rows whose labels are never learned: crc32 of the id's text leaves 1 modulo 3."""
    return F.coalesce(crc_mod(id_col, 3) == 1, F.lit(False))


def examples(docs: DataFrame, labels: DataFrame, size: int = EXAMPLES) -> DataFrame:
    """(doc_id, text, toxic) of a bounded sample of the training rows.

    The sample is taken from the labels, before any text moves; its ids are at most about ``size`` and are
    broadcast, so documents are not shuffled.
    """
    rows = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", "toxic")
    total = rows.count()
    share = int(min(1.0, size / max(1, total)) * 1_000_000)
    picked = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share).distinct()
    return (docs.join(F.broadcast(picked), "doc_id").where(F.col("text").isNotNull())
            .select("doc_id", "text", F.col("toxic").cast("int").alias("toxic")).dropDuplicates(["text", "toxic"]))


def choose_terms(rows: DataFrame, limit: int = TERMS) -> np.ndarray:
    """Sorted hashes of the words that go with the label."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, parts = alnum_hasher(), []
        for x in batches:
            texts, y = x["text"].tolist(), x["toxic"].to_numpy()
            word, first = alnum_words(texts, hasher)
            doc = np.repeat(np.arange(len(texts)), np.diff(first))
            order = np.lexsort((doc, word))
            w, d = word[order], doc[order]
            new = np.append(True, (w[1:] != w[:-1]) | (d[1:] != d[:-1])) if len(w) else np.empty(0, bool)
            parts.append(pd.DataFrame({"word": w[new].view(np.int64), "n": 1, "pos": y[d[new]]}))
        if parts:
            yield pd.concat(parts).groupby("word", as_index=False).sum().astype("int64")

    n, pos = rows.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    if not n or not pos or pos == n:
        return np.empty(0, np.uint64)
    words = stored(rows.select("text", "toxic").mapInPandas(run, "word bigint, n bigint, pos bigint")
                   .groupBy("word").agg(F.sum("n").cast("double").alias("n"), F.sum("pos").cast("double").alias("pos")),
                   "toxic-words")
    least = 2.0 * np.log(10.0 * max(1, words.count()))
    a, c = F.col("pos"), F.col("n") - F.col("pos")
    b, d = F.lit(float(pos)) - a, F.lit(float(n - pos)) - c
    chi = F.lit(float(n)) * (a * d - b * c) ** 2 / (F.col("n") * (F.lit(float(n)) - F.col("n")) * float(pos) * float(n - pos))
    marking = F.col("pos") >= F.col("n") * (1.0 + pos / n) / 2.0
    top = (words.where((F.col("n") >= 3) & (F.col("n") < n) & marking).withColumn("chi", chi).where(F.col("chi") >= float(least))
           .orderBy(F.desc("chi"), "word").limit(limit).select("word").toPandas())
    return np.sort(top["word"].to_numpy().astype(np.int64).view(np.uint64))


def counted(found: np.ndarray, n_terms: int) -> tuple[np.ndarray, np.ndarray]:
    """(terms, counts) of the term numbers found in a text, and one more term that tells how many differ."""
    if not len(found):
        return np.empty(0, np.int32), np.empty(0, np.int32)
    term, count = np.unique(found, return_counts=True)
    breadth = n_terms + min(len(term), BREADTHS) - 1
    return np.append(term, breadth).astype(np.int32), np.append(count, 1).astype(np.int32)


def term_counts(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """(doc_id, terms, counts): the given terms in each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, hasher = shared.value, alnum_hasher()
        for batch in batches:
            texts = [t if t is not None else "" for t in batch["text"].tolist()]
            term, count = [], []
            for lo, hi in batched(texts):
                word, first = alnum_words(texts[lo:hi], hasher)
                at = np.minimum(np.searchsorted(known, word), max(0, len(known) - 1))
                hit = np.flatnonzero(known[at] == word) if len(known) else np.empty(0, np.int64)
                cut = np.searchsorted(hit, first)
                for a, b in zip(cut[:-1], cut[1:]):
                    t, n = counted(at[hit[a:b]], len(known))
                    term.append(t)
                    count.append(n)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "terms": term, "counts": count})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id bigint, terms array<int>, counts array<int>")


@dataclass
class BlockMaxIndex:
    """Postings of the examples by term, with the greatest weight of each block of examples."""

    idf: np.ndarray
    ids: np.ndarray               # of the examples
    toxic: np.ndarray
    start: np.ndarray             # [term, block]: where the postings of that block begin; one more column
    example: np.ndarray
    weight: np.ndarray
    most: np.ndarray              # [term, block]
    votes: np.ndarray | None = None      # calibration: votes and the score from each up to the next
    scores: np.ndarray | None = None
    none: float = 0.5                    # score of a document without a term

    @classmethod
    def of(cls, idf, ids, toxic, terms: list[np.ndarray], counts: list[np.ndarray]) -> BlockMaxIndex:
        n, n_terms = len(ids), len(idf)
        blocks = max(1, -(-n // BLOCK))
        row = np.repeat(np.arange(n), [len(t) for t in terms]).astype(np.int64)
        term = np.concatenate(terms).astype(np.int64) if n else np.empty(0, np.int64)
        w = tf_weight(np.concatenate(counts)) * idf[term] if n else np.empty(0)
        norm = np.sqrt(np.bincount(row, weights=w ** 2, minlength=n))
        w = w / np.maximum(norm[row], 1e-12)
        order = np.lexsort((row, term))
        row, term, w = row[order], term[order], w[order]
        key = term * blocks + row // BLOCK
        edges = np.searchsorted(key, np.arange(n_terms * blocks + 1))
        start = np.lib.stride_tricks.sliding_window_view(edges, blocks + 1)[::blocks][:n_terms]
        most = np.zeros(n_terms * blocks)
        np.maximum.at(most, key, w)
        return cls(idf, ids, toxic, np.ascontiguousarray(start), row, w, most.reshape(n_terms, blocks))

    def nearest(self, terms: np.ndarray, counts: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(example numbers, cosines) of the k nearest, ties to the lesser number; cosines above 0 only."""
        q = tf_weight(counts) * self.idf[terms]
        q = q / max(np.sqrt((q ** 2).sum()), 1e-12)
        bound = q @ self.most[terms]
        found_e, found_c, kth = np.empty(0, np.int64), np.empty(0), 0.0
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or bound[b] < kth - 1e-9:
                break
            lo = self.start[terms, b]
            n = self.start[terms, b + 1] - lo
            at = np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)
            score = np.bincount(self.example[at] - b * BLOCK, np.repeat(q, n) * self.weight[at], BLOCK)
            here = np.flatnonzero(score > 0)
            here = here[here + b * BLOCK != without]
            found_e, found_c = np.append(found_e, here + b * BLOCK), np.append(found_c, score[here].round(12))
            if len(found_c) > k:
                best = np.lexsort((found_e, -found_c))[:k]
                found_e, found_c = found_e[best], found_c[best]
            if len(found_c) == k:
                kth = found_c.min()
        best = np.lexsort((found_e, -found_c))
        return found_e[best], found_c[best]

    def vote(self, terms, counts, k: int = NEIGHBOURS, without: int = -1):
        """(weighted share of toxic neighbours or nan, neighbours, cosines)."""
        e, c = self.nearest(terms, counts, k, without)
        if not len(e):
            return np.nan, e, c
        weight = 1.0 / (1.0 - np.minimum(c, 1.0) + 0.1)
        return float((weight * self.toxic[e]).sum() / weight.sum()), e, c

    def calibrated(self, vote: float) -> float:
        if np.isnan(vote) or self.votes is None or not len(self.votes):
            return self.none
        return float(self.scores[max(0, np.searchsorted(self.votes, vote, side="right") - 1)])


def tf_weight(counts: np.ndarray) -> np.ndarray:
    return 1.0 + np.log(counts)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising step function of least squares (pools of adjacent violators, each with one success and failure more)."""
    value, at = np.unique(x, return_inverse=True)
    total, size = np.bincount(at, weights=y), np.bincount(at).astype(float)
    pools: list[list[float]] = []
    for v, t, n in zip(value, total, size):
        pools.append([v, t, n])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            _, t2, n2 = pools.pop()
            pools[-1][1] += t2
            pools[-1][2] += n2
    scores = np.array([(t + 0.1) / (n + 0.2) for _, t, n in pools])
    return np.array([v for v, _, _ in pools]), np.maximum.accumulate(scores)


def train(docs: DataFrame, labels: DataFrame) -> tuple[BlockMaxIndex | None, DataFrame]:
    """(index or None without training rows, term counts of all documents)."""
    rows = stored(examples(docs, labels), "toxic-examples")
    terms = choose_terms(rows)
    counts = stored(term_counts(docs, terms), "toxic-terms")
    sample = _labelled_counts(rows, terms).toPandas()
    if not len(sample):
        return None, counts
    total, = counts.agg(F.count(F.lit(1))).first()
    df = np.zeros(len(terms) + BREADTHS)
    for row in counts.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
        df[row["t"]] = row["count"]
    idf = np.log((total + 1.0) / (df + 0.5)).clip(0.05)
    sample = sample.sort_values(["doc_id", "toxic"], kind="stable")
    some = sample["terms"].map(len).to_numpy() > 0
    y = sample["toxic"].to_numpy().astype(float)
    none = (y[~some].sum() + y.mean()) / ((~some).sum() + 1.0)
    held = sample[some]
    index = BlockMaxIndex.of(idf, held["doc_id"].to_numpy(), held["toxic"].to_numpy().astype(float),
                             [np.asarray(t, np.int64) for t in held["terms"]], [np.asarray(c) for c in held["counts"]])
    index.none = float(none)
    if len(held):
        votes = np.array([index.vote(np.asarray(t, np.int64), np.asarray(c), without=i)[0]
                          for i, (t, c) in enumerate(zip(held["terms"], held["counts"]))])
        ok = ~np.isnan(votes)
        if ok.any():
            index.votes, index.scores = isotonic(votes[ok], index.toxic[ok])
    return index, counts


def _labelled_counts(rows: DataFrame, terms: np.ndarray) -> DataFrame:
    """(doc_id, toxic, terms, counts) of the examples."""
    shared = rows.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        known, hasher = shared.value, alnum_hasher()
        for x in batches:
            out = []
            for i, y, text in zip(x["doc_id"], x["toxic"], x["text"]):
                word, _ = alnum_words([text], hasher)
                at = np.minimum(np.searchsorted(known, word), max(0, len(known) - 1))
                out.append((i, y, *counted(at[known[at] == word] if len(known) else at[:0], len(known))))
            yield pd.DataFrame(out, columns=["doc_id", "toxic", "terms", "counts"])

    return rows.mapInPandas(run, "doc_id bigint, toxic int, terms array<int>, counts array<int>")


EVIDENCE = T.ArrayType(T.StructType().add("doc_id", T.LongType()).add("cosine", T.DoubleType()).add("toxic", T.IntegerType()))


def score_toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted, evidence (up to three nearest examples)."""
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    labels = labels.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label_col).alias("toxic"))
    index, counts = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ix, known = shared.value, {}
        for x in batches:
            score, evidence = [], []
            for t, c in zip(x["terms"], x["counts"]):
                if ix is None or not len(t):
                    score.append(0.5 if ix is None else ix.none)
                    evidence.append([])
                    continue
                key = (np.asarray(t).tobytes(), np.asarray(c).tobytes())
                if key not in known:
                    if len(known) > 100_000:
                        known.clear()
                    vote, e, cosine = ix.vote(np.asarray(t, np.int64), np.asarray(c))
                    known[key] = (ix.calibrated(vote), [{"doc_id": int(ix.ids[i]), "cosine": float(s),
                                                         "toxic": int(ix.toxic[i])} for i, s in zip(e[:3], cosine[:3])])
                got = known[key]
                score.append(got[0])
                evidence.append(got[1])
            yield pd.DataFrame({"doc_id": x["doc_id"].astype("Int64"), "score": score, "evidence": evidence})

    schema = T.StructType().add("doc_id", T.LongType()).add("score", T.DoubleType()).add("evidence", EVIDENCE)
    scored = counts.mapInPandas(run, schema)
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence")

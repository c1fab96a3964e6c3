"""Benchmark decontamination: latent semantic search for benchmark passages, then order and answer checks.

1. Benchmark items are cut into passages of at most ``PASSAGE`` words; the words of all items are the terms. One
   pass over the whole documents keeps the places of these terms (other words can match nothing) and counts in
   how many passages of the corpus each occurs.
2. A distributed randomised SVD of the TF-IDF matrix of the benchmark passages (Gaussian range finder, power
   iterations, orthonormalisation between them) gives the latent space of ``RANK`` dimensions. All items are searched
   in one pass over the places; a benchmark of more than ``BLOCK`` passages is searched in blocks of so many, which
   bounds what is broadcast.
3. Every window of two passages' length, at every passage's step, is searched. A window that covers the least part
   (``LEAST_PART``) of a passage's weight must hold a certain weight of the passage's heaviest terms, which an
   inverted list of those terms tells; the windows that do are projected and compared to all benchmark passages
   by cosine and by the part of the passage that they cover in the latent space. A window that may cover
   ``SURE_PART`` is a candidate as it is, since the space keeps some passages badly.
4. Near pairs are checked on the words: the longest common subsequence of the item and the surrounding words, in
   shares of the item, and the same for the item's answer (its last sentence, or last quarter). A task checks equal
   surroundings once, so copies of a text cost one check.

Words are runs of letters and digits, lower-cased. Only step 1 sees texts; nothing is shuffled but term counts.
Defined cases: null and empty texts match nothing, null, empty and repeated items are no harm (equal items are
reported each), items of fewer than ``SHORT`` words count only if all their words follow in order; rows with
equal id are reported as one document; very long texts are read whole, in memory in proportion to them; columns other than ids and texts are ignored; without items the result
is empty.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histora.llm.common import alnum_hasher, alnum_words, batched, ship, stored

PASSAGE = 32
RANK = 256
BLOCK = 4096           # passages searched at a time: 4096 x PASSAGE terms of RANK numbers at most are broadcast
CHECKED = 100_000      # checks that a task remembers
OVERSAMPLE = 16
POWER_STEPS = 2
LEAST_COSINE = 0.2
HEAVY = 0.8            # share of a passage's weight that its heaviest terms hold
LEAST_PART = 0.3
SURE_PART = 0.45       # of a passage's weight, from which a window need not be near in the latent space
SHORT = 8
LEAST_LCS, LEAST_ANSWER, SURE_LCS = 0.6, 0.5, 0.8


@dataclass
class Items:
    """A block of benchmark items: word hashes, passages, answers, and the sorted terms."""

    ids: list[int]
    words: list[np.ndarray]
    answers: list[np.ndarray]
    terms: np.ndarray
    passages: list[tuple[int, np.ndarray]]     # (item, term numbers)

    @classmethod
    def of(cls, rows: list[tuple[int, str]]) -> Items:
        hasher = alnum_hasher()
        ids, words, answers = [], [], []
        for item, text in rows:
            got, _ = alnum_words([text], hasher)
            if not len(got):
                continue
            last = re.split(r"[.!?]\s+", text.strip().rstrip(".!? "))[-1]
            tail, _ = alnum_words([last], hasher)
            quarter = -(-len(got) // 4)
            ids.append(item)
            words.append(got)
            answers.append(tail if 0 < len(tail) <= 2 * quarter and len(tail) >= 3 else got[-quarter:])
        terms = np.unique(np.concatenate(words)) if words else np.empty(0, np.uint64)
        passages = []
        for i, got in enumerate(words):
            for part in np.array_split(got, -(-len(got) // PASSAGE)):
                passages.append((i, np.searchsorted(terms, part)))
        return cls(ids, [np.searchsorted(terms, w) for w in words], [np.searchsorted(terms, a) for a in answers],
                   terms, passages)


def term_places(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """(doc_id, n_words, places, terms): where the given terms stand in each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, hasher = shared.value, alnum_hasher()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for lo, hi in batched(texts):
                word, first = alnum_words(texts[lo:hi], hasher)
                at = np.minimum(np.searchsorted(known, word), len(known) - 1)
                hit = np.flatnonzero(known[at] == word)
                cut = np.searchsorted(hit, first).astype(np.int32)
                place = hit - np.repeat(first[:-1], np.diff(cut))
                lists = [pa.ListArray.from_arrays(pa.array(cut), pa.array(x.astype(np.int32))) for x in (place, at[hit])]
                yield pa.RecordBatch.from_arrays([ids[lo:hi], pa.array(np.diff(first).astype(np.int64)), *lists],
                                                 names=["doc_id", "n_words", "places", "terms"])

    return docs.mapInArrow(run, "doc_id bigint, n_words bigint, places array<int>, terms array<int>")


def flat_places(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, term) of all places of a batch of :func:`term_places`."""
    places, terms = batch.column("places"), batch.column("terms")
    row = np.repeat(np.arange(len(places)), pc.list_value_length(places).to_numpy(zero_copy_only=False))
    return row.astype(np.int64), *(x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in (places, terms))


def passage_counts(places: DataFrame, n_terms: int) -> tuple[int, np.ndarray]:
    """(passages of the corpus, how many hold each term); each task sums its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held = 0, np.zeros(n_terms, np.int64)
        for x in batches:
            total += int((-(-x.column("n_words").to_numpy(zero_copy_only=False) // PASSAGE)).sum())
            row, place, term = flat_places(x)
            key = np.unique(row << 48 | (place // PASSAGE) << 24 | term)
            held += np.bincount(key & 0xFFFFFF, minlength=n_terms)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict({"term": np.append(at, -1), "n": np.append(held[at], total)})

    rows = places.mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(n_terms, np.int64)
    real = rows[rows["term"] >= 0]
    out[real["term"].to_numpy()] = real["n"].to_numpy()
    return int(rows.loc[rows["term"] < 0, "n"].sum()), out


def latent_basis(passages: DataFrame, n_terms: int, rank: int, seed: int = 11) -> np.ndarray:
    """Leading right singular vectors (terms x rank) of the rows (at array<int>, weight array<double>).

    Rows stay distributed: a task returns its share of A'(A Q), the rows of the terms that it has met, and the shares
    are added. Together they hold at most one row of ``width`` numbers for each entry of the matrix, which ``BLOCK``
    bounds.
    """
    sc = passages.sparkSession.sparkContext

    def gram(basis: np.ndarray) -> np.ndarray:
        shared = sc.broadcast(basis.astype(np.float32))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            terms, parts = [], []
            for x in batches:
                for at, weight in zip(x["at"], x["weight"]):
                    terms.append(np.asarray(at))
                    parts.append(np.outer(weight, weight @ shared.value[at]).astype(np.float32))
            if terms:          # the rows of the terms that the task has met, in one piece
                met, row = np.unique(np.concatenate(terms), return_inverse=True)
                out = np.zeros((len(met), basis.shape[1]), np.float32)
                np.add.at(out, row, np.concatenate(parts))
                yield pd.DataFrame({"terms": [met.astype(np.int64).tobytes()], "share": [out.tobytes()]})

        total = np.zeros(basis.shape)
        for row in passages.mapInPandas(run, "terms binary, share binary").collect():
            met = np.frombuffer(row["terms"], np.int64)
            total[met] += np.frombuffer(row["share"], np.float32).reshape(len(met), -1)
        shared.unpersist()
        return total

    width = min(rank + OVERSAMPLE, n_terms)
    basis = np.random.default_rng(seed).standard_normal((n_terms, width))
    for _ in range(1 + POWER_STEPS):
        basis, _ = np.linalg.qr(gram(basis))
    values, vectors = np.linalg.eigh(basis.T @ gram(basis))
    order = np.argsort(values)[::-1][:rank]
    order = order[values[order] > 1e-6 * max(values.max(), 1e-12)]
    return basis @ vectors[:, order]


def word_masks(words: np.ndarray) -> tuple[dict[int, int], int]:
    """(for each word the bits of its places, number of words): one side of :func:`common_length`."""
    masks: dict[int, int] = {}
    for i, x in enumerate(words.tolist()):
        masks[x] = masks.get(x, 0) | 1 << i
    return masks, len(words)


def common_length(masks: dict[int, int], n: int, right: list[int]) -> int:
    """Length of the longest common subsequence, a row of the table at a time as the bits of one integer."""
    full = row = (1 << n) - 1
    for x in right:
        m = masks.get(x)
        if m is not None and (m := m & row):
            row = (row + m | row - m) & full
    return n - row.bit_count()


def lcs(left: np.ndarray, right: np.ndarray) -> int:
    return common_length(*word_masks(left), right.tolist())


@dataclass
class Search:
    """What a task needs to search: weights, latent vectors of terms and passages, and the items."""

    items: Items
    weight: np.ndarray        # per term
    latent: np.ndarray        # weighted latent vector per term
    passage: np.ndarray       # unit latent vector per passage
    length: np.ndarray        # and its length
    item_of: np.ndarray
    heavy_start: np.ndarray   # per term: where its passages begin, among those that it is a heavy term of
    heavy_passage: np.ndarray
    least_heavy: np.ndarray   # per passage: weight of heavy terms that a window must hold
    sure_heavy: np.ndarray    # and the weight that makes it a candidate whatever its cosine
    masks: list = field(default_factory=list)         # per item: word masks of its words and of its answer
    checked: dict = field(default_factory=dict)       # (item, surrounding words) to shares found; of the task

    def shares(self, i: int, around: np.ndarray) -> tuple[float, float]:
        """Longest common subsequence with the item and with its answer, in shares of them."""
        key = i, around.astype(np.int32).tobytes()
        found = self.checked.get(key)
        if found is None:
            if not self.masks:
                self.masks = [(word_masks(w), word_masks(a)) for w, a in zip(self.items.words, self.items.answers)]
            words = around.tolist()
            found = tuple(common_length(*m, words) / m[1] for m in self.masks[i])
            if len(self.checked) >= CHECKED:
                self.checked.clear()
            self.checked[key] = found
        return found

    def windows(self, step: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Steps at which a window (the step and the next) may cover the least part of some passage, and the
        (step, passage) pairs of windows that hold enough of its heavy terms to be candidates as they are."""
        lists = np.diff(self.heavy_start)
        heavy = np.flatnonzero(lists[term])
        once = np.unique(step[heavy] << 20 | term[heavy])       # each term once a step
        step, term = once >> 20, once & (1 << 20) - 1
        n = lists[term]
        row = np.repeat(np.arange(len(term)), n)
        at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.heavy_start[term], n)
        p, width = self.heavy_passage[at], len(self.least_heavy)
        key = np.concatenate((step[row] * width + p, (step[row] - 1) * width + p))
        key, back = np.unique(key, return_inverse=True)
        held = np.bincount(back, weights=np.tile(self.weight[term[row]] ** 2, 2))
        real = (key // width & 0xFFFFFF) != 0xFFFFFF      # no window begins before its document
        found = np.unique(key[real & (held >= self.least_heavy[key % width])] // width)
        sure = key[real & (held >= self.sure_heavy[key % width])]
        return found, sure // width, sure % width

    def matches(self, place: np.ndarray, term: np.ndarray, doc: np.ndarray) -> list[tuple]:
        """(doc, item number, cosine, lcs, answer) for the term places of a batch of documents."""
        if not len(place):
            return []
        step = doc.astype(np.int64) << 24 | (place // PASSAGE).astype(np.int64)
        out: dict[tuple[int, int], tuple] = {}
        near, sure_step, sure_passage = self.windows(step, term)
        for lo in range(0, len(near), 2048):
            some = near[lo:lo + 2048]
            spans = zip(np.searchsorted(step, some), np.searchsorted(step, some + 2))
            vector = np.stack([self.latent[np.unique(term[a:b])].sum(axis=0) for a, b in spans])
            norm = np.linalg.norm(vector, axis=1, keepdims=True)
            along = vector @ self.passage.T
            near_by = (along >= LEAST_COSINE * norm) & (along >= LEAST_PART * self.length)
            cosine = along / np.maximum(norm, 1e-9)
            a, b = np.searchsorted(sure_step, [some[0], some[-1] + 1])
            at = np.searchsorted(some, sure_step[a:b])
            near_by[at, sure_passage[a:b]] = True       # their steps are among the windows' steps
            for w, p in zip(*np.nonzero(near_by)):
                i = int(self.item_of[p])
                d, at = (int(x) for x in divmod(some[w], 1 << 24))
                reach = 1 + len(self.items.words[i]) // PASSAGE
                a, b = np.searchsorted(step, [(d << 24) + max(0, at - reach), (d << 24) + at + 2 + reach])
                common, answer = self.shares(i, term[a:b])
                best = out.get((d, i))
                if best is None or (self.accepts(i, common, answer), common) > (self.accepts(i, *best[1:]), best[1]):
                    out[d, i] = (float(cosine[w, p]), common, answer)
        return [(d, i, *x) for (d, i), x in out.items() if self.accepts(i, x[1], x[2])]

    def accepts(self, i: int, common: float, answer: float) -> bool:
        if len(self.items.words[i]) < SHORT:
            return common == 1.0
        return common >= SURE_LCS or common >= LEAST_LCS and answer >= LEAST_ANSWER


def prepare(items: Items, total: int, held: np.ndarray, docs: DataFrame) -> Search:
    weight = np.log((total + len(items.passages) + 1) / (held + 0.5)).clip(0.05)
    rows = [(int(i), (t := np.unique(at)).tolist(), weight[t].tolist()) for i, (_, at) in enumerate(items.passages)]
    spark = docs.sparkSession
    frame = spark.createDataFrame(pd.DataFrame(rows, columns=["id", "at", "weight"]),
                                  "id bigint, at array<int>, weight array<double>").repartition(4, "id")
    basis = latent_basis(frame, len(items.terms), RANK)
    latent = (weight[:, None] * basis).astype(np.float32)
    passage = np.stack([latent[np.unique(at)].sum(axis=0) for _, at in items.passages])
    length = np.maximum(np.linalg.norm(passage, axis=1), 1e-9)
    start, heavy, least, sure = heavy_terms(items, weight)
    return Search(items, weight, latent, passage / length[:, None], length.astype(np.float32),
                  np.array([i for i, _ in items.passages]), start, heavy, least, sure)


def heavy_terms(items: Items, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Inverted list of the terms that hold ``HEAVY`` of a passage's weight, and the weights of them to ask for."""
    rows, least, sure = [], [], []
    for p, (_, at) in enumerate(items.passages):
        t = np.unique(at)
        t = t[np.argsort(-weight[t], kind="stable")]
        mass = np.cumsum(weight[t] ** 2)
        top = int(np.searchsorted(mass, HEAVY * mass[-1])) + 1
        rows += [(x, p) for x in t[:top].tolist()]
        for part, out in ((LEAST_PART, least), (SURE_PART, sure)):
            out.append(mass[min(top, len(t)) - 1] - (1 - part) * mass[-1] - 1e-6)
    pairs = np.array(sorted(rows), dtype=np.int64)
    return np.searchsorted(pairs[:, 0], np.arange(len(weight) + 1)), pairs[:, 1], np.array(least), np.array(sure)


def find_block(docs: DataFrame, rows: list[tuple[int, str]]) -> DataFrame | None:
    items = Items.of(rows)
    if not items.ids:
        return None
    places = stored(term_places(docs, items.terms), "leak-places")
    search = prepare(items, *passage_counts(places, len(items.terms)), docs)
    shared = docs.sparkSession.sparkContext.broadcast(search)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), *((c, pa.float64()) for c in
                                                                               ("cosine", "lcs", "answer"))])
        for x in batches:
            ids = x.column("doc_id").to_pylist()
            row, place, term = flat_places(x)
            found = [(ids[d], s.items.ids[i], *rest) for d, i, *rest in s.matches(place, term, row)]
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in found], schema=schema)

    return places.where(F.size("places") > 0).mapInArrow(
        run, "doc_id bigint, item_id bigint, cosine double, lcs double, answer double")


def contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, cosine, lcs, answer): the documents that hold a benchmark item, a row for each pair."""
    ship(docs.sparkSession)
    docs = (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
            .where(F.col("doc_id").isNotNull() & (F.length("text") > 0)))
    items = (benchmark.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(item_text_col).alias("text"))
             .where("item_id IS NOT NULL AND length(text) > 0"))
    out, block, held = None, [], 0

    def searched(out, block):
        found = find_block(docs, block)
        return found if out is None else out if found is None else out.unionByName(found)

    hasher = alnum_hasher()
    for row in items.orderBy("item_id", "text").toLocalIterator():
        size = len(alnum_words([row["text"]], hasher)[0]) // PASSAGE + 1
        if block and held + size > BLOCK:
            out, block, held = searched(out, block), [], 0
        block.append((row["item_id"], row["text"]))
        held += size
    if block:
        out = searched(out, block)
    if out is None:
        return docs.sparkSession.createDataFrame(
            [], "doc_id bigint, item_id bigint, cosine double, lcs double, answer double")
    return out.groupBy("doc_id", "item_id").agg(F.max("cosine").alias("cosine"), F.max("lcs").alias("lcs"),
                                                F.max("answer").alias("answer"))

"""Near duplicates: one-permutation MinHash with optimal densification, banded buckets, star-shaped candidates.

A document's set holds its distinct shingles of ``SHINGLE`` words as 64-bit hashes. The hashes are one
permutation: their top bits are the bin, the least hash of a bin its minimum, and an empty bin borrows from the
first non-empty one on its own fixed random walk (optimal densification). Bands of ``ROWS`` bins are bucket keys.

1. Equal sets collapse to their least document; only such representatives go on.
2. Every bucket emits a star: each member with the bucket's least member. Pairs whose bins agree too rarely are
   left out (``LEAST_AGREEMENT``, seven standard deviations below the threshold); the rest are compared on their
   full sets, made anew from the whole texts.
3. Verified links give components. A bucket in which a star edge failed can hide a link between two of its other
   members; there, members of different components are compared in blocks of bounded size, by bins and where
   these agree on full sets. All other buckets lie within one component already.

So a link is missed only if its two documents share no bucket: (1 - s**ROWS)**BANDS, 1e-6 at similarity 0.75 and
far less above. No group is gathered in one task: minima are map-side aggregates, members join them under
adaptive skew handling, texts are compared in parts of ``PART`` members against a copy of the star's centre.

Defined cases: null and empty texts, and texts without a word, have an empty set and are linked with nothing.
Fewer words than a shingle make one shingle. Rows with equal id are one document. A null id has no component
and is kept. Columns other than id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histora.llm.common import WordHasher, ascii_lower, batched, byte_table, mix64, powers, rows_with_ids, ship, stored
from histora.llm.components import connected_components

SHINGLE = 5
LEAST_PERCENT = 75
BINS = 256
ROWS = 5
BANDS = 51
LEAST_AGREEMENT = 0.55
PART = 128
BLOCK = 256

_WALK = 4096       # steps of an empty bin's walk before it takes the next non-empty bin
_SPACES = b" \t\n\x0b\x0c\r"


def word_hasher() -> WordHasher:
    return WordHasher(byte_table(_SPACES), ascii_lower())


def shingle_sets(texts: list[str], hasher: WordHasher, width: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text, one text after another."""
    factor = mix64(powers(width + 1)[1:]) | np.uint64(1)
    for lo, hi in batched(texts):
        word, first = hasher([t.encode("utf-8", "surrogatepass") for t in texts[lo:hi]])
        n = len(word)
        value = np.zeros(n, np.uint64)
        for j in range(min(width, n)):
            value[:n - j] += mix64(word[j:] + np.uint64(j)) * factor[j]
        value = mix64(value)
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= width:
                yield np.unique(value[a:b - width + 1])
            elif b > a:
                place = np.arange(b - a, dtype=np.uint64)
                whole = (mix64(word[a:b] + place) * factor[:b - a]).sum(dtype=np.uint64, keepdims=True)
                yield mix64(whole + place[-1:] + np.uint64(1))
            else:
                yield np.empty(0, np.uint64)


class Sketcher:
    """Bin minima, band keys and agreement bytes of a shingle set."""

    def __init__(self):
        step = np.arange(_WALK * BINS, dtype=np.uint64) + np.uint64(0x5EED)
        self.walk = (mix64(step) >> np.uint64(32)).astype(np.int64).reshape(_WALK, BINS) % BINS
        self.edges = np.arange(BINS, dtype=np.uint64) << np.uint64(56)
        self.band = mix64(np.arange(BANDS, dtype=np.uint64) + np.uint64(0xBA2D))
        self.factor = mix64(powers(ROWS + 1)[1:]) | np.uint64(1)

    def bins(self, shingles: np.ndarray) -> np.ndarray:
        at = np.searchsorted(shingles, self.edges)
        full = np.diff(at, append=len(shingles)) > 0
        source = np.arange(BINS)
        empty = np.flatnonzero(~full)
        for lo in range(0, _WALK, 64):
            if not len(empty):
                break
            steps = self.walk[lo:lo + 64, empty]
            met = full[steps]
            hit = met.any(axis=0)
            source[empty[hit]] = steps[met.argmax(axis=0)[hit], np.flatnonzero(hit)]
            empty = empty[~hit]
        if len(empty):
            source[empty] = np.flatnonzero(full)[0]
        return mix64(shingles[at[source]])

    def bands(self, bins: np.ndarray) -> np.ndarray:
        rows = bins[:BANDS * ROWS].reshape(BANDS, ROWS)
        return mix64((rows * self.factor).sum(axis=1, dtype=np.uint64) + self.band).view(np.int64)


def sketch(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_id, bands, agree) of every row of (doc_id, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, sketcher = word_hasher(), Sketcher()
        for batch in batches:
            texts = [t if t is not None else "" for t in batch["text"].tolist()]
            size, ids, bands, agree = [], [], [], []
            for s in shingle_sets(texts, hasher):
                size.append(len(s))
                ids.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                bins = sketcher.bins(s) if len(s) else None
                bands.append(sketcher.bands(bins) if len(s) else np.empty(0, np.int64))
                agree.append(bins.astype(np.uint8).tobytes() if len(s) else b"")
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "n_shingles": size, "set_id": ids,
                                "bands": bands, "agree": agree})

    return docs.mapInPandas(run, "doc_id bigint, n_shingles bigint, set_id binary, bands array<bigint>, agree binary")


def _agreement(left, right) -> np.ndarray:
    """Share of equal bins of two rows of agreement bytes, less what equal bytes occur by chance."""
    same = (left == right).mean(axis=-1)
    return (same - 1 / 256) / (1 - 1 / 256)


def _bytes(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint8).reshape(-1, BINS)


def _could_link(n_a, n_b, agree_a, agree_b):
    sizes = 100 * np.minimum(n_a, n_b) >= LEAST_PERCENT * np.maximum(n_a, n_b)
    return sizes & (_agreement(agree_a, agree_b) >= LEAST_AGREEMENT)


def likely(edges: DataFrame, reps: DataFrame) -> DataFrame:
    """The edges (a, b) whose set sizes allow a link and whose bins agree often enough."""

    def run(batches):
        for x in batches:
            if len(x):
                yield x.loc[_could_link(x["n_a"].to_numpy(), x["n_b"].to_numpy(), _bytes(x["agree_a"]),
                                        _bytes(x["agree_b"])), ["a", "b"]]

    side = lambda c: reps.select(F.col("doc_id").alias(c), F.col("n_shingles").alias(f"n_{c}"),
                                 F.col("agree").alias(f"agree_{c}"))
    return edges.join(side("a"), "a").join(side("b"), "b").mapInPandas(run, "a bigint, b bigint")


def confirm(edges: DataFrame, docs: DataFrame) -> DataFrame:
    """The edges (a, b) whose full shingle sets reach the threshold.

    Each text travels once per star it belongs to; a centre's text once per ``PART`` members.
    """
    parts = edges.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
    member = edges.join(parts, "a").select(
        "a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("kind"),
        F.col("b").alias("doc_id"))
    centre = parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                          F.lit(0).alias("kind"), F.col("a").alias("doc_id"))
    needed = member.unionByName(centre)
    texts = (rows_with_ids(docs, needed).join(needed.hint("merge"), "doc_id").repartition("a", "part")
             .sortWithinPartitions("a", "part", "kind").select("a", "part", "kind", "doc_id", "text"))

    def run(batches):
        hasher = word_hasher()
        at, centre_set = None, None
        for x in batches:
            a, b = [], []
            sets = shingle_sets(x["text"].tolist(), hasher)
            for star, part, kind, doc, own in zip(x["a"], x["part"], x["kind"], x["doc_id"], sets):
                if kind == 0:
                    at, centre_set = (star, part), own
                elif at == (star, part):
                    both = len(np.intersect1d(centre_set, own, assume_unique=True))
                    if 100 * both >= LEAST_PERCENT * (len(own) + len(centre_set) - both):
                        a.append(star)
                        b.append(doc)
            yield pd.DataFrame({"a": pd.Series(a, dtype="int64"), "b": pd.Series(b, dtype="int64")})

    return texts.mapInPandas(run, "a bigint, b bigint")


def _cells(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of (a, doc_id, ...) dealt so that each two rows of one ``a`` meet in one cell (a, i, j) of two blocks."""
    sizes = rows.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    return (rows.join(sizes, "a").withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("a", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "doc_id",
                    "component", *columns))


def _cell_pairs(cell: pd.DataFrame, n: np.ndarray, agree: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(row, later rows) of a cell that are of different components and could link."""
    doc, comp, own = (cell[c].to_numpy() for c in ("doc_id", "component", "own"))
    i, j = cell["i"].iloc[0], cell["j"].iloc[0]
    right = np.flatnonzero(own == j)
    for x in np.flatnonzero(own == i):
        ys = right[((doc[right] > doc[x]) | (i != j)) & (comp[right] != comp[x])]
        ys = ys[_could_link(n[x], n[ys], agree[x], agree[ys])] if len(ys) else ys
        if len(ys):
            yield x, ys


def hidden_links(members: DataFrame, links: DataFrame, component: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) that a failed star may hide: between members of one star, of different components.

    ``members`` (key, a, doc_id) lists the buckets of three members or more. Buckets with a failed star edge are
    taken together by centre; their members are dealt into cells of two blocks of about ``BLOCK`` rows. A first
    pass over bin bytes keeps the members that could link with one of another component; a second compares
    the full sets of those in the cell itself. So each text travels once per block, not once per pair.
    """
    linked = links.select("a", F.col("b").alias("doc_id"))
    failed = (members.where("a <> doc_id").join(linked, ["a", "doc_id"], "left_anti").select("key").distinct())
    star = members.where("a <> doc_id").join(failed, "key", "left_semi").select("a", "doc_id").distinct()
    rows = stored(star.join(component.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
                  .withColumn("component", F.coalesce("component", "doc_id")), "neardup-stars")
    mixed = rows.groupBy("a").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    rows = rows.join(mixed.select("a"), "a", "left_semi")

    def could(cell: pd.DataFrame) -> pd.DataFrame:
        hit: set[int] = set()
        for x, ys in _cell_pairs(cell, cell["n_shingles"].to_numpy(), _bytes(cell["agree"])):
            hit.add(x)
            hit.update(ys.tolist())
        return cell.iloc[sorted(hit)][["a", "doc_id", "component"]]

    some = stored(_cells(rows.join(reps.select("doc_id", "n_shingles", "agree"), "doc_id"), ["n_shingles", "agree"])
                  .groupBy("a", "i", "j").applyInPandas(could, "a bigint, doc_id bigint, component bigint").distinct(),
                  "neardup-could")

    def compare(cell: pd.DataFrame) -> pd.DataFrame:
        sets = list(shingle_sets(cell["text"].tolist(), word_hasher()))
        n = np.array([len(s) for s in sets])
        sketcher = Sketcher()
        agree = np.stack([sketcher.bins(s).astype(np.uint8) for s in sets])
        doc, found = cell["doc_id"].to_numpy(), []
        for x, ys in _cell_pairs(cell, n, agree):
            every = np.concatenate([sets[y] for y in ys])
            at = np.minimum(np.searchsorted(sets[x], every), n[x] - 1)
            both = np.add.reduceat(sets[x][at] == every, np.concatenate(([0], np.cumsum(n[ys])[:-1])), dtype=np.int64)
            ys = ys[100 * both >= LEAST_PERCENT * (n[x] + n[ys] - both)]
            found += [(min(doc[x], doc[y]), max(doc[x], doc[y])) for y in ys]
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    texts = rows_with_ids(docs, some.select("doc_id")).join(some.hint("merge"), "doc_id")
    return (_cells(texts, ["text"]).groupBy("a", "i", "j").applyInPandas(compare, "a bigint, b bigint").distinct())


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (least id reachable over links), kept (it is that id)."""
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    sketches = stored(sketch(docs), "neardup-sketch")
    sets = stored(sketches.where("n_shingles > 0").groupBy("set_id").agg(F.min("doc_id").alias("doc_id"))
                  .where("doc_id IS NOT NULL"), "neardup-sets")
    reps = stored(sketches.join(sets.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi")
                  .select("doc_id", "n_shingles", "bands", "agree"), "neardup-reps")
    buckets = reps.select("doc_id", F.explode("bands").alias("key"))
    stars = (buckets.groupBy("key").agg(F.min("doc_id").alias("a"), F.count(F.lit(1)).alias("size"))
             .where("size > 1"))
    members = stored(buckets.join(stars, "key").select("key", "size", "a", "doc_id"), "neardup-members")
    edges = members.where("a <> doc_id").groupBy("a", F.col("doc_id").alias("b")).agg(F.lit(1).alias("_one"))
    texts = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    links = stored(confirm(stored(likely(edges.select("a", "b"), reps), "neardup-likely"), texts), "neardup-links")
    component = connected_components(links)
    more = stored(hidden_links(members.where("size > 2").drop("size"), links, component, reps, texts), "neardup-more")
    if not more.isEmpty():
        component = connected_components(links.unionByName(more))
    of_set = (sets.join(component.withColumnRenamed("node", "doc_id"), "doc_id", "left")
              .select("set_id", F.coalesce("component", "doc_id").alias("_of_set")))
    return (sketches.select("doc_id", "n_shingles", "set_id").join(of_set, "set_id", "left")
            .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("_of_set", "doc_id")))
            .select("doc_id", "n_shingles", "component_id",
                    F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept")))


def near_dup_oracle() -> str:
    """DuckDB SQL for ``near_duplicates`` over ``documents``: exact links on full sets, recursive components."""
    return r"""
WITH RECURSIVE base AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
         WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct([array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s FROM base),
sized AS (SELECT doc_id, s, len(s) AS n FROM sets),
-- equal sets meet by their digest, so that copies are not expanded into pairs
digests AS (SELECT doc_id, n, md5(array_to_string(list_sort(s), chr(10))) AS d FROM sized WHERE n > 0),
reps AS (SELECT d, min(doc_id) AS rep FROM digests GROUP BY d),
items AS (SELECT z.doc_id, z.n, hash(unnest(z.s)) AS x FROM sized z JOIN reps r ON r.rep = z.doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
  FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id
  WHERE 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n) GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs WHERE 100 * c >= 75 * (na + nb - c)),
twoway AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(v, c) AS (
  SELECT rep, rep FROM reps
  UNION
  SELECT e.b, r.c FROM reach r JOIN twoway e ON e.a = r.v),
comp AS (SELECT v, min(c) AS c FROM reach GROUP BY v)
SELECT z.doc_id, z.n::BIGINT AS n_shingles, coalesce(k.c, z.doc_id) AS component_id,
       coalesce(k.c, z.doc_id) = z.doc_id AS kept
FROM sized z LEFT JOIN digests g ON g.doc_id = z.doc_id LEFT JOIN reps r ON r.d = g.d LEFT JOIN comp k ON k.v = r.rep"""

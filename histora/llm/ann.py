"""Approximate nearest neighbours by an inverted multi-index, for the largest inner product.

Each half of a vector is quantised by its own codebook (k-means on a bounded sample, ``TRAIN_ROWS`` in
expectation); a cell is a pair of centroids. All valid rows are indexed. A query walks the cells by summed
half products, best first, taking the next pair off a heap, until the cells hold ``probe`` rows. How many rows
that takes is measured, not assumed: for a bounded sample of queries the true neighbours are found by brute
force over all rows, and ``probe`` is the depth at which ``RECALL`` of them are met. Entries met are reranked by
the exact double product of the original vectors.

Cells are laid into row blocks of at most about ``BLOCK_ROWS`` rows (small cells share one, a large cell is
split by hash), and the queries that visit a block are dealt into parts of ``QUERY_ROWS``; one task holds one
block and one part. Centroids are at most ``MAX_CENTROIDS`` per half, so cells, codebooks and cell sizes are
bounded and may travel to every task.

Defined cases: vectors that are null, zero, hold null or non-finite components, or are not of the most frequent
dimension (ties: the larger) take no part, as queries or candidates. Fewer candidates than asked for: all of
them. Ties go to the smaller id. Equal vectors under different ids are different rows; a row never finds its own id.
An id is one entry however many rows it has: as a candidate it counts once, with the best of its rows, and as a query
it is asked once, with the least of its vectors in the order of their components.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histora.llm.common import ship, stored

TRAIN_ROWS = 16_384
CALIBRATION_QUERIES = 96
RECALL = 0.955
MAX_CENTROIDS = 256
ROWS_PER_CELL = 48
BLOCK_ROWS = 8_192
QUERY_ROWS = 512


def valid(vector: Column) -> Column:
    """Whether a vector may take part (its dimension aside)."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def vectors_of(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    rows = (table.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
            .where(F.col("vec_id").isNotNull() & valid(F.col("v"))))
    most = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("v") == (most["d"] if most else 0))


def k_means(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centre = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = nearest(x, centre)
        size = np.bincount(own, minlength=len(centre))
        total = np.zeros_like(centre)
        np.add.at(total, own, x)
        centre[size > 0] = total[size > 0] / size[size > 0, None]
    return centre


def nearest(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return (x @ centre.T - 0.5 * (centre ** 2).sum(axis=1)).argmax(axis=1)


@dataclass
class MultiIndex:
    """Codebooks of the two halves, rows per cell, rows to visit per query, and the blocks of each cell."""

    left: np.ndarray
    right: np.ndarray
    size: np.ndarray                # rows per cell
    probe: int = 0
    block: np.ndarray | None = None     # first block of a cell
    splits: np.ndarray | None = None    # blocks of a cell

    @property
    def half(self) -> int:
        return self.left.shape[1]

    def cell(self, v: np.ndarray) -> np.ndarray:
        return nearest(v[:, :self.half], self.left) * len(self.right) + nearest(v[:, self.half:], self.right)

    def lay_out(self) -> None:
        """Small cells share a block; a cell of more than ``BLOCK_ROWS`` rows has several of its own."""
        self.splits = np.maximum(1, -(-self.size // BLOCK_ROWS))
        self.block = np.zeros(len(self.size), np.int64)
        at, filled = 0, 0
        for c, n in enumerate(self.size):
            if self.splits[c] > 1:
                at += filled > 0
                self.block[c] = at
                at, filled = at + self.splits[c], 0
                continue
            if filled + n > BLOCK_ROWS:
                at, filled = at + 1, 0
            self.block[c] = at
            filled += n

    def walk(self, query: np.ndarray) -> Iterator[int]:
        """Cells by summed product of the halves, largest first; only neighbours of taken pairs enter the heap."""
        a, b = self.left @ query[:self.half], self.right @ query[self.half:]
        i_of, j_of = np.argsort(-a, kind="stable"), np.argsort(-b, kind="stable")
        a, b = -a[i_of], -b[j_of]
        heap = [(a[0] + b[0], 0, 0)]
        while heap:
            _, i, j = heapq.heappop(heap)
            yield int(i_of[i]) * len(self.right) + int(j_of[j])
            if j + 1 < len(b):
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))

    def visited(self, query: np.ndarray, rows: int) -> list[int]:
        """The cells walked until they hold ``rows`` rows, empty ones left out."""
        out, met = [], 0
        for c in self.walk(query):
            if self.size[c]:
                out.append(c)
                met += int(self.size[c])
                if met >= rows:
                    break
        return out


def _matrix(column) -> np.ndarray:
    return np.stack([np.asarray(x, dtype=np.float64) for x in column])


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, added component by component: equal rows give equal values anywhere."""
    out = np.zeros(len(a))
    for d in range(a.shape[1]):
        out += a[:, d] * b[:, d]
    return out


def best_rows(query_id, query, vec_id, v, allowed, k: int) -> pd.DataFrame:
    """The k best allowed ids per query, by exact product of an id's best row, ties to the smaller id.

    ``at`` is the row's place in ``v``. Rows of one id count once.
    """
    rows = np.arange(len(vec_id))
    if len(vec_id) and len(np.unique(vec_id)) < len(vec_id):
        whole = np.ascontiguousarray(np.column_stack((vec_id.astype(np.int64).view(np.float64), v)))
        _, rows = np.unique(whole.view([("", np.void, whole.shape[1] * 8)]).ravel(), return_index=True)   # no equal rows
        rows = rows[np.argsort(vec_id[rows], kind="stable")]
        vec_id, v = vec_id[rows], v[rows]
        allowed = allowed[:, rows] if isinstance(allowed, np.ndarray) else allowed
    score = np.where(allowed & (query_id[:, None] != vec_id[None, :]), query @ v.T, -np.inf)
    by_id, start = np.unique(vec_id, return_index=True)
    top = score if len(by_id) == len(vec_id) else np.maximum.reduceat(score, start, axis=1)
    if top.shape[1] > k:
        kth = np.partition(top, top.shape[1] - k, axis=1)[:, -k]
    else:
        kth = np.full(len(score), -np.inf)
    slack = 1e-9 * np.maximum(1.0, np.abs(np.where(np.isfinite(kth), kth, 0.0)))
    q, r = np.nonzero((score >= (kth - slack)[:, None]) & np.isfinite(score))
    exact = exact_products(query[q], v[r])
    if len(by_id) < len(vec_id):                     # an id's best row only
        order = np.lexsort((-exact, vec_id[r], q))
        first = np.ones(len(order), dtype=bool)
        first[1:] = (np.diff(q[order]) != 0) | (np.diff(vec_id[r[order]]) != 0)
        q, r, exact = q[order][first], r[order][first], exact[order][first]
    order = np.lexsort((vec_id[r], -exact, q))
    q, r, exact = q[order], r[order], exact[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    keep = place < k
    return pd.DataFrame({"query_id": query_id[q[keep]], "vec_id": vec_id[r[keep]], "score": exact[keep],
                         "at": rows[r[keep]]})


def brute_force(vectors: DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """(query_id, vec_id, score, v): the true neighbours of a bounded set of queries, over all rows."""
    shared = vectors.sparkSession.sparkContext.broadcast((queries["vec_id"].to_numpy(), _matrix(queries["v"])))

    def run(batches):
        ids, q = shared.value
        for x in batches:
            if len(x):
                v = _matrix(x["v"])
                found = best_rows(ids, q, x["vec_id"].to_numpy(), v, True, k)
                found["v"] = list(v[found.pop("at").to_numpy()]) if len(found) else []
                yield found

    found = vectors.mapInPandas(run, "query_id bigint, vec_id bigint, score double, v array<double>")
    found = (found.groupBy("query_id", "vec_id").agg(F.max(F.struct("score", "v")).alias("best"))
             .select("query_id", "vec_id", "best.*"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).toPandas()


def _sample(rows: DataFrame, n: int, total: int, salt: int) -> DataFrame:
    share = int(min(1.0, n / max(1, total)) * 1_000_000)
    return rows.where(F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(1_000_000)) < share)


def train_index(vectors: DataFrame, queries: DataFrame, k: int) -> MultiIndex | None:
    total = vectors.count()
    if not total:
        return None
    sample = _matrix(_sample(vectors, TRAIN_ROWS, total, 1).union(vectors.limit(1)).toPandas()["v"])
    centroids = int(np.clip(np.sqrt(total / ROWS_PER_CELL), 1, MAX_CENTROIDS))
    half = max(1, sample.shape[1] // 2)
    index = MultiIndex(k_means(sample[:, :half], centroids), k_means(sample[:, half:], centroids), np.zeros(0))
    shared = vectors.sparkSession.sparkContext.broadcast(index)

    def cells(batches):
        for x in batches:
            if len(x):
                c, n = np.unique(shared.value.cell(_matrix(x["v"])), return_counts=True)
                yield pd.DataFrame({"cell": c, "n": n})

    sizes = (vectors.mapInPandas(cells, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toPandas())
    index.size = np.zeros(len(index.left) * len(index.right), np.int64)
    index.size[sizes["cell"].to_numpy()] = sizes["n"].to_numpy()
    index.lay_out()
    some = _sample(queries, CALIBRATION_QUERIES, queries.count(), 2).toPandas()
    index.probe = total
    if len(some):
        truth = brute_force(vectors, some, k)
        depth = []
        query = {i: np.asarray(v) for i, v in zip(some["vec_id"], some["v"])}
        for q, rows in truth.groupby("query_id"):
            met, at = 0, {}
            for c in index.walk(query[q]):
                met += int(index.size[c])
                at[c] = met
            depth += [at[c] for c in index.cell(_matrix(rows["v"]))]
        if len(depth) >= 200:      # fewer measurements prove nothing: every row is visited
            index.probe = int(np.quantile(depth, RECALL))
    return index


def search(vectors: DataFrame, index: MultiIndex, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best rows met by each query; ``queries`` has each id once."""
    shared = vectors.sparkSession.sparkContext.broadcast(index)

    def place(batches):
        ix = shared.value
        for x in batches:
            if len(x):
                cell = ix.cell(_matrix(x["v"]))
                ids = x["vec_id"].to_numpy()
                yield pd.DataFrame({"block": ix.block[cell] + ids.astype(np.uint64) * 0x9E3779B1 % (1 << 32)
                                    % ix.splits[cell].astype(np.uint64),
                                    "vec_id": ids, "cell": cell, "v": x["v"]}).astype({"block": "int64"})

    def visit(batches):
        ix = shared.value
        for x in batches:
            out = []
            for i, v in zip(x["vec_id"], x["v"]):
                by_block: dict[int, list[int]] = {}
                for c in ix.visited(np.asarray(v), ix.probe):
                    for s in range(int(ix.splits[c])):
                        by_block.setdefault(int(ix.block[c]) + s, []).append(c)
                out += [(b, i, v, cells) for b, cells in by_block.items()]
            yield pd.DataFrame(out, columns=["block", "query_id", "v", "cells"])

    rows = vectors.mapInPandas(place, "block bigint, vec_id bigint, cell bigint, v array<double>")
    visits = stored(queries.mapInPandas(
        visit, "block bigint, query_id bigint, v array<double>, cells array<bigint>"), "ann-visits")
    parts = visits.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("int").alias("parts"))
    asked = visits.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int"))
    given = rows.join(parts, "block").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    def rerank(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "vec_id": "int64", "score": "float64"})
        cell, own = np.unique(right["cell"].to_numpy(), return_inverse=True)
        seen = np.zeros((len(left), len(cell)), dtype=bool)
        for i, cells in enumerate(left["cells"]):
            seen[i, np.flatnonzero(np.isin(cell, cells))] = True
        return best_rows(left["query_id"].to_numpy(), _matrix(left["v"]), right["vec_id"].to_numpy(),
                         _matrix(right["v"]), seen[:, own], k).drop(columns="at")

    # an id with several vectors may be met in several blocks: one shuffle serves its best row and the ranks
    found = (asked.select("block", "part", "query_id", "v", "cells").groupBy("block", "part")
             .cogroup(given.select("block", "part", "vec_id", "cell", "v").groupBy("block", "part"))
             .applyInPandas(rerank, "query_id bigint, vec_id bigint, score double")
             .repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int"), "vec_id", "score"))


def nearest_neighbours(table: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
                       every: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows whose id is divisible by ``every``, against all rows."""
    ship(table.sparkSession)
    vectors = vectors_of(table, id_col, vector_col)
    queries = stored(vectors.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v")), "ann-queries")
    index = train_index(vectors, queries, k)
    if index is None:
        return table.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    return search(vectors, index, queries, k)

"""Centroid clustering by a bisector tournament on exact integers.

Every component ``x`` becomes ``floor(256 * x)``, so sums, means and distances are exact and do not depend on how
rows are dealt to tasks. The nearest of ``k`` centroids is found without k distances: for a pair i < j the set of
points as near to one as to the other is the hyperplane ``2 (c_j - c_i) . x = |c_j|**2 - |c_i|**2``. The integer
normals and thresholds of all pairs are computed once a round; a vector then plays k - 1 linear sign tests, each of
which eliminates one centroid (zero: the smaller number stays), and only the winner's distance is computed.

On Spark a round is one pass without a shuffle of vectors: each task adds up its vectors by cluster (at most k rows a
batch), Spark sums these, and k rows come to the driver, which makes the next centroids. What tasks are given is the
k * k normals, a size set by two parameters and not by the data.

Defined results:
- a vector that is null, has not exactly ``dims`` components, or holds a null or non-finite one is not kept and has
  no row; so an empty table gives an empty result;
- every row is a vector of its own, repeated ids and repeated rows included; a null id sorts after all others when
  the first centroids are taken, and rows of one id are taken in the order of their components;
- with fewer than ``k`` kept vectors there are as many centroids as vectors;
- ties go to the smaller centroid number; a cluster that is empty keeps its centroid;
- a component beyond 2**18 in size raises an error: its squared distance would not fit a long;
- columns other than the id and the vector are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histora.llm.common import ship, stored

SCALE = 256
LARGEST = 1 << 26          # of a scaled component: every test and distance then fits a long
_EXACT_DOUBLE = 1 << 21    # up to here they also fit a double's 53 bits, and products run in floating point


def scaled_vectors(batch: pa.RecordBatch, dims: int) -> tuple[pa.Array, np.ndarray]:
    """(ids, integer vectors) of the rows of (id, vector) whose vector is kept."""
    ids, vectors = batch.column(0), batch.column(1)
    whole = pc.fill_null(pc.equal(pc.list_value_length(vectors), dims), False)
    ids, vectors = ids.filter(whole), vectors.filter(whole)
    flat = vectors.flatten().cast(pa.float64())
    values = flat.to_numpy(zero_copy_only=False).reshape(-1, dims)   # nulls come as NaN
    good = np.isfinite(values).all(axis=1)
    values = values[good]
    if values.size and np.abs(values).max() > LARGEST / SCALE:
        raise ArithmeticError(f"a component beyond {LARGEST // SCALE} in size: its distances do not fit a long")
    return ids.filter(pa.array(good)), np.floor(values * SCALE).astype(np.int64)


class Tournament:
    """The bisectors of all pairs of centroids, and the search by sign tests over them."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = np.asarray(centroids, dtype=np.int64)
        c = self.centroids
        squares = (c * c).sum(axis=1)
        self.normals = 2 * (c[None, :, :] - c[:, None, :])             # [i, j]: from c_i towards c_j
        self.thresholds = squares[None, :] - squares[:, None]
        self._exact = self.normals.astype(np.float64)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the nearest centroid, squared distance to it) of every integer row of ``x``."""
        winner = np.zeros(len(x), dtype=np.int64)
        small = not x.size or max(np.abs(x).max(), np.abs(self.centroids).max()) <= _EXACT_DOUBLE
        points, normals = (x.astype(np.float64), self._exact) if small else (x, self.normals)
        for j in range(1, len(self.centroids)):
            side = np.einsum("nd,nd->n", normals[winner, j], points)   # winner < j always holds
            winner[side > self.thresholds[winner, j]] = j
        gap = x - self.centroids[winner]
        return winner, (gap * gap).sum(axis=1)


def first_centroids(vectors: DataFrame, id_col: str, vector_col: str, k: int, seed: int, dims: int) -> np.ndarray:
    """The ``k`` kept vectors with the smallest sha256 of ``<seed>:<id>``, in hash order."""
    ok = ((F.size(vector_col) == dims) & F.forall(
        vector_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
        & (F.abs(x.cast("double")) < F.lit(float("inf")))))
    picked = (vectors.where(ok).select(
        F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256).alias("h"), F.col(vector_col).alias("v"))
        .orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect())
    rows = [np.floor(np.asarray(r["v"], dtype=np.float64) * SCALE) for r in picked]
    if rows and np.abs(rows).max() > LARGEST:
        raise ArithmeticError(f"a component beyond {LARGEST // SCALE} in size: its distances do not fit a long")
    return np.asarray(rows, dtype=np.int64).reshape(-1, dims)


def next_centroids(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: every non-empty centroid moves to the exact floor of its vectors' mean."""
    k, dims = centroids.shape

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        game = Tournament(centroids)
        sums, counts = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            _, x = scaled_vectors(batch, dims)
            winner, _ = game.nearest(x)
            np.add.at(sums, winner, x)
            counts += np.bincount(winner, minlength=k)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"cluster": some, "n": counts[some], "sums": list(sums[some])},
                                         schema=pa.schema([("cluster", pa.int64()), ("n", pa.int64()),
                                                           ("sums", pa.list_(pa.int64()))]))

    parts = vectors.mapInArrow(add_up, "cluster long, n long, sums array<long>")
    wide = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dims)]
    out = centroids.copy()
    for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *wide).collect():   # at most k rows
        out[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(dims)]
    return out


def cluster_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, k: int = 40,
                    rounds: int = 5, seed: int = 2, dims: int = 64) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector."""
    spark = vectors.sparkSession
    ship(spark)
    vectors = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                             F.col(vector_col).cast("array<double>").alias("embedding"))
    centroids = first_centroids(vectors, "vec_id", "embedding", k, seed, dims)
    schema = ("vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    if not len(centroids):
        return spark.createDataFrame([], schema)
    for _ in range(rounds):
        centroids = next_centroids(vectors, centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        game = Tournament(centroids)
        for batch in batches:
            ids, x = scaled_vectors(batch, dims)
            winner, distance = game.nearest(x)
            yield pa.RecordBatch.from_arrays([ids, pa.array(winner.astype(np.int32)), pa.array(distance)],
                                             names=["vec_id", "cluster", "distance"])

    found = stored(vectors.mapInArrow(assign, "vec_id long, cluster int, distance long"), "clusters")
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    names = spark.createDataFrame(list(enumerate(digests)), "cluster int, centroid_sha256 string")
    totals = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    inertia = found.agg(F.sum("distance").alias("inertia")).first()["inertia"]
    per_cluster = totals.join(F.broadcast(names), "cluster")           # at most k rows
    return (found.join(F.broadcast(per_cluster), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(inertia).cast("long").alias("inertia"),
                    "centroid_sha256"))


def cluster_oracle(k: int = 40, rounds: int = 5, seed: int = 2, dims: int = 64) -> str:
    """DuckDB SQL of :func:`cluster_vectors`: all distances, the least taken."""
    def near(points: str, centroids: str) -> str:
        return f"""
    SELECT r, vec_id, v, arg_min(cluster, d * 100 + cluster) AS cluster, min(d) AS distance
    FROM (SELECT p.r, p.vec_id, p.v, c.cluster,
                 list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::HUGEINT AS d
          FROM {points} p, {centroids} c)
    GROUP BY r, vec_id, v"""

    ctes = [f"""kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v, embedding AS e
    FROM embeddings
    WHERE len(embedding) = {dims}
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = {dims}
)""", f"""c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY h NULLS LAST, e) - 1 AS cluster, v
    FROM (SELECT sha256('{seed}:' || CAST(vec_id AS VARCHAR)) AS h, e, v FROM kept)
    ORDER BY h NULLS LAST, e LIMIT {k}
)"""]
    for i in range(rounds):
        ctes += [f"a{i} AS MATERIALIZED ({near('kept', f'c{i}')}\n)", f"""c{i + 1} AS MATERIALIZED (
    SELECT c.cluster, coalesce(m.v, c.v) AS v
    FROM c{i} c LEFT JOIN (
        SELECT cluster, list(CAST(s // n - CASE WHEN s % n < 0 THEN 1 ELSE 0 END AS BIGINT) ORDER BY pos) AS v
        FROM (SELECT cluster, pos, sum(x) AS s, count(*) AS n
              FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM a{i})
              GROUP BY cluster, pos)
        GROUP BY cluster) m USING (cluster)
)"""]
    ctes.append(f"last AS MATERIALIZED ({near('kept', f'c{rounds}')}\n)")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT l.vec_id, CAST(l.cluster AS INTEGER) AS cluster, CAST(l.distance AS BIGINT) AS distance,
       CAST(sum(l.distance) OVER (PARTITION BY l.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(l.distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM last l JOIN c{rounds} c USING (cluster)"""

"""Quality classifier: a regularised quadratic discriminant over transformed document statistics.

A text is described by statistics of its characters, words and lines (``STATISTICS``): counts on a log scale, shares
as smoothed log-odds. Each class is a normal distribution of them with its own mean and covariance; a text's evidence
is the difference of the two log-densities, i.e. of two Mahalanobis distances and log-determinants, computed with the
inverse Cholesky factor of each class that is cached in the model. A class covariance is shrunk twice: towards the
covariance pooled over both classes, then towards its own diagonal.

How it runs: one pass computes the statistics of every text and stores them (some 30 numbers a document); the labelled
rows' moments (count, sum, sum of outer products) are added up inside tasks and summed by Spark, over all labelled
rows, so fitting holds a few thousand numbers at any size. The shrinkage and the map from evidence to a probability
are chosen on ``CALIBRATION_ROWS`` labelled rows at most, picked by a hash, whose rows are not in the moments. Scores
are one pass over the stored statistics.

Defined results: a null text counts as empty, and an empty text has a score like any other, from statistics of zero
counts; a label other than 0 or 1 is ignored, a document with several labels counts with each; rows with a null id
are scored and never learned from; repeated rows are each scored; without labelled rows of both classes the score of
every text is the labelled rows' share of ones, (ones + 1) / (rows + 2); an empty table gives no rows. Other columns
are ignored, whatever their names. A text is read whole; its statistics take memory in proportion to it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histora.llm.common import crc_mod, ship, stored

HELD_OUT_MOD, HELD_OUT_REST = 5, 0
THRESHOLD = 0.3
CALIBRATION_ROWS = 20_000
_CALIBRATION_SHARE = 4                                    # one labelled row in four, at most CALIBRATION_ROWS
SHRINKAGES = (0.02, 0.1, 0.25, 0.5, 0.9)                  # towards the pooled covariance; chosen by calibration
DIAGONAL = 0.02                                           # then towards the diagonal
_LEAST_VARIANCE = 1e-4

_LETTERS = re.compile(r"[^\W\d_]+")
_PLAIN = frozenset(".,;:!?'\"()-")


def _share(part: float, whole: float) -> float:
    """Smoothed log-odds of a share."""
    return float(np.log((part + 0.5) / (max(whole - part, 0) + 0.5)))


STATISTICS = ("chars", "words", "word_length", "word_length_spread", "distinct_words", "top_word", "once_words",
              "repeated_pairs", "letters", "capitals", "capital_words", "digits", "spaces", "plain_marks", "symbols",
              "ends_in_symbol", "wordless", "short_words", "long_words", "lines", "line_length", "copied_lines",
              "short_lines", "sentence_ends", "entropy", "packed", "letter_kinds", "run_on")


def statistics(text: str) -> list[float]:
    """The transformed statistics of a whole text, in the order of ``STATISTICS``."""
    n, words, lines = len(text), text.split(), [x for x in text.split("\n") if x.strip()]
    w, counts = len(words), Counter(words)
    sizes = np.fromiter(map(len, words), dtype=np.float64, count=w) if w else np.zeros(1)
    chars = Counter(text)
    letters = sum(c for x, c in chars.items() if x.isalpha())
    capitals = sum(c for x, c in chars.items() if x.isupper())
    digits = sum(c for x, c in chars.items() if x.isdigit())
    spaces = sum(c for x, c in chars.items() if x.isspace())
    plain = sum(c for x, c in chars.items() if x in _PLAIN)
    symbols = n - letters - digits - spaces - plain
    pairs = Counter(zip(words, words[1:]))
    shares = np.fromiter(chars.values(), dtype=np.float64, count=len(chars)) / max(n, 1)
    raw = text.encode("utf-8", "replace")
    runs = _LETTERS.findall(text)
    return [
        np.log1p(n), np.log1p(w), np.log1p(sizes.mean()), np.log1p(sizes.std()), _share(len(counts), w),
        _share(max(counts.values(), default=0), w), _share(sum(c == 1 for c in counts.values()), w),
        _share(sum(c - 1 for c in pairs.values()), max(w - 1, 0)), _share(letters, n), _share(capitals, letters),
        _share(sum(x.isupper() and len(x) > 1 for x in words), w), _share(digits, n), _share(spaces, n),
        _share(plain, n), _share(symbols, n),
        _share(sum(not (x[-1].isalnum() or x[-1] in _PLAIN) for x in words), w),
        _share(w - min(len(runs), w), w), _share(float((sizes <= 2).sum()) if w else 0, w),
        _share(float((sizes >= 12).sum()), w), np.log1p(len(lines)), np.log1p(n / max(len(lines), 1)),
        _share(len(lines) - len(set(lines)), len(lines)), _share(sum(len(x) < 30 for x in lines), len(lines)),
        _share(sum(x[-1] in ".!?" for x in words), w), float(-(shares * np.log(shares)).sum()),
        _share(min(len(zlib.compress(raw, 1)), len(raw)), len(raw)), np.log1p(sum(x.isalpha() for x in chars)),
        np.log1p(float(sizes.max())),
    ]


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, statistics) of every document, stored."""
    ship(docs.sparkSession)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t.decode("utf-8", "replace") if t else "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))],
                                             names=["doc_id", "x"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return stored(rows.mapInArrow(describe, "doc_id long, x array<double>"), "quality-statistics")


@dataclass(frozen=True)
class Moments:
    """Count, sum and sum of outer products of a class's statistics."""
    n: float
    total: np.ndarray
    outer: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return self.total / self.n

    @property
    def scatter(self) -> np.ndarray:
        return self.outer - np.outer(self.total, self.mean)


@dataclass(frozen=True)
class Discriminant:
    """Class means, inverse Cholesky factors and log-determinants; ``slope`` and ``bias`` map evidence to a score."""
    prior: float
    means: np.ndarray | None = None
    factors: np.ndarray | None = None
    log_dets: np.ndarray | None = None
    slope: float = 1.0
    bias: float = 0.0

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """log p(x | 1) - log p(x | 0), its size on a logarithmic scale."""
        log_p = [-0.5 * (((x - m) @ f.T) ** 2).sum(axis=1) - 0.5 * d
                 for m, f, d in zip(self.means, self.factors, self.log_dets)]
        return np.arcsinh(log_p[1] - log_p[0])

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.prior)
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * self.evidence(x) + self.bias, -700, 700)))


def fitted(classes: tuple[Moments, Moments], shrinkage: float) -> Discriminant:
    """The discriminant of two classes' moments at one shrinkage."""
    pooled = sum(c.scatter for c in classes) / sum(c.n for c in classes)
    factors, log_dets = [], []
    for c in classes:
        cov = (1 - shrinkage) * c.scatter / c.n + shrinkage * pooled
        cov = (1 - DIAGONAL) * cov + DIAGONAL * np.diag(np.diag(cov)) + _LEAST_VARIANCE * np.eye(len(cov))
        root = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(root))
        log_dets.append(2 * np.log(np.diag(root)).sum())
    n = [c.n for c in classes]
    return Discriminant((n[1] + 1) / (sum(n) + 2), np.stack([c.mean for c in classes]), np.stack(factors),
                        np.array(log_dets))


def calibrated(model: Discriminant, x: np.ndarray, y: np.ndarray) -> tuple[Discriminant, float]:
    """The model with a logistic map of its evidence fitted to the rows (Newton steps), and its mean log-loss."""
    e = model.evidence(x)
    design = np.column_stack([e, np.ones_like(e)])
    beta = np.array([1.0, np.log(model.prior / (1 - model.prior))])
    ridge = np.diag([1e-3, 1e-3])                       # keeps separable classes finite

    def loss(b: np.ndarray) -> float:
        z = design @ b
        return float(np.logaddexp(0, -z)[y == 1].sum() + np.logaddexp(0, z)[y == 0].sum() + 0.5 * b @ ridge @ b)

    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -50, 50)))
        gradient = design.T @ (p - y) + ridge @ beta
        step = np.linalg.solve(design.T @ (design * (p * (1 - p) + 1e-9)[:, None]) + ridge, gradient)
        size = 1.0
        while size > 1e-6 and loss(beta - size * step) > loss(beta):
            size /= 2
        beta = beta - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    done = Discriminant(model.prior, model.means, model.factors, model.log_dets, float(beta[0]), float(beta[1]))
    return done, loss(beta) / max(len(y), 1)


def _moments(rows: DataFrame) -> dict[int, Moments]:
    """Moments of the classes of (x, label) rows: added up inside tasks, then by Spark."""
    d = len(STATISTICS)
    width = 1 + d + d * d

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, width))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            y = batch.column(1).to_numpy(zero_copy_only=False)
            for c in (0, 1):
                own = x[y == c]
                held[c] += np.concatenate(([len(own)], own.sum(axis=0), (own.T @ own).ravel()))
        some = [c for c in (0, 1) if held[c, 0]]
        values = [(c, i, v) for c in some for i, v in enumerate(held[c].tolist())]
        yield pa.RecordBatch.from_pydict(
            {"c": [v[0] for v in values], "i": [v[1] for v in values], "v": [v[2] for v in values]},
            schema=pa.schema([("c", pa.int32()), ("i", pa.int32()), ("v", pa.float64())]))

    found = rows.mapInArrow(add_up, "c int, i int, v double").groupBy("c", "i").agg(F.sum("v").alias("v")).collect()
    out = {}
    for c in {r["c"] for r in found}:
        v = np.zeros(width)
        for r in found:
            if r["c"] == c:
                v[r["i"]] = r["v"]
        out[c] = Moments(v[0], v[1:1 + d], v[1 + d:].reshape(d, d))
    return out


def train(described_docs: DataFrame, labels: DataFrame, train_rows: Column) -> Discriminant:
    """The discriminant learned from the labelled rows for which ``train_rows`` (a condition on doc_id) holds."""
    wanted = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
              .where(train_rows & F.col("y").isin(0, 1) & F.col("doc_id").isNotNull()))
    rows = stored(described_docs.join(wanted, "doc_id").select("doc_id", "x", "y"), "quality-training")
    total = rows.count()
    share = min(1.0 / _CALIBRATION_SHARE, CALIBRATION_ROWS / max(total, 1))
    mark = F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))
    moments = _moments(rows.where(~mark).select("x", "y"))
    ones = moments[1].n if 1 in moments else 0
    known = sum(m.n for m in moments.values())
    if len(moments) < 2 or min(m.n for m in moments.values()) < 2:
        return Discriminant((ones + 1) / (known + 2))
    picked = rows.where(mark).select("x", "y").limit(2 * CALIBRATION_ROWS).toPandas()   # a bound, not the share
    x, y = np.array(picked["x"].tolist(), dtype=np.float64).reshape(-1, len(STATISTICS)), picked["y"].to_numpy()
    if len(set(y.tolist())) < 2:
        return fitted((moments[0], moments[1]), SHRINKAGES[len(SHRINKAGES) // 2])
    return min((calibrated(fitted((moments[0], moments[1]), s), x, y) for s in SHRINKAGES), key=lambda m: m[1])[0]


def held_out() -> Column:
    return crc_mod("doc_id", HELD_OUT_MOD) == HELD_OUT_REST


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document; a null id is not held out."""
    rows = described(docs)
    model = train(rows, labels, ~held_out())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], names=["doc_id", "score"])

    found = rows.mapInArrow(score, "doc_id long, score double")
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

"""Language identification by interpolated Kneser-Ney character models, one per language.

Text is lower-cased and cut to its letters: every run of other characters counts as one boundary symbol.
A symbol is 12 bits (letters beyond the first 2,048 code points share the upper half), so an n-gram of up
to five symbols is one 64-bit key whose high bits are its context and whose low bits its shorter suffix.
Spark counts the highest order over all training rows, every lower order from the distinct keys (continuation
counts), and the discounts of every order and language from all counts; no n-gram is left out. The models of all
languages lie in one sorted key array per order with a row of log probabilities, one per language; a text is
scored by binary search, backing off where a key is missing. The language of lowest cross-entropy per symbol wins.

Calibration uses a bounded share of the training rows that the counts leave out (``CALIBRATION_ROWS`` in
expectation, one row in ten at most): one temperature for the posterior that becomes the score, and the level of
cross-entropy up to which a text is accepted. A row's excess over its language's median is scaled by the root of
its symbols (``_LONG`` at most); the allowance of a language and length class is ``MARGIN`` times the excess that
all but ``STRAY`` of its rows keep to, so junk or mislabelled rows up to that share do not widen it. A class with
too few rows takes that length's rows of all languages, then the language's rows, then all rows; below ``_SURE``
rows the allowance is wider by the root of what is missing.

The model grows with the input and is dealt into parts by the two symbols before the last (``part_of``): all that
an n-gram of order three or more needs, down to its context of two symbols, lies in one part; orders one and two
lie in every part's base. Tasks build the parts; each is broadcast by itself, and a task scores the positions of a
batch part by part. A task holds ``MODEL_CELLS`` log probabilities of the highest order (keys times languages) at
a time: a larger model's parts are read again for each batch and dropped after use.

Defined cases: a null text, one without a letter, and any text when there is no training row are ``und`` with
score 0 and rejected. Whole texts are read; a long one takes some 30 bytes a character, its probabilities are
summed piece by piece. Ties go to the language first in alphabetical order. Repeated rows are judged alike and
each counts in training; columns other than id, text and language are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histora.llm.common import batched, crc_mod, ship, stored

ORDER = 4
BITS = 12
MODEL_CELLS = 8_000_000        # log probabilities that a task holds at a time
CALIBRATION_ROWS = 4_000
UNKNOWN = "und"
_LONG = 400                    # symbols from which a text's cross-entropy counts as settled
STRAY = 0.02                   # share of calibration rows that may be junk or mislabelled
MARGIN = 8.0                   # allowance, in excesses that the other rows keep to
_LENGTHS = (50, _LONG)         # symbols from which the next length class begins
_ENOUGH = 200                  # rows from which a class speaks for itself
_SURE = 1_000                  # and from which its tail counts as measured
_SPREAD = 2_654_435_761        # an odd mixing constant
_MARK = 1                      # the code point put between texts
_BATCH_CHARS = 1 << 18
_POSITIONS = 1 << 16           # positions whose probabilities, one per language, are held at a time
_HELD = 4                      # parts that make up MODEL_CELLS
_SYMBOLS: list[np.ndarray] = []
Higher = tuple[list, list, list, list]      # keys, log_p, contexts and log_back of the orders from three on


def symbols() -> np.ndarray:
    """Symbol of each code point: 0 for all but letters, the letters below 2,048 themselves."""
    if not _SYMBOLS:
        letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
        code = np.arange(0x110000, dtype=np.int64)
        code[2048:] = 2048 + code[2048:] % 2039
        _SYMBOLS.append(np.where(letter, code, 0).astype(np.int16))
    return _SYMBOLS[0]


def keys_of(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key of the n-gram that ends at each kept position, whether it is predicted, first position per text)."""
    mark = chr(_MARK) * (order - 1)
    parts = [t.lower() + " " for t in texts]
    whole = np.frombuffer((mark + "".join(p + mark for p in parts)).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    begin = np.cumsum([order - 1] + [len(p) + order - 1 for p in parts])
    symbol = symbols()[np.minimum(whole, 0x10FFFF)]
    marked = whole == _MARK
    keep = marked.copy()
    keep[1:] |= (symbol[1:] != 0) | (symbol[:-1] != 0)
    at = np.flatnonzero(keep)
    kept = symbol[at].astype(np.int64)
    key = kept.copy()
    for back in range(1, order):
        key[back:] |= kept[:-back] << (BITS * back)
    return key, ~marked[at], np.searchsorted(at, begin)


@dataclass
class LanguageModel:
    """Sorted keys and log probabilities per order; backoff weights per context; calibration."""

    languages: list[str]
    order: int = ORDER
    keys: list[np.ndarray] = field(default_factory=list)        # [n - 1]: keys of order n
    log_p: list[np.ndarray] = field(default_factory=list)       # rows as keys, a column per language
    contexts: list[np.ndarray] = field(default_factory=list)
    log_back: list[np.ndarray] = field(default_factory=list)
    temperature: float = 8.0
    level: np.ndarray | None = None                              # accepted cross-entropy per language
    allowance: np.ndarray | None = None                          # above it, at one symbol, a column per length class
    parts: list = field(default_factory=list)                    # broadcast orders from three on; else all orders are here

    def score_positions(self, key: np.ndarray) -> np.ndarray:
        """Log probability of each key's last symbol given the rest, a column per language."""
        out = np.zeros((len(key), len(self.languages)), dtype=np.float32)
        rest = np.arange(len(key))
        for n in range(self.order, 0, -1):
            table = self.keys[n - 1]
            if not len(table):      # a part that no training text reached
                key = key & ((1 << (BITS * (n - 1))) - 1)
                continue
            at = np.minimum(np.searchsorted(table, key), len(table) - 1)
            hit = table[at] == key
            out[rest[hit]] += self.log_p[n - 1][at[hit]]
            rest, key = rest[~hit], key[~hit]
            if not len(rest):
                break
            context = key >> BITS
            table = self.contexts[n - 1]
            at = np.minimum(np.searchsorted(table, context), len(table) - 1)
            hit = table[at] == context
            out[rest[hit]] += self.log_back[n - 1][at[hit]]
            key = key & ((1 << (BITS * (n - 1))) - 1)
        else:
            out[rest] -= np.float32(BITS * np.log(2))
        return out

    def with_part(self, part: Higher) -> LanguageModel:
        """This base with the higher orders of one part."""
        return LanguageModel(self.languages, self.order, *(mine + own for mine, own in zip(
            (self.keys, self.log_p, self.contexts, self.log_back), part)))

    def totals(self, texts: list[str], parts: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(log probability of each text per language, symbols predicted); ``parts`` as broadcast to the task."""
        total = np.zeros((len(texts), len(self.languages)))
        count = np.zeros(len(texts), dtype=np.int64)
        for i in range(max(1, len(parts or ()))):
            model = self.with_part(parts[i].value) if parts else self
            for lo, hi in batched(texts, _BATCH_CHARS):
                key, used, first = keys_of(texts[lo:hi], self.order)
                n = np.concatenate(([0], np.cumsum(used)))
                count[lo:hi] = n[first[1:]] - n[first[:-1]]
                here = np.flatnonzero(used)
                if parts and len(parts) > 1:
                    here = here[part_of(key[here], len(parts)) == i]
                for a in range(0, len(here), _POSITIONS):      # a long text is scored piece by piece
                    some = here[a:a + _POSITIONS]
                    of = np.searchsorted(first, some, side="right") - 1
                    start = np.flatnonzero(np.diff(of, prepend=-1))
                    total[lo + of[start]] += np.add.reduceat(model.score_positions(key[some]), start, axis=0,
                                                             dtype=np.float64)
            if parts and len(parts) > _HELD and getattr(parts[i], "_path", None):
                parts[i].__dict__.pop("_value", None)      # read again from the executor's disk for the next batch
        return total, count


def part_of(key, parts: int):
    """The part of each key: a scrambling of the two symbols before the last (numbers or a Spark column)."""
    if isinstance(key, Column):
        mid = F.shiftright(key, BITS).bitwiseAND((1 << (2 * BITS)) - 1)
        return F.shiftright((mid * F.lit(_SPREAD)) % (1 << 32), 8) % parts
    mid = (key >> BITS) & ((1 << (2 * BITS)) - 1)
    return ((mid * _SPREAD) % (1 << 32) >> 8) % parts


def count_ngrams(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, key, n) over all rows of (lang, text); each task sums its own rows first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def merged(parts):
            key, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            return key, np.bincount(at, weights=np.concatenate([n for _, n in parts])).astype(np.int64)

        def out():
            for lang, parts in held.items():
                key, n = merged(parts)
                yield pd.DataFrame({"lang": lang, "key": key, "n": n})
            held.clear()

        for batch in batches:
            for lang, rows in batch.groupby("lang", sort=False):
                texts = rows["text"].tolist()
                for lo, hi in batched(texts, _BATCH_CHARS):
                    key, used, _ = keys_of(texts[lo:hi], order)
                    part = np.unique(key[used], return_counts=True)
                    held.setdefault(lang, []).append(part)
                    size += len(part[0])
                    if size > 4_000_000:      # keep a task's memory bounded: fold, and hand out if still large
                        held.update({k: [merged(v)] for k, v in held.items()})
                        size = sum(len(v[0][0]) for v in held.values())
                        if size > 2_000_000:
                            yield from out()
                            size = 0
        yield from out()

    found = (docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
             .mapInPandas(run, "lang string, key bigint, n bigint"))
    return found.groupBy("lang", "key").agg(F.sum("n").alias("n"))


def discount(ones: int, twos: int) -> float:
    return min(0.95, max(0.1, ones / (ones + 2 * twos) if ones + twos else 0.5))


def add_order(model: LanguageModel, counts: list[tuple[np.ndarray, np.ndarray]], cuts: list[float]) -> None:
    """The next order of interpolated Kneser-Ney: (keys, counts) and the discount of each language."""
    m, width = len(model.keys) + 1, len(model.languages)
    keys = np.unique(np.concatenate([k for k, _ in counts]))
    contexts = np.unique(keys >> BITS)
    log_p = np.empty((len(keys), width), dtype=np.float32)
    log_back = np.zeros((len(contexts), width), dtype=np.float32)
    if m == 1:
        lower = np.full((len(keys), width), 2.0 ** -BITS)
    else:
        below = np.searchsorted(model.keys[m - 2], keys & ((1 << (BITS * (m - 1))) - 1))
        lower = np.exp(model.log_p[m - 2][below].astype(np.float64))
    of = np.searchsorted(contexts, keys >> BITS)
    for i, ((k, c), cut) in enumerate(zip(counts, cuts)):
        at = np.searchsorted(keys, k)
        size = np.bincount(of[at], weights=c, minlength=len(contexts))
        kinds = np.bincount(of[at], minlength=len(contexts))
        back = np.where(size > 0, cut * kinds / np.maximum(size, 1), 1.0)
        p = back[of] * lower[:, i]
        p[at] += (c - cut) / size[of[at]]
        log_p[:, i] = np.log(p)
        log_back[:, i] = np.log(back)
    model.keys.append(keys)
    model.log_p.append(log_p)
    model.contexts.append(contexts)
    model.log_back.append(log_back)


def by_language(width: int, lang: np.ndarray, key: np.ndarray, n: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(sorted keys, counts) of each language."""
    out = []
    for i in range(width):
        mine = lang == i
        rank = np.argsort(key[mine])
        out.append((key[mine][rank], n[mine][rank].astype(np.float64)))
    return out


def continued(counts: list[tuple[np.ndarray, np.ndarray]], m: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Continuation counts of order ``m`` from the keys of order m + 1: distinct longer keys per suffix."""
    pairs = [np.unique(k & ((1 << (BITS * m)) - 1), return_counts=True) for k, _ in counts]
    return [(k, c.astype(np.float64)) for k, c in pairs]


def build_model(languages: list[str], lang: np.ndarray, key: np.ndarray, n: np.ndarray, order: int) -> LanguageModel:
    """Interpolated Kneser-Ney over the counts; ``lang`` indexes ``languages``."""
    model = LanguageModel(languages, order)
    counts = [by_language(len(languages), lang, key, n)]
    for m in range(order - 1, 0, -1):
        counts.append(continued(counts[-1], m))
    for of_order in reversed(counts):
        add_order(model, of_order, [discount(np.count_nonzero(c == 1), np.count_nonzero(c == 2)) for _, c in of_order])
    return model


def build_parts(counts: DataFrame, languages: list[str], order: int, cells: int) -> LanguageModel:
    """``build_model`` over all rows of (lang index, key, n): a base of orders one and two, and broadcast parts."""
    spark, width = counts.sparkSession, len(languages)
    levels = {order: counts}
    for m in range(order - 1, 0, -1):
        levels[m] = stored(levels[m + 1].groupBy("lang", F.col("key").bitwiseAND((1 << (BITS * m)) - 1).alias("key"))
                           .agg(F.count(F.lit(1)).alias("n")), f"langid-counts-{m}")
    cuts = {m: [discount(0, 0)] * width for m in levels}
    rows = 0
    for m, level in levels.items():
        for r in level.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos"),
                                           F.count(F.lit(1)).alias("rows")).collect():
            cuts[m][r["lang"]] = discount(r["ones"], r["twos"])
            rows += r["rows"] if m == order else 0
    base = LanguageModel(languages, order)
    for m in range(1, min(order, 2) + 1):
        low = levels[m].select("lang", "key", "n").toArrow()
        add_order(base, by_language(width, *(low[c].to_numpy() for c in ("lang", "key", "n"))), cuts[m])
    if order < 3:
        return base
    parts = max(1, -(-rows * width * _HELD // max(1, cells)))
    if rows * width <= cells:
        parts = 1
    shared = spark.sparkContext.broadcast(base)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        model = shared.value.with_part(([], [], [], []))
        own = [by_language(width, *(rows[c].to_numpy() for c in ("lang", "key", "n")))]
        for m in range(order - 1, 2, -1):
            own.append(continued(own[-1], m))
        for m, of_order in enumerate(reversed(own), 3):
            add_order(model, of_order, cuts[m])
        higher = tuple(x[2:] for x in (model.keys, model.log_p, model.contexts, model.log_back))
        return pd.DataFrame({"part": rows["part"].iloc[:1], "model": [pickle.dumps(higher, protocol=5)]})

    built = stored(counts.withColumn("part", part_of(F.col("key"), parts)).groupBy("part")
                   .applyInPandas(build, "part bigint, model binary"), "langid-parts")
    of_part = {r["part"]: spark.sparkContext.broadcast(pickle.loads(r["model"])) for r in built.toLocalIterator()}
    shared.unpersist()
    nothing = ([np.empty(0, np.int64)] * (order - 2), [np.empty((0, width), np.float32)] * (order - 2)) * 2
    base.parts = [of_part[i] if i in of_part else spark.sparkContext.broadcast(nothing) for i in range(parts)]
    return base


def calibrate(model: LanguageModel, truth: np.ndarray, total: np.ndarray, count: np.ndarray) -> None:
    """Temperature of least log loss, and the accepted level of cross-entropy of each language."""
    n = np.maximum(count, 1)[:, None]
    best = np.inf
    for t in (1, 2, 4, 8, 16, 32, 64):
        logit = total / t
        logit = logit - logit.max(axis=1, keepdims=True)
        p = logit - np.log(np.exp(logit).sum(axis=1, keepdims=True))
        loss = -p[np.arange(len(truth)), truth].mean()
        if loss < best:
            best, model.temperature = loss, float(t)
    own = (-total / n)[np.arange(len(truth)), truth]
    some = count > 0
    if not some.any():
        return
    model.level = np.full(len(model.languages), np.median(own[some]))
    for i in range(len(model.languages)):
        mine = some & (truth == i)
        if mine.sum() >= 20:
            model.level[i] = np.median(own[mine])
    over = (own - model.level[truth]) * np.sqrt(np.minimum(n[:, 0], _LONG))
    length = np.searchsorted(_LENGTHS, n[:, 0], side="right")
    model.allowance = np.empty((len(model.languages), len(_LENGTHS) + 1))
    for i in range(len(model.languages)):
        for j in range(len(_LENGTHS) + 1):
            rows = next((x for x in (some & (truth == i) & (length == j), some & (length == j), some & (truth == i))
                         if x.sum() >= _ENOUGH), some)
            wider = np.sqrt(max(1.0, _SURE / rows.sum()))
            model.allowance[i, j] = MARGIN * wider * max(0.0, np.quantile(over[rows], 1 - STRAY, method="lower"))


def train_model(docs: DataFrame, *, order: int = ORDER, cells: int = MODEL_CELLS,
                calibration_rows: int = CALIBRATION_ROWS) -> LanguageModel | None:
    """Model from all rows of (lang, text) with a language; None if there is none.

    ``cells`` bounds what a task holds at a time, not the model.
    """
    ship(docs.sparkSession)
    docs = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    share = int(min(0.1, calibration_rows / max(1, docs.count())) * 1_000_000)
    apart = F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < share
    counts = stored(count_ngrams(docs.where(~apart), order), "langid-counts")
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    if not languages:
        return None
    place = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col("lang")).cast("int") - 1
    model = build_parts(counts.select(place.alias("lang"), "key", "n"), languages, order, cells)
    shared, parts = docs.sparkSession.sparkContext.broadcast(replace(model, parts=[])), model.parts

    def run(batches):
        for batch in batches:
            total, count = shared.value.totals(batch["text"].tolist(), parts)
            yield pd.DataFrame({"lang": batch["lang"], "total": list(total), "count": count})

    seen = docs.where(apart).mapInPandas(run, "lang string, total array<double>, count bigint").toPandas()
    seen = seen[seen["lang"].isin(languages)]
    if len(seen):
        calibrate(model, pd.Categorical(seen["lang"], categories=languages).codes.astype(int),
                  np.stack(seen["total"].to_numpy()), seen["count"].to_numpy())
    shared.unpersist()
    return model


FOUND = (T.StructType().add("lang_pred", T.StringType()).add("score", T.DoubleType())
         .add("cross_entropy", T.DoubleType()).add("n_symbols", T.LongType()).add("rejected", T.BooleanType()))


def language_of(text: Column, model: LanguageModel | None, spark: SparkSession) -> Column:
    """Struct (lang_pred, score, cross_entropy in nats a symbol, n_symbols, rejected) of a text column."""
    ship(spark)
    shared = spark.sparkContext.broadcast(model and replace(model, parts=[]))
    parts = model.parts if model else []

    @F.pandas_udf(FOUND)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for batch in batches:
            texts = [t if t is not None else "" for t in batch.tolist()]
            out = pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": 0.0, "cross_entropy": np.nan,
                                "n_symbols": 0, "rejected": True})
            if known is not None and texts:
                total, count = known.totals(texts, parts)
                best = total.argmax(axis=1)
                rows = np.arange(len(texts))
                entropy = -total[rows, best] / np.maximum(count, 1)
                logit = (total - total[rows, best][:, None]) / known.temperature
                some = count > 0
                out["lang_pred"] = np.where(some, np.array(known.languages, dtype=object)[best], UNKNOWN)
                out["score"] = np.where(some, 1.0 / np.exp(logit).sum(axis=1), 0.0)
                out["cross_entropy"] = np.where(some, entropy, np.nan)
                out["n_symbols"] = count
                if known.level is not None:
                    room = known.allowance[best, np.searchsorted(_LENGTHS, count, side="right")]
                    limit = known.level[best] + room / np.sqrt(np.clip(count, 1, _LONG))
                    some = some & (entropy <= limit)
                out["rejected"] = ~some
            yield out

    return found.asNondeterministic()(text)     # so that a filter on the result does not score the texts again


def identify(docs: DataFrame, model: LanguageModel | None, *, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Per row: doc_id, lang_pred, score, cross_entropy, n_symbols, rejected."""
    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                        language_of(F.col(text_col), model, docs.sparkSession).alias("found"))
            .select("doc_id", "found.*"))


def held_out(id_col: str = "doc_id") -> Column:
    """The rows that training never sees: crc32 of the id's text leaves 2 modulo 4."""
    return F.coalesce(crc_mod(id_col, 4) == 2, F.lit(False))

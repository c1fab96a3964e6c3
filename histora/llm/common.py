"""Small helpers shared by the operators: table access, cut lineage, keyed splits, rolling word hashes."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histora.session import work_path


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package's code to the tasks of the application (once), as ``--py-files`` would."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parents[1]
        archive = f"{tempfile.mkdtemp(prefix='histora-code-')}/{root.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, str(file.relative_to(root.parent)))
        sc.addPyFile(archive)
        _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of a scale directory, read by Spark (any path Spark can open)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back: lineage is cut durably."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _bitmap(rows: DataFrame, ids: DataFrame, id_col: str, bits: int) -> tuple[DataFrame, Column]:
    """(words of a bitmap of the ids' hashes, at most ``bits`` / 64 rows; the condition that a row's id is in it)."""
    word, mask = fresh(rows.columns, "_word"), fresh(rows.columns, "_bits")
    slot = f"pmod(xxhash64(`{id_col}`), {bits}L)"
    place, bit = f"shiftright({slot}, 6)", f"shiftleft(1L, cast({slot} & 63 AS int))"
    words = (ids.select(F.expr(place).alias(word), F.expr(bit).alias(mask)).groupBy(word)
             .agg(F.bit_or(mask).alias(mask)))
    return words, (F.expr(place) == F.col(word)) & F.expr(f"(`{mask}` & {bit}) <> 0")


def rows_with_ids(rows: DataFrame, ids: DataFrame, id_col: str = "doc_id", bits: int = 1 << 24) -> DataFrame:
    """The rows whose id may be among ``ids``, found without moving a row: none missed, some too many.

    The bitmap's size is fixed, so it may be broadcast. A join that follows then moves little more than the
    rows it needs; with far more ids than bits it moves all of them.
    """
    words, found = _bitmap(rows, ids, id_col, bits)
    return rows.join(F.broadcast(words), found, "left_semi")


def rows_without_ids(rows: DataFrame, ids: DataFrame, id_col: str = "doc_id", bits: int = 1 << 24) -> DataFrame:
    """Exactly the rows whose id is not among ``ids`` (null ids stay); only rows that may go are moved."""
    words, found = _bitmap(rows, ids, id_col, bits)
    sure = rows.join(F.broadcast(words), found, "left_anti")
    rest = rows.join(F.broadcast(words), found, "left_semi").join(ids.hint("merge"), id_col, "left_anti")
    return sure.unionByName(rest.select(rows.columns))


def fresh(columns: list[str], name: str) -> str:
    """``name``, lengthened until no column has it in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc_mod(column: str, modulus: int) -> Column:
    """``crc32`` of the column's text modulo ``modulus``: the fixed split of labelled rows (null: null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(modulus)


# Odd 64-bit mixing constants.
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_ROLL = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (two multiply-xorshift rounds)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    """``r**0 .. r**(n-1)`` modulo 2**64 for the rolling hash's odd base."""
    out = np.empty(max(n, 1), dtype=np.uint64)
    out[0] = 1
    if n > 1:
        np.multiply.accumulate(np.full(n - 1, _ROLL), out=out[1:])
    return out


class WordHasher:
    """64-bit hashes of the words of a batch of byte texts, computed for the whole batch at once.

    A word's hash is a base-``r`` polynomial of its bytes modulo 2**64, read off prefix sums, so the
    cost does not depend on the number of words. ``separator`` and ``fold`` are 256-entry tables:
    which bytes separate words, and which byte each byte counts as.
    """

    def __init__(self, separator: np.ndarray, fold: np.ndarray):
        self.separator, self.fold = separator, fold
        self._pow = powers(1 << 12)

    def _powers(self, n: int) -> np.ndarray:
        if n > len(self._pow):
            self._pow = powers(max(n, 2 * len(self._pow)))
        return self._pow

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(hash of every word in order, for each text the index of its first word; one more at the end)."""
        data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))
        sep = self.separator[data]
        edge = np.flatnonzero(np.diff(sep.view(np.int8), prepend=np.int8(1)))
        start, stop = edge[0::2], edge[1::2]
        first = np.searchsorted(start, np.concatenate(([0], ends)))
        if not len(start):
            return np.empty(0, np.uint64), first
        length = stop - start
        # sum of byte * r**(distance to the word's end), taken byte position by byte position
        value = np.zeros(len(start), np.uint64)
        folded = self.fold[data]
        order = np.argsort(length, kind="stable")
        sorted_len = length[order]
        longest = int(sorted_len[-1])
        if longest <= 64:
            for j in range(longest):
                live = order[np.searchsorted(sorted_len, j, side="right"):]
                value[live] = value[live] * _ROLL + folded[start[live] + j] + np.uint64(1)
        else:
            short = sorted_len <= 64
            for j in range(64):
                lo = np.searchsorted(sorted_len, j, side="right")
                live = order[lo:][short[lo:]]
                value[live] = value[live] * _ROLL + folded[start[live] + j] + np.uint64(1)
            for i in order[~short]:
                part = folded[start[i]:stop[i]].astype(np.uint64) + np.uint64(1)
                value[i] = np.sum(part * self._powers(len(part))[:len(part)][::-1], dtype=np.uint64)
        return mix64(value ^ (length.astype(np.uint64) << np.uint64(48))), first


def byte_table(members: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(members)] = True
    return out


def ascii_lower() -> np.ndarray:
    """Byte table that lower-cases A-Z and leaves every other byte."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


def alnum_hasher() -> WordHasher:
    """Words are runs of ASCII letters and digits and of all characters beyond ASCII."""
    apart = np.ones(256, dtype=bool)
    apart[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = False
    apart[128:] = False
    return WordHasher(apart, ascii_lower())


def alnum_words(texts: list[str], hasher: WordHasher) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, and each text's first word."""
    return hasher([t.lower().encode("utf-8", "surrogatepass") for t in texts])


def batched(texts: list, limit: int = 1 << 21):
    """Consecutive index ranges whose texts hold about ``limit`` bytes together (one text at least)."""
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)

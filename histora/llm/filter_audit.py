"""Filter interaction audit: what every filter removes, in every order, from sorted posting lists.

Five filters judge every text (``FILTERS``). For each part (a ``lang`` value) the audit tells, for all 120 orders and
each step, how many documents the step's filter removes, how many it would have removed had they not gone before, and
so on. Nothing is filtered 120 times: a step depends on the *set* of filters before it and on its own filter only, so
80 pairs (set, filter) cover all orders.

How it runs:
1. one pass over the texts gives (id, part, failure bits A-D, sha256 of the text), stored;
2. E (the text of a smaller id) is a join of the rows with the least id of each repeated digest. Rows whose digest is
   surely single are told by a bitmap of fixed size and do not move; a digest with very many rows is spread over salts,
   in proportion to its rows, so that no task holds a hot text;
3. equal rows (part, id, bits) are counted together before they are dealt, so that a repeated or null id cannot be
   hot; rows that fail nothing only count in their part's total;
4. what fails and the label rows are dealt by ranges of id (one shuffle for both). Within a range each part has a
   sorted posting list a filter, the labels have two (good, toxic); unions grow filter by filter through k-way merges,
   differences and intersections gallop the shorter list through the longer one, and the sizes of a range are emitted;
5. Spark sums the sizes; a part's 80 sums and its total give its 600 rows.

Defined results:
- a null text is empty; it has no words, so it fails A, and B not (0 < 0 is false); a null ``lang`` is the part '';
- a document is a row: repeated rows and ids count each; E compares ids, so copies under one id do not fail by each
  other, a null id never fails E and makes nothing fail E;
- a label holds for every row of its id; several labels of an id hold together (good if any quality is 1, toxic if
  any toxic is 1); null ids have no label;
- an empty table gives no rows; parts without failures have all rows, with zeros;
- other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histora.llm.common import _bitmap, ship, stored

FILTERS = "ABCDE"
WORDS_LEAST = 100              # A: under this many words
DISTINCT_PERCENT = 80          # B: distinct words under this share of the words
CAPITAL_PERCENT = 10           # C: capitals A-Z over this share of the code points
_SYMBOLS = re.compile(rb"[#$%&*|]")                  # D
RANGE_ROWS = 1 << 16           # rows whose lists are merged at a time
HOT_PARTS = 2_000              # a digest with more than 1 / HOT_PARTS of the repeated rows is salted

_CAPITALS = bytes(range(65, 91))
_CONTINUED = bytes(range(0x80, 0xC0))                # bytes of UTF-8 that begin no code point
_ALL = (1 << len(FILTERS)) - 1


def text_bits(data: bytes) -> int:
    """Bits 0-3: whether the text fails A, B, C, D. Words are maximal runs without ASCII white space."""
    words = data.split()           # of bytes: at 0x20 and 0x09-0x0D only
    points = len(data.translate(None, _CONTINUED))
    capitals = len(data) - len(data.translate(None, _CAPITALS))
    return ((len(words) < WORDS_LEAST)
            | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
            | (100 * capitals > CAPITAL_PERCENT * points) << 2
            | (_SYMBOLS.search(data) is not None) << 3)


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [x or b"" for x in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([text_bits(t) for t in texts], pa.int32()),
             pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())],
            names=["doc_id", "part", "bits", "digest"])


def judged(docs: DataFrame) -> DataFrame:
    """(doc_id, part, bits of A-D, digest) of every document, stored."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                       F.col("text").cast("string").cast("binary").alias("text"))
    return stored(rows.mapInArrow(_judge, "doc_id long, part string, bits int, digest binary"), "audit-rows")


def with_copies(rows: DataFrame) -> DataFrame:
    """(doc_id, part, bits of A-E, n): E joined to the stored rows of :func:`judged`; n equal rows are one."""
    repeated = stored(rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
                      .where("n > 1 AND least IS NOT NULL"), "audit-copies")
    total = repeated.agg(F.sum("n")).first()[0]
    one = F.lit(1).cast("long").alias("n")
    if not total:
        return rows.select("doc_id", "part", "bits", one)
    words, maybe = _bitmap(rows, repeated, "digest", 1 << 24)
    single = rows.join(F.broadcast(words), maybe, "left_anti").select("doc_id", "part", "bits", one)
    moved = (rows.join(F.broadcast(words), maybe, "left_semi").groupBy("doc_id", "part", "bits", "digest")
             .agg(F.count(F.lit(1)).alias("rows")))
    share = max(1, total // HOT_PARTS)                     # rows of a digest that one task takes
    salts = F.ceil(F.col("n") / F.lit(share)).cast("int")
    hot = repeated.where(F.col("n") > share).select("digest", salts.alias("salts"))    # under HOT_PARTS rows
    # the salt follows row values only, so a task that is run again deals its rows the same way
    salted = (moved.join(F.broadcast(hot), "digest", "left")
              .withColumn("salt", F.when(F.col("salts").isNull(), F.lit(0)).otherwise(
                  F.pmod(F.xxhash64("doc_id", "part"), F.coalesce("salts", F.lit(1)).cast("long")).cast("int"))))
    spread = repeated.withColumn("salt", F.explode(F.sequence(F.lit(0), F.when(F.col("n") > share, salts - 1)
                                                              .otherwise(F.lit(0)))))
    joined = salted.join(spread.select("digest", "salt", "least").hint("merge"), ["digest", "salt"], "left")
    fails = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
    return single.unionByName(joined.select("doc_id", "part", F.col("bits").bitwiseOR(
        F.when(fails, F.lit(16)).otherwise(F.lit(0))).alias("bits"), F.col("rows").alias("n")))


def found_in(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which members of the sorted list ``a`` (repeats allowed) are in the sorted set ``b``.

    The shorter list gallops through the longer one: its members are searched in order, each from where the one
    before it was found.
    """
    inside = np.zeros(len(a), dtype=bool)
    if not len(a) or not len(b):
        return inside
    if len(a) <= len(b):
        at = np.minimum(np.searchsorted(b, a), len(b) - 1)
        return b[at] == a
    low, high = np.searchsorted(a, b, "left"), np.searchsorted(a, b, "right")
    edges = np.zeros(len(a) + 1, dtype=np.int64)
    np.add.at(edges, low, 1)
    np.add.at(edges, high, -1)
    return np.cumsum(edges[:-1]) > 0


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The union of two sorted sets: the members that only the shorter one has are put in place."""
    if len(a) < len(b):
        a, b = b, a
    new = b[~found_in(b, a)]
    return np.insert(a, np.searchsorted(a, new), new) if len(new) else a


def range_sizes(ids: np.ndarray, bits: np.ndarray, weight: np.ndarray, good: np.ndarray,
                toxic: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """(set before, filter, removed, good lost, toxic lost) of the rows of one part in one range of ids, sorted by id.

    A posting list holds positions in ``ids``, so rows that share an id stay apart; ``weight`` is a row's count and
    ``good`` and ``toxic`` are sorted sets of ids. Filter -1 gives the size of the union of a whole set.
    """
    lists = [np.flatnonzero(bits & (1 << f)) for f in range(len(FILTERS))]
    unions = {0: np.empty(0, dtype=np.int64)}
    for members in range(1, _ALL + 1):
        top = members.bit_length() - 1
        unions[members] = merged(unions[members & ~(1 << top)], lists[top])
    marked = [found_in(ids, good) * weight, found_in(ids, toxic) * weight]
    for f, own in enumerate(lists):
        if len(own):
            for before in range(_ALL + 1):
                if not before & (1 << f):
                    left = own[~found_in(own, unions[before])]
                    if len(left):
                        yield before, f, int(weight[left].sum()), *(int(m[left].sum()) for m in marked)


def _range_rows(chunk: pd.DataFrame) -> pd.DataFrame:
    labels, rows = chunk[chunk["kind"] == 0], chunk[chunk["kind"] == 1]
    marks = [np.unique(labels.loc[(labels["bits"] & b) > 0, "doc_id"].to_numpy(dtype=np.int64)) for b in (1, 2)]
    out = []
    for part, own in rows.groupby("part", sort=False):
        known = own["doc_id"].notna().to_numpy()
        for keep, marked in ((known, marks), (~known, [np.empty(0, np.int64)] * 2)):
            some = own[keep]
            ids = some["doc_id"].fillna(0).to_numpy(dtype=np.int64)
            for sizes in range_sizes(ids, some["bits"].to_numpy(), some["n"].to_numpy(), *marked):
                out.append((part, *sizes))
    return pd.DataFrame(out, columns=["part", "before", "filter", "removed", "good_lost", "toxic_lost"])


def _ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cuts a task's rows, sorted by id, into ranges of about ``RANGE_ROWS`` rows, never within an id."""
    held, size = [], 0
    for batch in batches:
        batch["doc_id"] = batch["doc_id"].astype("Int64")
        held.append(batch)
        size += len(batch)
        if size >= RANGE_ROWS:
            rows = pd.concat(held, ignore_index=True)
            last = rows["doc_id"].iloc[-1]
            same = rows["doc_id"].isna() if last is pd.NA else (rows["doc_id"] == last).fillna(False)
            yield _range_rows(rows[~same])
            held, size = [rows[same]], int(same.sum())
    if held:
        yield _range_rows(pd.concat(held, ignore_index=True))


def _orders() -> list[tuple[str, int, int, int]]:
    """(order, step, set before, filter) of all orders and steps."""
    return [("".join(order), i + 1, sum(1 << FILTERS.index(x) for x in order[:i]), FILTERS.index(f))
            for order in itertools.permutations(FILTERS) for i, f in enumerate(order)]


def _part_rows(sums: pd.DataFrame) -> pd.DataFrame:
    """The 600 rows of one part from its at most 81 sums."""
    table = {(int(b), int(f)): (int(r), int(g), int(t)) for b, f, r, g, t in
             zip(sums["before"], sums["filter"], sums["removed"], sums["good_lost"], sums["toxic_lost"])}
    total = table.pop((0, -1))[0]
    nothing = (0, 0, 0)
    shapley = [0] * len(FILTERS)
    for _, _, before, f in _orders():
        shapley[f] += table.get((before, f), nothing)[0]
    out, kept = [], total
    for order, step, before, f in _orders():
        removed, good, toxic = table.get((before, f), nothing)
        kept = (total if step == 1 else kept) - removed
        out.append((sums["part"].iloc[0], order, step, kept, removed, table.get((0, f), nothing)[0] - removed,
                    table.get((_ALL & ~(1 << f), f), nothing)[0], good, toxic, shapley[f]))
    return pd.DataFrame(out, columns=[x.split()[0] for x in _RESULT.split(", ")])


_RESULT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
           "good_lost long, toxic_lost long, shapley long")


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step (see the module's text)."""
    rows = judged(docs)
    failing = (with_copies(rows).where("bits <> 0").groupBy("doc_id", "part", "bits")
               .agg(F.sum("n").alias("n")).withColumn("kind", F.lit(1)))
    one = lambda c, bit: F.max(F.when(F.col(c) == 1, F.lit(bit)).otherwise(F.lit(0)))
    marks = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").where("doc_id IS NOT NULL")
             .groupBy("doc_id").agg((one("quality", 1) + one("toxic", 2)).alias("bits")).where("bits <> 0")
             .select("doc_id", F.lit("").alias("part"), "bits", F.lit(0).cast("long").alias("n"),
                     F.lit(0).alias("kind")))
    dealt = (failing.unionByName(marks).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "kind"))
    sizes = dealt.mapInPandas(_ranges, "part string, before int, filter int, removed long, good_lost long, "
                                       "toxic_lost long")
    sums = sizes.groupBy("part", "before", "filter").agg(*[F.sum(c).alias(c) for c in
                                                           ("removed", "good_lost", "toxic_lost")])
    totals = rows.groupBy("part").agg(F.count(F.lit(1)).alias("removed")).select(
        "part", F.lit(0).alias("before"), F.lit(-1).alias("filter"), "removed", F.lit(0).cast("long").alias("good_lost"),
        F.lit(0).cast("long").alias("toxic_lost"))
    return sums.unionByName(totals).groupBy("part").applyInPandas(_part_rows, _RESULT)


def audit_oracle() -> str:
    """DuckDB SQL of :func:`audit_filters`: every document's failure bits, counted under every order."""
    pick = " ".join(f"WHEN '{f}' THEN {1 << i}" for i, f in enumerate(FILTERS))
    return f"""
WITH t AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
    FROM documents
),
least AS (SELECT text, min(doc_id) AS first_id FROM t GROUP BY text),
lab AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
           max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
),
judged AS (
    SELECT t.part, coalesce(lab.good, 0) AS good, coalesce(lab.bad, 0) AS bad,
           CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
           + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
           + CASE WHEN 100 * (length(t.text) - length(regexp_replace(t.text, '[A-Z]', '', 'g'))) > 10 * length(t.text)
                  THEN 4 ELSE 0 END
           + CASE WHEN regexp_matches(t.text, '[#$%&*|]') THEN 8 ELSE 0 END
           + CASE WHEN t.doc_id > least.first_id THEN 16 ELSE 0 END AS bits
    FROM t JOIN least ON t.text = least.text LEFT JOIN lab ON t.doc_id = lab.doc_id
),
counted AS (SELECT part, bits, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM judged GROUP BY part, bits),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE b.x <> a.x AND c.x NOT IN (a.x, b.x) AND d.x NOT IN (a.x, b.x, c.x) AND e.x NOT IN (a.x, b.x, c.x, d.x)
),
bit AS (SELECT x, CASE x {pick} END AS b FROM letters),
steps AS (
    SELECT filter_order, step, bit.x AS letter, bit.b AS own,
           (SELECT coalesce(sum(p.b), 0) FROM bit p WHERE position(p.x IN filter_order) < step) AS before
    FROM orders, range(1, 6) s(step), bit
    WHERE substr(filter_order, CAST(step AS INTEGER), 1) = bit.x
),
sized AS (
    SELECT c.part, s.filter_order, s.step, s.letter,
           sum(CASE WHEN (c.bits & CAST(s.before AS INTEGER)) = 0 AND (c.bits & s.own) = 0 THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN (c.bits & CAST(s.before AS INTEGER)) = 0 AND (c.bits & s.own) > 0 THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN (c.bits & CAST(s.before AS INTEGER)) > 0 AND (c.bits & s.own) > 0 THEN n ELSE 0 END)
               AS redundant,
           sum(CASE WHEN c.bits = s.own THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN (c.bits & CAST(s.before AS INTEGER)) = 0 AND (c.bits & s.own) > 0 THEN good ELSE 0 END)
               AS good_lost,
           sum(CASE WHEN (c.bits & CAST(s.before AS INTEGER)) = 0 AND (c.bits & s.own) > 0 THEN bad ELSE 0 END)
               AS toxic_lost
    FROM counted c, steps s
    GROUP BY c.part, s.filter_order, s.step, s.letter
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM sized"""

"""Ordered per-entity scans that split hot entities.

Every history operator needs a value from a neighbouring row in the entity's time order: the next
change (``lead``), the previous one (``lag``), the row's rank (``row_number``) or a running max / last
value. ``Window.partitionBy(entity)`` would put all rows of one entity into one task, and one entity may
hold a third of all rows. These helpers run the same scans as two levels instead:

0. an input whose Catalyst size estimate is below ``spark.histora.hotCheckMinBytes``, or that has no more
   rows than one chunk, cannot hold an entity too big for one task and runs as the plain window;
1. rows are hash-partitioned once on ``(entity, chunk)`` and the window runs per ``(entity, chunk)``. Only
   *hot* entities have more than one chunk. Their chunk borders come from the rows themselves: a hash
   sample of the full order key (``_SAMPLES`` rows per chunk of ``spark.histora.hotChunkRows`` rows) is sorted
   per entity, and every ``_SAMPLES``-th sampled key is a border. So borders follow the real distribution --
   an outlier, a dense hour or many rows of one instant do not collapse them -- and any order type works,
   since keys are only compared. Rows of one full key share a chunk; rows of one instant need not. Chunks grow with the input, so that all
   borders together stay below ``_MOST_BORDERS`` and may be broadcast;
2. one summary row per ``(entity, chunk)`` (row count, first row, chunk aggregate) is scanned per entity;
   that table has one row per chunk, not per change;
3. the summary is joined back on ``(entity, chunk)`` and combined with the local result.

The big side is shuffled once. The summary is computed from the *same* exchange: the summary aggregate
references every column of the repartitioned input, so both branches have identical plans below the
exchange and Spark reuses it (``ReusedExchange``) instead of recomputing the input. The join back uses
the same non-null partition keys, so the big side is not shuffled again. Results equal the plain window
exactly, ties (the full order key decides) and NULLs (ascending puts them last, as in SQL) included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histora.session import work_path

CHUNK = "_chunk"
_PARTED = "_parted"
_SAMPLES = 8              # sampled rows per chunk
_MOST_BORDERS = 100_000   # borders of all entities together
_NULL_CHUNK = 2**62  # NULL order values sort after every real chunk (ascending, NULLS LAST)

# Session settings (defaults in brackets).
HOT_ROWS_CONF = "spark.histora.hotEntityRows"        # [1000000] an entity above this is split; 0 = all
MIN_BYTES_CONF = "spark.histora.hotCheckMinBytes"     # [268435456] smaller inputs are never split
CHUNK_ROWS_CONF = "spark.histora.hotChunkRows"        # [1000000] target rows per chunk of a hot entity


def _estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of ``df`` (what the broadcast threshold is checked against)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # e.g. a Spark Connect session: no estimate, always check for hot entities
        return None


def _conf(df: DataFrame, key: str, default: int) -> int:
    return int(df.sparkSession.conf.get(key, str(default)))


def chunk_of(c: Column, dtype: T.DataType, minutes: int | Column = 60) -> Column:
    """Monotone, non-null bucket of a time: ``minutes``-wide steps (or steps of value for numbers).

    A zoned time is an instant and counted as one, a zone-less time by its calendar fields; neither depends
    on the session's zone or its daylight saving.
    """
    width = minutes if isinstance(minutes, Column) else F.lit(minutes)
    if isinstance(dtype, T.TimestampType):
        units = F.floor(F.unix_micros(c) / 60_000_000)
    elif isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        units = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long") * 1440
        if not isinstance(dtype, T.DateType):
            units = units + F.hour(c) * 60 + F.minute(c)
    else:
        units = c
    return F.coalesce(F.floor(units / width).cast("long"), F.lit(_NULL_CHUNK).cast("long"))


def _default(dtype: T.DataType):
    if isinstance(dtype, T.StringType):
        return F.lit("")
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        return F.lit("1970-01-01 00:00:00").cast(dtype)
    if isinstance(dtype, T.DateType):
        return F.lit("1970-01-01").cast("date")
    return F.lit(0).cast(dtype)


def _partition_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """NULL-free stand-ins for the keys (value with a default + null flag), so joins stay plain equi-joins."""
    cols = []
    for i, k in enumerate(keys):
        df = df.withColumn(f"_pk{i}", F.coalesce(F.col(k), _default(df.schema[k].dataType))) \
               .withColumn(f"_pn{i}", F.col(k).isNull())
        cols += [f"_pk{i}", f"_pn{i}"]
    return df, cols


def _order(cols: Sequence[str], descending: bool) -> list[Column]:
    return [F.col(c).desc_nulls_first() if descending else F.col(c).asc_nulls_last() for c in cols]


def _sort_key(cols: Sequence[str]) -> Column:
    """A struct whose natural (ascending) order equals ``ORDER BY cols ASC NULLS LAST``."""
    parts = []
    for i, c in enumerate(cols):
        parts += [F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"k{i}")]
    return F.struct(*parts)


def _borders(src: DataFrame, pkeys: Sequence[str], order: Sequence[str], hot_rows: int) -> DataFrame | None:
    """(pkeys, _cuts): the sorted chunk borders of the hot entities; None if there is none.

    Measured on the rows by two small jobs (a count, a sample) and written once, so that every branch of the
    scan and every retried task sees the same borders.
    """
    chunk_rows = _conf(src, CHUNK_ROWS_CONF, 1_000_000 if hot_rows else _SAMPLES)
    total = src.count()
    if total <= max(hot_rows, chunk_rows):
        return None
    chunk_rows = max(chunk_rows, total // _MOST_BORDERS)
    share = min(1.0, _SAMPLES / chunk_rows)
    picked = src.where(F.pmod(F.xxhash64(*pkeys, *order), F.lit(1_000_000_000)) < F.lit(int(share * 1_000_000_000)))
    least = max(2 * _SAMPLES if hot_rows else 2, int(hot_rows * share))
    step = _SAMPLES if hot_rows else 1
    found = (picked.groupBy(*pkeys).agg(F.sort_array(F.collect_set(_sort_key(order))).alias("_s"))
             .where(F.size("_s") >= least)
             .select(*pkeys, F.expr(f"transform(sequence({step}, size(_s) - 1, {step}), i -> _s[i])").alias("_cuts")))
    path = work_path(src.sparkSession, "borders")
    found.write.parquet(path)
    stored = src.sparkSession.read.schema(found.schema).parquet(path)
    return None if stored.isEmpty() else stored


# How many sorted borders are at or below the row's key, by bisection (2**17 exceeds _MOST_BORDERS).
_BISECT = """aggregate(sequence(1, 18), named_struct('lo', 0, 'hi', size(_cuts)), (a, i) -> if(a.lo < a.hi,
    if(_cuts[(a.lo + a.hi) div 2] <= _key,
       named_struct('lo', cast((a.lo + a.hi) div 2 + 1 AS int), 'hi', a.hi),
       named_struct('lo', a.lo, 'hi', cast((a.lo + a.hi) div 2 AS int))), a), a -> a.lo)"""


def _prepare(df: DataFrame, keys: Sequence[str], order: Sequence[str], hot_source: DataFrame | None = None,
             mark_parted: bool = False):
    """Repartition on (keys, chunk): the frame, the partition columns and the hot-row flag; None: do not split.

    ``mark_parted`` adds the flag of rows whose first order value a border holds too, so that rows sharing that
    value may lie in several chunks.

    ``hot_source`` (with the key and order columns) may stand in for ``df`` when borders are measured, e.g.
    the staged log, which is a cheap column-pruned scan while ``df`` may sit behind a shuffle.
    """
    hot_rows = _conf(df, HOT_ROWS_CONF, 1_000_000)
    given = hot_source if hot_source is not None and set(order) <= set(hot_source.columns) else df
    size = _estimated_bytes(given) if hot_rows > 0 else None
    if size is not None and size < _conf(df, MIN_BYTES_CONF, 256 * 1024 * 1024):
        return None
    src = given.select(*[F.col(c).cast(df.schema[c].dataType).alias(c) for c in dict.fromkeys([*keys, *order])])
    src, pkeys = _partition_keys(src, keys)
    cuts = _borders(src, pkeys, order, hot_rows)
    if cuts is None:
        return None
    df, pkeys = _partition_keys(df, keys)
    df = df.join(F.broadcast(cuts), list(pkeys), "left").withColumn("_hot", F.col("_cuts").isNotNull())
    df = df.withColumn("_key", _sort_key(order)).withColumn(
        CHUNK, F.when(F.col("_hot"), F.expr(_BISECT).cast("long")).otherwise(F.lit(0).cast("long")))
    if mark_parted:
        # borders of one instant are neighbours, so the nearest one on either side of the row tells
        df = df.withColumn(_PARTED, F.coalesce(F.expr(
            f"_hot AND ((get(_cuts, cast({CHUNK} - 1 AS int)) IS NOT NULL "
            f"AND get(_cuts, cast({CHUNK} - 1 AS int)).k0 <=> _key.k0) "
            f"OR (get(_cuts, cast({CHUNK} AS int)) IS NOT NULL AND get(_cuts, cast({CHUNK} AS int)).k0 <=> _key.k0))"),
            F.lit(False)))
    return df.drop("_cuts", "_key").repartition(*pkeys, CHUNK), [*pkeys, CHUNK], F.col("_hot")


def _split_rows(x: DataFrame, hot: Column) -> DataFrame:
    """The rows of split entities, for the per-chunk summary (other entities have a single chunk).

    The predicate is one non-deterministic expression (``spark_partition_id() >= 0`` is always true), so
    Catalyst keeps it above the shared repartition exchange; a pushed-down ``hot`` would make the two
    branches differ (and turn the heavy-hitter outer join into an inner one), so the input would be
    computed twice. This way the summary's sort only sees the rows of hot entities. (``rand() >= 0``
    would not do: Catalyst folds it to true; conjuncts are split, so the condition must be nested.)
    """
    return x.where(F.when(F.spark_partition_id() >= F.lit(0), hot).otherwise(F.lit(False)))


def _row_struct(df: DataFrame) -> Column:
    """Every column of ``df``: pins the summary branch to the same input plan as the window branch."""
    return F.struct(*[F.col(c) for c in df.columns])


def _join_back(df: DataFrame, summ: DataFrame, part: Sequence[str]) -> DataFrame:
    return df.join(summ, list(part), "left").drop(*part)


def _peers_across(x: DataFrame, part: Sequence[str], instant: str, peers: dict[str, Column]) -> DataFrame:
    """(keys, instant, aggregates over all its rows) of the instants that a border parts: one row a border at most.

    The rows are aggregated inside the tasks first, so an instant with very many rows is no hot group. As in
    :func:`_split_rows` the filter must stay above the shared exchange, and ``_pin`` keeps its columns.
    """
    rows = x.where(F.when(F.spark_partition_id() >= F.lit(0), F.col(_PARTED)).otherwise(F.lit(False)))
    keys = [F.col(c).alias(f"_b{i}") for i, c in enumerate(part[:-1])]
    found = rows.groupBy(*keys, F.col(instant).alias("_bt")).agg(
        *[agg.alias(f"_all_{n}") for n, agg in peers.items()],
        F.max(F.xxhash64(*[F.col(c) for c in x.columns])).alias("_pin"))
    return found.select(*[f"_b{i}" for i in range(len(keys))], "_bt", *[
        F.when(F.col("_pin").isNotNull(), F.col(f"_all_{n}")).alias(f"_all_{n}") for n in peers])


def chunked_lead(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, Column],
                 out: str, *, descending: bool = False, row_number: str | None = None,
                 hot_source: DataFrame | None = None, peers: dict[str, Column] | None = None,
                 maxima: dict[str, Column] | None = None):
    """Add ``out`` = struct of ``values`` taken from the next row in ``order`` within ``keys``.

    ``descending=True`` gives the previous row (``lag``). ``row_number`` optionally adds the 1-based
    rank in that order (bigint). ``peers`` optionally adds aggregates (name to aggregate expression) over the rows
    that share the keys and the first order value (the *instant*, NULL being one). They reuse the scan's
    partitioning and sort; where a chunk border parts an instant, the instant's rows are aggregated across chunks
    and joined back (:func:`_peers_across`). ``maxima`` optionally adds the greatest value of a column over all rows of
    the keys; it rides on the same partitioning and, for split entities, on the chunk summary.
    """
    peers, maxima = peers or {}, maxima or {}
    df = df.withColumn("_v", F.struct(*[v.alias(n) for n, v in values.items()]))
    prepared = _prepare(df, keys, order, hot_source, mark_parted=bool(peers))
    if prepared is None:
        w = Window.partitionBy(*keys).orderBy(*_order(order, descending))
        same = Window.partitionBy(*keys, order[0])
        out_df = df.withColumn(out, F.lead("_v").over(w))
        if row_number:
            out_df = out_df.withColumn(row_number, F.row_number().over(w).cast("long"))
        whole = Window.partitionBy(*keys)
        return out_df.select("*", *[agg.over(same).alias(n) for n, agg in peers.items()],
                             *[F.max(c).over(whole).alias(n) for n, c in maxima.items()]).drop("_v")
    x, part, hot = prepared
    w = Window.partitionBy(*part).orderBy(*_order(order, descending))
    local = x.withColumn("_lead_local", F.lead("_v").over(w))
    if row_number:
        local = local.withColumn("_rn_local", F.row_number().over(w).cast("long"))
    if peers:
        same = Window.partitionBy(*part, order[0])
        local = local.select("*", *[agg.over(same).alias(f"_own_{n}") for n, agg in peers.items()])
    if maxima:
        here = Window.partitionBy(*part)
        local = local.select("*", *[F.max(c).over(here).alias(f"_here_{n}") for n, c in maxima.items()])

    # Only split (hot) entities have more than one chunk; only their rows feed the summary.
    pick = F.max if descending else F.min
    summ = _split_rows(x, hot).groupBy(*part).agg(
        pick(F.struct(_sort_key(order).alias("k"), _row_struct(x).alias("r"))).alias("_first"),
        F.count(F.lit(1)).alias("_cnt"),
        *[F.max(c).alias(f"_max_{n}") for n, c in maxima.items()],
    )
    wc = Window.partitionBy(*part[:-1]).orderBy(F.col(CHUNK).desc() if descending else F.col(CHUNK).asc())
    cols = [*part, F.lead(F.col("_first.r._v")).over(wc).alias("_lead_next")]
    if row_number:
        cols.append(F.coalesce(F.sum("_cnt").over(wc.rowsBetween(Window.unboundedPreceding, -1)),
                               F.lit(0)).cast("long").alias("_rn_offset"))
    chunks = Window.partitionBy(*part[:-1])
    summ = summ.select(*cols, *[F.max(f"_max_{n}").over(chunks).alias(f"_max_{n}") for n in maxima])

    joined = local.join(summ, list(part), "left")
    for n in maxima:
        joined = joined.withColumn(n, F.when(hot, F.col(f"_max_{n}")).otherwise(F.col(f"_here_{n}")))
    joined = joined.drop(*[f"_{k}_{n}" for k in ("max", "here") for n in maxima])
    # Only split entities need the neighbouring chunk (``hot`` keeps both branches' columns equal).
    joined = joined.withColumn(out, F.coalesce(F.col("_lead_local"), F.when(hot, F.col("_lead_next"))))
    if row_number:
        joined = joined.withColumn(row_number, F.when(hot, F.col("_rn_offset")).otherwise(F.lit(0))
                                   + F.col("_rn_local"))
    if peers:
        across = F.broadcast(_peers_across(x, part, order[0], peers))      # at most _MOST_BORDERS rows
        same = F.col(_PARTED) & F.col(order[0]).eqNullSafe(F.col("_bt"))
        for i, c in enumerate(part[:-1]):
            same = same & (F.col(c) == F.col(f"_b{i}"))
        joined = joined.join(across, same, "left")
        for n in peers:
            joined = joined.withColumn(n, F.when(F.col(_PARTED), F.col(f"_all_{n}")).otherwise(F.col(f"_own_{n}")))
        joined = joined.drop("_bt", _PARTED, *[f"_b{i}" for i in range(len(part) - 1)],
                             *[f"_{k}_{n}" for k in ("all", "own") for n in peers])
    return joined.drop("_v", "_lead_local", "_lead_next", "_rn_local", "_rn_offset", "_hot", *part)


def chunked_running(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                    value: Column | dict[str, Column], out: str | None, how: str, *,
                    descending: bool = False, include_current: bool = False,
                    hot_source: DataFrame | None = None) -> DataFrame:
    """Add ``out`` = running ``how`` (``max``, ``min``, ``sum`` or ``last`` non-null) of ``value``.

    ``value`` may be a dict ``{out_name: column}`` to compute several running values in one pass (then
    ``out`` is ignored). The frame is every earlier row in ``order`` (plus the row itself when
    ``include_current``); ``descending=True`` runs the scan from the end, i.e. over the following rows.
    """
    if how not in ("max", "min", "sum", "last"):
        raise ValueError(how)
    values = value if isinstance(value, dict) else {out: value}
    names = list(values)
    for i, n in enumerate(names):
        df = df.withColumn(f"_val{i}", values[n])
    prepared = _prepare(df, keys, order, hot_source)
    if prepared is None:
        w = Window.partitionBy(*keys).orderBy(*_order(order, descending)).rowsBetween(
            Window.unboundedPreceding, 0 if include_current else -1)
        fns = {"max": F.max, "min": F.min, "sum": F.sum, "last": lambda c: F.last(c, ignorenulls=True)}
        for i, n in enumerate(names):
            df = df.withColumn(n, fns[how](F.col(f"_val{i}")).over(w))
            if how == "sum":
                df = df.withColumn(n, F.coalesce(F.col(n), F.lit(0)))
        return df.drop(*[f"_val{i}" for i in range(len(names))])
    x, part, hot = prepared
    w = Window.partitionBy(*part).orderBy(*_order(order, descending)).rowsBetween(
        Window.unboundedPreceding, 0 if include_current else -1)
    local_df, totals = x, []
    for i in range(len(names)):
        v = F.col(f"_val{i}")
        if how == "max":
            local, total = F.max(v).over(w), F.max(v)
        elif how == "min":
            local, total = F.min(v).over(w), F.min(v)
        elif how == "sum":
            local, total = F.sum(v).over(w), F.sum(v)
        else:
            local = F.last(v, ignorenulls=True).over(w)
            pick = F.min if descending else F.max
            total = pick(F.when(v.isNotNull(),
                                F.struct(_sort_key(order).alias("k"), v.alias("v")))).getField("v")
        local_df = local_df.withColumn(f"_loc{i}", local)
        totals.append(total.alias(f"_tot{i}"))

    # ``_pin`` (a hash of whole rows) is referenced below, so the optimizer keeps every column in this
    # branch and the repartition exchange is shared with the window branch. Only split entities' rows
    # feed the summary; scalar aggregates keep it a hash aggregate (no sort) except for ``last``.
    summ = _split_rows(x, hot).groupBy(*part).agg(
        *totals, F.max(F.xxhash64(*[F.col(c) for c in x.columns])).alias("_pin"))
    wc = Window.partitionBy(*part[:-1]).orderBy(
        F.col(CHUNK).desc() if descending else F.col(CHUNK).asc()
    ).rowsBetween(Window.unboundedPreceding, -1)
    carries = []
    for i in range(len(names)):
        t = F.col(f"_tot{i}")
        carry = {"max": F.max(t), "min": F.min(t), "sum": F.sum(t), "last": F.last(t, ignorenulls=True)}[how]
        carries.append(F.when(F.col("_pin").isNotNull(), carry.over(wc)).alias(f"_car{i}"))
    summ = summ.select(*part, *carries)

    joined = _join_back(local_df, summ, part)
    for i, n in enumerate(names):
        loc, carry_in = F.col(f"_loc{i}"), F.when(hot, F.col(f"_car{i}"))   # only split entities carry
        if how == "sum":
            result = F.coalesce(loc, F.lit(0)) + F.coalesce(carry_in, F.lit(0))
        elif how == "max":
            result = F.greatest(loc, carry_in)
        elif how == "min":
            result = F.least(loc, carry_in)
        else:
            result = F.coalesce(loc, carry_in)
        joined = joined.withColumn(n, result)
    drop = [f"_{p}{i}" for i in range(len(names)) for p in ("val", "loc", "car")]
    return joined.drop(*drop, "_hot")

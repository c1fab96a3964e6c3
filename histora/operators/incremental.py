"""Late-arrival repair of only the affected entities, and incremental fact appends.

The repaired table equals a full rebuild over the same log: every version of an affected entity is
replaced by the history rebuilt from that entity's *whole* visible log. The affected set is deleted
as a set, not by the keys the rebuild happens to emit, so an entity that rebuilds to zero versions
loses its stale rows too (S10, a deliberate difference from a keyed delete+insert).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histora.functions.exprs import EPOCH, ts_literal
from histora.operators.changes import deduplicate_changes
from histora.operators.scd2 import build_scd2
from histora.session import work_path
from histora.sources.stored import PART, StoredTable
from histora.spec import DEFAULT_EVENTS, DEFAULT_SPEC, ChangeLogSpec, EventSpec


def high_water(dim: DataFrame) -> DataFrame:
    """One row, the latest arrival already reflected in the table (epoch when empty)."""
    return dim.agg(F.coalesce(F.max("last_seen_ingested_at"), ts_literal(EPOCH)).alias("high_water"))


def event_high_water(facts: DataFrame, events: EventSpec = DEFAULT_EVENTS) -> DataFrame:
    """D3: one row, the latest *event time* in the fact table (epoch when empty)."""
    return facts.agg(F.coalesce(F.max(events.event_ts), ts_literal(EPOCH)).alias("high_water"))


def _scalar(df: DataFrame):
    """Collect a one-row, one-column aggregate as a literal, so the scan below can prune by it.

    A zone-less timestamp goes back as text cast to ``timestamp_ntz``: ``lit(datetime)`` would make a
    session-zone timestamp and shift the comparison by the zone offset.
    """
    value, dtype = df.first()[0], df.schema.fields[0].dataType
    if isinstance(dtype, T.TimestampNTZType) and value is not None:
        return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    return F.lit(value).cast(dtype)


def affected_entities(staged: DataFrame, dim: DataFrame, spec: ChangeLogSpec = DEFAULT_SPEC) -> DataFrame:
    """Distinct entities with a delivery strictly after the table's high-water mark."""
    s = spec
    mark = _scalar(high_water(dim))
    return staged.where(F.col(s.ingest_ts) > mark).select(s.entity).distinct()


def affected_entities_stored(log: StoredTable, dim: DataFrame, spec: ChangeLogSpec = DEFAULT_SPEC) -> DataFrame:
    """J1 over a staged log stored by arrival day (``daily_table(path, ingest time)``).

    The mark is a literal, so its day is a partition filter: only the days from the mark on are read.
    """
    s, mark = spec, _scalar(high_water(dim))
    new = log.read(dim.sparkSession).where((F.col(PART) >= F.to_date(mark)) & (F.col(s.ingest_ts) > mark))
    return new.select(s.entity).distinct()


def rebuild_entities(staged: DataFrame, affected: DataFrame, spec: ChangeLogSpec = DEFAULT_SPEC,
                     order: str = "source", change_ids_unique_to_entity: bool = True) -> DataFrame:
    """The full history of ``affected`` entities from their whole visible log.

    Dedup runs per change_id; restricting the log to the affected entities *before* dedup is only
    equal to dedup-then-restrict when a change_id never appears on two entities (S2). That is the
    default contract (checked by :func:`histora.operators.changes.shared_change_ids`); with
    ``change_ids_unique_to_entity=False`` the whole log is deduplicated first.
    """
    s = spec
    scoped = staged.join(affected.select(s.entity), s.entity, "left_semi")
    if change_ids_unique_to_entity:
        changes = deduplicate_changes(scoped, s)
    else:
        changes = deduplicate_changes(staged, s).join(affected.select(s.entity), s.entity, "left_semi")
    return build_scd2(changes, scoped, s, order=order)


def repair_scd2(dim: DataFrame, staged: DataFrame, spec: ChangeLogSpec = DEFAULT_SPEC,
                affected: DataFrame | None = None, order: str = "source",
                change_ids_unique_to_entity: bool = True) -> DataFrame:
    """Replace every version of the affected entities with their rebuilt history.

    ``affected`` defaults to the high-water detection of :func:`affected_entities`. The untouched part
    is an anti-join (C6) and the rebuilt part a semi-join-scoped build (C4).
    """
    s = spec
    if affected is None:
        affected = affected_entities(staged, dim, s)
    affected = affected.select(s.entity).distinct()
    kept = dim.join(affected, s.entity, "left_anti")
    rebuilt = rebuild_entities(staged, affected, s, order=order,
                               change_ids_unique_to_entity=change_ids_unique_to_entity)
    return kept.unionByName(rebuilt)


def rebuild_tail(dim_rows: DataFrame, scoped: DataFrame, new: DataFrame, spec: ChangeLogSpec = DEFAULT_SPEC) -> DataFrame:
    """All versions of the entities in ``new`` after a bounded rebuild (the core of the tail repair).

    ``dim_rows``: their current versions; ``scoped``: their whole staged log, ``new`` included; ``new``: the
    deliveries that arrived since. Per entity, ``t`` is the earliest source time in ``new`` and ``b`` the
    latest source time of the log strictly before ``t``: versions starting before ``b`` are kept (they end at
    or before ``b``), the rest is rebuilt from the deliveries with source time >= ``b``.
    """
    s = spec
    tmin = new.groupBy(s.entity).agg(F.min(s.source_ts).alias("_t"))
    stats = (scoped.join(tmin, s.entity)
             .groupBy(s.entity)
             .agg(F.max(F.when(F.col(s.source_ts) < F.col("_t"), F.col(s.source_ts))).alias("_b"),
                  F.max(s.ingest_ts).alias("_seen")))
    tail = (scoped.join(stats, s.entity)
            .where(F.col("_b").isNull() | (F.col(s.source_ts) >= F.col("_b")))
            .drop("_b", "_seen"))
    rebuilt = build_scd2(deduplicate_changes(tail, s), scoped, s)
    kept = (dim_rows.join(stats, s.entity)
            .where(F.col("_b").isNotNull() & (F.col("valid_from") < F.col("_b")))
            .withColumn("last_seen_ingested_at", F.col("_seen"))
            .select(*dim_rows.columns))
    return kept.unionByName(rebuilt.select(*dim_rows.columns))


def repair_scd2_tail(dim: DataFrame, staged: DataFrame, spec: ChangeLogSpec = DEFAULT_SPEC) -> DataFrame:
    """J2 with a bounded rebuild: only the part of each affected history that late rows can change.

    For an affected entity let ``t`` be the earliest source time among its new deliveries (ingested after
    the high-water mark) and ``b`` the latest source time of its log strictly before ``t``. Versions that
    start before ``b`` end at or before ``b`` and cannot change; versions from ``b`` on are rebuilt from the
    deliveries with source time >= ``b``. So dedup and the ordered scan cost what the new tail costs, not
    the entity's whole history (a hot entity touched by every batch stays cheap). Kept versions get the
    entity's new ``last_seen_ingested_at``. Source order only. Contract (checked by
    :func:`histora.operators.changes.unstable_change_ids`): re-deliveries of a change_id keep its entity
    and source time. Equal to :func:`repair_scd2` and to a full rebuild under that contract.
    """
    s = spec
    mark = _scalar(high_water(dim))
    new = staged.where(F.col(s.ingest_ts) > mark)
    keys = new.select(s.entity).distinct()
    scoped = staged.join(keys, s.entity, "left_semi")
    untouched = dim.join(keys, s.entity, "left_anti")
    rebuilt = rebuild_tail(dim.join(keys, s.entity, "left_semi"), scoped, new, s)
    return untouched.unionByName(rebuilt)


def append_facts(existing: DataFrame, new: DataFrame, events: EventSpec = DEFAULT_EVENTS,
                 mode: str = "by_id") -> DataFrame:
    """Fold newly staged events into the fact table (keyed delete+insert on ``event_id``).

    ``by_id`` (default) takes every new row and replaces earlier rows with the same ``event_id``: late
    events are never lost. ``event_time`` reproduces the watermark form: only rows with event time
    strictly after the table's latest event time are taken, so a late event waits for a full refresh
    (S9). Duplicate ids inside one batch are all inserted, as in the keyed delete+insert.
    """
    e = events
    if mode == "event_time":
        new = new.where(F.col(e.event_ts) > _scalar(event_high_water(existing, e)))
    elif mode != "by_id":
        raise ValueError(f"mode must be 'by_id' or 'event_time', not {mode!r}")
    kept = existing.join(new.select(e.event_id).distinct(), e.event_id, "left_anti")
    return kept.unionByName(new.select(*existing.columns))


def repair_stored(table: StoredTable, staged: DataFrame, step: str, spec: ChangeLogSpec = DEFAULT_SPEC,
                  order: str = "source") -> None:
    """J2 into a stored, keyed history (A4): only the buckets of the affected entities are read and written.

    ``step`` names the repair, so that a repeated one changes nothing (see :mod:`histora.sources.stored`).
    """
    s, spark = spec, staged.sparkSession
    if table.resume(spark, step):
        return
    path = work_path(spark, "affected")
    affected_entities(staged, table.read(spark), s).write.parquet(path)     # read three times below
    affected = spark.read.schema(staged.select(s.entity).schema).parquet(path)
    parts = table.parts_of(affected)
    kept = table.read(spark, parts).drop(PART).join(affected, s.entity, "left_anti")
    rebuilt = rebuild_entities(staged, affected, s, order=order)
    table.replace(step, parts, rebuilt.unionByName(kept))


def moved_events(existing: DataFrame, new: DataFrame, events: EventSpec = DEFAULT_EVENTS) -> DataFrame:
    """Event ids that are stored under another day than they come with now (the contract of ``append_stored``)."""
    e = events
    day = lambda df, name: df.select(e.event_id, F.to_date(e.event_ts).alias(name)).distinct()
    both = day(existing, "stored_day").join(day(new, "new_day"), e.event_id)
    return both.where(~F.col("stored_day").eqNullSafe(F.col("new_day")))


def append_stored(table: StoredTable, new: DataFrame, step: str, events: EventSpec = DEFAULT_EVENTS,
                  ids_keep_their_day: bool = True) -> None:
    """J4 into a stored fact table (A5): ``append_facts(mode="by_id")`` on the days that the new events touch.

    With ``ids_keep_their_day`` an event that comes again keeps its day (checked by :func:`moved_events`), so stored
    rows with a new event's id can only lie on the new events' days: the delete's anti-join reads those days alone,
    by dynamic partition pruning, and only they are written. Without it the table's ids are searched for further
    days first.
    """
    e, spark = events, new.sparkSession
    if table.resume(spark, step):
        return
    stored = table.read(spark)
    ids = new.select(e.event_id).distinct()
    # the comparison, true of every day, makes Spark take the days as a filter worth pruning by
    days = table.with_part(new).select(PART).distinct().where(F.col(PART) >= F.lit("0001-01-01").cast("date"))
    if not ids_keep_their_day:
        days = days.unionByName(stored.select(e.event_id, PART).join(ids, e.event_id, "left_semi").select(PART)).distinct()
    parts = sorted(r[0] for r in days.collect())          # calendar days
    table.replace(step, parts, kept_facts(stored, days, ids, e).unionByName(new.select(*e.columns)))


def kept_facts(stored: DataFrame, days: DataFrame, ids: DataFrame, events: EventSpec = DEFAULT_EVENTS) -> DataFrame:
    """The stored events of ``days`` whose id is not among ``ids``; days are few, and their set prunes the scan."""
    e = events
    return (stored.join(F.broadcast(days), PART, "left_semi").join(ids, e.event_id, "left_anti").select(*e.columns))

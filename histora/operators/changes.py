"""Canonical mutations: first-delivery dedup, source-time sequencing, delivery diagnostics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histora.functions.exprs import any_differs
from histora.plans.ordered import chunked_lead, chunked_running
from histora.spec import DEFAULT_SPEC, ChangeLogSpec


LAST_ARRIVAL = "_last_arrival"


def deduplicate_changes(staged: DataFrame, spec: ChangeLogSpec = DEFAULT_SPEC, last_arrival: bool = False) -> DataFrame:
    """Keep the first *ingested* delivery of every ``change_id`` (first write wins, S3).

    Written as an aggregate, ``min(struct(ingest_ts, received_id, payload...))`` per change_id, instead of
    ``row_number() = 1``: the partial aggregate collapses re-deliveries inside each map task before the
    shuffle, so a change_id replayed a billion times moves one row per task. The payload columns are
    the last tie-breakers, which makes the winner deterministic even for identical delivery keys (S4).
    ``last_arrival`` adds the latest arrival of any delivery of the change (``LAST_ARRIVAL``), from which
    :func:`histora.operators.scd2.build_scd2` takes the entity's watermark without a second read of the log. The two
    agree if a change id stays on one entity (S2, checked by :func:`shared_change_ids`).
    """
    s = spec
    rest = [c for c in s.staged_columns if c not in (s.change_id, s.ingest_ts, s.received_id)]
    order = [s.ingest_ts, s.received_id, *rest]
    packed = F.struct(*[x for i, c in enumerate(order)
                        for x in (F.col(c).isNull().alias(f"_n{i}"), F.col(c).alias(c))])
    latest = [F.max(s.ingest_ts).alias(LAST_ARRIVAL)] if last_arrival else []
    first = staged.groupBy(s.change_id).agg(F.min(packed).alias("_first"), *latest)
    return first.select(*[F.col(s.change_id) if c == s.change_id else F.col(f"_first.{c}").alias(c)
                          for c in s.staged_columns], *([LAST_ARRIVAL] if last_arrival else []))


def sequence_changes(changes: DataFrame, spec: ChangeLogSpec = DEFAULT_SPEC,
                     hot_source: DataFrame | None = None) -> DataFrame:
    """Order every entity's mutations by (source time, change_id) and flag ambiguous ties.

    Adds ``change_seq`` (bigint), the next mutation's time / id / operation, the number of mutations
    sharing the source instant and ``is_ambiguous_tie``: more than one mutation at that instant and
    some attribute differing among them (``<>`` on peer min/max, so NULL vs value is no conflict, S5).
    ``hot_source`` (e.g. the staged log) may stand in for ``changes`` when counting rows per entity.
    """
    s = spec
    peers = {"same_timestamp_change_count": F.count(F.lit(1))}
    pairs = []
    for i, a in enumerate(s.attributes):
        v = F.col(a).cast("int") if dict(changes.dtypes)[a] == "boolean" else F.col(a)
        peers |= {f"_pmin{i}": F.min(v), f"_pmax{i}": F.max(v)}
        pairs.append((F.col(f"_pmin{i}"), F.col(f"_pmax{i}")))
    out = chunked_lead(
        changes, [s.entity], [s.source_ts, s.change_id],
        {"ts": F.col(s.source_ts), "id": F.col(s.change_id), "op": F.col(s.operation)},
        "_next", row_number="change_seq", peers=peers,
        hot_source=None if hot_source is None else hot_source.select(s.entity, s.source_ts, s.change_id),
    )
    return out.select(
        *[F.col(c) for c in s.staged_columns],
        F.col("change_seq"),
        F.col("_next.ts").alias("next_source_updated_at"),
        F.col("_next.id").alias("next_change_id"),
        F.col("_next.op").alias("next_operation"),
        F.col("same_timestamp_change_count"),
        ((F.col("same_timestamp_change_count") > 1) & any_differs(pairs)).alias("is_ambiguous_tie"),
    )


def duplicate_deliveries(staged: DataFrame, spec: ChangeLogSpec = DEFAULT_SPEC) -> DataFrame:
    """Mutations delivered more than once: ``change_id``, delivery count, first and last arrival."""
    s = spec
    return (staged.groupBy(s.change_id)
            .agg(F.count(F.lit(1)).alias("deliveries"),
                 F.min(s.ingest_ts).alias("first_ingested_at"),
                 F.max(s.ingest_ts).alias("last_ingested_at"))
            .where(F.col("deliveries") > 1))


def noop_changes(changes: DataFrame, spec: ChangeLogSpec = DEFAULT_SPEC,
                 hot_source: DataFrame | None = None) -> DataFrame:
    """Non-DELETE mutations whose attributes all equal those of the entity's previous mutation.

    The previous mutation must not be a DELETE either: the version this change opens then repeats the
    values of the version it closes. These are legitimate changes (never merged, S8) that carry no new
    value; a duplicate *delivery* shares the change_id instead (see :func:`duplicate_deliveries`).
    """
    s = spec
    prev = chunked_lead(changes.select(s.change_id, s.entity, s.operation, s.source_ts, *s.attributes),
                        [s.entity], [s.source_ts, s.change_id],
                        {"id": F.col(s.change_id), "op": F.col(s.operation),
                         **{f"a{i}": F.col(a) for i, a in enumerate(s.attributes)}},
                        "_prev", descending=True,
                        hot_source=None if hot_source is None else hot_source.select(s.entity, s.source_ts, s.change_id))
    same = (F.col(s.operation) != F.lit(s.delete_value)) & (F.col("_prev.op") != F.lit(s.delete_value))
    for i, a in enumerate(s.attributes):
        same = same & F.col(a).eqNullSafe(F.col(f"_prev.a{i}"))
    return prev.where(F.col("_prev").isNotNull() & same).select(
        F.col(s.change_id), F.col(s.entity), F.col(s.source_ts),
        F.col("_prev.id").alias("previous_change_id"))


def arrival_anomalies(changes: DataFrame, spec: ChangeLogSpec = DEFAULT_SPEC,
                      hot_source: DataFrame | None = None) -> DataFrame:
    """Mutations that arrive after a mutation of the same entity with a *later* source time.

    Arrival order is (ingest time, change_id); the running max of source time over everything that
    arrived earlier exceeds the row's own source time. ``arrival_lag_seconds`` is ingest minus source
    time, the plain lateness of the delivery.
    """
    s = spec
    run = chunked_running(changes.select(s.change_id, s.entity, s.source_ts, s.ingest_ts), [s.entity], [s.ingest_ts, s.change_id], F.col(s.source_ts),
                          "max_prior_source_updated_at", "max",
                          hot_source=None if hot_source is None else hot_source.select(s.entity, s.ingest_ts, s.change_id))
    lag = F.expr(f"timestampdiff(SECOND, `{s.source_ts}`, `{s.ingest_ts}`)")
    return run.where(F.col("max_prior_source_updated_at") > F.col(s.source_ts)).select(
        F.col(s.change_id), F.col(s.entity), F.col(s.source_ts), F.col(s.ingest_ts),
        F.col("max_prior_source_updated_at"), lag.cast("long").alias("arrival_lag_seconds"))


def shared_change_ids(staged: DataFrame, spec: ChangeLogSpec = DEFAULT_SPEC) -> DataFrame:
    """change_ids seen on more than one entity (breaks the entity-scoped repair contract, S2)."""
    s = spec
    return (staged.groupBy(s.change_id).agg(F.countDistinct(s.entity).alias("entities"))
            .where(F.col("entities") > 1))


def unstable_change_ids(staged: DataFrame, spec: ChangeLogSpec = DEFAULT_SPEC) -> DataFrame:
    """change_ids whose deliveries disagree on entity or source time (the tail-repair contract)."""
    s = spec
    return (staged.groupBy(s.change_id)
            .agg(F.countDistinct(s.entity).alias("entities"), F.countDistinct(s.source_ts).alias("source_times"))
            .where((F.col("entities") > 1) | (F.col("source_times") > 1)))

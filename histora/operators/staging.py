"""Staging: type the raw deliveries, keep every one of them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histora.functions.exprs import received_id
from histora.spec import DEFAULT_EVENTS, DEFAULT_SPEC, ChangeLogSpec, EventSpec


def _cutoff_literal(cutoff: str | datetime) -> F.Column:
    text = cutoff.strftime("%Y-%m-%d %H:%M:%S.%f") if isinstance(cutoff, datetime) else str(cutoff)
    return F.lit(text).cast("timestamp_ntz")


def stage_changes(raw: DataFrame, spec: ChangeLogSpec = DEFAULT_SPEC,
                  ingest_cutoff: str | datetime | None = None) -> DataFrame:
    """One row per *received* delivery, typed, with an upper-cased operation and a delivery key.

    ``ingest_cutoff`` (inclusive) simulates what had arrived by then; it never filters on source time,
    which would hide exactly the late mutations. An empty or ``None`` cutoff means no filter.
    """
    s = spec
    cols = []
    for c in s.log_columns:
        if c == s.operation:
            cols.append(F.upper(F.col(c)).alias(c))
        elif c in (s.source_ts, s.ingest_ts):
            cols.append(F.col(c).cast("timestamp_ntz").alias(c))
        else:
            cols.append(F.col(c))
    staged = raw.select(*cols, received_id(s.change_id, s.entity, s.ingest_ts, s.source_ts).alias(s.received_id))
    if ingest_cutoff not in (None, ""):
        staged = staged.where(F.col(s.ingest_ts) <= _cutoff_literal(ingest_cutoff))
    return staged


def stage_events(raw: DataFrame, events: EventSpec = DEFAULT_EVENTS) -> DataFrame:
    """Typed pass-through of the activity events."""
    e = events
    return raw.select(F.col(e.event_id), F.col(e.entity), F.col(e.event_name),
                      F.col(e.event_ts).cast("timestamp_ntz").alias(e.event_ts))

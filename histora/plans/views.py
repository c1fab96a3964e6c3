"""A3: expose every layer as a Spark SQL temporary view, so the models can also be queried with SQL.

``register_views`` builds the DataFrames once and registers them. With the ``auto`` strategy the history behind
the serving view is written when the views are registered, and large inputs are measured for hot entities on
the staged log; nothing else is computed until a query runs, and Catalyst optimises SQL over the views exactly
like the DataFrame calls (filters on the serving view reach the Parquet scans, unused columns are pruned).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from histora.operators.changes import deduplicate_changes, sequence_changes
from histora.operators.pit import point_in_time_join
from histora.operators.scd2 import build_scd2
from histora.operators.staging import stage_changes, stage_events
from histora.spec import DEFAULT_EVENTS, DEFAULT_SPEC, ChangeLogSpec, EventSpec

VIEW_NAMES = ("stg_changes", "stg_events", "changes_deduplicated", "change_sequence", "dimension_scd2",
              "fact_events", "events_enriched")


def register_views(spark: SparkSession, raw_log: DataFrame, raw_events: DataFrame,
                   spec: ChangeLogSpec = DEFAULT_SPEC, events: EventSpec = DEFAULT_EVENTS,
                   ingest_cutoff=None, order: str = "source", pit_strategy: str = "auto",
                   prefix: str = "") -> dict[str, DataFrame]:
    staged = stage_changes(raw_log, spec, ingest_cutoff)
    facts = stage_events(raw_events, events)
    changes = deduplicate_changes(staged, spec)
    dim = build_scd2(deduplicate_changes(staged, spec, last_arrival=True), staged, spec, order=order)
    frames = {
        "stg_changes": staged,
        "stg_events": facts,
        "changes_deduplicated": changes,
        "change_sequence": sequence_changes(changes, spec, hot_source=staged),
        "dimension_scd2": dim,
        "fact_events": facts,
        "events_enriched": point_in_time_join(facts, dim, spec, events, strategy=pit_strategy),
    }
    for name, df in frames.items():
        df.createOrReplaceTempView(prefix + name)
    return frames

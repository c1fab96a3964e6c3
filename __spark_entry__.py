"""

Every query reads ``events`` of the given scale directory and derives the change log and the facts
from it (FIXTURES.md section 4): each event gives a customer mutation and an activity event. The oracles repeat that derivation as CTEs, then state each operator in plain SQL.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from histora.operators import (  # noqa: E402
    accepted_values_violations, affected_entities, affected_entities_stored, append_facts, append_stored, arrival_anomalies, build_scd2,
    current_record_violations, current_state, deduplicate_changes, duplicate_deliveries, entity_watermarks,
    high_water, history, interval_order_violations, missing_scenarios, noop_changes, not_null_violations,
    overlap_counts, overlap_violations, point_in_time_join, repair_scd2_tail, repair_stored, sequence_changes, shared_change_ids,
    stage_changes, stage_events, table_diff, table_diff_by_bucket, unique_violations, unstable_change_ids,
)
from histora.operators.quality import declared_check_list, dimension_checks, validate  # noqa: E402
from histora.plans.layers import store_layers, validate_layers  # noqa: E402
from histora.plans.views import register_views  # noqa: E402
from histora.session import work_path  # noqa: E402
from histora.sources import derived_change_log, derived_facts, read_change_log, read_events, scenario_catalog  # noqa: E402
from histora.sources.bucketed import read_bucketed, save_bucketed  # noqa: E402
from histora.sources.derived import SCENARIO_CATALOG  # noqa: E402
from histora.sources.stored import PART, daily_table, keyed_table  # noqa: E402
from histora.streaming import RepairStreamTables, start_repair_stream  # noqa: E402

try:   # the operators for training data may be absent; this is the only place that tolerates it
    from histora.llm.queries import llm_oracle_sql, llm_queries
except ImportError:
    llm_oracle_sql = llm_queries = dict
try:
    import corpus_pipeline
except ImportError:
    corpus_pipeline = None

# Fixed parameters of the benchmark queries.
T1_CUTOFF = "2024-01-15 00:00:00"       # first arrival batch (inclusive ingest cutoff)
T2_CUTOFF = "2024-01-15 06:00:00"       # small second batch
FACT_BATCH1_BEFORE = "2024-01-20 00:00:00"
HISTORY_ENTITY = 7
BUCKETS = 16                            # of the stored dimension; for a large one, 128 MB to 1 GB a bucket
ACCEPTED_OPERATIONS = ("INSERT", "UPDATE", "DELETE")
CANONICAL = ["customer_id", "country_code", "subscription_tier", "account_status", "email_verified",
             "valid_from", "valid_to", "row_current", "source_change_id"]

SF0001 = "/root/testdata/sf0.001"


# --------------------------------------------------------------------------------------------------
# Spark side
# --------------------------------------------------------------------------------------------------
def _staged(spark, sf, cutoff=None):
    return stage_changes(derived_change_log(spark, sf), ingest_cutoff=cutoff)


def _dim(spark, sf, cutoff=None, order="source"):
    staged = _staged(spark, sf, cutoff)
    return build_scd2(deduplicate_changes(staged, last_arrival=True), staged, order=order)


def _facts(spark, sf):
    return stage_events(derived_facts(spark, sf))


def q_stage_changes(spark, sf):
    return _staged(spark, sf)


def q_stage_changes_cutoff(spark, sf):
    return _staged(spark, sf, T1_CUTOFF)


def q_stage_events(spark, sf):
    return _facts(spark, sf)


def q_deduplicate_changes(spark, sf):
    return deduplicate_changes(_staged(spark, sf))


def q_sequence_changes(spark, sf):
    staged = _staged(spark, sf)
    return sequence_changes(deduplicate_changes(staged), hot_source=staged)


def q_scd2_full(spark, sf):
    return _dim(spark, sf)


def q_scd2_ingest_order(spark, sf):
    return _dim(spark, sf, order="ingest")


def q_scd2_after_cutoff(spark, sf):
    return _dim(spark, sf, T1_CUTOFF)


def q_entity_watermarks(spark, sf):
    return entity_watermarks(_staged(spark, sf))


def q_high_water(spark, sf):
    return high_water(_dim(spark, sf))


def q_affected_entities(spark, sf):
    return affected_entities(_staged(spark, sf, T2_CUTOFF), _dim(spark, sf, T1_CUTOFF))


def q_affected_entities_stored(spark, sf):
    """The same over a staged log stored by arrival day: only the days from the mark on are read."""
    log = daily_table(work_path(spark, "staged"), "ingested_at")
    log.write(_staged(spark, sf, T2_CUTOFF))
    return affected_entities_stored(log, _dim(spark, sf, T1_CUTOFF))


def q_scd2_incremental(spark, sf):
    """T1 table stored by entity bucket, then two keyed repairs (small batch, then everything) of the stored table."""
    table = keyed_table(work_path(spark, "scd2_incremental"), "customer_id", BUCKETS)
    table.write(_dim(spark, sf, T1_CUTOFF))
    for step, cutoff in (("t2", T2_CUTOFF), ("all", None)):
        repair_stored(table, _staged(spark, sf, cutoff), step)
    return table.read(spark).drop(PART)


def q_scd2_incremental_tail(spark, sf):
    """T1 table, then the bounded repair that rebuilds only the tails of the affected histories."""
    return repair_scd2_tail(_dim(spark, sf, T1_CUTOFF), _staged(spark, sf))


def q_scd2_stream_repair(spark, sf):
    """The log lands as three arrival batches; a streaming foreachBatch repair keeps the table current."""
    base = work_path(spark, "scd2_stream")
    landing = f"{base}/landing"
    log = derived_change_log(spark, sf)
    ing = F.col("ingested_at")
    cuts = [ing <= F.lit(T1_CUTOFF).cast("timestamp_ntz"),
            (ing > F.lit(T1_CUTOFF).cast("timestamp_ntz")) & (ing <= F.lit(T2_CUTOFF).cast("timestamp_ntz")),
            ing > F.lit(T2_CUTOFF).cast("timestamp_ntz")]
    tables = RepairStreamTables(log_path=f"{base}/log", dim_path=f"{base}/dim", buckets=BUCKETS)
    for i, cond in enumerate(cuts):      # one start an arrival, so that an arrival is a micro-batch of all its files
        log.where(cond).write.mode("errorifexists").parquet(f"{landing}/arrival={i}")
        q = start_repair_stream(spark, f"{landing}/*", tables, f"{base}/_checkpoint", schema=log.schema)
        q.awaitTermination()
    if not all(tables.dim.done(spark, f"batch-{i}") for i in range(len(cuts))):
        raise RuntimeError("the stream did not repair the table once an arrival")
    return tables.read_dim(spark)


def _fact_batch1(spark, sf):
    f = _facts(spark, sf)
    return f.where((F.col("event_timestamp") < F.lit(FACT_BATCH1_BEFORE).cast("timestamp_ntz"))
                   & (F.col("event_id") % 10 != 1))


def q_facts_full(spark, sf):
    return _facts(spark, sf)


def q_facts_event_time_append(spark, sf):
    return append_facts(_fact_batch1(spark, sf), _facts(spark, sf), mode="event_time")


def q_facts_by_id_append(spark, sf):
    return append_facts(_fact_batch1(spark, sf), _facts(spark, sf), mode="by_id")


def q_facts_stored_append(spark, sf):
    """A stored fact table, by day of the event: a first batch, then two keyed appends to the days that they touch."""
    table = daily_table(work_path(spark, "facts"), "event_timestamp")
    table.write(_fact_batch1(spark, sf))
    facts = _facts(spark, sf)
    append_stored(table, facts.where(F.col("event_id") % 3 == 0), "third")
    append_stored(table, facts, "all", ids_keep_their_day=False)
    return table.read(spark).drop(PART)


def q_pit_range(spark, sf):
    return point_in_time_join(_facts(spark, sf), _dim(spark, sf), strategy="range")


def q_pit_asof(spark, sf):
    return point_in_time_join(_facts(spark, sf), _dim(spark, sf), strategy="asof")


def q_pit_auto(spark, sf):
    return point_in_time_join(_facts(spark, sf), _dim(spark, sf), strategy="auto")


def q_pit_ingest_order_auto(spark, sf):
    """PIT over the defective ingest-order history: overlapping entities must take the range join."""
    return point_in_time_join(_facts(spark, sf), _dim(spark, sf, order="ingest"), strategy="auto")


def q_pit_ingest_order_bucketed(spark, sf):
    """Bucketed range join over the overlapping ingest-order history (several matches per event)."""
    return point_in_time_join(_facts(spark, sf), _dim(spark, sf, order="ingest"), strategy="range_bucketed")


def q_current_state(spark, sf):
    return current_state(_dim(spark, sf))


def q_entity_history(spark, sf):
    """One entity's history: the log is cut to the entity before it is deduplicated (change ids stay on one entity)."""
    staged = _staged(spark, sf).where(F.col("customer_id") == HISTORY_ENTITY)
    return history(build_scd2(deduplicate_changes(staged), staged), HISTORY_ENTITY)


def q_entity_history_stored(spark, sf):
    """One entity's history from the whole dimension stored in Spark's buckets: one bucket is read."""
    name = f"dim_{uuid.uuid4().hex}"
    save_bucketed(_dim(spark, sf), name, "customer_id", BUCKETS, work_path(spark, "dim"), ["customer_id", "valid_from"])
    return history(read_bucketed(spark, name), HISTORY_ENTITY)


def q_overlap_violations(spark, sf):
    return overlap_violations(_dim(spark, sf, order="ingest"), "customer_id", "valid_from", "valid_to")


def q_overlap_counts(spark, sf):
    """The same overlaps as one row a window with the number of its partners."""
    return overlap_counts(_dim(spark, sf, order="ingest"), "customer_id", "valid_from", "valid_to")


def q_current_record_violations(spark, sf):
    dim = _dim(spark, sf)
    corrupted = dim.withColumn("row_current", F.when(F.col("source_change_id").endswith("4"),
                                                     ~F.col("row_current")).otherwise(F.col("row_current")))
    return current_record_violations(corrupted, "customer_id", "row_current", "valid_to")


def q_validate_dimension(spark, sf):
    """The declared tests of the dimension, run as one job over the defective ingest-order build."""
    return validate(dimension_checks(_dim(spark, sf, order="ingest")))


def q_validate_all_layers(spark, sf):
    """Every declared not-null / unique / accepted-values / temporal test of every layer, each layer computed once."""
    return validate_layers(store_layers(spark, derived_change_log(spark, sf), derived_facts(spark, sf)))


def q_interval_order_violations(spark, sf):
    return interval_order_violations(_dim(spark, sf, order="ingest"))


def q_not_null_violations(spark, sf):
    return not_null_violations(_dim(spark, sf), ["valid_to"], keep=["customer_version_id"])


def q_unique_violations(spark, sf):
    return unique_violations(_staged(spark, sf), "change_id")


def q_accepted_values_violations(spark, sf):
    return accepted_values_violations(derived_change_log(spark, sf), "operation", ACCEPTED_OPERATIONS)


def q_table_diff(spark, sf):
    return table_diff(_dim(spark, sf, T1_CUTOFF), _dim(spark, sf), CANONICAL)


def q_table_diff_by_bucket(spark, sf):
    """The same differences, sought only in buckets whose fingerprints differ."""
    return table_diff_by_bucket(_dim(spark, sf, T1_CUTOFF), _dim(spark, sf), CANONICAL, "customer_id")


def q_missing_scenarios(spark, sf):
    return missing_scenarios(scenario_catalog(spark), derived_change_log(spark, sf))


def q_missing_scenarios_by_entity(spark, sf):
    """Every entity is expected to have each tag of the catalogue."""
    log = derived_change_log(spark, sf)
    wanted = log.select("customer_id").distinct().select(
        "customer_id", F.explode(F.array(*[F.lit(t) for t in SCENARIO_CATALOG])).alias("tag"))
    return missing_scenarios(wanted, log, entity_column="customer_id").select("customer_id", "tag")


def q_stage_from_csv(spark, sf):
    """The log written as CSV text, read back by the typed scan and staged."""
    path = work_path(spark, "log-csv")
    log = derived_change_log(spark, sf)
    times = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in ("ingested_at", "source_updated_at")}
    log.withColumns(times).write.option("header", True).csv(path)
    return stage_changes(read_change_log(spark, path))


def q_facts_from_csv(spark, sf):
    path = work_path(spark, "events-csv")
    text = F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    derived_facts(spark, sf).withColumn("event_timestamp", text).write.option("header", True).csv(path)
    return stage_events(read_events(spark, path))


def q_serving_view(spark, sf):
    """Every layer as a SQL view, the enriched serving view read by name."""
    register_views(spark, derived_change_log(spark, sf), derived_facts(spark, sf))
    return spark.sql("SELECT * FROM events_enriched")


def q_scd2_closing_operation(spark, sf):
    """The operation that closed each version: a DELETE, or the change that followed."""
    staged = _staged(spark, sf)
    dim = build_scd2(deduplicate_changes(staged, last_arrival=True), staged, with_closing_operation=True)
    return dim.select("customer_version_id", "valid_from", "valid_to", "closed_by_operation")


def q_shared_change_ids(spark, sf):
    """The contract of the repair (S2), on a log whose change ids are cut to collide across entities."""
    return shared_change_ids(_staged(spark, sf).withColumn("change_id", F.substring("change_id", 1, 12)))


def q_unstable_change_ids(spark, sf):
    """The contract of the tail repair, on the same log."""
    return unstable_change_ids(_staged(spark, sf).withColumn("change_id", F.substring("change_id", 1, 12)))


def q_duplicate_deliveries(spark, sf):
    return duplicate_deliveries(_staged(spark, sf))


def q_noop_changes(spark, sf):
    staged = _staged(spark, sf)
    return noop_changes(deduplicate_changes(staged), hot_source=staged)


def q_arrival_anomalies(spark, sf):
    staged = _staged(spark, sf)
    return arrival_anomalies(deduplicate_changes(staged), hot_source=staged)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stage_changes": q_stage_changes,
    "stage_changes_cutoff": q_stage_changes_cutoff,
    "stage_events": q_stage_events,
    "deduplicate_changes": q_deduplicate_changes,
    "sequence_changes": q_sequence_changes,
    "scd2_full": q_scd2_full,
    "scd2_ingest_order": q_scd2_ingest_order,
    "scd2_after_cutoff": q_scd2_after_cutoff,
    "entity_watermarks": q_entity_watermarks,
    "high_water": q_high_water,
    "affected_entities": q_affected_entities,
    "affected_entities_stored": q_affected_entities_stored,
    "scd2_incremental": q_scd2_incremental,
    "scd2_incremental_tail": q_scd2_incremental_tail,
    "scd2_stream_repair": q_scd2_stream_repair,
    "facts_full": q_facts_full,
    "facts_event_time_append": q_facts_event_time_append,
    "facts_by_id_append": q_facts_by_id_append,
    "facts_stored_append": q_facts_stored_append,
    "pit_range": q_pit_range,
    "pit_asof": q_pit_asof,
    "pit_auto": q_pit_auto,
    "pit_ingest_order_auto": q_pit_ingest_order_auto,
    "pit_ingest_order_bucketed": q_pit_ingest_order_bucketed,
    "current_state": q_current_state,
    "entity_history": q_entity_history,
    "entity_history_stored": q_entity_history_stored,
    "overlap_violations": q_overlap_violations,
    "overlap_counts": q_overlap_counts,
    "current_record_violations": q_current_record_violations,
    "interval_order_violations": q_interval_order_violations,
    "validate_dimension": q_validate_dimension,
    "validate_all_layers": q_validate_all_layers,
    "not_null_violations": q_not_null_violations,
    "unique_violations": q_unique_violations,
    "accepted_values_violations": q_accepted_values_violations,
    "table_diff": q_table_diff,
    "table_diff_by_bucket": q_table_diff_by_bucket,
    "missing_scenarios": q_missing_scenarios,
    "missing_scenarios_by_entity": q_missing_scenarios_by_entity,
    "stage_from_csv": q_stage_from_csv,
    "facts_from_csv": q_facts_from_csv,
    "serving_view": q_serving_view,
    "scd2_closing_operation": q_scd2_closing_operation,
    "shared_change_ids": q_shared_change_ids,
    "unstable_change_ids": q_unstable_change_ids,
    "duplicate_deliveries": q_duplicate_deliveries,
    "noop_changes": q_noop_changes,
    "arrival_anomalies": q_arrival_anomalies,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: stage -> dedup -> SCD2 -> point-in-time enrichment on sf0.001."""
    return q_pit_range(spark, SF0001)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {**_QUERIES, **llm_queries()}
    if corpus_pipeline is not None:
        out["pipeline"] = corpus_pipeline.run
    return out


# --------------------------------------------------------------------------------------------------
# DuckDB oracles
# --------------------------------------------------------------------------------------------------
_RAW = """
raw AS (
    SELECT 'chg_' || lpad(CAST(event_id AS VARCHAR), 10, '0') AS change_id,
           CAST(user_id AS INTEGER) AS customer_id,
           CASE WHEN event_id % 40 = 8 THEN 'delete' ELSE 'update' END AS operation,
           CASE event_id % 16 WHEN 0 THEN 'US' WHEN 2 THEN 'CA' WHEN 4 THEN 'GB' WHEN 6 THEN 'DE'
                WHEN 8 THEN 'FR' WHEN 10 THEN 'AU' WHEN 12 THEN 'JP' ELSE 'BR' END AS country_code,
           CASE event_id % 3 WHEN 0 THEN 'free' WHEN 1 THEN 'plus' ELSE 'premium' END AS subscription_tier,
           event_type AS account_status,
           value > 10.0 AS email_verified,
           CAST(date_trunc('hour', ts) AS TIMESTAMP) AS source_updated_at,
           CASE WHEN event_id % 14 = 0 THEN ts + INTERVAL 5 DAY ELSE ts + INTERVAL 1 MINUTE END AS ingested_at,
           event_type AS scenario_tag
    FROM events
),
log AS (
    SELECT * FROM raw
    UNION ALL
    SELECT change_id, customer_id, operation, country_code, subscription_tier, account_status, email_verified,
           source_updated_at, ingested_at + INTERVAL 30 SECOND AS ingested_at, scenario_tag
    FROM raw
    WHERE change_id LIKE '%0'
),
facts AS (
    SELECT event_id, CAST(user_id AS INTEGER) AS customer_id, event_type AS event_name, ts AS event_timestamp
    FROM events
)"""

_LOG_COLS = ("change_id, customer_id, operation, country_code, subscription_tier, account_status, "
             "email_verified, source_updated_at, ingested_at, scenario_tag")


def _sql_staged(name: str, cutoff: str | None = None) -> str:
    where = f"WHERE ingested_at <= TIMESTAMP '{cutoff}'" if cutoff else ""
    return f"""
{name} AS (
    SELECT change_id, customer_id, upper(operation) AS operation, country_code, subscription_tier,
           account_status, email_verified, source_updated_at, ingested_at, scenario_tag,
           md5(concat_ws('|', change_id, CAST(customer_id AS VARCHAR), CAST(ingested_at AS VARCHAR),
                         CAST(source_updated_at AS VARCHAR))) AS received_id
    FROM log
    {where}
)"""


def _sql_dedup(name: str, staged: str) -> str:
    return f"""
{name} AS (
    SELECT {_LOG_COLS}, received_id
    FROM (SELECT *, row_number() OVER (PARTITION BY change_id ORDER BY ingested_at, received_id) AS rn
          FROM {staged})
    WHERE rn = 1
)"""


def _sql_dim(name: str, changes: str, staged: str, order: str = "source") -> str:
    order_by = "source_updated_at, change_id" if order == "source" else "ingested_at, change_id"
    emit = "AND (next_ts IS NULL OR source_updated_at < next_ts)" if order == "source" else ""
    return f"""
{name}_seq AS (
    SELECT *, lead(source_updated_at) OVER (PARTITION BY customer_id ORDER BY {order_by}) AS next_ts
    FROM {changes}
),
{name}_ver AS (
    SELECT CAST(customer_id AS VARCHAR) || '-' || change_id AS customer_version_id, customer_id,
           country_code, subscription_tier, account_status, email_verified,
           source_updated_at AS valid_from, next_ts AS valid_to, change_id AS source_change_id
    FROM {name}_seq
    WHERE operation <> 'DELETE' {emit}
),
{name}_wm AS (
    SELECT customer_id, max(ingested_at) AS last_seen_ingested_at FROM {staged} GROUP BY customer_id
),
{name} AS (
    SELECT v.customer_version_id, v.customer_id, v.country_code, v.subscription_tier, v.account_status,
           v.email_verified, v.valid_from, v.valid_to, v.valid_to IS NULL AS row_current,
           v.source_change_id, w.last_seen_ingested_at
    FROM {name}_ver v JOIN {name}_wm w ON v.customer_id = w.customer_id
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join((_RAW, *ctes))


def _full_dim_ctes(order: str = "source", cutoff: str | None = None, name: str = "dim") -> tuple[str, ...]:
    return (_sql_staged(f"{name}_staged", cutoff), _sql_dedup(f"{name}_changes", f"{name}_staged"),
            _sql_dim(name, f"{name}_changes", f"{name}_staged", order))


_DIM_COLS = ("customer_version_id, customer_id, country_code, subscription_tier, account_status, "
             "email_verified, valid_from, valid_to, row_current, source_change_id, last_seen_ingested_at")

_PIT = """
SELECT f.event_id, f.customer_id, f.event_name, f.event_timestamp,
       d.customer_version_id, d.country_code, d.subscription_tier, d.account_status, d.email_verified,
       d.valid_from AS customer_valid_from, d.valid_to AS customer_valid_to,
       d.row_current AS customer_row_current, d.source_change_id,
       d.customer_version_id IS NOT NULL AS matched_historical_state
FROM facts f
LEFT JOIN dim d
  ON f.customer_id = d.customer_id
 AND f.event_timestamp >= d.valid_from
 AND (f.event_timestamp < d.valid_to OR d.valid_to IS NULL)"""

# A window is [start, stop) with an open stop far in the future. Two different windows of an entity share
# time unless one stops before the other starts; every window reports each such other window once.
# An entity's forward windows as two sorted lists, its backward ones as a list of bounds. A forward window misses the
# forward windows that start at or after its end and those that end at or before its start, two sets without a common
# member; it holds the backward windows that lie inside.
_PARTNERS = """
windows AS (
    SELECT entity_id, valid_from AS f, valid_to AS t, coalesce(valid_to, TIMESTAMP '9999-12-31') AS e, count(*) AS copies
    FROM base WHERE entity_id IS NOT NULL AND valid_from IS NOT NULL GROUP BY ALL
),
lists AS (
    SELECT entity_id, list(f ORDER BY f) FILTER (f < e) AS starts, list(e ORDER BY e) FILTER (f < e) AS ends,
           list({'f': f, 'e': e}) FILTER (f < e) AS forward, list({'f': f, 'e': e}) FILTER (f >= e) AS backward
    FROM base, LATERAL (SELECT valid_from AS f, coalesce(valid_to, TIMESTAMP '9999-12-31') AS e)
    WHERE f IS NOT NULL GROUP BY entity_id
),
partners AS (
    SELECT w.entity_id, f AS valid_from, t AS valid_to, copies,
           CASE WHEN f < e
                THEN len(starts) - len(list_filter(starts, lambda x: x >= e)) - len(list_filter(ends, lambda x: x <= f))
                     - copies + coalesce(len(list_filter(backward, lambda x: x.e > f AND x.f < e)), 0)
                ELSE coalesce(len(list_filter(forward, lambda x: x.f < e AND x.e > f)), 0) END AS n_overlaps
    FROM windows w JOIN lists USING (entity_id)
)"""
_OVERLAP = """
SELECT entity_id, valid_from, valid_to, 'inverted_or_zero_width' AS failure_kind FROM base WHERE valid_to <= valid_from
UNION ALL
SELECT entity_id, valid_from, valid_to, 'overlap' AS failure_kind
FROM partners, LATERAL (SELECT unnest(range(copies * n_overlaps)))"""

_CANON = ", ".join(CANONICAL)


def _facts_batch1() -> str:
    return f"""
batch1 AS (
    SELECT * FROM facts
    WHERE event_timestamp < TIMESTAMP '{FACT_BATCH1_BEFORE}' AND event_id % 10 <> 1
)"""


def _append_sql(new_filter: str) -> str:
    return _with(_facts_batch1(), f"""
new_rows AS (SELECT * FROM facts {new_filter})""") + """
SELECT * FROM batch1 b WHERE NOT EXISTS (SELECT 1 FROM new_rows n WHERE n.event_id = b.event_id)
UNION ALL
SELECT * FROM new_rows"""


def _sql_declared_checks() -> str:
    views = {"staging": "staged", "events": "facts", "changes": "changes", "sequence": "sequenced",
             "dimension": "dim", "facts": "facts", "serving": "enriched"}
    parts = []
    for name, layer, kind, col in declared_check_list():
        v = views[layer]
        if kind == "not_null":
            q = f"SELECT count(*) FROM {v} WHERE {col} IS NULL"
        elif kind == "unique":
            q = (f"SELECT count(*) FROM (SELECT {col} FROM {v} WHERE {col} IS NOT NULL "
                 f"GROUP BY {col} HAVING count(*) > 1) u")
        elif kind == "accepted_values":
            q = (f"SELECT count(*) FROM (SELECT {col} FROM {v} GROUP BY {col}) a "
                 f"WHERE {col} NOT IN ('INSERT', 'UPDATE', 'DELETE')")
        elif kind == "no_overlapping_validity_windows":
            q = "SELECT count(*) FROM overlap"
        elif kind == "exactly_one_current_record":
            q = "SELECT count(*) FROM per_entity WHERE current_rows <> least(open_rows, 1)"
        else:
            q = "SELECT count(*) FROM dim WHERE valid_to IS NOT NULL AND valid_from >= valid_to"
        parts.append(f"SELECT '{name}' AS check_name, ({q}) AS violations")
    return "\nUNION ALL\n".join(parts)


#: Queries that reach a result by another plan than the one whose oracle they share.
_SAME_RESULT = {"affected_entities_stored": "affected_entities", "entity_history_stored": "entity_history",
                "table_diff_by_bucket": "table_diff"}


def oracle_sql() -> dict[str, str]:
    out = {**_core_oracles(), **llm_oracle_sql()}
    for stored, plain in _SAME_RESULT.items():
        out[stored] = out[plain]
    if corpus_pipeline is not None and corpus_pipeline.ORACLE_SQL:
        out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out


def _core_oracles() -> dict[str, str]:
    full = _full_dim_ctes()
    dim_select = f"SELECT {_DIM_COLS} FROM dim"
    seq = _with(_sql_staged("staged"), _sql_dedup("changes", "staged"), """
peers AS (
    SELECT customer_id, source_updated_at, count(*) AS n,
           greatest(count(DISTINCT country_code), count(DISTINCT subscription_tier), count(DISTINCT account_status),
                    count(DISTINCT email_verified)) > 1 AS conflict
    FROM changes GROUP BY ALL
),
sequenced AS (
    SELECT changes.*,
           row_number() OVER w AS change_seq,
           lead(source_updated_at) OVER w AS next_source_updated_at,
           lead(change_id) OVER w AS next_change_id,
           lead(operation) OVER w AS next_operation,
           peers.n AS same_timestamp_change_count, peers.conflict
    FROM changes JOIN peers USING (customer_id, source_updated_at)
    WINDOW w AS (PARTITION BY customer_id ORDER BY source_updated_at, change_id)
)""") + f"""
SELECT {_LOG_COLS}, received_id, CAST(change_seq AS BIGINT) AS change_seq, next_source_updated_at,
       next_change_id, next_operation, CAST(same_timestamp_change_count AS BIGINT) AS same_timestamp_change_count,
       conflict AS is_ambiguous_tie
FROM sequenced"""
    return {
        "stage_changes": _with(_sql_staged("staged")) + "\nSELECT * FROM staged",
        "stage_changes_cutoff": _with(_sql_staged("staged", T1_CUTOFF)) + "\nSELECT * FROM staged",
        "stage_events": _with() + "\nSELECT * FROM facts",
        "stage_from_csv": _with(_sql_staged("staged")) + """
SELECT * REPLACE (CAST(source_updated_at AS TIMESTAMP) AS source_updated_at) FROM staged""",
        "facts_from_csv": _with() + """
SELECT CAST(event_id AS VARCHAR) AS event_id, customer_id, event_name, event_timestamp FROM facts""",
        "deduplicate_changes": _with(_sql_staged("staged"), _sql_dedup("changes", "staged"))
        + "\nSELECT * FROM changes",
        "sequence_changes": seq,
        "scd2_full": _with(*full) + "\n" + dim_select,
        "scd2_ingest_order": _with(*_full_dim_ctes("ingest")) + "\n" + dim_select,
        "scd2_after_cutoff": _with(*_full_dim_ctes(cutoff=T1_CUTOFF)) + "\n" + dim_select,
        "entity_watermarks": _with(_sql_staged("staged"))
        + "\nSELECT customer_id, max(ingested_at) AS last_seen_ingested_at FROM staged GROUP BY customer_id",
        "high_water": _with(*full)
        + "\nSELECT coalesce(max(last_seen_ingested_at), TIMESTAMP '1970-01-01 00:00:00') AS high_water FROM dim",
        "affected_entities": _with(*_full_dim_ctes(cutoff=T1_CUTOFF, name="dim_t1"),
                                   _sql_staged("staged_t2", T2_CUTOFF)) + """
SELECT DISTINCT customer_id FROM staged_t2
WHERE ingested_at > (SELECT coalesce(max(last_seen_ingested_at), TIMESTAMP '1970-01-01 00:00:00') FROM dim_t1)""",
        "scd2_incremental": _with(*full) + "\n" + dim_select,
        "scd2_incremental_tail": _with(*full) + "\n" + dim_select,
        "scd2_stream_repair": _with(*full) + "\n" + dim_select,
        "facts_full": _with() + "\nSELECT * FROM facts",
        "facts_event_time_append": _append_sql(
            "WHERE event_timestamp > (SELECT coalesce(max(event_timestamp), TIMESTAMP '1970-01-01 00:00:00') "
            "FROM batch1)"),
        "facts_by_id_append": _append_sql(""),
        "facts_stored_append": _append_sql(""),
        "pit_range": _with(*full) + _PIT,
        "pit_asof": _with(*full) + _PIT,
        "pit_auto": _with(*full) + _PIT,
        "pit_ingest_order_auto": _with(*_full_dim_ctes("ingest")) + _PIT,
        "pit_ingest_order_bucketed": _with(*_full_dim_ctes("ingest")) + _PIT,
        "current_state": _with(*full) + f"\nSELECT {_DIM_COLS} FROM dim WHERE row_current",
        "entity_history": _with(*full) + f"\nSELECT {_DIM_COLS} FROM dim WHERE customer_id = {HISTORY_ENTITY}",
        "overlap_violations": _with(*_full_dim_ctes("ingest"), """
base AS (SELECT customer_id AS entity_id, valid_from, valid_to FROM dim)""", _PARTNERS) + _OVERLAP,
        "overlap_counts": _with(*_full_dim_ctes("ingest"), """
base AS (SELECT customer_id AS entity_id, valid_from, valid_to FROM dim)""", _PARTNERS) + """
SELECT entity_id, valid_from, valid_to, copies, CAST(n_overlaps AS BIGINT) AS n_overlaps FROM partners
WHERE n_overlaps > 0""",
        "current_record_violations": _with(*full, """
corrupted AS (
    SELECT customer_id,
           CASE WHEN source_change_id LIKE '%4' THEN NOT row_current ELSE row_current END AS row_current,
           valid_to
    FROM dim
)""") + """
SELECT customer_id AS entity_id, count(*) FILTER (WHERE row_current) AS current_rows,
       count(*) - count(valid_to) AS open_rows
FROM corrupted GROUP BY customer_id
HAVING count(*) FILTER (WHERE row_current) <> least(count(*) - count(valid_to), 1)""",
        "validate_dimension": _with(*_full_dim_ctes("ingest"), """
base AS (SELECT customer_id AS entity_id, valid_from, valid_to FROM dim),
""" + _PARTNERS + """,
overlap AS (""" + _OVERLAP + """),
per_entity AS (
    SELECT customer_id, count(*) FILTER (WHERE row_current) AS current_rows, count(*) - count(valid_to) AS open_rows
    FROM dim GROUP BY customer_id
),
counts AS (
    SELECT 'no_overlapping_validity_windows' AS check_name, (SELECT count(*) FROM overlap) AS violations
    UNION ALL
    SELECT 'exactly_one_current_record',
           (SELECT count(*) FROM per_entity WHERE current_rows <> least(open_rows, 1))
    UNION ALL
    SELECT 'closed_intervals_ordered',
           (SELECT count(*) FROM dim WHERE valid_to IS NOT NULL AND valid_from >= valid_to)
    UNION ALL
    SELECT 'not_null',
           (SELECT count(*) FILTER (WHERE customer_version_id IS NULL) + count(*) FILTER (WHERE customer_id IS NULL)
                 + count(*) FILTER (WHERE valid_from IS NULL) + count(*) FILTER (WHERE row_current IS NULL)
                 + count(*) FILTER (WHERE source_change_id IS NULL) FROM dim)
    UNION ALL
    SELECT 'unique_version_id',
           (SELECT count(*) FROM (SELECT customer_version_id FROM dim WHERE customer_version_id IS NOT NULL
                                  GROUP BY customer_version_id HAVING count(*) > 1) d)
)""") + """
SELECT check_name, CAST(violations AS BIGINT) AS violations, violations = 0 AS passed FROM counts""",
        "validate_all_layers": _with(_sql_staged("staged"), _sql_dedup("changes", "staged"),
                                     _sql_dim("dim", "changes", "staged"), """
sequenced AS (
    SELECT changes.*, row_number() OVER (PARTITION BY customer_id ORDER BY source_updated_at, change_id)
           AS change_seq
    FROM changes
),
enriched AS (""" + _PIT + """),
base AS (SELECT customer_id AS entity_id, valid_from, valid_to FROM dim),
""" + _PARTNERS + """,
overlap AS (""" + _OVERLAP + """),
per_entity AS (
    SELECT customer_id, count(*) FILTER (WHERE row_current) AS current_rows, count(*) - count(valid_to) AS open_rows
    FROM dim GROUP BY customer_id
),
counts AS (""" + _sql_declared_checks() + """)""") + """
SELECT check_name, CAST(violations AS BIGINT) AS violations, violations = 0 AS passed FROM counts""",
        "interval_order_violations": _with(*_full_dim_ctes("ingest")) + """
SELECT customer_id, source_change_id, valid_from, valid_to FROM dim
WHERE valid_to IS NOT NULL AND valid_from >= valid_to""",
        "not_null_violations": _with(*full)
        + "\nSELECT customer_version_id, 'valid_to' AS column_name FROM dim WHERE valid_to IS NULL",
        "unique_violations": _with(_sql_staged("staged")) + """
SELECT change_id AS unique_field, count(*) AS n_records FROM staged
WHERE change_id IS NOT NULL GROUP BY change_id HAVING count(*) > 1""",
        "accepted_values_violations": _with() + """
SELECT * FROM (SELECT operation AS value_field, count(*) AS n_records FROM log GROUP BY operation) t
WHERE value_field NOT IN ('INSERT', 'UPDATE', 'DELETE')""",
        "table_diff": _with(*_full_dim_ctes(cutoff=T1_CUTOFF, name="dim_t1"), *full) + f"""
SELECT *, 'left_only' AS diff_side FROM (SELECT {_CANON} FROM dim_t1 EXCEPT ALL SELECT {_CANON} FROM dim) l
UNION ALL
SELECT *, 'right_only' AS diff_side FROM (SELECT {_CANON} FROM dim EXCEPT ALL SELECT {_CANON} FROM dim_t1) r""",
        "missing_scenarios": _with() + """
SELECT tag FROM (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view'), ('replayed_snapshot')) c(tag)
WHERE NOT EXISTS (SELECT 1 FROM log WHERE log.scenario_tag = c.tag)""",
        "missing_scenarios_by_entity": _with() + """
SELECT e.customer_id, c.tag
FROM (SELECT DISTINCT customer_id FROM log) e,
     (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view'), ('replayed_snapshot')) c(tag)
WHERE NOT EXISTS (SELECT 1 FROM log WHERE log.customer_id = e.customer_id AND log.scenario_tag = c.tag)""",
        "serving_view": _with(*full) + _PIT,
        "scd2_closing_operation": _with(_sql_staged("staged"), _sql_dedup("changes", "staged"), """
closed AS (
    SELECT *, lead(source_updated_at) OVER w AS ends, lead(operation) OVER w AS closed_by_operation
    FROM changes WINDOW w AS (PARTITION BY customer_id ORDER BY source_updated_at, change_id)
)""") + """
SELECT customer_id || '-' || change_id AS customer_version_id, source_updated_at AS valid_from, ends AS valid_to,
       closed_by_operation
FROM closed WHERE operation <> 'DELETE' AND coalesce(source_updated_at < ends, true)""",
        "shared_change_ids": _with(_sql_staged("staged")) + """
SELECT change_id[:12] AS change_id, count(DISTINCT customer_id) AS entities FROM staged
GROUP BY ALL HAVING count(DISTINCT customer_id) > 1""",
        "unstable_change_ids": _with(_sql_staged("staged")) + """
SELECT change_id[:12] AS change_id, count(DISTINCT customer_id) AS entities,
       count(DISTINCT source_updated_at) AS source_times
FROM staged GROUP BY ALL HAVING count(DISTINCT (customer_id, source_updated_at)) > 1""",
        "duplicate_deliveries": _with(_sql_staged("staged")) + """
SELECT change_id, count(*) AS deliveries, min(ingested_at) AS first_ingested_at,
       max(ingested_at) AS last_ingested_at
FROM staged GROUP BY change_id HAVING count(*) > 1""",
        "noop_changes": _with(_sql_staged("staged"), _sql_dedup("changes", "staged"), """
prev AS (
    SELECT change_id, customer_id, operation, source_updated_at, country_code, subscription_tier,
           account_status, email_verified,
           lag(change_id) OVER w AS p_id, lag(operation) OVER w AS p_op, lag(country_code) OVER w AS p_c, lag(subscription_tier) OVER w AS p_t,
           lag(account_status) OVER w AS p_s, lag(email_verified) OVER w AS p_v
    FROM changes
    WINDOW w AS (PARTITION BY customer_id ORDER BY source_updated_at, change_id)
)""") + """
SELECT change_id, customer_id, source_updated_at, p_id AS previous_change_id FROM prev
WHERE p_id IS NOT NULL AND operation <> 'DELETE' AND p_op <> 'DELETE'
  AND (country_code, subscription_tier, account_status, email_verified) IS NOT DISTINCT FROM (p_c, p_t, p_s, p_v)""",
        "arrival_anomalies": _with(_sql_staged("staged"), _sql_dedup("changes", "staged"), """
run AS (
    SELECT change_id, customer_id, source_updated_at, ingested_at,
           max(source_updated_at) OVER (PARTITION BY customer_id ORDER BY ingested_at, change_id
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
               AS max_prior_source_updated_at
    FROM changes
)""") + """
SELECT change_id, customer_id, source_updated_at, ingested_at, max_prior_source_updated_at,
       date_sub('second', source_updated_at, ingested_at) AS arrival_lag_seconds
FROM run WHERE max_prior_source_updated_at > source_updated_at""",
    }

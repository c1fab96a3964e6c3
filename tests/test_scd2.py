"""Type 2 history against the hand-written expectations and the DELETE / tie edge cases."""

from __future__ import annotations

from histora.operators import build_scd2, current_state, deduplicate_changes, history, stage_changes
from histora.operators.quality import overlap_violations
from tests.fixtures_data import EXPECTED_42, EXPECTED_42_AFTER_T1, T1_CUTOFF
from tests.helpers import expected_history, intervals, log_df


def _dim(log, **kw):
    cutoff = kw.pop("cutoff", None)
    staged = stage_changes(log, ingest_cutoff=cutoff)
    return build_scd2(deduplicate_changes(staged), staged, **kw)


def test_full_history_matches_expected(scripted_log):
    dim = _dim(scripted_log)
    got = sorted((r.customer_id, r.source_change_id, r.valid_from, r.valid_to, r.row_current) for r in dim.collect())
    assert got == expected_history()


def test_customer_42_golden(scripted_log):
    assert intervals(_dim(scripted_log), 42) == EXPECTED_42


def test_customer_42_after_t1_cutoff(scripted_log):
    assert intervals(_dim(scripted_log, cutoff=T1_CUTOFF), 42) == EXPECTED_42_AFTER_T1


def test_dimension_columns_and_keys(scripted_log):
    dim = _dim(scripted_log)
    assert dim.columns == ["customer_version_id", "customer_id", "country_code", "subscription_tier",
                           "account_status", "email_verified", "valid_from", "valid_to", "row_current",
                           "source_change_id", "last_seen_ingested_at"]
    r = dim.where("source_change_id = 'chg_042_move'").first()
    assert r.customer_version_id == "42-chg_042_move"
    assert str(r.last_seen_ingested_at) == "2026-07-20 18:05:00"
    assert str(dim.where("customer_id = 11").first().last_seen_ingested_at) == "2026-03-22 09:01:00"


def test_delete_stale_duplicate_and_equal_values(scripted_log):
    dim = _dim(scripted_log)
    assert dim.where("customer_id = 21").count() == 1 and current_state(dim).where("customer_id = 21").count() == 0
    assert [r.source_change_id for r in history(dim, 14).collect()] == ["chg_014_insert", "chg_014_stale",
                                                                          "chg_014_newer"]
    assert dim.where("customer_id = 10").count() == 2
    assert dim.where("customer_id = 22").count() == 3  # equal consecutive values are not merged
    assert [r.source_change_id for r in current_state(dim).where("customer_id = 18").collect()] == ["chg_018_b"]


def _edge(spark, rows):
    full = [(c, e, op, "US", "free", "active", False, src, ing, "x") for (c, e, op, src, ing) in rows]
    return _dim(log_df(spark, full))


def test_delete_only_and_vanishing_entity(spark):
    assert _edge(spark, [("d", 1, "DELETE", "2026-01-01 00:00:00", "2026-01-01 00:00:00")]).count() == 0
    vanish = _edge(spark, [("a", 1, "INSERT", "2026-01-01 00:00:00", "2026-01-01 00:01:00"),
                           ("b", 1, "DELETE", "2026-01-01 00:00:00", "2026-01-02 00:00:00")])
    assert vanish.count() == 0


def test_delete_sorting_before_tied_update_leaves_entity_open(spark):
    dim = _edge(spark, [("i", 1, "INSERT", "2026-01-01 00:00:00", "2026-01-01 00:00:00"),
                        ("a", 1, "DELETE", "2026-01-02 00:00:00", "2026-01-02 00:00:00"),
                        ("b", 1, "UPDATE", "2026-01-02 00:00:00", "2026-01-02 00:00:00")])
    rows = sorted((r.source_change_id, r.valid_to is None) for r in dim.collect())
    assert rows == [("b", True), ("i", False)]


def test_reinsertion_and_double_delete(spark):
    re = _edge(spark, [("a", 1, "INSERT", "2026-01-01 00:00:00", "2026-01-01 00:00:00"),
                       ("b", 1, "DELETE", "2026-01-02 00:00:00", "2026-01-02 00:00:00"),
                       ("c", 1, "INSERT", "2026-01-03 00:00:00", "2026-01-03 00:00:00")])
    got = sorted((r.source_change_id, str(r.valid_from), str(r.valid_to)) for r in re.collect())
    assert got == [("a", "2026-01-01 00:00:00", "2026-01-02 00:00:00"), ("c", "2026-01-03 00:00:00", "None")]
    dd = _edge(spark, [("a", 1, "INSERT", "2026-01-01 00:00:00", "2026-01-01 00:00:00"),
                       ("b", 1, "DELETE", "2026-01-02 00:00:00", "2026-01-02 00:00:00"),
                       ("c", 1, "DELETE", "2026-01-03 00:00:00", "2026-01-03 00:00:00")])
    assert [(r.source_change_id, str(r.valid_to)) for r in dd.collect()] == [("a", "2026-01-02 00:00:00")]


def test_ingest_order_defect_is_caught(scripted_log):
    bad = _dim(scripted_log, order="ingest")
    kinds = {}
    for r in overlap_violations(bad).collect():
        kinds.setdefault(r.failure_kind, []).append(r.entity_id)
    assert sorted(set(kinds["inverted_or_zero_width"])) == [12, 13, 14, 18, 20, 42]
    assert sorted(kinds["overlap"]) == [12, 12, 13, 13, 14, 14, 20, 20, 42, 42]
    assert overlap_violations(_dim(scripted_log)).count() == 0


def test_full_history_with_every_entity_split(scripted_log, split_all):
    dim = _dim(scripted_log)
    got = sorted((r.customer_id, r.source_change_id, r.valid_from, r.valid_to, r.row_current) for r in dim.collect())
    assert got == expected_history()
    assert intervals(dim, 42) == EXPECTED_42


def test_closing_operation_and_sql_views(spark, scripted_log):
    staged = stage_changes(scripted_log)
    dim = build_scd2(deduplicate_changes(staged), staged, with_closing_operation=True)
    closed = {r.source_change_id: r.closed_by_operation for r in dim.where("customer_id IN (3, 42)").collect()}
    assert closed == {"chg_003_insert": "UPDATE", "chg_003_update": "DELETE", "chg_042_insert": "UPDATE",
                      "chg_042_move": "UPDATE", "chg_042_upgrade": "DELETE"}
    from histora.plans.views import register_views
    from histora.spec import EVENT_SCHEMA
    from tests.fixtures_data import EVENTS_42
    from tests.helpers import ts
    ev = spark.createDataFrame([(a, b, c, ts(d)) for a, b, c, d in EVENTS_42], EVENT_SCHEMA)
    register_views(spark, scripted_log, ev, prefix="t_")
    n = spark.sql("SELECT count(*) FROM t_events_enriched WHERE matched_historical_state").first()[0]
    assert n == 3
    assert spark.sql("SELECT count(*) FROM t_dimension_scd2").first()[0] == 42


def test_sql_filters_on_views_reach_the_parquet_scan(spark, scripted_log, tmp_path):
    from histora.plans.views import register_views
    from histora.sources import read_change_log
    from histora.spec import EVENT_SCHEMA
    scripted_log.write.parquet(str(tmp_path / "log"))
    log = read_change_log(spark, str(tmp_path / "log"), fmt="parquet")
    ev = spark.createDataFrame([], EVENT_SCHEMA)
    register_views(spark, log, ev, prefix="pq_")
    df = spark.sql("SELECT change_id FROM pq_stg_changes "
                   "WHERE ingested_at <= TIMESTAMP_NTZ'2026-03-01 00:00:00' AND customer_id = 11")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")   # do not truncate the scan's metadata
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PushedFilters: [IsNotNull(ingested_at), IsNotNull(customer_id)," in plan
    assert "LessThanOrEqual(ingested_at," in plan and "EqualTo(customer_id,11)" in plan
    assert "scenario_tag" not in plan.split("ReadSchema:")[1].split("\n")[0]   # unused columns pruned
    assert df.count() == 0


def test_full_build_reads_the_log_once_and_shuffles_twice(spark):
    """The watermark rides on the dedup aggregate and the ordered scan."""
    import re

    import __spark_entry__ as entry
    out = entry.q_scd2_full(spark, "/root/testdata/sf0.001")
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the derived log is a union of two reads of events: two scans are one log
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2 and len(re.findall(r"Scan parquet", plan)) == 2
    assert "Join" not in plan


def test_carried_watermarks_equal_joined_ones(spark, scripted_log, split_all):
    staged = stage_changes(scripted_log)
    carried = build_scd2(deduplicate_changes(staged, last_arrival=True), staged)
    joined = build_scd2(deduplicate_changes(staged), staged)
    assert carried.columns == joined.columns
    assert sorted(map(repr, carried.collect())) == sorted(map(repr, joined.collect()))

"""Data-quality checks return the violating rows; injected defects must be found."""

from __future__ import annotations

from pyspark.sql import functions as F

from histora.operators import (
    accepted_values_violations, build_scd2, current_record_violations, deduplicate_changes,
    interval_order_violations, missing_scenarios, not_null_violations, overlap_violations, stage_changes,
    table_diff, unique_violations, validate,
)
from histora.operators.quality import dimension_checks
from histora.sources.derived import SCENARIO_CATALOG


def _dim(log, order="source"):
    staged = stage_changes(log)
    return build_scd2(deduplicate_changes(staged), staged, order=order)


def test_valid_history_passes_every_declared_check(scripted_log):
    res = {r.check_name: (r.violations, r.passed) for r in validate(dimension_checks(_dim(scripted_log))).collect()}
    assert all(p for _, p in res.values()), res
    assert len(res) == 5


def test_injected_overlap_is_caught(scripted_log):
    dim = _dim(scripted_log)
    shifted = (dim.where("source_change_id = 'chg_042_move'")
               .withColumn("valid_from", F.col("valid_from") - F.expr("INTERVAL 1 HOUR"))
               .withColumn("customer_version_id", F.lit("42-injected")))
    bad = dim.unionByName(shifted)
    v = overlap_violations(bad)
    assert v.where("failure_kind = 'overlap'").count() >= 2
    res = {r.check_name: r.passed for r in validate(dimension_checks(bad)).collect()}
    assert res["no_overlapping_validity_windows"] is False


def test_identical_rows_are_not_overlaps_but_inverted_rows_are_reported(spark):
    rows = [(1, "2026-01-01 00:00:00", "2026-01-02 00:00:00"), (1, "2026-01-01 00:00:00", "2026-01-02 00:00:00"),
            (2, "2026-01-03 00:00:00", "2026-01-02 00:00:00"), (2, "2026-01-01 00:00:00", None),
            (3, "2026-01-01 00:00:00", None), (3, "2026-01-05 00:00:00", None)]
    df = spark.createDataFrame(rows, "customer_id int, valid_from string, valid_to string").select(
        "customer_id", F.col("valid_from").cast("timestamp_ntz").alias("valid_from"),
        F.col("valid_to").cast("timestamp_ntz").alias("valid_to"))
    got = sorted((r.entity_id, r.failure_kind) for r in overlap_violations(df).collect())
    assert got == [(2, "inverted_or_zero_width"), (2, "overlap"), (2, "overlap"), (3, "overlap"), (3, "overlap")]


def test_current_record_and_interval_order(scripted_log):
    dim = _dim(scripted_log)
    assert current_record_violations(dim).count() == 0
    two = dim.withColumn("row_current", F.when(F.col("customer_id") == 15, F.lit(True)).otherwise(F.col("row_current")))
    v = current_record_violations(two).collect()
    assert [(r.entity_id, r.current_rows, r.open_rows) for r in v] == [(15, 6, 1)]
    deleted = dim.withColumn("row_current", F.when(F.col("customer_id") == 21, F.lit(True)).otherwise(F.col("row_current")))
    assert [r.entity_id for r in current_record_violations(deleted).collect()] == [21]
    bad = _dim(scripted_log, order="ingest")
    assert sorted(r.customer_id for r in interval_order_violations(bad).collect()) == [12, 13, 14, 18, 20, 42]


def test_generic_checks(spark, scripted_log):
    staged = stage_changes(scripted_log)
    assert sorted(r.unique_field for r in unique_violations(staged, "change_id").collect()) == [
        "chg_010_update", "chg_011_insert", "chg_011_update", "chg_042_move"]
    assert unique_violations(staged, "received_id").count() == 0
    assert accepted_values_violations(staged, "operation", ["INSERT", "UPDATE", "DELETE"]).count() == 0
    lower = scripted_log.withColumn("operation", F.lower("operation"))
    assert {r.value_field for r in accepted_values_violations(lower, "operation", ["INSERT", "UPDATE", "DELETE"]).collect()} == {"insert", "update", "delete"}
    dim = _dim(scripted_log)
    nn = not_null_violations(dim, ["valid_to", "customer_id"], keep=["customer_version_id"])
    assert nn.where("column_name = 'customer_id'").count() == 0
    assert nn.where("column_name = 'valid_to'").count() == dim.where("valid_to IS NULL").count()
    cat = spark.createDataFrame([(t,) for t in ("normal_insert", "customer_42_canonical", "never_seen")], "tag string")
    assert [r.tag for r in missing_scenarios(cat, scripted_log).collect()] == ["never_seen"]
    assert "replayed_snapshot" in SCENARIO_CATALOG


def test_table_diff_is_two_sided_multiset(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (3,)], "x int")
    got = sorted((r.x, r.diff_side) for r in table_diff(a, b, ["x"]).collect())
    assert got == [(1, "left_only"), (2, "left_only"), (3, "right_only")]


def test_validate_declared_equals_one_check_per_branch(spark, scripted_log):
    from histora.operators import deduplicate_changes, point_in_time_join, sequence_changes, stage_events
    from histora.operators.quality import declared_checks, validate_declared
    from histora.spec import EVENT_SCHEMA
    from tests.fixtures_data import EVENTS_42
    from tests.helpers import ts
    staged = stage_changes(scripted_log)
    changes = deduplicate_changes(staged)
    dim = build_scd2(changes, staged, order="ingest")      # a defective build: some checks fail
    ev = stage_events(spark.createDataFrame([(a, b, c, ts(d)) for a, b, c, d in EVENTS_42], EVENT_SCHEMA))
    layers = {"staging": staged, "events": ev, "changes": changes, "sequence": sequence_changes(changes),
              "dimension": dim, "facts": ev, "serving": point_in_time_join(ev, dim)}
    a = {r.check_name: (r.violations, r.passed) for r in validate_declared(layers).collect()}
    b = {r.check_name: (r.violations, r.passed) for r in validate(declared_checks(layers)).collect()}
    assert a == b and len(a) == 36
    assert a["dimension.no_overlapping_validity_windows"][1] is False


def test_layers_are_stored_once_and_their_observed_tests_equal_the_plain_ones(spark, scripted_log):
    from histora.operators.quality import validate_declared
    from histora.plans.layers import store_layers, validate_layers
    from histora.spec import EVENT_SCHEMA
    from tests.fixtures_data import EVENTS_42
    from tests.helpers import ts
    events = spark.createDataFrame([(a, b, c, ts(d)) for a, b, c, d in EVENTS_42] + [(None, 42, "x", None)], EVENT_SCHEMA)
    broken = scripted_log.withColumn("ingested_at", F.when(F.col("change_id") < "c", F.col("ingested_at")))
    for log in (scripted_log, broken):
        layers = store_layers(spark, log, events)
        got = {tuple(r) for r in validate_layers(layers).collect()}
        assert got == {tuple(r) for r in validate_declared(layers.frames).collect()} and len(got) == 36
        assert len(layers.observed) > 20 and layers.observed["events.not_null.event_timestamp"] == 1
        assert all(len(f.inputFiles()) for f in layers.frames.values())

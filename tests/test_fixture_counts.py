"""The counts FIXTURES.md section 4 lists for the change log derived from sf0.001."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def q():
    return entry.queries()


def test_derived_log_counts(spark, q):
    staged = q["stage_changes"](spark, SF)
    changes = q["deduplicate_changes"](spark, SF)
    seq = q["sequence_changes"](spark, SF)
    assert staged.count() == 1100
    assert changes.count() == 1000
    assert changes.where("operation = 'DELETE'").count() == 25
    assert changes.where(F.col("ingested_at") > F.col("source_updated_at") + F.expr("INTERVAL 1 DAY")).count() == 72
    assert seq.where("same_timestamp_change_count > 1").count() == 98
    assert seq.where("is_ambiguous_tie").count() == 98
    assert q["duplicate_deliveries"](spark, SF).count() == 100
    assert q["arrival_anomalies"](spark, SF).count() == 69
    assert q["stage_changes_cutoff"](spark, SF).count() == 527


def test_history_and_check_counts(spark, q):
    dim = q["scd2_full"](spark, SF)
    assert dim.count() == 927
    assert dim.where("row_current").count() == 15
    assert dim.select("customer_id").distinct().count() == 15
    assert q["scd2_after_cutoff"](spark, SF).count() == 449
    v = q["overlap_violations"](spark, SF)
    assert v.where("failure_kind = 'inverted_or_zero_width'").count() == 101
    assert v.where("failure_kind = 'overlap'").count() == 1208
    pit = q["pit_range"](spark, SF)
    assert pit.count() == 1000 and pit.where("matched_historical_state").count() == 975
    assert q["facts_event_time_append"](spark, SF).count() == 933
    assert q["facts_by_id_append"](spark, SF).count() == 1000

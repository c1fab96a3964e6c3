"""Staging, first-delivery dedup and source-time sequencing on the scripted log."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from histora.operators import (
    arrival_anomalies, deduplicate_changes, duplicate_deliveries, noop_changes, sequence_changes,
    shared_change_ids, stage_changes,
)
from tests.fixtures_data import T1_CUTOFF
from tests.helpers import log_df


def test_stage_keeps_every_delivery_and_types(scripted_log):
    staged = stage_changes(scripted_log)
    assert staged.count() == 51
    assert dict(staged.dtypes)["source_updated_at"] == "timestamp_ntz"
    assert staged.where(F.col("operation") != F.upper("operation")).count() == 0


def test_received_id_is_md5_of_delivery_key(scripted_log):
    r = stage_changes(scripted_log).where("change_id = 'chg_042_insert'").first()
    key = "chg_042_insert|42|2026-07-01 09:05:00|2026-07-01 09:00:00"
    assert r.received_id == hashlib.md5(key.encode()).hexdigest()


def test_cutoff_is_inclusive_and_on_ingest_time(spark, scripted_log):
    staged = stage_changes(scripted_log, ingest_cutoff=T1_CUTOFF)
    ids42 = sorted(r.change_id for r in staged.where("customer_id = 42").collect())
    assert ids42 == ["chg_042_insert", "chg_042_upgrade"]
    edge = stage_changes(scripted_log, ingest_cutoff="2026-07-10 14:05:00").where("customer_id = 42")
    assert edge.count() == 2  # the upgrade arrives exactly at the cutoff
    assert stage_changes(scripted_log, ingest_cutoff="").count() == 51


def test_dedup_collapses_redeliveries_and_keeps_distinct_ids(scripted_log):
    changes = deduplicate_changes(stage_changes(scripted_log))
    assert changes.count() == 47
    counts = {r.change_id: r["count"] for r in changes.groupBy("change_id").count().collect()}
    assert counts["chg_042_move"] == 1 and counts["chg_010_update"] == 1
    assert "chg_022_insert" in counts and "chg_022_noop" in counts
    first = changes.where("change_id = 'chg_042_move'").first()
    assert str(first.ingested_at) == "2026-07-11 08:00:00"
    replay = changes.where("change_id = 'chg_011_update'").first()
    assert str(replay.ingested_at) == "2026-03-15 09:01:00"


def test_first_ingested_delivery_wins_even_with_other_payload(spark):
    rows = [
        ("c1", 1, "INSERT", "US", "free", "active", False, "2026-01-01 00:00:00", "2026-01-01 00:05:00", "t"),
        ("c1", 1, "INSERT", "FR", "plus", "active", True, "2026-01-01 00:00:00", "2026-01-01 00:01:00", "t"),
    ]
    got = deduplicate_changes(stage_changes(log_df(spark, rows))).first()
    assert got.country_code == "FR"


def test_equal_delivery_keys_give_a_deterministic_winner(spark):
    base = ("c1", 1, "UPDATE", None, "free", "active", False, "2026-01-01 00:00:00", "2026-01-01 00:01:00", "t")
    rows = [base[:3] + ("US",) + base[4:], base[:3] + ("CA",) + base[4:]]
    a = deduplicate_changes(stage_changes(log_df(spark, rows))).first().country_code
    b = deduplicate_changes(stage_changes(log_df(spark, rows[::-1]))).first().country_code
    assert a == b == "CA"


def test_sequence_orders_by_source_time_not_arrival(scripted_log):
    seq = sequence_changes(deduplicate_changes(stage_changes(scripted_log)))
    order = [r.change_id for r in seq.where("customer_id = 42").orderBy("change_seq").collect()]
    assert order == ["chg_042_insert", "chg_042_move", "chg_042_upgrade", "chg_042_delete"]
    last = seq.where("change_id = 'chg_042_upgrade'").first()
    assert last.next_change_id == "chg_042_delete" and last.next_operation == "DELETE"
    assert dict(seq.dtypes)["change_seq"] == "bigint"


def test_only_customer_18_is_an_ambiguous_tie(scripted_log):
    seq = sequence_changes(deduplicate_changes(stage_changes(scripted_log)))
    flagged = sorted(r.change_id for r in seq.where("is_ambiguous_tie").collect())
    assert flagged == ["chg_018_a", "chg_018_b"]
    r = seq.where("change_id = 'chg_018_a'").first()
    assert r.same_timestamp_change_count == 2 and r.next_change_id == "chg_018_b"


def test_tie_flag_null_semantics(spark):
    t = "2026-01-01 00:00:00"
    rows = [
        ("a", 1, "UPDATE", None, "free", "active", False, t, "2026-01-01 00:01:00", "x"),
        ("b", 1, "UPDATE", "FR", "free", "active", False, t, "2026-01-01 00:02:00", "x"),
        ("c", 2, "UPDATE", None, "free", "active", False, t, "2026-01-01 00:01:00", "x"),
        ("d", 2, "UPDATE", None, "free", "active", False, t, "2026-01-01 00:02:00", "x"),
        ("e", 3, "UPDATE", "US", "free", "active", False, t, "2026-01-01 00:01:00", "x"),
        ("f", 3, "DELETE", "US", "free", "active", False, t, "2026-01-01 00:02:00", "x"),
    ]
    seq = sequence_changes(deduplicate_changes(stage_changes(log_df(spark, rows))))
    flags = {r.customer_id: r.is_ambiguous_tie for r in seq.collect()}
    assert flags[1] is False      # NULL vs FR is not a conflict
    assert flags[2] is None       # all-NULL column, rest equal: NULL, as in SQL
    assert flags[3] is False      # UPDATE/DELETE tie with equal attributes


def test_delivery_diagnostics(scripted_log):
    staged = stage_changes(scripted_log)
    dups = {r.change_id: r.deliveries for r in duplicate_deliveries(staged).collect()}
    assert dups == {"chg_010_update": 2, "chg_011_insert": 2, "chg_011_update": 2, "chg_042_move": 2}
    changes = deduplicate_changes(staged)
    assert [r.change_id for r in noop_changes(changes).collect()] == ["chg_022_noop"]
    late = sorted(r.change_id for r in arrival_anomalies(changes).collect())
    assert late == ["chg_012_late", "chg_013_first", "chg_014_stale", "chg_020_late", "chg_042_move"]
    assert shared_change_ids(staged).count() == 0


def test_a_tie_whose_attributes_are_all_null_is_neither_ambiguous_nor_clear(spark):
    """Comparing NULL with NULL gives NULL, and so does the flag; one differing attribute decides it."""
    at = "2026-01-01 00:00:00"
    rows = [("a", 1, "INSERT", None, None, None, None, at, at, "x"), ("b", 1, "UPDATE", None, None, None, None, at, at, "x"),
            ("c", 2, "INSERT", None, "free", None, None, at, at, "x"), ("d", 2, "UPDATE", None, "plus", None, None, at, at, "x"),
            ("e", 3, "INSERT", None, None, None, None, at, at, "x")]
    out = sequence_changes(deduplicate_changes(stage_changes(log_df(spark, rows)))).collect()
    assert {r.change_id: r.is_ambiguous_tie for r in out} == {"a": None, "b": None, "c": True, "d": True, "e": False}

"""Streaming micro-batch repair equals a full build; a replayed batch changes nothing."""

from __future__ import annotations

import uuid

import pytest

from pyspark.sql import functions as F

from histora.operators import build_scd2, deduplicate_changes, stage_changes, table_diff
from histora.session import checkpoint_dir
from histora.sources import stored
from histora.streaming import RepairStreamTables, start_repair_stream
from histora.streaming.repair import _process_batch
from histora.spec import DEFAULT_SPEC
from tests.fixtures_data import EXPECTED_42
from tests.helpers import intervals, log_df

CANON = ["customer_id", "country_code", "subscription_tier", "account_status", "email_verified", "valid_from",
         "valid_to", "row_current", "source_change_id", "last_seen_ingested_at"]


def _full(log):
    staged = stage_changes(log)
    return build_scd2(deduplicate_changes(staged), staged)


@pytest.mark.parametrize("tail", [False, True])
def test_three_micro_batches_equal_full_build(spark, scripted_log, tail):
    base = f"{checkpoint_dir(spark)}/test-stream-{uuid.uuid4().hex}"
    cuts = ["2026-03-01 00:00:00", "2026-07-10 23:59:59"]
    ing = F.col("ingested_at")
    parts = [ing <= F.lit(cuts[0]).cast("timestamp_ntz"),
             (ing > F.lit(cuts[0]).cast("timestamp_ntz")) & (ing <= F.lit(cuts[1]).cast("timestamp_ntz")),
             ing > F.lit(cuts[1]).cast("timestamp_ntz")]
    for i, p in enumerate(parts):
        scripted_log.where(p).write.parquet(f"{base}/landing/arrival={i}")
    tables = RepairStreamTables(f"{base}/log", f"{base}/dim")
    q = start_repair_stream(spark, f"{base}/landing/*", tables, f"{base}/_ckpt", schema=scripted_log.schema,
                            max_files_per_trigger=1, tail=tail)
    q.awaitTermination()
    assert tables.dim.done(spark, "batch-2")
    dim = tables.read_dim(spark)
    assert table_diff(dim, _full(scripted_log), CANON).count() == 0
    assert intervals(dim, 42) == EXPECTED_42

    # at-least-once: replaying an already processed batch leaves the table unchanged
    _process_batch(spark, tables, DEFAULT_SPEC, scripted_log.where(parts[1]), 1, tail)
    assert table_diff(tables.read_dim(spark), _full(scripted_log), CANON).count() == 0


def test_stream_sees_watermark_tie(spark):
    base = f"{checkpoint_dir(spark)}/test-stream-{uuid.uuid4().hex}"
    row = lambda c, e, src, ing: (c, e, "INSERT", "US", "free", "active", False, src, ing, "x")
    a = log_df(spark, [row("a", 1, "2026-01-01 00:00:00", "2026-01-05 00:00:00")])
    late = log_df(spark, [row("b", 2, "2026-01-02 00:00:00", "2026-01-05 00:00:00")])
    a.write.parquet(f"{base}/landing/arrival=0")
    late.write.parquet(f"{base}/landing/arrival=1")
    tables = RepairStreamTables(f"{base}/log", f"{base}/dim")
    start_repair_stream(spark, f"{base}/landing/*", tables, f"{base}/_ckpt", schema=a.schema).awaitTermination()
    assert sorted(r.customer_id for r in tables.read_dim(spark).collect()) == [1, 2]


def test_arrivals_of_the_query_are_written_by_many_tasks(spark, monkeypatch):
    import __spark_entry__ as entry
    base, real = f"{checkpoint_dir(spark)}/test-stream-{uuid.uuid4().hex}", entry.derived_change_log
    monkeypatch.setattr(entry, "work_path", lambda spark, name: base)
    monkeypatch.setattr(entry, "derived_change_log", lambda spark, sf: real(spark, sf).repartition(4))
    dim = entry.q_scd2_stream_repair(spark, "/root/testdata/sf0.001")
    assert len(spark.read.parquet(f"{base}/landing/arrival=0").inputFiles()) == 4
    assert table_diff(dim, entry._dim(spark, "/root/testdata/sf0.001"), CANON).count() == 0


@pytest.mark.parametrize("lost", ["before rows", "before parts", "half of the parts"])
def test_a_batch_lost_at_any_point_is_repeated_with_the_same_result(spark, scripted_log, monkeypatch, lost):
    """Killed after the log is written: before the table's rows, before its parts, and between two parts."""
    base = f"{checkpoint_dir(spark)}/test-stream-{uuid.uuid4().hex}"
    tables = RepairStreamTables(f"{base}/log", f"{base}/dim", buckets=3)
    early = F.col("ingested_at") <= F.lit("2026-03-01 00:00:00").cast("timestamp_ntz")
    _process_batch(spark, tables, DEFAULT_SPEC, scripted_log.where(early), 0)
    before = tables.read_dim(spark).collect()
    real = stored.StoredTable._apply

    def killed(self, spark, step, parts):
        if lost == "half of the parts":
            rows = spark.read.parquet(f"{self.path}.steps/{step}.rows").where(F.col("_part") == parts[0])
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_part").parquet(self.path)
        raise RuntimeError("lost")

    if lost == "before rows":
        monkeypatch.setattr(stored.StoredTable, "replace", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    else:
        monkeypatch.setattr(stored.StoredTable, "_apply", killed)
    with pytest.raises(RuntimeError, match="lost"):
        _process_batch(spark, tables, DEFAULT_SPEC, scripted_log.where(~early), 1)
    monkeypatch.undo()
    assert stored.StoredTable._apply is real
    if lost != "half of the parts":
        assert sorted(map(repr, tables.read_dim(spark).collect())) == sorted(map(repr, before))
    for _ in range(2):
        _process_batch(spark, tables, DEFAULT_SPEC, scripted_log.where(~early), 1)
        assert table_diff(tables.read_dim(spark), _full(scripted_log), CANON).count() == 0


def test_a_batch_reads_only_the_buckets_of_its_entities(spark, scripted_log):
    base = f"{checkpoint_dir(spark)}/test-stream-{uuid.uuid4().hex}"
    tables = RepairStreamTables(f"{base}/log", f"{base}/dim")
    _process_batch(spark, tables, DEFAULT_SPEC, scripted_log, 0)
    first = tables.log_of(spark, "change_id string", [5], 0)
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    parts = tables.dim.parts_of(scripted_log)
    some = tables.log_of(spark, "change_id string", parts[:1], 0).select(F.input_file_name()).distinct().collect()
    assert len(parts) > 1 and some and all(f"_part={parts[0]}/" in r[0] for r in some)

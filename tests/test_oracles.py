"""Every registered query equals its DuckDB oracle on the smallest scale (the driver checks sf0.01)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tools.compare_oracles import compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF, list(entry._QUERIES))


@pytest.mark.parametrize("name", sorted(entry._QUERIES))
def test_query_matches_oracle(results, name):
    assert name in entry.oracle_sql()
    assert results[name]["match"], results[name]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 1000 and "matched_historical_state" in df.columns


SPLIT_KEYS = ["sequence_changes", "scd2_full", "scd2_ingest_order", "pit_asof", "pit_auto", "pit_ingest_order_auto",
              "overlap_violations", "noop_changes", "arrival_anomalies"]


@pytest.fixture(scope="module")
def split_results(spark):
    from histora.plans.ordered import HOT_ROWS_CONF
    spark.conf.set(HOT_ROWS_CONF, "0")
    try:
        return compare(spark, SF, SPLIT_KEYS)
    finally:
        spark.conf.unset(HOT_ROWS_CONF)


@pytest.mark.parametrize("name", SPLIT_KEYS)
def test_query_matches_oracle_with_every_entity_split(split_results, name):
    assert split_results[name]["match"], split_results[name]


@pytest.fixture(scope="module")
def adaptive_results(spark):
    from histora.plans.ordered import CHUNK_ROWS_CONF, HOT_ROWS_CONF, MIN_BYTES_CONF
    confs = {MIN_BYTES_CONF: "0", HOT_ROWS_CONF: "20", CHUNK_ROWS_CONF: "4"}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        return compare(spark, SF, SPLIT_KEYS)
    finally:
        for k in confs:
            spark.conf.unset(k)


@pytest.mark.parametrize("name", SPLIT_KEYS)
def test_query_matches_oracle_with_adaptive_split(adaptive_results, name):
    assert adaptive_results[name]["match"], adaptive_results[name]

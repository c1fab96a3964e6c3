"""The change log and the facts that the benchmark derives from the ``events`` table.

Every event becomes a mutation of the entity ``user_id`` and an activity fact of it; every change_id ending in 0 is delivered a second time 30 seconds later, every 14th mutation arrives five
days late, and source times are truncated to the hour so that ties occur. The same derivation is
written as SQL in the DuckDB oracles of ``__spark_entry__.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histora.functions.exprs import hour_floor_ntz
from histora.sources.readers import read_table

# Fixed values of the derivation.
COUNTRY_BY_MOD16 = {0: "US", 2: "CA", 4: "GB", 6: "DE", 8: "FR", 10: "AU", 12: "JP"}  # else BR
TIER_BY_MOD3 = {0: "free", 1: "plus"}  # else premium
# Expected scenario catalogue: the five event types, plus one tag the data never carries.
SCENARIO_CATALOG = ("click", "error", "purchase", "signup", "view", "replayed_snapshot")


def _case(key: F.Column, mapping: dict[int, str], default: str) -> F.Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(key == k, v) if expr is None else expr.when(key == k, v)
    return expr.otherwise(default)


def derived_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw change log (lower-case operations, duplicates included) derived from ``events``."""
    ev = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    base = ev.select(
        F.concat(F.lit("chg_"), F.lpad(eid.cast("string"), 10, "0")).alias("change_id"),
        F.col("user_id").cast("int").alias("customer_id"),
        F.when(eid % 40 == 8, "delete").otherwise("update").alias("operation"),
        _case(eid % 16, COUNTRY_BY_MOD16, "BR").alias("country_code"),
        _case(eid % 3, TIER_BY_MOD3, "premium").alias("subscription_tier"),
        F.col("event_type").alias("account_status"),
        (F.col("value") > 10.0).alias("email_verified"),
        hour_floor_ntz("ts").alias("source_updated_at"),
        F.when(eid % 14 == 0, F.col("ts") + F.expr("INTERVAL 5 DAYS"))
         .otherwise(F.col("ts") + F.expr("INTERVAL 1 MINUTE")).alias("ingested_at"),
        F.col("event_type").alias("scenario_tag"),
    )
    dup = (base.where(F.col("change_id").endswith("0"))
           .withColumn("ingested_at", F.col("ingested_at") + F.expr("INTERVAL 30 SECONDS")))
    return base.unionByName(dup)


def derived_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw activity events."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id"),
        F.col("user_id").cast("int").alias("customer_id"),
        F.col("event_type").alias("event_name"),
        F.col("ts").alias("event_timestamp"),
    )


def scenario_catalog(spark: SparkSession) -> DataFrame:
    """Catalogue of scenario tags that the change log is expected to cover (a tiny fixed table)."""
    return spark.createDataFrame([(t,) for t in SCENARIO_CATALOG], "tag string")

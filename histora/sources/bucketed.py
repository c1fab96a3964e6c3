"""Co-located storage: save tables with Spark's native bucketing on the entity key.

When the history and the events are both saved with ``bucketBy(n, entity)`` (same ``n``), Spark joins
them bucket against bucket: the point-in-time join, the repair's anti-join and any per-entity join run as
sort-merge joins without an exchange, because each table's scan already reports
``HashPartitioning(entity, n)``. The table is registered in the session catalog as an external table
at ``path`` (on shared storage), so it is also readable by name from SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def save_bucketed(df: DataFrame, name: str, key: str, n_buckets: int, path: str,
                  sort_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as an external Parquet table bucketed (and optionally sorted) by ``key``."""
    writer = df.write.mode("overwrite").format("parquet").option("path", path).bucketBy(n_buckets, key)
    if sort_by:
        writer = writer.sortBy(*sort_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def read_bucketed(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)

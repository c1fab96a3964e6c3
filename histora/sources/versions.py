"""Whole versions of a table as plain Parquet: ``root/version=<n>``, each written once by Spark's own writer.

A repair is a DataFrame in and a DataFrame out; storing its result is a write of the next version, which reads
only versions before it. A retried job overwrites its own version. Old versions are left to the storage's
retention rules.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def latest_version(spark: SparkSession, root: str) -> int | None:
    """The greatest stored version; None if there is none."""
    try:
        files = spark.read.option("basePath", root).parquet(f"{root}/version=*").inputFiles()
    except AnalysisException:
        return None
    found = [int(m[1]) for m in (re.search(r"/version=([0-9]+)/", f) for f in files) if m]
    return max(found, default=None)


def write_version(df: DataFrame, root: str, version: int) -> int:
    df.write.mode("overwrite").parquet(f"{root}/version={version}")
    return version


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """One stored version, by default the latest."""
    return spark.read.parquet(f"{root}/version={latest_version(spark, root) if version is None else version}")

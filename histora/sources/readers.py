"""Typed scans of the two append-only inputs (CSV with header, or Parquet).

CSV is read against the fixed schema with FAILFAST: a malformed row stops the job instead of turning
into NULLs, and nothing is inferred. Timestamps are zone-less (``timestamp_ntz``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from histora.spec import CDC_SCHEMA, EVENT_SCHEMA

TS_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"     # the fraction may be absent


def _read(spark: SparkSession, path: str | list[str], schema: T.StructType, fmt: str) -> DataFrame:
    if fmt == "parquet":
        df = spark.read.parquet(*([path] if isinstance(path, str) else path))
        return df.select([df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    if fmt == "csv":
        return (spark.read.schema(schema)
                .option("header", True)
                .option("mode", "FAILFAST")
                .option("timestampNTZFormat", TS_FORMAT)
                .csv(path))
    raise ValueError(f"unsupported format {fmt!r}")


def read_change_log(spark: SparkSession, path: str | list[str], fmt: str = "csv",
                    schema: T.StructType = CDC_SCHEMA) -> DataFrame:
    """A1: typed change-log scan."""
    return _read(spark, path, schema, fmt)


def read_events(spark: SparkSession, path: str | list[str], fmt: str = "csv",
                schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """A2: typed activity-event scan."""
    return _read(spark, path, schema, fmt)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

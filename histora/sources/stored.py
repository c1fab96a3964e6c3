"""Stored tables that a repair changes partition by partition: Spark's dynamic partition overwrite on plain Parquet.

The rows lie under ``path/_part=<p>``, where the part follows from a row's own columns: a hash bucket of its entity
(:func:`keyed_table`) or the day of its event (:func:`daily_table`). A change replaces whole parts and leaves the files
of all others alone, so what it writes follows the parts that it touches and not the table.

A change is a *step* with a name of the caller's choice, and safe to repeat. Its rows are written to
``path.steps/<step>`` first and then marked as whole; only then are the table's parts replaced from there, and the step
is marked as done. A step that is run again does nothing if it is done, replaces the parts again from its own stored
rows if they are whole (an attempt may have been lost while it replaced them), and begins anew otherwise. While parts
are replaced, readers may see some of them new and others old. Steps of one table must not run at the same time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histora.functions.exprs import entity_bucket

PART = "_part"


@dataclass(frozen=True)
class StoredTable:
    """``part`` gives the part of a row from its columns; ``kind`` is the part's SQL type."""

    path: str
    part: Callable[[], Column]
    kind: str

    def with_part(self, df: DataFrame) -> DataFrame:
        return df.withColumn(PART, self.part().cast(self.kind))

    def write(self, df: DataFrame) -> None:
        """The whole table anew."""
        (self.with_part(df).hint("rebalance", PART).write.mode("overwrite")
         .option("partitionOverwriteMode", "static").partitionBy(PART).parquet(self.path))
        try:
            df.sparkSession.read.parquet(self.path)
        except AnalysisException:       # no row, hence no file that tells the columns
            self._empty(df, "0" if self.kind == "int" else "0001-01-01")

    def _empty(self, df: DataFrame, part) -> None:
        df.drop(PART).limit(0).write.mode("overwrite").parquet(f"{self.path}/{PART}={part}")

    def read(self, spark: SparkSession, parts: list | None = None) -> DataFrame:
        """The table with its ``_part`` column; with ``parts``, only those are read (a partition filter)."""
        found = spark.read.parquet(self.path)
        found = found.withColumn(PART, F.col(PART).cast(self.kind)) if found.schema[PART].dataType.simpleString() \
            != self.kind else found
        return found if parts is None else found.where(F.col(PART).isin(list(parts)))

    def parts_of(self, rows: DataFrame) -> list:
        """The parts of the rows: at most the table's buckets, or the days that the rows span."""
        return sorted(r[0] for r in self.with_part(rows).select(PART).distinct().collect())

    # -- steps -----------------------------------------------------------------------------------
    def _mark(self, spark: SparkSession, step: str, state: str) -> str:
        return f"{self.path}.steps/{step}.{state}"

    def _marked(self, spark: SparkSession, step: str, state: str) -> list | None:
        """The parts that the mark lists; None if the step has no such mark."""
        try:
            rows = spark.read.schema(f"part {self.kind}, listed boolean").parquet(self._mark(spark, step, state)).collect()
        except AnalysisException:
            return None
        return [r["part"] for r in rows if r["listed"]] if rows else None

    def _set_mark(self, spark: SparkSession, step: str, state: str, parts: list) -> None:
        rows = [(p, True) for p in parts] + [(None, False)]     # never empty: an empty mark is no mark
        (spark.createDataFrame(rows, f"part {self.kind}, listed boolean").coalesce(1)
         .write.mode("overwrite").parquet(self._mark(spark, step, state)))

    def done(self, spark: SparkSession, step: str) -> bool:
        return self._marked(spark, step, "done") is not None

    def resume(self, spark: SparkSession, step: str) -> bool:
        """True if the step is done, if need be by replacing its parts again from its stored rows."""
        if self.done(spark, step):
            return True
        parts = self._marked(spark, step, "whole")
        if parts is None:
            return False
        self._apply(spark, step, parts)
        return True

    def replace(self, step: str, parts: list, rows: DataFrame) -> None:
        """Replace ``parts`` by ``rows``, which must hold all rows that these parts shall have."""
        spark = rows.sparkSession
        if self.resume(spark, step):
            return
        self.with_part(rows.drop(PART)).hint("rebalance", PART).write.mode("overwrite").parquet(
            f"{self.path}.steps/{step}.rows")
        self._set_mark(spark, step, "whole", parts)
        self._apply(spark, step, parts)

    def _apply(self, spark: SparkSession, step: str, parts: list) -> None:
        rows = spark.read.parquet(f"{self.path}.steps/{step}.rows")
        (rows.hint("rebalance", PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(PART).parquet(self.path))
        # a dynamic overwrite leaves a part alone that has no row any more
        left = {r[0] for r in rows.select(PART).distinct().collect()}
        for part in sorted(set(parts) - left):
            self._empty(rows, part)
        self._set_mark(spark, step, "done", parts)


def keyed_table(path: str, key: str, buckets: int = 64) -> StoredTable:
    """Parts are ``buckets`` hash buckets of ``key``; all rows of a key lie in one."""
    return StoredTable(path, lambda: entity_bucket(key, buckets), "int")


def daily_table(path: str, at: str) -> StoredTable:
    """Parts are the days of the time ``at``; rows without a time lie under the day 0001-01-01."""
    return StoredTable(path, lambda: F.coalesce(F.to_date(at), F.lit("0001-01-01").cast("date")), "date")

"""Late-arrival repair as a Structured Streaming job.

New change-log files land in a folder; a file-source stream hands each micro-batch to ``foreachBatch``.
The batch's distinct entities *are* the affected set, so no high-water mark is needed and a delivery
whose arrival time ties the old mark is still seen (unlike the batch form, S11). No event-time
watermark is set: a watermark would drop exactly the late rows the repair exists for.

Per micro-batch:

1. the staged batch is stored once in the change log under ``batch=<id>``, dealt into the entity buckets of the
   dimension; a retried batch overwrites exactly its own earlier attempt (``foreachBatch`` is at-least-once) and
   nothing else. All that follows reads the stored batch, so the stream's source is evaluated once;
2. only the log's buckets that the batch touches are read, in all batches, and the affected entities rebuilt;
3. only these buckets of the dimension are replaced, as the step ``batch-<id>`` of the stored table: a batch that was
   lost at any point, also between its log and its table, is finished or repeated by its retry with the same result.

So what a batch reads and writes follows the buckets of its entities. After all batches the dimension equals a full
rebuild over everything that landed. The tables belong to the stream's checkpoint: batch ids count on from it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from histora.operators.incremental import rebuild_entities, rebuild_tail
from histora.operators.staging import stage_changes
from histora.sources.readers import TS_FORMAT
from histora.sources.stored import PART, StoredTable, keyed_table
from histora.spec import CDC_SCHEMA, DEFAULT_SPEC, ChangeLogSpec


@dataclass
class RepairStreamTables:
    log_path: str          # stored, staged change log: batch=<id>/_part=<bucket>
    dim_path: str          # the repaired Type 2 dimension: _part=<bucket>
    key: str = DEFAULT_SPEC.entity
    buckets: int = 64

    @property
    def dim(self) -> StoredTable:
        return keyed_table(self.dim_path, self.key, self.buckets)

    def read_dim(self, spark: SparkSession) -> DataFrame:
        return self.dim.read(spark).drop(PART)

    def log_of(self, spark: SparkSession, columns: str, parts: list, batch_id: int) -> DataFrame:
        """The stored log of some buckets up to a batch: ``PartitionFilters`` on both."""
        log = (spark.read.option("basePath", self.log_path).schema(f"{columns}, batch bigint, {PART} int")
               .parquet(self.log_path))
        return log.where((F.col("batch") <= batch_id) & F.col(PART).isin(parts)).drop("batch", PART)


def _process_batch(spark: SparkSession, tables: RepairStreamTables, spec: ChangeLogSpec, batch: DataFrame,
                   batch_id: int, tail: bool = False) -> None:
    s, step, dim = spec, f"batch-{batch_id}", tables.dim
    if dim.resume(spark, step):
        return
    here = f"{tables.log_path}/batch={batch_id}"
    dim.with_part(stage_changes(batch, s)).write.mode("overwrite").partitionBy(PART).parquet(here)
    new = spark.read.parquet(here).drop(PART)
    affected = new.select(s.entity).distinct()
    parts = dim.parts_of(affected)
    scoped = tables.log_of(spark, _ddl(new), parts, batch_id).join(affected, s.entity, "left_semi")
    if batch_id == 0:
        dim.replace(step, parts, rebuild_entities(scoped, affected, s))
        return
    stored = dim.read(spark, parts).drop(PART)
    kept = stored.join(affected, s.entity, "left_anti")
    if tail:
        rebuilt = rebuild_tail(stored.join(affected, s.entity, "left_semi"), scoped, new, s)
    else:
        rebuilt = rebuild_entities(scoped, affected, s)
    dim.replace(step, parts, rebuilt.unionByName(kept))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def start_repair_stream(spark: SparkSession, landing_path: str, tables: RepairStreamTables,
                        checkpoint_path: str, spec: ChangeLogSpec = DEFAULT_SPEC,
                        schema: T.StructType = CDC_SCHEMA, fmt: str = "parquet",
                        available_now: bool = True, max_files_per_trigger: int | None = None, tail: bool = False) -> StreamingQuery:
    """Start the repair stream over ``landing_path``; ``checkpoint_path`` must be on shared storage.

    ``tail=True`` rebuilds only the part of each affected history the batch can change (see
    :func:`histora.operators.incremental.rebuild_tail`; contract: re-deliveries keep entity and source time).
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("mode", "FAILFAST").option(
            "timestampNTZFormat", TS_FORMAT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(landing_path)
    writer = (stream.writeStream
              .foreachBatch(lambda df, bid: _process_batch(df.sparkSession, tables, spec, df, bid,
                                                           tail))
              .option("checkpointLocation", checkpoint_path))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()

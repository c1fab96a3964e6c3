"""Scaling runs on a replicated change log (not part of the driver's bench).

The derived log of $BENCH_SF_DIR is replicated $SCALE_X times with offset entity ids and change ids
(a generator, no join). ``SCALE_HOT=1`` maps the first third of the copies onto ONE entity, so a single
key holds a third of all rows. Each query runs to completion through the ``noop`` sink.
Prints one JSON line per configuration.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from histora.operators import (  # noqa: E402
    affected_entities, build_scd2, deduplicate_changes, overlap_violations, point_in_time_join,
    repair_scd2, repair_scd2_tail, stage_changes, stage_events,
)
from histora.sources import derived_change_log, derived_facts  # noqa: E402

OFFSET = 1_000_000


def replicate(df, k: int, hot: bool, id_col: str, id_is_string: bool):
    rep = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_rep")
    out = df.select("*", rep)
    entity = F.col("customer_id") + F.col("_rep") * F.lit(OFFSET)
    if hot:
        entity = F.when(F.col("_rep") < F.lit(max(1, k // 3)), F.lit(0)).otherwise(entity)
    new_id = (F.concat(F.col(id_col), F.lit("_r"), F.col("_rep").cast("string")) if id_is_string
              else F.col(id_col) + F.col("_rep") * F.lit(10_000_000_000))
    return out.withColumn("customer_id", entity.cast("int")).withColumn(id_col, new_id).drop("_rep")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    k = int(os.environ.get("SCALE_X", "20"))
    hot = os.environ.get("SCALE_HOT", "0") == "1"
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("histora-scale")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", str(int(cpus) * 4))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "24g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("SCALE_SPLIT", "1") == "1":
        # this data is far below the 256 MB size check: force the heavy-hitter path so it is measured
        spark.conf.set("spark.histora.hotCheckMinBytes", "0")
        spark.conf.set("spark.histora.hotEntityRows", os.environ.get("SCALE_HOT_ROWS", "100000"))
        spark.conf.set("spark.histora.hotChunkRows", os.environ.get("SCALE_CHUNK_ROWS", "200000"))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="histora-scale-"))

    log = replicate(derived_change_log(spark, sf_dir), k, hot, "change_id", True)
    facts = stage_events(replicate(derived_facts(spark, sf_dir), k, hot, "event_id", False))
    staged = stage_changes(log)
    t1 = stage_changes(log, ingest_cutoff="2024-01-15 00:00:00")
    t2 = stage_changes(log, ingest_cutoff="2024-01-15 06:00:00")

    def dim(st, order="source"):
        return build_scd2(deduplicate_changes(st), st, order=order)

    runs = {
        "scd2_full": lambda: dim(staged),
        "scd2_incremental_small": lambda: repair_scd2(dim(t1), t2, affected=affected_entities(t2, dim(t1))),
        "scd2_incremental_all": lambda: repair_scd2(dim(t1), staged, affected=affected_entities(staged, dim(t1))),
        "scd2_incremental_tail_small": lambda: repair_scd2_tail(dim(t1), t2),
        "pit_range": lambda: point_in_time_join(facts, dim(staged), strategy="range"),
        "pit_asof": lambda: point_in_time_join(facts, dim(staged), strategy="asof"),
        "overlap_violations_ingest_order": lambda: overlap_violations(dim(staged, "ingest")),
    }
    only = os.environ.get("SCALE_QUERIES")
    times = {}
    for name, fn in runs.items():
        if only and name not in only.split(","):
            continue
        t0 = time.perf_counter()
        fn().write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 2)
        print(name, times[name], file=sys.stderr, flush=True)
    rows = staged.count()
    print(json.dumps({"metric": "scale_total_sec", "value": round(sum(times.values()), 2), "unit": "sec",
                      "replicas": k, "hot_entity": hot, "split": os.environ.get("SCALE_SPLIT", "1") == "1",
                      "deliveries": rows, "queries": times}))
    spark.stop()


if __name__ == "__main__":
    main()

"""All layers of the change-log warehouse, each computed and written once, with its declared tests.

What a row alone decides (NULLs in not-null columns, closed windows out of order) is counted while its layer is
written, by ``DataFrame.observe``: no second read. What takes several rows (unique keys, accepted values, overlaps, one
current record) is counted from the stored layer. The next layer reads the stored one before it, so nothing is computed
twice, whatever the number of tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from histora.operators.changes import LAST_ARRIVAL, deduplicate_changes, sequence_changes
from histora.operators.pit import point_in_time_join
from histora.operators.quality import declared_check_list, declared_checks, validate
from histora.operators.scd2 import build_scd2
from histora.operators.staging import stage_changes, stage_events
from histora.session import work_path

_OBSERVED = ("not_null", "closed_intervals_ordered")


class Layers:
    """Stored layers by name, and what was observed while they were written (test name to violations)."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.frames: dict[str, DataFrame] = {}
        self.observed: dict[str, int] = {}

    def store(self, name: str, df: DataFrame, tested: tuple[str, ...] | None = None) -> DataFrame:
        """Write ``df`` once; ``tested`` names the layers whose declared tests it answers (by default its own)."""
        metrics = {}
        for check, layer, kind, column in declared_check_list():
            if layer in (tested or (name,)) and kind in _OBSERVED:
                bad = F.col(column).isNull() if kind == "not_null" else F.col("valid_from") >= F.col("valid_to")
                metrics[check] = F.coalesce(F.count_if(bad), F.lit(0)).cast("long")
        path, seen = work_path(self.spark, f"layer-{name}"), Observation(f"layer-{name}")
        watched = df.observe(seen, *[c.alias(f"m{i}") for i, c in enumerate(metrics.values())]) if metrics else df
        watched.write.parquet(path)
        if metrics:
            found = seen.get
            self.observed.update((check, found[f"m{i}"]) for i, check in enumerate(metrics))
        stored = self.spark.read.schema(df.schema).parquet(path)
        for layer in tested or (name,):
            self.frames[layer] = stored
        return stored


def store_layers(spark: SparkSession, raw_log: DataFrame, raw_events: DataFrame) -> Layers:
    """Staging, events, facts, changes, sequence, dimension and serving view, stored in this order."""
    out = Layers(spark)
    staged = out.store("staging", stage_changes(raw_log))
    facts = out.store("events", stage_events(raw_events), ("events", "facts"))
    changes = out.store("changes", deduplicate_changes(staged, last_arrival=True))
    out.store("sequence", sequence_changes(changes.drop(LAST_ARRIVAL)))
    dim = out.store("dimension", build_scd2(changes, staged))
    out.store("serving", point_in_time_join(facts, dim))
    return out


def validate_layers(layers: Layers) -> DataFrame:
    """(check_name, violations, passed) of every declared test, observed or counted from the stored layers."""
    observed = layers.spark.createDataFrame(sorted(layers.observed.items()), "check_name string, violations long")
    rest = {n: df for n, df in declared_checks(layers.frames).items() if n not in layers.observed}
    return (validate(rest).select("check_name", "violations").unionByName(observed)
            .withColumn("passed", F.col("violations") == 0))

"""Command line: the three workflows of a change-log warehouse, as Spark jobs over stored tables.

    python -m histora build  --log LOG --events EVENTS --out DIR [--format csv|parquet] [--ingest-cutoff TS]
                             [--order source|ingest]
    python -m histora repair --log LOG [--events EVENTS] --out DIR [--format ...] [--ingest-cutoff TS]
    python -m histora check  --log LOG --out DIR [--format ...] [--ingest-cutoff TS]

``build`` is the full refresh: stage, dedup, SCD2 and facts, written as new versions of ``dim``, ``facts`` and
``enriched`` under DIR. ``repair`` rebuilds the entities with deliveries after the stored high-water mark, adds the
facts of EVENTS whose ids are new or changed, and enriches again only the events that are new or whose entity was
rebuilt; each table gets its next version. ``check`` runs the declared tests of every layer and exits
non-zero when one fails. DIR should be on storage shared by all executors.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from histora.operators import (
    affected_entities, append_facts, build_scd2, deduplicate_changes, point_in_time_join, repair_scd2, sequence_changes,
    stage_changes, stage_events,
)
from histora.operators.quality import validate_declared
from histora.sources import read_change_log, read_events
from histora.sources.versions import latest_version, read_version, write_version


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="histora")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("build", "repair", "check"):
        s = sub.add_parser(name)
        s.add_argument("--log", required=True)
        s.add_argument("--out", required=True)
        s.add_argument("--format", default="csv", choices=("csv", "parquet"))
        s.add_argument("--ingest-cutoff", default=None)
        if name != "check":
            s.add_argument("--order", default="source", choices=("source", "ingest"))
            s.add_argument("--events", required=name == "build")
    return p


def build(spark: SparkSession, log: str, events: str, out: str, fmt: str = "csv", ingest_cutoff=None,
          order: str = "source") -> int:
    version = (latest_version(spark, f"{out}/dim") or 0) + 1
    staged = stage_changes(read_change_log(spark, log, fmt), ingest_cutoff=ingest_cutoff)
    write_version(build_scd2(deduplicate_changes(staged), staged, order=order), f"{out}/dim", version)
    write_version(stage_events(read_events(spark, events, fmt)), f"{out}/facts", version)
    dim, facts = (read_version(spark, f"{out}/{t}", version) for t in ("dim", "facts"))
    return write_version(point_in_time_join(facts, dim), f"{out}/enriched", version)


def repair(spark: SparkSession, log: str, out: str, fmt: str = "csv", ingest_cutoff=None,
           order: str = "source", events: str | None = None) -> int:
    last = latest_version(spark, f"{out}/dim")
    dim, facts, enriched = (read_version(spark, f"{out}/{t}", last) for t in ("dim", "facts", "enriched"))
    staged = stage_changes(read_change_log(spark, log, fmt), ingest_cutoff=ingest_cutoff)
    affected = affected_entities(staged, dim)
    write_version(repair_scd2(dim, staged, affected=affected, order=order), f"{out}/dim", last + 1)
    dim = read_version(spark, f"{out}/dim", last + 1)
    changed = facts.limit(0)
    if events:
        given = stage_events(read_events(spark, events, fmt))
        changed = given.exceptAll(facts)
        facts = append_facts(facts, changed)
    write_version(facts, f"{out}/facts", last + 1)
    facts = read_version(spark, f"{out}/facts", last + 1)
    redo = (facts.join(affected, "customer_id", "left_semi").select("event_id")
            .unionByName(changed.select("event_id")).distinct())
    again = point_in_time_join(facts.join(redo, "event_id", "left_semi"), dim)
    return write_version(enriched.join(redo, "event_id", "left_anti").unionByName(again), f"{out}/enriched", last + 1)


def check(spark: SparkSession, log: str, out: str, fmt: str = "csv", ingest_cutoff=None) -> bool:
    staged = stage_changes(read_change_log(spark, log, fmt), ingest_cutoff=ingest_cutoff)
    changes = deduplicate_changes(staged)
    dim, facts, enriched = (read_version(spark, f"{out}/{t}") for t in ("dim", "facts", "enriched"))
    res = validate_declared({"staging": staged, "events": facts, "changes": changes,
                             "sequence": sequence_changes(changes, hot_source=staged), "dimension": dim,
                             "facts": facts, "serving": enriched}).collect()
    for r in res:
        print(f"{r.check_name:45s} {'PASS' if r.passed else 'FAIL'} {r.violations}")
    return all(r.passed for r in res)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"histora-{args.cmd}").getOrCreate()
    if args.cmd == "build":
        build(spark, args.log, args.events, args.out, args.format, args.ingest_cutoff, args.order)
        return 0
    if args.cmd == "repair":
        repair(spark, args.log, args.out, args.format, args.ingest_cutoff, args.order, args.events)
        return 0
    return 0 if check(spark, args.log, args.out, args.format, args.ingest_cutoff) else 1


if __name__ == "__main__":
    sys.exit(main())

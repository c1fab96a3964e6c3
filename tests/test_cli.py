"""The command-line workflows: build at T1, repair, check; a defect build fails the checks."""

from __future__ import annotations

import uuid

from histora.__main__ import main
from histora.session import checkpoint_dir
from histora.sources.versions import read_version
from tests.fixtures_data import EVENTS_42, EXPECTED_42, EXPECTED_42_AFTER_T1, EXPECTED_42_ENRICHED, SCRIPTED_LOG_CSV, T1_CUTOFF
from tests.helpers import intervals


def _inputs(tmp_path):
    log = tmp_path / "customer_cdc_log.csv"
    log.write_text(SCRIPTED_LOG_CSV)
    ev = tmp_path / "customer_activity_events.csv"
    ev.write_text("event_id,customer_id,event_name,event_timestamp\n"
                  + "".join(f"{a},{b},{c},{d}\n" for a, b, c, d in EVENTS_42))
    return str(log), str(ev)


def test_build_repair_check(spark, tmp_path):
    log, ev = _inputs(tmp_path)
    out = f"{checkpoint_dir(spark)}/cli-{uuid.uuid4().hex}"
    assert main(["build", "--log", log, "--events", ev, "--out", out, "--ingest-cutoff", T1_CUTOFF], spark) == 0
    assert intervals(read_version(spark, f"{out}/dim"), 42) == EXPECTED_42_AFTER_T1
    assert main(["repair", "--log", log, "--out", out], spark) == 0
    assert intervals(read_version(spark, f"{out}/dim"), 42) == EXPECTED_42
    assert main(["check", "--log", log, "--out", out], spark) == 0
    enriched = {r.event_id: r.source_change_id for r in read_version(spark, f"{out}/enriched").collect()}
    assert enriched == {k: (v[4] if v else None) for k, v in EXPECTED_42_ENRICHED.items()}


def test_defect_build_fails_checks(spark, tmp_path):
    log, ev = _inputs(tmp_path)
    out = f"{checkpoint_dir(spark)}/cli-{uuid.uuid4().hex}"
    assert main(["build", "--log", log, "--events", ev, "--out", out, "--order", "ingest"], spark) == 0
    assert main(["check", "--log", log, "--out", out], spark) == 1


def test_repair_appends_facts_and_enriches_them(spark, tmp_path):
    log, ev = _inputs(tmp_path)
    out = f"{checkpoint_dir(spark)}/cli-{uuid.uuid4().hex}"
    few = tmp_path / "few.csv"
    few.write_text("".join(open(ev).readlines()[:3]))
    main(["build", "--log", log, "--events", str(few), "--out", out, "--ingest-cutoff", T1_CUTOFF], spark)
    assert read_version(spark, f"{out}/facts").count() == 2
    main(["repair", "--log", log, "--events", ev, "--out", out], spark)
    enriched = {r.event_id: r.source_change_id for r in read_version(spark, f"{out}/enriched").collect()}
    assert enriched == {k: (v[4] if v else None) for k, v in EXPECTED_42_ENRICHED.items()}
    assert read_version(spark, f"{out}/facts").count() == len(EVENTS_42)

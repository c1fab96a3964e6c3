from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from histora.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("4", shuffle_partitions=4, app="histora-tests",
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="histora-warehouse-")})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="histora-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def scripted_log(spark, tmp_path_factory):
    from histora.sources import read_change_log
    from tests.fixtures_data import SCRIPTED_LOG_CSV
    p = tmp_path_factory.mktemp("log") / "customer_cdc_log.csv"
    p.write_text(SCRIPTED_LOG_CSV)
    return read_change_log(spark, str(p)).cache()


@pytest.fixture
def split_all(spark):
    """Run a test with every entity split into time chunks (exercises the hot-entity path)."""
    from histora.plans.ordered import HOT_ROWS_CONF
    spark.conf.set(HOT_ROWS_CONF, "0")
    yield
    spark.conf.unset(HOT_ROWS_CONF)

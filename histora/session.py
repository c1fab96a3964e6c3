"""Session helpers: local test sessions and the shared work folder.

Library code never picks a machine-local folder on a cluster: anything that must outlive a task
(versioned tables, stream checkpoints, cut lineage) goes under ``spark.checkpoint.dir``. Only when that
setting is absent *and* the master is local (tests, laptop runs) is a temporary folder created and
registered as the checkpoint dir.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "histora",
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for durable intermediate data (``spark.checkpoint.dir``)."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not conf:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            return current
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        conf = tempfile.mkdtemp(prefix="histora-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", conf)
        except Exception:  # a session may refuse core settings at run time; the context setting suffices
            pass
    spark.sparkContext.setCheckpointDir(conf)
    return conf.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name under the shared checkpoint dir."""
    base = checkpoint_dir(spark)
    return f"{base}/histora/{name}-{uuid.uuid4().hex[:12]}"

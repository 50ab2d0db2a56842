"""Spark session helpers.

The library never creates a cluster session itself in production code paths;
``get_spark`` is for tests, the bench and local runs. ``ensure_checkpoint_dir``
reads ``spark.checkpoint.dir`` from the session and only falls back to a local
scratch folder when the setting is absent (local runs / tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8, app: str = "tspanel",
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    builder = builder.master(master or os.environ.get("TSPANEL_MASTER", "local[8]"))
    conf = dict(SESSION_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_session_conf(spark)
    return spark


def apply_session_conf(spark: SparkSession) -> None:
    """Settings the library semantics rely on (naive UTC timestamps)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def materialize(df):
    """Write ``df`` once to the shared checkpoint folder (reliable checkpoint)
    and return the re-readable result, so plans that reference it in several
    branches do not recompute — or rescan — its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="tspanel-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return configured

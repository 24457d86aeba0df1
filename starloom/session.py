"""Session construction and shared-storage locations.

On a cluster the checkpoint directory (``spark.checkpoint.dir``) names a
shared folder every executor can reach.  Lineage cuts and materialised
tables are written below it.  A private fallback is created only when the
session has none configured (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings we rely on for every job: AQE re-plans joins and
# partition counts from runtime statistics, skew-join splitting handles hot
# keys on the join side, UTC keeps date arithmetic timezone-free.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", app: str = "starloom",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and written tables.

    Reads ``spark.checkpoint.dir`` from the session.  Only when it is unset
    in a local run (as in tests) a private folder is created and registered;
    on a cluster an unset folder is an error, since executors share no local one.
    """
    sc = spark.sparkContext
    configured = sc.getCheckpointDir()
    if not configured:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured:
            sc.setCheckpointDir(configured)
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="starloom-ckpt-")
        sc.setCheckpointDir(configured)
        configured = sc.getCheckpointDir() or configured
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path below the checkpoint root."""
    root = checkpoint_root(spark)
    return os.path.join(root, "tables", f"{name}-{uuid.uuid4().hex[:12]}")

"""Session construction and lineage cutting.

Everything in the library takes a ``SparkSession`` from the caller; this module only
offers a builder with sensible defaults for local runs and tests, and a helper that
materialises a DataFrame under the cluster's shared checkpoint folder.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "zonecast", extra: dict | None = None) -> SparkSession:
    """Session with AQE on, UTC session time zone and the UI off."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("ZONECAST_DRIVER_MEMORY", "8g"),
    }
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is only read. Only when it is
    unset in a single-process local session (tests) a fresh scratch folder is set; elsewhere
    that is an error, since executors would each write to a disk of their own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[.*\])?$", sc.master):
            raise ValueError("set spark.checkpoint.dir to storage that all executors share")
        configured = tempfile.mkdtemp(prefix="zonecast-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def materialize(df: DataFrame, name: str | None = None) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Cuts lineage (a lost executor recomputes from the written files, not from the raw
    scan) and gives the optimizer real statistics for what follows.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/tables/{name or 'table'}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (for sinks used by queries)."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/scratch/{name}-{uuid.uuid4().hex}"

"""Session defaults and the shared scratch location.

Nothing here hard-codes cluster paths: the shared folder is whatever the
cluster configured as ``spark.checkpoint.dir``.  Only when that is unset
(local tests) do we create one of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults that matter at scale: AQE re-plans joins and coalesces shuffle
# partitions at runtime, skew-join splits hot keys, UTC pins time semantics.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Partition sizing: ~128 MB scan splits and shuffle partitions, so a task
    # holds a bounded slice whatever the data size; AQE coalesces small ones
    # and splits skewed ones (> 5x median and > 256 MB).
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    # Arrow batches to Python tasks capped by bytes, not only rows: a batch of
    # 256 x 256 tiles stays ~64 MB instead of 10 000 tiles.
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "gridsmith", extra: dict | None = None) -> SparkSession:
    """A session with the library's defaults.  Without ``master`` and ``shuffle_partitions`` the cluster's (or
    spark-submit's) own settings hold; plain Python then runs on local[*]."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared checkpoint location.

    Reads ``spark.checkpoint.dir`` from the session (or a checkpoint dir set
    on the context); only when neither exists (local runs) do we create one
    and register it with ``setCheckpointDir`` — ``spark.checkpoint.dir`` is a
    core setting and cannot be changed at runtime.  Each call returns a new
    unique sub-folder so runs never clean up or overwrite each other.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and sc.getCheckpointDir():
        base = os.path.dirname(sc.getCheckpointDir().rstrip("/"))
    if not base and (spark.conf.get("spark.master", None) or sc.master).split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not base:
        base = tempfile.mkdtemp(prefix="gridsmith-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return "/".join([base.rstrip("/"), *parts, uuid.uuid4().hex])


def cut_lineage(df, spark: SparkSession | None = None):
    """Reliable checkpoint (survives executor loss); never localCheckpoint."""
    spark = spark or df.sparkSession
    shared_dir(spark)  # makes sure a checkpoint dir is set
    return df.checkpoint(eager=True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")

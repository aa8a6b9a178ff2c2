"""Session defaults and the shared scratch location.

Only SQL confs that can be changed at runtime are touched by
``configure``; cluster sizing (executors, memory, shuffle partitions)
belongs to whoever submits the job.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_DEFAULTS = {
    # Naive sensor wall-clock is published as UTC; keep the session in UTC so
    # no conversion happens on the way.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Month partitions are rewritten one by one (late corrections, reloads).
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "sensorlake") -> SparkSession:
    """Session for tests and local runs; on a cluster use the submitted one."""
    builder = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("SENSORLAKE_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a path every executor
    sees), else this raises. Only a local master without it -- tests -- gets
    a folder made here.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        try:
            path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        except Exception:   # Spark Connect: no SparkContext, the conf is all there is
            path = None
    if not path:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="sensorlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    try:
        spark.sparkContext.setCheckpointDir(path)
    except Exception:
        pass
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/sensorlake-scratch/{name}-{uuid.uuid4().hex}"


def materialize(df):
    """Cut the lineage of a frame that several branches of a plan read.

    Writes it once to the shared checkpoint folder (``spark.checkpoint.dir``,
    survives executor loss) and returns a frame backed by those files; the
    physical partitioning is kept, so later joins/aggregations on the same
    keys add no exchange.
    """
    from pyspark import StorageLevel
    checkpoint_dir(df.sparkSession)
    # persisted first, or writing the checkpoint would compute the frame a second time
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist(blocking=False)
    return out

"""Session defaults shared by the library, the tests and the bench.

Only settings a Spark user would set themselves: UTC session zone (naive timestamps must
not shift), AQE with skew-join splitting, Arrow for the few pandas hand-offs. Cluster
settings that already exist on the session (master, checkpoint dir, shuffle partitions)
are never overwritten.
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
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "aerolytics") -> SparkSession:
    """Return the active session (or build a local one) with the library defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor (no effect on a running JVM)
        builder = builder.config("spark.driver.memory", os.environ.get("AEROLYTICS_DRIVER_MEMORY", "8g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in SESSION_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; set a scratch one only if unset.

    Iterative operators (density clustering) cut their lineage with ``checkpoint()`` into
    this folder, so lost executors never force a recomputation from the first iteration.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, object store)")
        # local mode only (tests): a cluster names a shared folder in its conf
        configured = tempfile.mkdtemp(prefix="aerolytics-ckpt-", dir=os.environ.get("TMPDIR"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()

"""Session defaults shared by jobs, tests and the bench."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job needs for repeatable results.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    # Template call parameters: the last assignment of a name wins.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Spark 4.1 takes a union of equally bucketed scans for partitioned by key, which it is not.
    "spark.sql.unionOutputPartitioning": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "quarry") -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    On a cluster the master and partition counts come from spark-submit;
    the arguments are only for local runs and tests.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "8g"))
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    for key, value in SESSION_DEFAULTS.items():
        if not key.startswith("spark.ui") and not key.startswith("spark.sql.execution.arrow"):
            spark.conf.set(key, value)
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, for shuffles whose rows compress too well to be joined by size."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session; only a local master, whose
    one machine is the whole cluster, gets a scratch folder when it is unset.
    """
    sc = spark.sparkContext
    configured = (spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
                  or sc.getCheckpointDir())
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="quarry-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()

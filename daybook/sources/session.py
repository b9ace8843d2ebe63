"""Session configuration and the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Defaults a job sets on its own session. Sizes are for a large cluster; local runs
# override the partition count.
DEFAULT_CONF: dict[str, str] = {
    # Many initial shuffle partitions; AQE coalesces them to ~advisory size at run time.
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # Iterative jobs (connected components) checkpoint every round; let the cleaner
    # delete a round's files once nothing references it.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.checkpoint.compress": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Joins decide broadcast by measured size; 64 MB keeps the build side small
    # relative to executor memory even when statistics are estimates.
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "daybook", master: str | None = None,
                  conf: dict[str, str] | None = None, hive: bool = False,
                  warehouse_dir: str | None = None) -> SparkSession:
    """Session helper: app name, optional master, a config map, optional catalog
    support and warehouse folder. On a cluster leave ``master`` unset so spark-submit
    decides."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    if warehouse_dir:
        b = b.config("spark.sql.warehouse.dir", warehouse_dir)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        b = b.config(k, v)
    if hive:
        b = b.enableHiveSupport()
    return b.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder for lineage cuts.

    Reads ``spark.checkpoint.dir`` (or a folder already set on the context). Only a
    session of one process (``local[n]``) without one gets a fresh scratch folder; on a
    cluster, a local one of several processes included, an unset folder is an error,
    because executors don't share a machine's folders and these don't survive their loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not re.match(r"local(\[|$)", sc.master):
        raise ValueError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) "
                         "before running iterative jobs on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="daybook-ckpt-"))
    return sc.getCheckpointDir()

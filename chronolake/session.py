"""Spark session defaults and the shared working folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only what was measured: no static (estimate-based) broadcast joins; AQE
    # converts a join to broadcast once the finished shuffle stage proves the side small.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
    # Target size of AQE-coalesced and skew-split shuffle partitions.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(
    app_name: str = "chronolake",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings the pipeline assumes.

    On a cluster ``master`` stays unset (spark-submit decides) and ``shuffle_partitions``
    should be sized so one shuffle partition is ~128 MB of the largest increment.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    The setting is read from the session. Unset, it is an error on a cluster, whose executors
    see no folder that the driver could choose; with a ``local`` master, where all run in one
    process, ``chronolake-checkpoints`` under the warehouse folder is used.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set: it must name a folder that driver and executors share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/chronolake-checkpoints"
        sc.setCheckpointDir(base)
    base = re.sub("^file:/(?!/)", "file:///", base)
    # Nothing is created here: Spark's writers create the folder on the shared file system.
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"

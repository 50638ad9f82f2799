"""Session helpers: configuration, shared scratch folder, lineage cuts."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

_TEST_CHECKPOINT_ROOT = "/tmp/fieldstat-checkpoints"


def get_session(master: str | None = None, app: str = "fieldstat",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with ANSI on, AQE on and the UI off.

    On a cluster ``master`` stays None and the launcher decides. Local runs
    pass ``local[N]``; shuffle partitions then default to N.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    if shuffle_partitions is None and master and master.startswith("local["):
        n = master[len("local["):-1]
        shuffle_partitions = os.cpu_count() if n == "*" else int(n)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # Local mode: the driver JVM is the whole cluster.
        conf["spark.driver.memory"] = os.environ.get("FIELDSTAT_DRIVER_MEMORY", "16g")
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder; set one only when none is named.

    The folder comes from ``spark.checkpoint.dir`` (a shared file system on a
    cluster). Only a local session, whose driver is its one executor, falls
    back to a /tmp folder; on a cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    target = spark.conf.get("spark.checkpoint.dir", None)
    if not target:
        if not re.fullmatch(r"local(\[[^,\]]*(,\d+)?\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        target = _TEST_CHECKPOINT_ROOT
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for written intermediate tables under the checkpoint root."""
    root = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    root = root.rstrip("/")
    return f"{root}/fieldstat/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder.

    Survives executor loss (unlike a local checkpoint) and fixes values that
    depend on partitioning, so that several branches of one plan see the same
    rows.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)

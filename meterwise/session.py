"""Session construction and the shared scratch folder."""

from __future__ import annotations

import logging
import os
import re
import tempfile

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

# Defaults applied only where the cluster has not set a value itself.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "meterwise") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    # an existing session keeps its own values; only unset SQL settings are filled in
    for key, value in DEFAULT_CONF.items():
        if key.startswith("spark.sql.") and spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when it is unset on a local master (local runs, tests) is a local folder
    created and set. Executors of a cluster do not see each other's local disks,
    so there an unset folder is an error."""
    sc = spark.sparkContext
    configured = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("spark.checkpoint.dir is unset: name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="meterwise-ckpt-")
    log.warning("spark.checkpoint.dir is unset; using local %s", local)
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, *parts: str) -> str:
    return "/".join([checkpoint_dir(spark), *parts])


def unique_scratch(spark: SparkSession, prefix: str) -> str:
    """A fresh path under the shared folder, never reused between calls."""
    import uuid
    return scratch_path(spark, f"{prefix}-{os.getpid()}-{uuid.uuid4().hex[:12]}")

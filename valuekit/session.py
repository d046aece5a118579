"""Session helpers for tests, the bench and the command-line jobs.

Library operators never build a session or set configuration; only the entry
points in ``plans.cli``, ``bench.py`` and the tests call :func:`local_session`.
On a cluster the submitter owns the configuration (shuffle partitions, AQE,
checkpoint directory) and the jobs read what they find.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "valuekit") -> SparkSession:
    """A local-mode session with AQE on and the web UI off."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("VALUEKIT_DRIVER_MEMORY", "8g"))
    )
    event_dir = os.environ.get("VALUEKIT_EVENT_LOG_DIR")
    if event_dir:  # stage and task timings for profiling, written to a scratch folder
        builder = (builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_dir)
                   .config("spark.eventLog.compress", "false"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint directory the session names, if any."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory. When none is configured, a
    local one is created only in local mode (tests, single-machine runs); on a
    cluster a machine-local folder would be invisible to other executors, so
    the job stops and asks for ``spark.checkpoint.dir`` instead."""
    d = checkpoint_dir(spark)
    if d:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(d)
        return d
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):  # local-cluster has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors "
                           "(needed for staged tables and scratch output)")
    d = tempfile.mkdtemp(prefix="valuekit-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint directory for intermediate
    tables; never a machine-local temp folder when a cluster names one."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"

"""Shuffle sizing for the jobs from the size of their input (spill-aware).

The library sets no configuration. The command-line jobs call
:func:`size_shuffles` once per run. It reads the input's byte size from the
file system's metadata (no data is read) and, only for settings the
submitter did not pass explicitly:

* turns AQE on with partition coalescing and skew-join splitting;
* sets the advisory shuffle partition size (what AQE coalesces towards and
  what a ``rebalance`` write aims for) to ``target_mb``;
* sets ``spark.sql.shuffle.partitions`` to input bytes / ``target_mb``, and at
  least to the cores there are. These are bytes at rest; rows in a shuffle can
  be larger or smaller, so the number is a start that AQE coalesces from;
* sets ``spark.sql.files.maxPartitionBytes`` to ``target_mb`` (Spark's default
  is 128 MB), so one scan task reads about one target partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession


def input_bytes(spark: SparkSession, paths: Sequence[str]) -> int:
    """Total bytes under the paths, from file-system metadata."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            total += fs.getContentSummary(path).getLength()
    return int(total)


def size_shuffles(spark: SparkSession, paths: Sequence[str], target_mb: int = 256) -> dict:
    """Apply the settings above where the submitter left them unset; returns
    what was set."""
    explicit = spark.sparkContext.getConf()
    chosen = {}

    def put(key: str, value: str) -> None:
        if not explicit.contains(key):
            spark.conf.set(key, value)
            chosen[key] = value

    n_bytes = input_bytes(spark, paths)
    target = target_mb * 1024 * 1024
    parts = max(spark.sparkContext.defaultParallelism, -(-n_bytes // target))
    put("spark.sql.adaptive.enabled", "true")
    put("spark.sql.adaptive.coalescePartitions.enabled", "true")
    put("spark.sql.adaptive.skewJoin.enabled", "true")
    put("spark.sql.adaptive.advisoryPartitionSizeInBytes", f"{target_mb}m")
    put("spark.sql.shuffle.partitions", str(parts))
    put("spark.sql.files.maxPartitionBytes", f"{target_mb}m")
    return chosen

"""Publication of a partitioned table (S4, S5): readers see a write whole or not.

A write puts new folders next to the old ones, ``<partition>/version=<id>``,
for the partitions it has rows of. A small pointer file lists the folders that
are current; replacing it is one rename, and the only step readers can see. A
write that dies leaves folders that nothing points to and the previous table
readable; partitions without new rows stay as they were.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER, DATA, VERSION = "current.txt", "data", "version"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def current_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders of the published table, one a partition; none before the
    first publication."""
    jvm, pointer, fs = _fs(spark, f"{path.rstrip('/')}/{POINTER}")
    if not fs.exists(pointer):
        return []
    return [r.value for r in spark.read.text(pointer.toString()).collect()]


def publish(df: DataFrame, path: str, partition_by: Sequence[str]) -> list[str]:
    """Write ``df`` and make its partitions current; returns all current folders.
    One writer at a time."""
    spark, root, version = df.sparkSession, path.rstrip("/"), uuid.uuid4().hex
    out = df.withColumn(VERSION, F.lit(version)).hint("rebalance", *partition_by)
    out.write.mode("append").partitionBy(*partition_by, VERSION).parquet(f"{root}/{DATA}")
    jvm, data, fs = _fs(spark, f"{root}/{DATA}")
    pattern = jvm.org.apache.hadoop.fs.Path(f"{root}/{DATA}/" + "*/" * len(partition_by) + f"{VERSION}={version}")
    base = fs.makeQualified(data).toUri().getPath()
    written = [s.getPath().toUri().getPath()[len(base) + 1:] for s in fs.globStatus(pattern) or []]
    touched = {f.rsplit("/", 1)[0] for f in written}
    folders = sorted([f for f in current_folders(spark, root) if f.rsplit("/", 1)[0] not in touched] + written)

    made = jvm.org.apache.hadoop.fs.Path(f"{root}/.{version}.txt")
    stream = fs.create(made, True)
    stream.write(bytearray("\n".join(folders).encode()))
    stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(made), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{root}/{POINTER}")), how)
    return folders


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The table as the pointer has it when the frame is built."""
    root = path.rstrip("/")
    folders = current_folders(spark, root)
    if not folders:
        raise FileNotFoundError(f"nothing is published at {root}")
    return spark.read.option("basePath", f"{root}/{DATA}").parquet(*[f"{root}/{DATA}/{f}" for f in folders]).drop(VERSION)


def remove_unpublished(spark: SparkSession, path: str) -> int:
    """Delete version folders that the pointer does not name (dead writes and
    replaced partitions); returns their number. Not while others read or write."""
    root = path.rstrip("/")
    folders = set(current_folders(spark, root))
    jvm, data, fs = _fs(spark, f"{root}/{DATA}")
    depth = max((f.count("/") for f in folders), default=1)
    base = fs.makeQualified(data).toUri().getPath()
    found = [s.getPath() for s in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/{DATA}/" + "*/" * depth + f"{VERSION}=*")) or []]
    gone = [p for p in found if p.toUri().getPath()[len(base) + 1:] not in folders]
    for p in gone:
        fs.delete(p, True)
    return len(gone)

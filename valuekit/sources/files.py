"""File sources and sinks.

* CSV is read with an explicit schema (no inference pass), header skipped,
  PERMISSIVE mode: binding is by position, surplus fields are cut, missing
  trailing fields and malformed values become NULL.
* Parquet reads are plain ``spark.read.parquet`` so column pruning and filter
  pushdown reach the scan.
* Writes never ``coalesce`` (that would shrink the parallelism of the whole
  upstream stage); a file-count bound, when asked for, is a ``repartition``
  that keeps the upstream stage wide, and ``max_records_per_file`` bounds file
  size instead.
* Hive-partitioned writes carry a ``rebalance`` hint on the partition columns:
  AQE then sizes the write partitions to the advisory size and splits a
  skewed partition value, instead of every task writing one small file per
  value it happens to hold.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def load_csv(spark: SparkSession, path: str, schema: StructType, **options) -> DataFrame:
    """Header CSV with a fixed schema."""
    reader = spark.read.option("header", "true").option("mode", "PERMISSIVE").schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path)


def load_csv_tables(spark: SparkSession, input_dir: str, tables: Mapping[str, tuple[str, StructType]]) -> dict:
    """S1 for a set of tables: ``{name: (file name, schema)}`` -> ``{name: DataFrame}``."""
    base = input_dir.rstrip("/")
    return {name: load_csv(spark, f"{base}/{fname}", schema) for name, (fname, schema) in tables.items()}


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S3."""
    return spark.read.parquet(path)


def read_parquet_tables(spark: SparkSession, input_dir: str, names: Sequence[str],
                        renames: Mapping[str, Mapping[str, str]] | None = None) -> dict:
    """Several Parquet tables under one directory, with optional renames."""
    base = input_dir.rstrip("/")
    out = {}
    for n in names:
        df = spark.read.parquet(f"{base}/{n}")
        for old, new in (renames or {}).get(n, {}).items():
            df = df.withColumnRenamed(old, new)
        out[n] = df
    return out


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (),
                  n_files: int | None = None, max_records_per_file: int | None = None,
                  rebalance: bool = True, compression: str | None = None) -> None:
    """Parquet write; optional Hive-style partitioning and file bounds.
    A number of files is a bound on the whole table, so it cannot be combined
    with partitioning, where each value needs a file of its own at least; bound
    the files' size there."""
    if n_files is not None and partition_by:
        raise ValueError("n_files bounds an unpartitioned write; use max_records_per_file with partition_by")
    if n_files is not None:
        df = df.repartition(n_files)
    elif partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_parquet_counted(df: DataFrame, path: str, name: str = "rows_written", **kw) -> int:
    """``write_parquet`` that returns the number of rows written, observed on
    the write itself (no second job over the output). When the result is
    empty, the optimiser can drop the observation with the empty plan; the
    count then comes from the written files' metadata, read with the known
    schema (an empty partitioned write leaves no file to infer it from)."""
    obs = Observation(name)
    write_parquet(df.observe(obs, F.count(F.lit(1)).alias("rows")), path, **kw)
    return observed(obs, "rows", lambda: df.sparkSession.read.schema(df.schema).parquet(path).count())


def observed(observation: Observation, name: str, otherwise) -> int:
    """A count of an observation whose job has run; ``otherwise()`` where the
    optimiser dropped the observation together with an empty plan."""
    try:
        value = observation.get.get(name)
    except Py4JJavaError as e:
        if "toPyRow" not in str(e):  # a row without fields is what such a plan leaves
            raise
        value = None
    return int(otherwise() if value is None else value)


#: Spark's own switch: a query's shuffle files go when it ends, not when the driver happens to collect garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that are run inside leave no shuffle files behind. For writes,
    whose plan is not run again; the session's setting is put back."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def delete(spark: SparkSession, paths: Sequence[str]) -> None:
    """Remove scratch folders, wherever they are stored."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", **options) -> None:
    writer = df.write.mode(mode).option("header", "true")
    for k, v in options.items():
        writer = writer.option(k, v)
    writer.csv(path)

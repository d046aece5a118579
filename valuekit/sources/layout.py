"""Bucketed (co-located) tables for joins on the same key.

Tables written with the same number of buckets on the same key join without a
shuffle and, as each bucket is one sorted file, without a sort. The layout
lives in the session's catalog, so a cluster needs a catalog that outlasts the
session. A key that holds a large share of the rows makes one large bucket,
which no run-time split helps: leave such tables unbucketed and take the plain
plan, which AQE splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Write ``df`` as an external table, one sorted file a bucket, and return
    it as the catalog has it."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS `{table}`")
    (df.repartition(buckets, *keys).write.mode("overwrite").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return spark.table(table)


def bucketing(spark: SparkSession, table: str) -> tuple[int, tuple[str, ...]] | None:
    """Number of buckets and key of a table, None where it has none."""
    if not spark.catalog.tableExists(table):
        return None
    facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE FORMATTED `{table}`").collect()}
    if "Num Buckets" not in facts:
        return None
    return int(facts["Num Buckets"]), tuple(c.strip(" `") for c in facts["Bucket Columns"].strip("[]").split(","))


def colocated(spark: SparkSession, tables: Sequence[str], keys: Sequence[str]) -> bool:
    """Whether all of the tables have the same buckets on these keys."""
    layouts = {bucketing(spark, t) for t in tables}
    return len(layouts) == 1 and None not in layouts and next(iter(layouts))[1] == tuple(keys)

"""Tables laid out for lookups by key.

A lookup of one player reads the files and row groups that may hold it:

* rows are range-partitioned and sorted by the key, so each file and row group
  has a narrow range of keys and its minimum and maximum exclude most lookups;
* Parquet Bloom filters on the key, and on other columns that lookups name
  (a player's name is not in the key's order), exclude the rest.

Spark pushes ``=`` and ``IN`` on these columns into the scan, also joined by OR,
so queries stay as they are. A key with many rows spreads over several ranges:
the other columns and at last a hash of the row are part of the range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_clustered(df: DataFrame, path: str, keys: Sequence[str], lookups: Sequence[str] = (), n_files: int | None = None,
                    row_group_bytes: int = 16 << 20, distinct_values: int = 100_000) -> DataFrame:
    """Write ``df`` sorted by ``keys`` over all files, with Bloom filters on the
    first key and on ``lookups``, and return the table as read again.

    ``distinct_values`` is what a filter holds in a row group at about 1 % of
    false hits; more values raise that share, and no row is lost. ``n_files``
    ranges (the session's shuffle partitions, if None). The written schema is
    that of ``df``; NULL keys come first."""
    n = n_files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ties = F.xxhash64(*[F.to_json(F.struct(*df.columns))])
    ranged = df.withColumn("__tie", ties).repartitionByRange(n, *keys, "__tie").sortWithinPartitions(*keys).drop("__tie")
    writer = ranged.write.mode("overwrite").option("parquet.block.size", str(row_group_bytes))
    for column in dict.fromkeys([keys[0], *lookups]):
        writer = (writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
                  .option(f"parquet.bloom.filter.expected.ndv#{column}", str(distinct_values)))
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

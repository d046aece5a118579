"""Data-quality reports as DataFrames.

The source prints these from driver-side loops with one ``count()`` job per
table and per key column. Here each report is a lazily built DataFrame whose
counts are global aggregates (partial on every map task, one tiny shuffle), so
a report over many columns or tables is a single job and nothing but the
counts reaches the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def _count_row(df: DataFrame, table: str, stage: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(table).alias("table_name"), F.lit(stage).alias("stage"), F.col("n"))


def cleaning_summary(tables: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Per table raw rows, clean rows and the difference."""
    parts = []
    for name, (raw, clean) in tables.items():
        parts += [_count_row(raw, name, "raw"), _count_row(clean, name, "clean")]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    out = rows.groupBy("table_name").agg(
        F.sum(F.when(F.col("stage") == "raw", F.col("n"))).cast("bigint").alias("raw_rows"),
        F.sum(F.when(F.col("stage") == "clean", F.col("n"))).cast("bigint").alias("clean_rows"),
    )
    return out.withColumn("dropped_rows", F.col("raw_rows") - F.col("clean_rows"))


def observed_counts(obs: Observation) -> dict:
    """Counts recorded by an ``Observation`` attached to a write (A8, no extra job)."""
    return dict(obs.get)


def null_key_report(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """NULL count per key column from one aggregate; status WARN/OK."""
    counts = df.agg(*[F.count_if(F.col(k).isNull()).alias(k) for k in keys])
    long = counts.unpivot([], list(keys), "column_name", "null_count")
    return long.select(
        F.lit(table).alias("table_name"), "column_name", F.col("null_count").cast("bigint").alias("null_count"),
        F.when(F.col("null_count") > 0, F.lit("WARN")).otherwise(F.lit("OK")).alias("status"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their multiplicity."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)


def duplicate_key_report(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """Total rows, distinct keys and surplus rows (total - distinct)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"))
    out = per_key.agg(
        F.sum("c").cast("bigint").alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
    )
    return out.select(
        F.lit(table).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"),
        "total_rows", "distinct_keys", (F.col("total_rows") - F.col("distinct_keys")).alias("duplicate_rows"),
    )


def key_profile(df: DataFrame, keys: Sequence[str], table: str, tag_col: str | None = None,
                tags: Sequence[str] = ()) -> DataFrame:
    """D15 + D16 + A8 + A9 in one pass: from one partially aggregated
    ``groupBy(keys)`` derive total rows, distinct keys, surplus rows, keys
    occurring more than once and the NULL count of every key column, as a long
    table (table_name, item, value, status): WARN where a key is NULL or repeated.

    With ``tag_col`` also ``kept_rows``, the rows that
    :func:`valuekit.operators.dedupe.prefer_tagged_rows` keeps: a key's tagged
    rows if it has any, else its others; rows with a NULL key are never matched,
    rows with a NULL tag never kept."""
    counts = [F.count(F.lit(1)).alias("c")]
    if tag_col:
        tagged = F.col(tag_col).isin(list(tags))
        counts += [F.count_if(tagged).alias("t"), F.count_if(~tagged).alias("u")]
    per_key = df.groupBy(*keys).agg(*counts)
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    kept = [F.sum(F.when(whole & (F.col("t") > 0), F.col("t")).otherwise(F.col("t") + F.col("u"))).cast("bigint").alias("kept_rows")] if tag_col else []
    wide = per_key.agg(
        F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("c") > 1).alias("keys_with_duplicates"), *kept,
        *[F.coalesce(F.sum(F.when(F.col(k).isNull(), F.col("c"))), F.lit(0)).cast("bigint").alias(f"null_{k}")
          for k in keys],
    ).withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_keys"))
    return profile_items(wide, keys, table, ["kept_rows"] if tag_col else [])


def profile_items(wide: DataFrame, keys: Sequence[str], table: str, more: Sequence[str] = ()) -> DataFrame:
    """The long form of a key profile's one row of counts."""
    items = ["total_rows", "distinct_keys", "duplicate_rows", "keys_with_duplicates", *more, *[f"null_{k}" for k in keys]]
    bad = (F.col("item").startswith("null_") | F.col("item").isin("duplicate_rows", "keys_with_duplicates")) & (F.col("value") > 0)
    return wide.unpivot([], items, "item", "value").select(
        F.lit(table).alias("table_name"), "item", F.col("value").cast("bigint").alias("value"),
        F.when(bad, F.lit("WARN")).otherwise(F.lit("OK")).alias("status"))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first n rows of an unordered scan (a sampling feature, not a cap)."""
    return df.limit(n)

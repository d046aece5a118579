"""Top-k of groups that may hold a large share of all rows, ties included.

``rank.top_k_per_group`` sends every row that a map task cannot rule out to its
group's task and sorts it there. Where many rows tie for a place, all of them
arrive in that one task. Here no group is sorted as rows:

1. rows are counted by (group, value), with map-side partial counts, so ties
   are one row each;
2. of these, each group keeps its k best values. Values are distinct, so a map
   task ships at most k of them for a group, and a group's task receives at most
   k for each map task. The counts before a value give its rank;
3. rows meet their (group, value) and get the rank. The value is part of the
   key, so a hot group is spread, and a hot value is split by AQE's skew join.
   Where the list of best values is small, AQE broadcasts it after measuring it.

Rows come back as ``rank() <= k`` would give them. NULL values are a value that
sorts last; NaN sorts above all numbers; NULL in a group column is a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def best_values(df: DataFrame, group_cols: Sequence[str], order_col: str, k: int, rank_col: str = "rank",
                descending: bool = True) -> DataFrame:
    """The values of ``order_col`` that have a rank of at most k in their group:
    at most k rows a group."""
    order = F.col(order_col).desc_nulls_last() if descending else F.col(order_col).asc_nulls_last()
    by_value = Window.partitionBy(*group_cols).orderBy(order)
    before = F.sum("__rows").over(by_value.rowsBetween(Window.unboundedPreceding, -1))
    return (df.groupBy(*group_cols, order_col).agg(F.count(F.lit(1)).alias("__rows"))
            .withColumn("__place", F.row_number().over(by_value)).where(F.col("__place") <= k)
            .withColumn(rank_col, (F.coalesce(before, F.lit(0)) + 1).cast("int"))
            .where(F.col(rank_col) <= k).select(*group_cols, order_col, rank_col))


def top_k_by_threshold(df: DataFrame, group_cols: Sequence[str], order_col: str, k: int = 5,
                       rank_col: str = "rank", descending: bool = True) -> DataFrame:
    """W1 + O3: the rows that ``rank.top_k_per_group`` returns, see above."""
    keys = [*group_cols, order_col]
    best = best_values(df, group_cols, order_col, k, "__rank", descending)
    best = best.select(*[F.col(c).alias(f"__best_{i}") for i, c in enumerate(keys)], "__rank")
    same = [F.col(c).eqNullSafe(F.col(f"__best_{i}")) for i, c in enumerate(keys)]
    return df.join(best, same).select(*[c for c in df.columns if c != rank_col], F.col("__rank").alias(rank_col))

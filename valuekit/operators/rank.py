"""Ranking, rollups and reports over labelled rows.

Top-k uses ``rank() <= k`` over a window; Catalyst plans it with a partial
``WindowGroupLimit`` before the shuffle and a final one after, so each map task
ships at most k rows (plus ties) per group and a hot group never arrives whole
in one task. Rollups are plain ``groupBy().agg()`` with partial aggregation;
the median is ``percentile_approx`` whose sketch merges map-side too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, group_cols: Sequence[str], order_col: str, k: int = 5,
                    rank_col: str = "rank", descending: bool = True) -> DataFrame:
    """W1 + O3: rows whose ``rank()`` within the group is <= k. Ties share a rank,
    so more than k rows can come back; NULL scores sort last."""
    order: Column = F.col(order_col).desc_nulls_last() if descending else F.col(order_col).asc_nulls_last()
    w = Window.partitionBy(*group_cols).orderBy(order)
    return df.withColumn(rank_col, F.rank().over(w)).filter(F.col(rank_col) <= k)


def archetype_season_rollup(df: DataFrame, keys: Sequence[str] = ("season", "season_start_year", "archetype"),
                            median_accuracy: int = 10000) -> DataFrame:
    """D33 (A4-A6): per season x archetype count, means, approximate median of
    cost per win share, salary total, and the two values in millions."""
    out = df.groupBy(*keys).agg(*[F.expr(e) for e in (
        "count(1) AS player_count",
        "avg(cost_per_ws) AS avg_cost_per_ws",
        f"percentile_approx(cost_per_ws, 0.5, {int(median_accuracy)}) AS median_cost_per_ws",
        "avg(value_score) AS avg_value_score",
        "avg(composite_index) AS avg_composite_index",
        "avg(ws) AS avg_win_shares",
        "avg(vorp) AS avg_vorp",
        "avg(per) AS avg_per",
        "avg(salary_millions) AS avg_salary_millions",
        "sum(player_salary) AS total_archetype_salary",
        "avg(availability) AS avg_availability",
        "avg(ts_pct) AS avg_ts_pct",
        "avg(bpm) AS avg_bpm",
        "avg(ws_per_48) AS avg_ws_per_48",
    )])
    return out.withColumns({
        "cost_per_ws_millions": F.expr("avg_cost_per_ws / 1000000.0D"),
        "total_archetype_salary_millions": F.expr("total_archetype_salary / 1000000.0D"),
    })


#: Averaged columns of the rollup and the names of their means.
MEANS = {"cost_per_ws": "avg_cost_per_ws", "value_score": "avg_value_score", "composite_index": "avg_composite_index", "ws": "avg_win_shares",
         "vorp": "avg_vorp", "per": "avg_per", "salary_millions": "avg_salary_millions", "availability": "avg_availability",
         "ts_pct": "avg_ts_pct", "bpm": "avg_bpm", "ws_per_48": "avg_ws_per_48"}
#: Size of the quantile sketches. Ranks of a KLL sketch of this size are off by
#: less than RANK_ERROR of the group with a probability above 99%, after any number of merges.
SKETCH_K, RANK_ERROR = 1024, 0.01


def rollup_states(df: DataFrame, keys: Sequence[str] = ("season", "season_start_year", "archetype"), sketch_k: int = SKETCH_K) -> DataFrame:
    """Mergeable partial states of the rollup, one row a group: counts, sums
    and a quantile sketch (binary) of cost per win share. States of any parts of
    the rows, merged in any order, give the rollup of all of them, so a new
    season's rows are added without reading the others again."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("player_count"), F.sum("player_salary").alias("total_archetype_salary"),
        *[F.count(c).alias(f"n_{c}") for c in MEANS], *[F.sum(F.col(c).cast("double")).alias(f"sum_{c}") for c in MEANS],
        F.kll_sketch_agg_double(F.col("cost_per_ws").cast("double"), F.lit(sketch_k)).alias("cost_sketch"))


def merge_states(states: DataFrame, keys: Sequence[str] = ("season", "season_start_year", "archetype")) -> DataFrame:
    """One state a group from any number of them."""
    sums = [c for c in states.columns if c not in (*keys, "cost_sketch")]
    return states.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums], F.kll_merge_agg_double("cost_sketch").alias("cost_sketch"))


def rollup_from_states(states: DataFrame, keys: Sequence[str] = ("season", "season_start_year", "archetype")) -> DataFrame:
    """D33 from states: the columns of :func:`archetype_season_rollup`, the
    median to a rank error of RANK_ERROR."""
    merged = merge_states(states, keys)
    median = F.when(F.col("n_cost_per_ws") > 0, F.kll_sketch_get_quantile_double("cost_sketch", F.lit(0.5)))
    mean = lambda c: F.when(F.col(f"n_{c}") > 0, F.col(f"sum_{c}") / F.col(f"n_{c}")).alias(MEANS[c])
    columns = []
    for c in MEANS:
        columns.append(mean(c))
        columns += {"cost_per_ws": [median.alias("median_cost_per_ws")], "salary_millions": [F.col("total_archetype_salary")]}.get(c, [])
    out = merged.select(*keys, "player_count", *columns)
    return out.withColumns({"cost_per_ws_millions": F.expr("avg_cost_per_ws / 1000000.0D"),
                            "total_archetype_salary_millions": F.expr("total_archetype_salary / 1000000.0D")})


def median_rank_check(df: DataFrame, rollup: DataFrame, keys: Sequence[str] = ("season", "season_start_year", "archetype"),
                      error: float = RANK_ERROR) -> DataFrame:
    """Per group the number of costs and whether the median's exact rank among
    them is within ``error`` of the middle (a group's costs are only counted)."""
    cost = F.col("cost_per_ws").cast("double")
    m = F.col("median_cost_per_ws")
    counted = df.join(rollup.select(*keys, "median_cost_per_ws"), list(keys)).groupBy(*keys).agg(
        F.count(cost).alias("n_costs"), F.count_if(cost < m).alias("below"), F.count_if(cost <= m).alias("upto"))
    half = F.col("n_costs") / 2
    inside = (F.col("below") <= half + error * F.col("n_costs")) & (F.col("upto") >= half - error * F.col("n_costs"))
    return counted.select(*keys, "n_costs", F.when(F.col("n_costs") == 0, True).otherwise(inside).alias("median_in_bounds"))


def label_distribution(df: DataFrame, label_col: str = "archetype") -> DataFrame:
    """D35 (A7 + O1): rows per label, most frequent first (label breaks ties)."""
    return df.groupBy(label_col).count().orderBy(F.col("count").desc(), F.col(label_col))


def season_report(rollup: DataFrame, season: str, season_col: str = "season",
                  columns: Sequence[str] = ("archetype", "player_count", "cost_per_ws_millions",
                                            "avg_value_score", "avg_win_shares"),
                  order_col: str = "cost_per_ws_millions") -> DataFrame:
    """D36 (P22 + P1 + O2): one season's rows, cheapest cost per win share first
    (NULL first, as Spark sorts ascending)."""
    return (rollup.filter(F.col(season_col) == F.lit(season))
            .select(*columns).orderBy(F.col(order_col).asc_nulls_first()))

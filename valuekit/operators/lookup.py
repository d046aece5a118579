"""Questions the dashboard answered, as DataFrame functions.

The web pages themselves are not rebuilt; their data questions are filters and
aggregates over the result tables. Filters on ``season_start_year`` prune
partitions of the partitioned archetype table at scan time.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def select_present(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Project the listed columns that exist, in the listed order."""
    have = set(df.columns)
    return df.select(*[c for c in columns if c in have])


def filter_results(df: DataFrame, **criteria) -> DataFrame:
    """Equality / membership filters; a list or tuple value means IN,
    None means the criterion is ignored."""
    out = df
    for column, value in criteria.items():
        if value is None:
            continue
        if isinstance(value, (list, tuple, set, frozenset)):
            out = out.filter(F.col(column).isin(list(value)))
        else:
            out = out.filter(F.col(column) == F.lit(value))
    return out


def player_history(df: DataFrame, who: str, id_col: str = "player_id", name_col: str = "name",
                   order_cols: Sequence[str] = ("season_start_year",)) -> DataFrame:
    """Every row of one entity, matched by id or by exact name."""
    cond = F.col(id_col).cast("string") == F.lit(str(who))
    if name_col in df.columns:
        cond = cond | (F.col(name_col) == F.lit(who))
    return df.filter(cond).orderBy(*order_cols)


def wasted_cap(df: DataFrame, group_cols: Sequence[str] = ("team_name_abbr", "season"),
               cost_col: str = "missed_game_cost") -> DataFrame:
    """D46 (our definition): salary paid for missed games, summed per team and season."""
    return df.groupBy(*group_cols).agg(
        F.sum(cost_col).alias("wasted_salary"),
        F.count(F.lit(1)).alias("player_count"),
    )

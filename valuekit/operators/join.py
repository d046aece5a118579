"""Joins: cap normalisation (D13) and the six-table unification.

No side is broadcast by hand and no job runs while a frame is built: AQE sees
each side's bytes at run time and turns a small one into a broadcast hash join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def normalize_to_cap(
    df: DataFrame,
    cap_df: DataFrame,
    on: str | Sequence[str] = "season",
    value_col: str = "salary",
    cap_col: str = "salary_cap",
    out: str = "salary_pct_of_cap",
    digits: int = 6,
) -> DataFrame:
    """D13 (J3): left-join the cap per key and add ``round(value / cap, digits)``
    where the cap is positive, NULL otherwise (missing cap included)."""
    keys = [on] if isinstance(on, str) else list(on)
    joined = df.join(cap_df.select(*keys, cap_col), on=keys, how="left")
    cap = F.col(cap_col)
    return joined.withColumn(
        out, F.when(cap.isNotNull() & (cap > 0), F.round(F.col(value_col) / cap, digits))
    )


#: Groups that rows with a NULL in the key are dealt into by :func:`unify`.
NULL_PARTS = 1024

# The advanced statistics that the unified table takes, in order.
ADVANCED_COLUMNS = (
    "per", "ts_pct", "fg3a_per_fga_pct", "fta_per_fga_pct", "orb_pct", "drb_pct", "trb_pct",
    "ast_pct", "stl_pct", "blk_pct", "tov_pct", "usg_pct", "ows", "dws", "ws", "ws_per_48",
    "obpm", "dbpm", "bpm", "vorp",
)


def first_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row a key, the least by the other columns in their order (NULL
    first); a grouped minimum, so copies are combined before the shuffle. Rows
    with a NULL in the key match nothing and stay out."""
    rest = [c for c in df.columns if c not in keys]
    whole = df.dropna(subset=list(keys))
    if not rest:
        return whole.distinct()
    return whole.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("first")).select(*keys, "first.*").select(*df.columns)


def unify(
    stats: DataFrame,
    advanced: DataFrame,
    profiles: DataFrame,
    salaries: DataFrame,
    caps: DataFrame,
    standings: DataFrame,
    entity_key: str = "player_id",
    period_key: str = "season",
    period_year: str = "season_start_year",
    group_key: str = "team_name_abbr",
    advanced_columns: Sequence[str] = ADVANCED_COLUMNS,
    cap_col: str = "league_salary_cap",
    standings_columns: Sequence[str] = ("wins", "losses", "win_pct"),
    colocated: bool = False,
    on_duplicate: str = "keep",
) -> DataFrame:
    """Five left joins onto the stats table, one row per stats row (more
    only where a right side repeats a key, as in the source).

    The two tables keyed by (entity, period) are narrow; a full outer join
    brings them together first, so the wide stats rows are shuffled for that key
    once, in a join whose hot partitions AQE can split (a second join on top of
    the first one's partitioning could not be split). Stats rows with a NULL in
    the key match nothing: a third key, 0 for all others, deals them out by period
    and group instead of into one partition. The entity's profile is joined before,
    as repeated keys on both sides multiply the stats rows there, and the copies
    would be shuffled. Output columns are projected in the source's order.

    ``colocated``: stats, advanced and salaries are bucketed alike on that key
    (``sources.layout``); then two left joins in a row need no shuffle at all.
    ``on_duplicate="first"`` takes of each right side one row a key, the least by
    its columns, so no stats row is multiplied.
    """
    ek, pk = entity_key, period_key
    adv = advanced.select(ek, pk, *advanced_columns)
    sal = salaries.drop(period_year)
    caps, standings = caps.select(pk, cap_col), standings.select(period_year, group_key, *standings_columns)
    if on_duplicate == "first":
        adv, sal, profiles = first_by_key(adv, [ek, pk]), first_by_key(sal, [ek, pk]), first_by_key(profiles, [ek])
        caps, standings = first_by_key(caps, [pk]), first_by_key(standings, [period_year, group_key])
    elif on_duplicate != "keep":
        raise ValueError(f"on_duplicate is keep or first, not {on_duplicate!r}")
    has_key = F.col(ek).isNotNull() & F.col(pk).isNotNull()
    if colocated:
        wide = stats.filter(has_key).join(adv.filter(has_key), on=[ek, pk], how="left").join(sal.filter(has_key), on=[ek, pk], how="left")
        wide = wide.unionByName(stats.filter(~has_key), allowMissingColumns=True).join(profiles, on=ek, how="left")
    else:
        both = adv.filter(has_key).join(sal.filter(has_key), on=[ek, pk], how="full_outer")
        dealt = F.when(has_key, F.lit(0)).otherwise(F.pmod(F.hash(ek, pk, period_year, group_key), F.lit(NULL_PARTS)) + 1)
        none = F.pmod(F.hash(ek), F.lit(1))  # 0, but no literal: that would be no key of the join
        wide = (stats.join(profiles, on=ek, how="left").withColumn("__dealt", dealt)
                .join(both.withColumn("__dealt", none), on=[ek, pk, "__dealt"], how="left").drop("__dealt"))
    joined = (
        wide.join(caps, on=pk, how="left")
        .join(standings, on=[period_year, group_key], how="left")
    )
    stats_rest = [c for c in stats.columns if c not in (period_year, group_key, pk, ek)]
    profile_rest = [c for c in profiles.columns if c != ek]
    salary_rest = [c for c in sal.columns if c not in (ek, pk)]
    order = [period_year, group_key, pk, ek, *stats_rest, *advanced_columns, *profile_rest,
             *salary_rest, cap_col, *standings_columns]
    return joined.select(*order)

"""Value metrics as column expressions (narrow, codegen-friendly).

Each function adds columns with one ``withColumns`` so the plan stays a single
projection; nothing here shuffles.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuekit import schemas as K
from valuekit.functions import columns as C


def per_game_rates(df: DataFrame, stats: Sequence[str] = K.PER_GAME_STATS, games: str = "games",
                   digits: int = 2, suffix: str = "_per_game") -> DataFrame:
    """``round(x / games, 2)``; NULL when games is 0 or NULL."""
    return df.withColumns({
        f"{s}{suffix}": F.expr(f"round(try_divide(CAST({C.q(s)} AS DOUBLE), CAST({C.q(games)} AS DOUBLE)), {digits})")
        for s in stats})


def per_minute_rates(df: DataFrame, stats: Sequence[str] = K.PER_MINUTE_STATS, minutes: str = "mp",
                     digits: int = 4, suffix: str = "_per_min") -> DataFrame:
    """``round(x / mp, 4)`` where mp > 0, else NULL."""
    m = C.q(minutes)
    return df.withColumns({
        f"{s}{suffix}": F.expr(f"CASE WHEN {m} > 0 THEN round({C.q(s)} / {m}, {digits}) END") for s in stats})


def production_expr(suffix: str = "_per_game", weights=K.PRODUCTION_WEIGHTS):
    """D19 formula: 1.0 pts + 1.2 trb + 1.5 ast + 2 stl + 2 blk - 1.0 tov (per game)."""
    return C.weighted_sum((f"{s}{suffix}", w) for s, w in weights)


def composite_value(df: DataFrame, share_col: str = "salary_pct_of_cap", floor: float = K.MIN_CAP_SHARE) -> DataFrame:
    """Production score, floored cap share (NULL share -> floor,
    since ``greatest`` skips NULL) and their ratio."""
    return df.withColumns(
        {"production_score": production_expr(),
         "salary_cap_share": F.greatest(F.col(share_col), F.lit(float(floor)))}
    ).withColumn("composite_value_score", F.col("production_score") / F.col("salary_cap_share"))


def games_possible_expr(season_col: str = "season", short_seasons: Mapping[str, int] = K.SHORT_SEASONS,
                        full: int = K.FULL_SEASON_GAMES):
    """D22 (first half): games on the schedule, by season label."""
    games = F.lit(int(full))
    for season, n in short_seasons.items():
        games = F.when(F.col(season_col) == F.lit(str(season)), F.lit(int(n))).otherwise(games)
    return games


def availability(df: DataFrame, season_col: str = "season", games: str = "games",
                 salary: str = "player_salary", short_seasons: Mapping[str, int] = K.SHORT_SEASONS,
                 full: int = K.FULL_SEASON_GAMES) -> DataFrame:
    """Games possible, capped availability rate, availability-adjusted
    CVS (needs :func:`composite_value` first) and missed-game cost."""
    df = df.withColumn("games_possible", games_possible_expr(season_col, short_seasons, full))
    df = df.withColumn("availability_rate", F.least(F.col(games) / F.col("games_possible"), F.lit(1.0)))
    cols = {"missed_game_cost": F.col(salary) * (F.lit(1.0) - F.col("availability_rate"))}
    if "composite_value_score" in df.columns:
        cols = {"availability_adj_cvs": F.col("composite_value_score") * F.col("availability_rate"), **cols}
    return df.withColumns(cols)


def per36_rates(df: DataFrame, stats: Sequence[str] = K.PER36_STATS, minutes: str = "mp",
                games: str = "games", salary: str = "player_salary",
                share: str = "salary_pct_of_cap") -> DataFrame:
    """``(x / mp) * 36`` in that order, minutes per game, salary in
    millions and the cap share alias."""
    m = C.q(minutes)
    cols = {"min_per_game": F.expr(f"{m} / {C.q(games)}")}
    cols.update({f"{s}_per36": F.expr(f"({C.q(s)} / {m}) * 36") for s in stats})
    cols["salary_millions"] = F.expr(f"{C.q(salary)} / 1000000.0D")
    cols["salary_share"] = F.col(share)
    return df.withColumns(cols)


def value_metrics(df: DataFrame, salary: str = "player_salary", ws: str = "ws", vorp: str = "vorp",
                  games: str = "games", share: str = "salary_share",
                  penalty: float = K.SALARY_SHARE_PENALTY, season_games: float = float(K.FULL_SEASON_GAMES)) -> DataFrame:
    """Cost per win share, surplus value score, simple availability,
    cost per available win share, composite index per $1M."""
    sal, w = C.q(salary), C.q(ws)
    df = df.withColumns({
        "cost_per_ws": F.expr(f"CASE WHEN {w} > 0 THEN {sal} / {w} END"),
        "value_score": F.expr(f"{C.q(vorp)} - {C.sql_num(penalty)} * {C.q(share)}"),
        "availability": F.expr(f"CAST({C.q(games)} / {C.sql_num(season_games)} AS DOUBLE)"),
    })
    production = C.weighted_sum_sql((f"{s}_per_game", wt) for s, wt in K.PRODUCTION_WEIGHTS)
    return df.withColumns({
        "cost_per_available_ws": F.expr(
            f"CASE WHEN {w} > 0 AND availability > 0 THEN {sal} / ({w} * availability) END"),
        "composite_index": F.expr(f"({production}) / salary_millions"),
    })


def qualify_for_scoring(df: DataFrame, min_games: int = 20, min_minutes: int = 200,
                        excluded_teams=K.SCORING_EXCLUDED_TEAMS, salary: str = "player_salary",
                        games: str = "games", minutes: str = "mp", team: str = "team_name_abbr") -> DataFrame:
    """P10: paid, enough games and minutes, not a multi-team aggregate row
    (a NULL team fails too). One conjunctive filter, pushed into the scan."""
    return df.filter(
        F.col(salary).isNotNull() & (F.col(salary) > 0) & (F.col(games) >= min_games)
        & (F.col(minutes) >= min_minutes) & ~F.col(team).isin(list(excluded_teams))
    )


def qualify_for_archetypes(df: DataFrame, min_games: int = 20, salary: str = "player_salary",
                           games: str = "games", minutes: str = "mp", ws: str = "ws") -> DataFrame:
    """Enough games, paid, some minutes, win shares present; multi-team
    aggregate rows are kept."""
    return df.filter((F.col(games) >= min_games) & (F.col(salary) > 0) & (F.col(minutes) > 0)
                     & F.col(ws).isNotNull())

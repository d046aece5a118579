"""Raw table schemas and the fixed values the domain jobs are configured with.

Everything here is data, not logic: column names and types of the six raw CSV
tables, the team-name map, tag sets and thresholds. Jobs in ``valuekit.plans``
pass these into the generic operators; a user with other data passes their own.
"""

from __future__ import annotations

from pyspark.sql.types import (
    FloatType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

S, I, Fl = StringType(), IntegerType(), FloatType()


def _schema(*fields: tuple[str, object]) -> StructType:
    # Raw CSV binding is positional; nullability is not enforced by the reader.
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


# --- Fixed values: raw CSV layouts (column order matters, binding is by position) ---
PROFILES_SCHEMA = _schema(
    ("player_id", S), ("name", S), ("college", S), ("draft_year", Fl), ("draft_round", Fl),
    ("draft_pick", Fl), ("height", I), ("weight", I), ("country", S), ("nba_debut_year", Fl),
    ("all_nba_appearances", I),
)

STATS_SCHEMA = _schema(
    ("player_id", S), ("season", S), ("age", I), ("team_name_abbr", S), ("comp_name_abbr", S),
    ("pos", S), ("games", I), ("games_started", I), ("mp", I), ("fg", I), ("fga", I),
    ("fg_pct", Fl), ("fg3", I), ("fg3a", I), ("fg3_pct", Fl), ("fg2", I), ("fg2a", I),
    ("fg2_pct", Fl), ("efg_pct", Fl), ("ft", I), ("fta", I), ("ft_pct", Fl), ("orb", I),
    ("drb", I), ("trb", I), ("ast", I), ("stl", I), ("blk", I), ("tov", I), ("pf", I), ("pts", I),
)

SALARIES_SCHEMA = _schema(("player_id", S), ("season", S), ("team", S), ("salary", S))

SALARY_CAP_SCHEMA = _schema(("season", S), ("salary_cap", I))

ADV_STATS_SCHEMA = _schema(
    ("player_id", S), ("season", S), ("age", I), ("team_name_abbr", S), ("pos", S), ("g", I),
    ("mp", I), ("per", Fl), ("ts_pct", Fl), ("fg3a_per_fga_pct", Fl), ("fta_per_fga_pct", Fl),
    ("orb_pct", Fl), ("drb_pct", Fl), ("trb_pct", Fl), ("ast_pct", Fl), ("stl_pct", Fl),
    ("blk_pct", Fl), ("tov_pct", Fl), ("usg_pct", Fl), ("ows", Fl), ("dws", Fl), ("ws", Fl),
    ("ws_per_48", Fl), ("obpm", Fl), ("dbpm", Fl), ("bpm", Fl), ("vorp", Fl),
)

STANDINGS_SCHEMA = _schema(("season", S), ("team", S), ("overall", S))

RAW_TABLES = {
    "player_profiles": ("player_profiles.csv", PROFILES_SCHEMA),
    "nba_stats": ("nba_stats.csv", STATS_SCHEMA),
    "nba_salaries": ("nba_salaries.csv", SALARIES_SCHEMA),
    "nba_salary_cap": ("nba_salary_cap.csv", SALARY_CAP_SCHEMA),
    "nba_advanced_player_stats": ("nba_advanced_player_stats.csv", ADV_STATS_SCHEMA),
    "nba_expanded_standings_2000_2026": ("nba_expanded_standings_2000_2026.csv", STANDINGS_SCHEMA),
}

# --- Fixed values: franchise name -> three-letter code (not season-aware) ---
TEAM_CODES = {
    "Atlanta Hawks": "ATL",
    "Boston Celtics": "BOS",
    "Brooklyn Nets": "BRK",
    "New Jersey Nets": "NJN",
    "Charlotte Hornets": "CHO",
    "Charlotte Bobcats": "CHA",
    "Chicago Bulls": "CHI",
    "Cleveland Cavaliers": "CLE",
    "Dallas Mavericks": "DAL",
    "Denver Nuggets": "DEN",
    "Detroit Pistons": "DET",
    "Golden State Warriors": "GSW",
    "Houston Rockets": "HOU",
    "Indiana Pacers": "IND",
    "Los Angeles Clippers": "LAC",
    "Los Angeles Lakers": "LAL",
    "Memphis Grizzlies": "MEM",
    "Vancouver Grizzlies": "VAN",
    "Miami Heat": "MIA",
    "Milwaukee Bucks": "MIL",
    "Minnesota Timberwolves": "MIN",
    "New Orleans Hornets": "NOH",
    "New Orleans/Oklahoma City Hornets": "NOK",
    "New Orleans Pelicans": "NOP",
    "New York Knicks": "NYK",
    "Oklahoma City Thunder": "OKC",
    "Orlando Magic": "ORL",
    "Philadelphia 76ers": "PHI",
    "Phoenix Suns": "PHO",
    "Portland Trail Blazers": "POR",
    "Sacramento Kings": "SAC",
    "San Antonio Spurs": "SAS",
    "Seattle SuperSonics": "SEA",
    "Toronto Raptors": "TOR",
    "Utah Jazz": "UTA",
    "Washington Wizards": "WAS",
}

# --- Fixed values: cleaning rules ---
AGGREGATE_TEAM_TAGS = ("2TM", "3TM", "4TM")          # rows that sum a traded player's season
SCORING_EXCLUDED_TEAMS = ("2TM", "3TM", "4TM", "5TM", "6TM")
SEASON_SENTINELS = ("", "N/A", "0")                    # rejected season values (besides NULL)
TWO_WAY_MARK = "(TW)"
SUB_MINIMUM_MARK = "< Minimum"
TEAMS_SEPARATOR = " / "
PROFILE_DEFAULTS = {
    "college": "None",
    "draft_year": -1.0,
    "draft_round": -1.0,
    "draft_pick": -1.0,
    "nba_debut_year": -1.0,
}
SHOOTING_BOUNDS = {"fg_pct": (0.0, 1.0), "fg3_pct": (0.0, 1.0), "fg2_pct": (0.0, 1.0),
                   "ft_pct": (0.0, 1.0), "efg_pct": (0.0, 1.5)}
ADVANCED_BOUNDS = {
    "ts_pct": (0.0, 1.0), "fg3a_per_fga_pct": (0.0, 1.0), "fta_per_fga_pct": (0.0, 1.0),
    "orb_pct": (0.0, 100.0), "drb_pct": (0.0, 100.0), "trb_pct": (0.0, 100.0),
    "ast_pct": (0.0, 100.0), "stl_pct": (0.0, 100.0), "blk_pct": (0.0, 100.0),
    "tov_pct": (0.0, 100.0), "usg_pct": (0.0, 100.0),
    "ws": (-50.0, 50.0), "bpm": (-50.0, 50.0),
}
PER_GAME_STATS = ("pts", "ast", "trb", "stl", "blk", "tov")
PER_MINUTE_STATS = ("pts", "ast", "trb")
PER36_STATS = ("pts", "ast", "trb", "stl", "blk", "fg3a", "fg2a", "tov")

# --- Fixed values: scoring ---
PRODUCTION_WEIGHTS = (("pts", 1.0), ("trb", 1.2), ("ast", 1.5), ("stl", 2.0), ("blk", 2.0), ("tov", -1.0))
MIN_CAP_SHARE = 0.01
SHORT_SEASONS = {"2011-12": 66, "2019-20": 73, "2020-21": 72}
FULL_SEASON_GAMES = 82
SALARY_SHARE_PENALTY = 5.0
TIER_SPLITS = (-1.0, 0.03, 0.07, 0.12, 0.18, 0.24, 0.30, float("inf"))
TIER_FEATURE_WEIGHTS = (("bpm", 0.40), ("ws_per_48", 0.25), ("ts_pct", 0.20), ("usg_pct", 0.15))
TOP_K = 5

# --- Fixed values: columns of the result tables, in order ---
CVS_COLUMNS = (
    "player_id", "name", "season", "season_start_year", "team_name_abbr", "pos", "age", "height", "weight",
    "country", "college", "draft_year", "draft_round", "draft_pick", "is_drafted", "games", "games_started",
    "mp", "games_possible", "availability_rate", "pts_per_game", "trb_per_game", "ast_per_game",
    "stl_per_game", "blk_per_game", "tov_per_game", "per", "ts_pct", "ws", "ows", "dws", "ws_per_48", "bpm",
    "obpm", "dbpm", "vorp", "usg_pct", "player_salary", "salary_cap", "salary_pct_of_cap", "salary_cap_share",
    "is_two_way", "is_sub_minimum", "wins", "losses", "win_pct", "production_score", "composite_value_score",
    "availability_adj_cvs", "missed_game_cost",
)

PLAYER_ARCHETYPE_COLUMNS = (
    "player_id", "name", "season", "season_start_year", "team_name_abbr", "pos", "archetype", "age", "games",
    "mp", "pts_per_game", "ast_per_game", "trb_per_game", "stl_per_game", "blk_per_game", "tov_per_game",
    "pts_per36", "ast_per36", "trb_per36", "ts_pct", "usg_pct", "ws", "ws_per_48", "vorp", "bpm", "per",
    "player_salary", "salary_millions", "salary_pct_of_cap", "cost_per_ws", "cost_per_available_ws",
    "value_score", "composite_index", "availability", "wins", "losses", "win_pct", "all_nba_appearances",
    "height", "weight", "country", "is_drafted",
)

TIER_COLUMNS = (
    "player_id", "name", "season", "season_start_year", "team_name_abbr", "pos", "age", "games", "mp", "bpm",
    "ws_per_48", "ts_pct", "usg_pct", "salary_pct_of_cap", "salary_group", "avg_bpm", "avg_ws_per_48",
    "avg_ts_pct", "avg_usg_pct", "bpm_diff", "ws_per_48_diff", "ts_pct_diff", "usg_pct_diff", "value_score",
)

"""DuckDB statements of the composite queries: the domain's raw tables, the
cleaners and the five joins, written out on their own (nothing here is read by
the Spark side)."""

from __future__ import annotations

from valuekit import schemas as K
from valuekit.catalog.oracle import PRODUCTION, label_rules, season_label, sql_text_to_integer, tier_case
from valuekit.catalog.shapes import sql_per_game, sql_round_ratio

CODES = sorted(set(K.TEAM_CODES.values()))[:30]
CODE_LIST = "[" + ", ".join(f"'{t}'" for t in CODES) + "]"
NAME_OF = {code: name for name, code in K.TEAM_CODES.items()}
NAME_LIST = "[" + ", ".join(f"'{NAME_OF[t]}'" for t in CODES) + "]"
CODE_OF_NAME = " ".join(f"WHEN '{name}' THEN '{code}'" for name, code in K.TEAM_CODES.items())
POSITION_LIST = "['PG', 'SG', 'SF', 'PF', 'C', 'G', 'F', 'SF-PF']"
START_YEAR = sql_text_to_integer("substring(season, 1, 4)", "INT")


def part_of(x: str, mod: int, by: int) -> str:
    return f"CAST(({x}) % {mod} / CAST({by} AS DOUBLE) AS FLOAT)"


def bounded(col: str, lo: str, hi: str) -> str:
    return f"CASE WHEN CAST({col} AS DOUBLE) BETWEEN {lo} AND {hi} THEN {col} END AS {col}"


PLAYER = "CASE WHEN pk % 41 = 0 THEN NULL ELSE concat('p', pk) END AS player_id"


def player(missing: str) -> str:
    """The id, another one where the table has a gap."""
    return f"CASE WHEN pk % 41 = 0 THEN NULL ELSE concat(CASE WHEN {missing} THEN 'q' ELSE 'p' END, pk) END AS player_id"


SEASON = f"""CASE (pk + y) % 37 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'N/A' WHEN 3 THEN '0'
    ELSE {season_label('y')} END AS season"""

BASE = f"""team_year AS (
  SELECT l_partkey AS pk, CAST(year(l_shipdate) AS INT) AS y, l_suppkey % 30 AS t, CAST(count(*) * 25 AS INT) AS games,
    CAST(sum(CAST(l_quantity AS INT)) * 20 AS INT) AS mp, CAST(sum(floor(l_extendedprice / 1000)) AS INT) AS pts,
    CAST(sum(l_linenumber) AS INT) AS trb, CAST(count_if(l_returnflag = 'A') AS INT) AS ast,
    CAST(count_if(l_returnflag = 'R') AS INT) AS stl, CAST(count_if(l_returnflag = 'N') AS INT) AS blk,
    CAST(count_if(l_linestatus = 'F') AS INT) AS tov
  FROM lineitem GROUP BY ALL),
lines AS (
  SELECT pk, y, CASE WHEN pk % 29 = 0 THEN NULL ELSE {CODE_LIST}[t + 1] END AS team_name_abbr, games, mp, pts, trb, ast, stl, blk, tov
  FROM team_year
  UNION ALL
  SELECT pk, y, concat(least(count(*), CASE WHEN pk % 7 = 0 THEN 5 ELSE 4 END), 'TM'), CAST(sum(games) AS INT), CAST(sum(mp) AS INT), CAST(sum(pts) AS INT),
    CAST(sum(trb) AS INT), CAST(sum(ast) AS INT), CAST(sum(stl) AS INT), CAST(sum(blk) AS INT), CAST(sum(tov) AS INT)
  FROM team_year GROUP BY pk, y HAVING count(*) > 1)"""

STATS = f"""raw_stats AS (
  SELECT {PLAYER}, {SEASON}, CAST(20 + pk % 15 AS INT) AS age, team_name_abbr, 'NBA' AS comp_name_abbr,
    {POSITION_LIST}[pk % 8 + 1] AS pos, games, CAST(floor(games / 2) AS INT) AS games_started, mp, CAST(floor(pts / 2) AS INT) AS fg,
    pts AS fga, {part_of('pts', 130, 100)} AS fg_pct, CAST(floor(ast / 3) AS INT) AS fg3, ast AS fg3a, {part_of('ast', 7, 5)} AS fg3_pct,
    CAST(floor(pts / 3) AS INT) AS fg2, CAST(floor(pts / 2) AS INT) AS fg2a, {part_of('trb', 25, 20)} AS fg2_pct,
    {part_of('trb', 40, 25)} AS efg_pct, tov AS ft, tov + 2 AS fta, {part_of('tov', 5, 4)} AS ft_pct, CAST(floor(trb / 4) AS INT) AS orb,
    CAST(floor(trb / 2) AS INT) AS drb, trb, ast, stl, blk, tov, CAST(floor(games / 3) AS INT) AS pf, pts
  FROM lines),
season_stats AS (SELECT * FROM raw_stats WHERE season IS NOT NULL AND season NOT IN ('', 'N/A', '0')),
chosen_stats AS (
  SELECT * FROM season_stats WHERE team_name_abbr IN ('2TM', '3TM', '4TM')
  UNION ALL
  SELECT * FROM season_stats s WHERE team_name_abbr NOT IN ('2TM', '3TM', '4TM') AND NOT EXISTS (
    SELECT 1 FROM season_stats a WHERE a.team_name_abbr IN ('2TM', '3TM', '4TM') AND a.player_id = s.player_id AND a.season = s.season)),
stats AS (
  SELECT * REPLACE ({bounded('fg_pct', '0.0', '1.0')}, {bounded('fg3_pct', '0.0', '1.0')}, {bounded('fg2_pct', '0.0', '1.0')},
    {bounded('ft_pct', '0.0', '1.0')}, {bounded('efg_pct', '0.0', '1.5')}), {sql_per_game()},
    """ + ", ".join(f"CASE WHEN mp > 0 THEN {sql_round_ratio(s, 'mp', 4)} END AS {s}_per_min" for s in ("pts", "ast", "trb")) + f""",
    {START_YEAR} AS season_start_year
  FROM chosen_stats)"""

ADVANCED = f"""raw_advanced AS (
  SELECT {player('(pk + y) % 5 = 0')}, {SEASON}, CAST(20 + pk % 15 AS INT) AS age, team_name_abbr, {POSITION_LIST}[pk % 8 + 1] AS pos, games AS g, mp,
    {part_of('mp + again', 300, 10)} AS per, CAST((50 + games % 60) / CAST(100 AS DOUBLE) AS FLOAT) AS ts_pct,
    {part_of('ast', 60, 50)} AS fg3a_per_fga_pct, CAST(0.25 AS FLOAT) AS fta_per_fga_pct, {part_of('trb', 12, 1)} AS orb_pct,
    CAST(15 AS FLOAT) AS drb_pct, CAST(10 AS FLOAT) AS trb_pct, {part_of('pts', 120, 1)} AS ast_pct, CAST(1.5 AS FLOAT) AS stl_pct,
    {part_of('mp', 60, 10)} AS blk_pct, CAST(12 AS FLOAT) AS tov_pct, {part_of('trb + 15', 31, 1)} AS usg_pct, CAST(1 AS FLOAT) AS ows,
    CAST(1 AS FLOAT) AS dws, CASE WHEN pk % 19 <> 0 THEN CAST((trb % 120 - 10) / CAST(10 AS DOUBLE) AS FLOAT) END AS ws,
    {part_of('ast', 25, 100)} AS ws_per_48, CAST(0.5 AS FLOAT) AS obpm, CAST(0.5 AS FLOAT) AS dbpm,
    CASE WHEN pk % 23 = 0 THEN NULL WHEN pk % 31 = 0 THEN CAST('nan' AS FLOAT)
      ELSE CAST((pts % 1200 - 600) / CAST(10 AS DOUBLE) AS FLOAT) END AS bpm,
    CAST((ast % 70 - 10) / CAST(10 AS DOUBLE) AS FLOAT) AS vorp
  FROM (SELECT *, unnest(CASE WHEN (pk + y) % 17 = 0 THEN [0, 1] ELSE [0] END) AS again FROM lines)),
season_advanced AS (SELECT * FROM raw_advanced WHERE season IS NOT NULL AND season NOT IN ('', 'N/A', '0')),
chosen_advanced AS (
  SELECT * FROM season_advanced WHERE team_name_abbr IN ('2TM', '3TM', '4TM')
  UNION ALL
  SELECT * FROM season_advanced s WHERE team_name_abbr NOT IN ('2TM', '3TM', '4TM') AND NOT EXISTS (
    SELECT 1 FROM season_advanced a WHERE a.team_name_abbr IN ('2TM', '3TM', '4TM') AND a.player_id = s.player_id AND a.season = s.season)),
advanced AS (
  SELECT * REPLACE (""" + ", ".join([bounded(x, "0.0", "1.0") for x in ("ts_pct", "fg3a_per_fga_pct", "fta_per_fga_pct")]
                                   + [bounded(x, "0.0", "100.0") for x in ("orb_pct", "drb_pct", "trb_pct", "ast_pct", "stl_pct",
                                                                           "blk_pct", "tov_pct", "usg_pct")]
                                   + [bounded(x, "-50.0", "50.0") for x in ("ws", "bpm")]) + f"""), {START_YEAR} AS season_start_year
  FROM chosen_advanced)"""

CAPS = f"""caps AS (
  SELECT season, CAST(CASE WHEN y = 1995 THEN 0 ELSE 90000000 + 3000000 * (y - 1990) + again END AS INT) AS salary_cap, y AS season_start_year
  FROM (SELECT y, {season_label('y')} AS season, unnest(CASE WHEN y = 1997 THEN [0, 1] ELSE [0] END) AS again
        FROM (SELECT DISTINCT CAST(CASE WHEN year(l_shipdate) = 1996 THEN 2096 ELSE year(l_shipdate) END AS INT) AS y FROM lineitem)))"""

SALARIES = f"""raw_salaries AS (
  SELECT {player('(pk + 2 * y) % 6 = 0')}, {SEASON}, CASE WHEN pk % 33 = 0 THEN NULL ELSE {CODE_LIST}[t + 1] END AS team,
    CASE WHEN pk % 7 = 0 THEN concat(n, ' (TW)') WHEN pk % 11 = 0 THEN '< Minimum' WHEN pk % 13 = 0 THEN concat(' ', n, ' < Minimum')
      WHEN pk % 17 = 0 THEN concat('$', n) WHEN pk % 19 = 0 THEN concat(n, chr(127)) WHEN pk % 23 = 0 THEN concat(n, '.0')
      WHEN pk % 25 = 0 THEN concat(n, chr(133)) WHEN pk % 27 = 0 THEN '0' WHEN pk % 29 = 0 THEN NULL ELSE n END AS txt
  FROM (SELECT *, CAST(1000000 + (pts * 7919) % 40000000 AS VARCHAR) AS n FROM team_year)),
amounts AS (
  SELECT player_id, season, team, contains(txt, '(TW)') AS is_two_way, contains(txt, '< Minimum') AS is_sub_minimum,
    trim(replace(replace(txt, '(TW)', ''), '< Minimum', '')) AS s
  FROM raw_salaries WHERE season IS NOT NULL AND season <> ''),
paid AS (
  SELECT player_id, season, CAST(sum(salary) AS BIGINT) AS salary, coalesce(string_agg(DISTINCT team, ' / ' ORDER BY team), '') AS teams,
    bool_or(is_two_way) AS is_two_way, bool_or(is_sub_minimum) AS is_sub_minimum
  FROM (SELECT *, CASE WHEN s <> '' THEN {sql_text_to_integer('s')} END AS salary FROM amounts) WHERE salary IS NOT NULL
  GROUP BY player_id, season),
salaries AS (
  SELECT p.season, p.player_id, p.salary, p.teams, p.is_two_way, p.is_sub_minimum,
    {sql_text_to_integer('substring(p.season, 1, 4)', 'INT')} AS season_start_year, c.salary_cap,
    CASE WHEN c.salary_cap > 0 THEN {sql_round_ratio('p.salary', 'c.salary_cap', 6)} END AS salary_pct_of_cap
  FROM paid p LEFT JOIN caps c ON c.season = p.season)"""

STANDINGS = f"""raw_standings AS (
  SELECT CASE WHEN t = 3 THEN '' ELSE {season_label('y')} END AS season,
    CASE t WHEN 5 THEN 'Unknown Team' WHEN 7 THEN 'Unknown Team' WHEN 6 THEN NULL ELSE {NAME_LIST}[t + 1] END AS team,
    CASE t WHEN 8 THEN '0-0' WHEN 9 THEN 'none' ELSE concat(sum(stl), '-', sum(blk)) END AS overall
  FROM team_year GROUP BY y, t),
records AS (
  SELECT *, {sql_text_to_integer("string_split(overall, '-')[1]", 'INT')} AS wins,
    {sql_text_to_integer("string_split(overall, '-')[2]", 'INT')} AS losses
  FROM raw_standings WHERE season <> '' AND team <> ''),
standings AS (
  SELECT *, CASE WHEN wins + losses > 0 THEN {sql_round_ratio('wins', 'wins + losses', 4)} END AS win_pct,
    CASE team {CODE_OF_NAME} END AS team_name_abbr, {START_YEAR} AS season_start_year
  FROM records)"""

PROFILES = """raw_profiles AS (
  SELECT CASE WHEN pk % 47 = 0 THEN '' WHEN pk % 41 = 0 THEN NULL WHEN pk % 9 = 0 THEN concat('q', pk)
      ELSE concat('p', pk) END AS player_id, p_name AS name,
    CASE WHEN pk % 5 <> 0 THEN p_brand END AS college, CASE WHEN pk % 4 <> 0 THEN CAST(1980 + pk % 40 AS INT) END AS draft_year,
    CASE WHEN pk % 6 <> 0 THEN CAST(1 + pk % 2 AS INT) END AS draft_round, CAST(1 + pk % 60 AS INT) AS draft_pick,
    CAST(70 + p_size % 20 AS INT) AS height, CAST(180 + p_size AS INT) AS weight, 'USA' AS country,
    CASE WHEN pk % 8 <> 0 THEN CAST(1981 + pk % 40 AS INT) END AS nba_debut_year, CAST(pk % 3 AS INT) AS all_nba_appearances
  FROM (SELECT *, p_partkey AS pk FROM part)),
profiles AS (
  SELECT * REPLACE (coalesce(college, 'None') AS college, coalesce(draft_year, -1) AS draft_year, coalesce(draft_round, -1) AS draft_round,
    coalesce(nba_debut_year, -1) AS nba_debut_year), draft_year IS NOT NULL AS is_drafted
  FROM raw_profiles WHERE player_id IS NOT NULL AND player_id <> '')"""

ADVANCED_TAKEN = ("per, ts_pct, fg3a_per_fga_pct, fta_per_fga_pct, orb_pct, drb_pct, trb_pct, ast_pct, stl_pct, blk_pct, tov_pct, "
                  "usg_pct, ows, dws, ws, ws_per_48, obpm, dbpm, bpm, vorp")
ALL_TABLES = ",\n".join([BASE, STATS, ADVANCED, CAPS, SALARIES, STANDINGS, PROFILES])
UNIFIED = f"""unified AS (
  SELECT s.*, {', '.join('a.' + x for x in ADVANCED_TAKEN.split(', '))}, p.* EXCLUDE (player_id),
    m.salary AS player_salary, m.teams, m.is_two_way, m.is_sub_minimum, m.salary_cap, m.salary_pct_of_cap,
    c.salary_cap AS league_salary_cap, w.wins, w.losses, w.win_pct
  FROM stats s
  LEFT JOIN advanced a ON a.player_id = s.player_id AND a.season = s.season
  LEFT JOIN profiles p ON p.player_id = s.player_id
  LEFT JOIN salaries m ON m.player_id = s.player_id AND m.season = s.season
  LEFT JOIN caps c ON c.season = s.season
  LEFT JOIN standings w ON w.season_start_year = s.season_start_year AND w.team_name_abbr = s.team_name_abbr)"""
WITH_UNIFIED = f"WITH {ALL_TABLES},\n{UNIFIED}"

SCORED = WITH_UNIFIED + f""",
qualified AS (
  SELECT * REPLACE (CAST(player_salary AS DOUBLE) AS player_salary) FROM unified
  WHERE player_salary > 0 AND games >= 20 AND mp >= 200 AND team_name_abbr NOT IN ('2TM', '3TM', '4TM', '5TM', '6TM')),
scored AS (
  SELECT *, {PRODUCTION} AS production_score, greatest(salary_pct_of_cap, 0.01) AS salary_cap_share,
    ({PRODUCTION}) / greatest(salary_pct_of_cap, 0.01) AS composite_value_score, 82 AS games_possible,
    least(games / 82, 1.0) AS availability_rate
  FROM qualified),
valued AS (
  SELECT *, composite_value_score * availability_rate AS availability_adj_cvs, player_salary * (1.0 - availability_rate) AS missed_game_cost
  FROM scored)"""

PLAYERS = WITH_UNIFIED + f""",
able AS (
  SELECT *, mp / games AS min_per_game, (pts / mp) * 36 AS pts_per36, (ast / mp) * 36 AS ast_per36, (trb / mp) * 36 AS trb_per36,
    (stl / mp) * 36 AS stl_per36, (blk / mp) * 36 AS blk_per36, (fg3a / mp) * 36 AS fg3a_per36, player_salary / 1000000.0 AS salary_millions
  FROM unified WHERE games >= 20 AND player_salary > 0 AND mp > 0 AND ws IS NOT NULL),
feat AS (SELECT *, pts_per36 AS p36, ast_per36 AS a36, trb_per36 AS t36, stl_per36 AS s36, blk_per36 AS b36, fg3a_per36 AS f36 FROM able),
{label_rules('feat')},
players AS (
  SELECT *, CASE WHEN ws > 0 THEN player_salary / CAST(ws AS DOUBLE) END AS cost_per_ws,
    CAST(vorp AS DOUBLE) - 5.0 * salary_pct_of_cap AS value_score, CAST(games AS DOUBLE) / 82.0 AS availability,
    CASE WHEN ws > 0 THEN player_salary / (CAST(ws AS DOUBLE) * (CAST(games AS DOUBLE) / 82.0)) END AS cost_per_available_ws,
    ({PRODUCTION}) / (CAST(player_salary AS DOUBLE) / 1000000.0) AS composite_index
  FROM lab)"""
PLAYER_LIST = ", ".join(K.PLAYER_ARCHETYPE_COLUMNS)


def mean(x: str, name: str, digits: int = 6) -> str:
    return f"round(avg(CAST({x} AS DOUBLE)), {digits}) AS {name}"


TIERED = SCORED.split(",\nscored AS (")[0] + f""",
whole AS (
  SELECT *, {tier_case('salary_pct_of_cap')} AS salary_group FROM qualified
  WHERE salary_pct_of_cap IS NOT NULL AND bpm IS NOT NULL AND ws_per_48 IS NOT NULL AND ts_pct IS NOT NULL AND usg_pct IS NOT NULL),
means AS (
  SELECT salary_group, avg(CAST(bpm AS DOUBLE)) AS avg_bpm, avg(CAST(ws_per_48 AS DOUBLE)) AS avg_ws_per_48,
    avg(CAST(ts_pct AS DOUBLE)) AS avg_ts_pct, avg(CAST(usg_pct AS DOUBLE)) AS avg_usg_pct
  FROM whole GROUP BY salary_group),
apart AS (
  SELECT w.*, avg_bpm, avg_ws_per_48, avg_ts_pct, avg_usg_pct, bpm - avg_bpm AS bpm_diff, ws_per_48 - avg_ws_per_48 AS ws_per_48_diff,
    ts_pct - avg_ts_pct AS ts_pct_diff, usg_pct - avg_usg_pct AS usg_pct_diff
  FROM whole w JOIN means USING (salary_group)),
spread AS (
  SELECT stddev_samp(bpm_diff) AS d1, stddev_samp(ws_per_48_diff) AS d2, stddev_samp(ts_pct_diff) AS d3, stddev_samp(usg_pct_diff) AS d4,
    avg(bpm_diff) AS m1, avg(ws_per_48_diff) AS m2, avg(ts_pct_diff) AS m3, avg(usg_pct_diff) AS m4 FROM apart),
tiers AS (
  SELECT apart.*, 0.40 * coalesce((bpm_diff - m1) / nullif(d1, 0), 0) + 0.25 * coalesce((ws_per_48_diff - m2) / nullif(d2, 0), 0)
    + 0.20 * coalesce((ts_pct_diff - m3) / nullif(d3, 0), 0) + 0.15 * coalesce((usg_pct_diff - m4) / nullif(d4, 0), 0) AS value_score
  FROM apart CROSS JOIN spread)"""
ROUNDED = ("avg_bpm", "avg_ws_per_48", "avg_ts_pct", "avg_usg_pct", "bpm_diff", "ws_per_48_diff", "ts_pct_diff", "usg_pct_diff", "value_score")


def report(name: str, raw: str, clean: str) -> str:
    return (f"SELECT '{name}' AS table_name, (SELECT count(*) FROM {raw}) AS raw_rows, (SELECT count(*) FROM {clean}) AS clean_rows, "
            f"(SELECT count(*) FROM {raw}) - (SELECT count(*) FROM {clean}) AS dropped_rows")


ORACLE = {
    "q12_unify": WITH_UNIFIED + "\nSELECT * FROM unified",
    "q29_clean_profiles": f"WITH {PROFILES}\nSELECT * FROM profiles",
    "q30_clean_stats": f"WITH {BASE}, {STATS}\nSELECT * FROM stats",
    "q31_clean_salaries": f"WITH {BASE}, {CAPS}, {SALARIES}\nSELECT * FROM salaries",
    "q32_clean_advanced": f"WITH {BASE}, {ADVANCED}\nSELECT * FROM advanced",
    "q33_clean_standings": f"WITH {BASE}, {STANDINGS}\nSELECT * FROM standings",
    "q34_clean_caps": f"WITH {CAPS}\nSELECT * FROM caps",
    "q35_foundation_report": f"WITH {ALL_TABLES}\n" + "\nUNION ALL ".join([
        report("player_profiles", "raw_profiles", "profiles"), report("nba_stats", "raw_stats", "stats"),
        report("nba_salaries", "raw_salaries", "salaries"), report("nba_salary_cap", "caps", "caps"),
        report("nba_advanced_player_stats", "raw_advanced", "advanced"),
        report("nba_expanded_standings_2000_2026", "raw_standings", "standings")]),
    "q36_composite_table": SCORED + "\nSELECT " + ", ".join(K.CVS_COLUMNS) + " FROM valued",
    "q37_archetype_players": PLAYERS + f"\nSELECT {PLAYER_LIST} FROM players",
    "q38_archetype_rollup": PLAYERS + f"""
SELECT season, season_start_year, archetype, count(*) AS player_count, {mean('cost_per_ws', 'avg_cost_per_ws', 2)},
  {mean('value_score', 'avg_value_score')}, {mean('composite_index', 'avg_composite_index')}, {mean('ws', 'avg_win_shares')},
  {mean('vorp', 'avg_vorp')}, {mean('per', 'avg_per')}, {mean('salary_millions', 'avg_salary_millions')},
  CAST(sum(player_salary) AS BIGINT) AS total_archetype_salary, {mean('availability', 'avg_availability')}, {mean('ts_pct', 'avg_ts_pct')},
  {mean('bpm', 'avg_bpm')}, {mean('ws_per_48', 'avg_ws_per_48')}, round(avg(cost_per_ws) / 1000000.0, 6) AS cost_per_ws_millions,
  round(CAST(sum(player_salary) AS DOUBLE) / 1000000.0, 6) AS total_archetype_salary_millions
FROM players GROUP BY season, season_start_year, archetype""",
    "q39_archetype_top": PLAYERS + f"""
SELECT * FROM (
  SELECT {PLAYER_LIST}, CAST(rank() OVER (PARTITION BY season, archetype ORDER BY value_score DESC NULLS LAST) AS INT) AS archetype_rank
  FROM players) WHERE archetype_rank <= 5""",
    "q40_tier_table": TIERED + "\nSELECT " + ", ".join(f"round({x}, 6) + 0.0 AS {x}" if x in ROUNDED else x for x in K.TIER_COLUMNS) + " FROM tiers",
    "q41_player_history": SCORED + "\nSELECT player_id, season, composite_value_score FROM valued WHERE player_id = 'p14' OR name = 'p14'",
}


def one_row(table: str, keys: str, columns: str) -> str:
    """The least row of each key."""
    order = ", ".join(f"{x} NULLS FIRST" for x in columns.split(", "))
    return f"(SELECT * FROM {table} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1)"


ORACLE["q50_player_history_clustered"] = ORACLE["q41_player_history"]
ORACLE["q43_unify_bucketed"] = ORACLE["q12_unify"]
ORACLE["q44_unify_first"] = (ORACLE["q12_unify"].replace("LEFT JOIN advanced a", "LEFT JOIN " + one_row("advanced", "player_id, season", ADVANCED_TAKEN) + " a")
                             .replace("LEFT JOIN caps c ON c.season = s.season", "LEFT JOIN " + one_row("caps", "season", "salary_cap") + " c ON c.season = s.season")
                             .replace("LEFT JOIN salaries m", "LEFT JOIN " + one_row("salaries", "player_id, season", "salary, teams, is_two_way, is_sub_minimum, salary_cap") + " m")
                             .replace("LEFT JOIN standings w", "LEFT JOIN " + one_row("standings", "season_start_year, team_name_abbr", "wins, losses, win_pct") + " w"))
ORACLE["q45_rollup_states"] = ORACLE["q38_archetype_rollup"].replace("SELECT season, season_start_year, archetype, count(*) AS player_count",
                                                                     "SELECT season, season_start_year, archetype, count(cost_per_ws) AS n_costs, TRUE AS median_in_bounds, "
                                                                     "count(*) AS player_count")
ORACLE["q46_published_seasons"] = f"""WITH {BASE}, {STANDINGS}
SELECT season, team, CASE WHEN season_start_year % 2 = 0 THEN wins * 2 ELSE wins END AS wins, losses, season_start_year FROM standings"""

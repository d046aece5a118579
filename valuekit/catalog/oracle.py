"""DuckDB statements of the catalogue queries (the correctness oracle).

Written by hand from the semantics, not generated from the Spark operators. Engine differences
threshold test, Spark's half-up rounding of an integer ratio is computed with
integer division, Spark's non-ANSI text-to-integer cast is written as a
regular expression, ``NULLS`` placement is explicit, and aggregates of doubles
are rounded like the Spark side.
"""

from __future__ import annotations

from valuekit.catalog.shapes import SS_SQL, SSX_SQL, sql_per_game, sql_round_ratio

WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(127)"


def sql_text_to_integer(expr: str, typ: str = "BIGINT") -> str:
    t = f"trim({expr}, {WS})"
    whole = f"regexp_extract({t}, '^([+-]?[0-9]*)', 1)"
    return (f"(CASE WHEN regexp_matches({t}, '^[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]*)$') "
            f"THEN TRY_CAST(CASE WHEN {whole} IN ('', '+', '-') THEN '0' ELSE {whole} END AS {typ}) END)")


def season_label(y: str) -> str:
    return f"concat(CAST({y} AS VARCHAR), '-', lpad(CAST(({y} + 1) % 100 AS VARCHAR), 2, '0'))"


PRODUCTION = ("1.0 * pts_per_game + 1.2 * trb_per_game + 1.5 * ast_per_game + 2.0 * stl_per_game"
              " + 2.0 * blk_per_game - 1.0 * tov_per_game")

LI_COLS = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_linestatus"

# ------------------------------------------------------------------ shared CTEs

MONEY_CTE = f"""m AS (
  SELECT c_custkey, c_nationkey, c_mktsegment,
    CASE c_mktsegment WHEN 'MACHINERY' THEN concat(n, ' (TW)') WHEN 'FURNITURE' THEN concat(n, ' < Minimum')
      WHEN 'BUILDING' THEN '< Minimum' WHEN 'HOUSEHOLD' THEN concat('$', n)
      WHEN 'AUTOMOBILE' THEN concat(n, '.75') ELSE n END AS txt
  FROM (SELECT *, CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) AS VARCHAR) AS n FROM customer)),
mp AS (
  SELECT c_custkey, c_nationkey, c_mktsegment, contains(txt, '(TW)') AS is_two_way,
    contains(txt, '< Minimum') AS is_sub_minimum,
    trim(replace(replace(txt, '(TW)', ''), '< Minimum', '')) AS s
  FROM m),
parsed AS (
  SELECT * FROM (
    SELECT c_custkey, c_nationkey, c_mktsegment, is_two_way, is_sub_minimum,
      CASE WHEN s = '' THEN NULL ELSE {sql_text_to_integer('s')} END AS salary
    FROM mp) WHERE salary IS NOT NULL)"""

CVS_CTE = SSX_SQL + f""",
g AS (SELECT ssx.*, {sql_per_game()} FROM ssx),
q AS (SELECT * FROM g WHERE player_salary IS NOT NULL AND player_salary > 0 AND games >= 80 AND mp >= 200
        AND team_name_abbr NOT IN ('2TM', '3TM', '4TM', '5TM', '6TM')),
cvs AS (
  SELECT *, CAST(player_salary AS DOUBLE) AS salary_d, {PRODUCTION} AS production_score,
    greatest(salary_pct_of_cap, 0.01) AS salary_cap_share,
    ({PRODUCTION}) / greatest(salary_pct_of_cap, 0.01) AS composite_value_score,
    CASE WHEN season = '1998-99' THEN 50 ELSE 82 END AS games_possible
  FROM q),
cvs2 AS (SELECT *, least(games / games_possible, 1.0) AS availability_rate FROM cvs),
cvs3 AS (SELECT *, composite_value_score * availability_rate AS availability_adj_cvs,
           salary_d * (1.0 - availability_rate) AS missed_game_cost FROM cvs2)"""


def label_rules(src: str) -> str:
    """The eight-way label over ``src``, which has p36, a36, t36, s36, b36, f36."""
    d = "CAST({} AS DOUBLE)".format
    guard = "pos IN ('PG', 'SG', 'G')"
    wing = "pos IN ('SF', 'SG-SF', 'SF-SG', 'F')"
    big = "pos IN ('PF', 'C', 'C-PF', 'PF-C', 'F-C')"
    u, ts, astp, blkp, orbp, ws48, fg3r = (d(c) for c in ("usg_pct", "ts_pct", "ast_pct", "blk_pct", "orb_pct",
                                                          "ws_per_48", "fg3a_per_fga_pct"))

    def pts(cond: str, n: int) -> str:
        return f"(CASE WHEN {cond} THEN {n} ELSE 0 END)"

    e = " + ".join([pts(f"{u} >= 25", 2), pts("p36 >= 20", 2), pts(f"{ts} >= 0.56", 1),
                    pts(f"{u} >= 22 AND p36 >= 18", 1)])
    w = " + ".join([pts(f"{fg3r} >= 0.45", 2), pts("f36 >= 5.0", 1), pts("s36 + b36 >= 2.5", 2), pts(wing, 1),
                    pts("a36 < 3.5", 1)])
    p = " + ".join([pts(f"{astp} >= 28", 3), pts("a36 >= 7.0", 2), pts(guard, 1), pts(f"{u} >= 22", 1)])
    r = " + ".join([pts(f"{blkp} >= 4.0", 3), pts("b36 >= 2.0", 2), pts(big, 1), pts(f"{orbp} >= 8.0", 1),
                    pts("t36 >= 9.0", 1)])
    s = " + ".join([pts(f"{big} AND {fg3r} >= 0.30", 3), pts(f"{big} AND f36 >= 3.5", 2), pts("a36 < 3.0", 1)])
    t = " + ".join([pts("s36 + b36 >= 3.0", 2), pts(f"{ws48} >= 0.12", 2), pts(f"{blkp} >= 2.5 AND s36 >= 1.0", 2)])
    c = " + ".join([pts(f"{guard} AND p36 >= 14 AND a36 >= 3.5", 3), pts(f"{guard} AND {fg3r} >= 0.30", 1),
                    pts(f"{guard} AND {u} < 25", 1)])
    inputs = ["pos", "usg_pct", "p36", "ts_pct", "f36", "s36", "b36", "a36", "ast_pct", "blk_pct", "orb_pct", "t36",
              "ws_per_48", "fg3a_per_fga_pct"]
    any_null = " OR ".join(f"{x} IS NULL" for x in inputs)
    return f"""sc AS (SELECT *, {e} AS sc_e, {w} AS sc_w, {p} AS sc_p, {r} AS sc_r, {s} AS sc_s, {t} AS sc_t, {c} AS sc_c,
         1 AS sc_g FROM {src}),
lab AS (
  SELECT *, CASE WHEN {any_null} THEN 'Role Player / Glue Guy'
    WHEN sc_e = greatest(sc_e, sc_w, sc_p, sc_r, sc_s, sc_t, sc_c, sc_g) THEN 'Elite Scorer'
    WHEN sc_w = greatest(sc_e, sc_w, sc_p, sc_r, sc_s, sc_t, sc_c, sc_g) THEN '3-and-D Wing'
    WHEN sc_p = greatest(sc_e, sc_w, sc_p, sc_r, sc_s, sc_t, sc_c, sc_g) THEN 'Playmaking Engine'
    WHEN sc_r = greatest(sc_e, sc_w, sc_p, sc_r, sc_s, sc_t, sc_c, sc_g) THEN 'Rim Protector'
    WHEN sc_s = greatest(sc_e, sc_w, sc_p, sc_r, sc_s, sc_t, sc_c, sc_g) THEN 'Stretch Big'
    WHEN sc_t = greatest(sc_e, sc_w, sc_p, sc_r, sc_s, sc_t, sc_c, sc_g) THEN 'Two-Way Anchor'
    WHEN sc_c = greatest(sc_e, sc_w, sc_p, sc_r, sc_s, sc_t, sc_c, sc_g) THEN 'Combo Guard'
    ELSE 'Role Player / Glue Guy' END AS archetype
  FROM sc)"""


def label_cte(src: str) -> str:
    """Stand-in per-36 features and the label over ``src``."""
    return f"""feat AS (
  SELECT *, CAST(pts % 28 AS DOUBLE) AS p36, CAST(ast % 10 AS DOUBLE) AS a36, CAST(trb % 13 AS DOUBLE) AS t36,
    CAST(stl % 25 AS DOUBLE) / 10 AS s36, CAST(blk % 30 AS DOUBLE) / 10 AS b36, CAST(fg3a % 9 AS DOUBLE) AS f36
  FROM {src}),
{label_rules('feat')}"""


METRICS_CTE = SSX_SQL + f""",
g AS (SELECT ssx.*, {sql_per_game()} FROM ssx),
q AS (SELECT * FROM g WHERE games >= 80 AND player_salary > 0 AND mp > 0 AND ws IS NOT NULL),
{label_cte('q')},
pm AS (
  SELECT *,
    CASE WHEN ws > 0 THEN player_salary / CAST(ws AS DOUBLE) END AS cost_per_ws,
    CAST(vorp AS DOUBLE) - 5.0 * salary_pct_of_cap AS value_score,
    CAST(games AS DOUBLE) / 82.0 AS availability,
    CASE WHEN ws > 0 AND CAST(games AS DOUBLE) / 82.0 > 0
      THEN player_salary / (CAST(ws AS DOUBLE) * (CAST(games AS DOUBLE) / 82.0)) END AS cost_per_available_ws,
    ({PRODUCTION}) / (CAST(player_salary AS DOUBLE) / 1000000.0) AS composite_index,
    CAST(player_salary AS DOUBLE) / 1000000.0 AS salary_millions
  FROM lab)"""

ROLLUP_SELECT = """SELECT season, season_start_year, archetype, count(*) AS player_count,
    round(avg(cost_per_ws), 2) AS avg_cost_per_ws,
    quantile_disc(cost_per_ws, 0.5) AS median_cost_per_ws,
    round(avg(value_score), 8) AS avg_value_score,
    round(avg(composite_index), 8) AS avg_composite_index,
    round(avg(CAST(ws AS DOUBLE)), 8) AS avg_win_shares,
    round(avg(CAST(vorp AS DOUBLE)), 8) AS avg_vorp,
    round(avg(CAST(per AS DOUBLE)), 8) AS avg_per,
    round(avg(salary_millions), 8) AS avg_salary_millions,
    CAST(sum(player_salary) AS BIGINT) AS total_archetype_salary,
    round(avg(availability), 8) AS avg_availability,
    round(avg(CAST(ts_pct AS DOUBLE)), 8) AS avg_ts_pct,
    round(avg(CAST(bpm AS DOUBLE)), 8) AS avg_bpm,
    round(avg(CAST(ws_per_48 AS DOUBLE)), 8) AS avg_ws_per_48,
    round(avg(cost_per_ws) / 1000000.0, 8) AS cost_per_ws_millions,
    round(CAST(sum(player_salary) AS DOUBLE) / 1000000.0, 8) AS total_archetype_salary_millions
  FROM pm GROUP BY season, season_start_year, archetype"""


def prefer_sql(src: str, cols: str, keys: tuple[str, str], tag: str, tags: str) -> str:
    k1, k2 = keys
    return f"""SELECT {cols} FROM {src} WHERE {tag} IN ({tags})
UNION ALL
SELECT {cols} FROM {src} u WHERE NOT ({tag} IN ({tags})) AND NOT EXISTS (
  SELECT 1 FROM {src} a WHERE a.{tag} IN ({tags}) AND a.{k1} = u.{k1} AND a.{k2} = u.{k2})"""


def tier_case(x: str) -> str:
    return (f"CAST(CASE WHEN {x} >= 0.30 THEN 6 WHEN {x} >= 0.24 THEN 5 WHEN {x} >= 0.18 THEN 4 "
            f"WHEN {x} >= 0.12 THEN 3 WHEN {x} >= 0.07 THEN 2 WHEN {x} >= 0.03 THEN 1 ELSE 0 END AS DOUBLE)")


ORACLE = {
    "q01_csv_roundtrip": """
SELECT c_custkey, c_name, c_nationkey, n_name, c_acctbal, c_mktsegment
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",

    "q02_key_sentinel_filter": f"""
WITH r AS (
  SELECT c_custkey,
    CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 10 = 1 THEN '' ELSE c_name END AS entity_id,
    CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 7 = 1 THEN '' WHEN c_custkey % 7 = 2 THEN 'N/A'
      WHEN c_custkey % 7 = 3 THEN '0' ELSE {season_label('(1990 + c_nationkey)')} END AS season,
    CASE WHEN c_custkey % 5 = 0 THEN 'n/a' ELSE CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) END AS amount
  FROM customer),
f AS (SELECT * FROM r WHERE entity_id IS NOT NULL AND entity_id <> ''
        AND season IS NOT NULL AND season NOT IN ('', 'N/A', '0')),
p AS (SELECT c_custkey, entity_id, season,
        CASE WHEN trim(amount) = '' THEN NULL ELSE {sql_text_to_integer('trim(amount)')} END AS amount FROM f)
SELECT c_custkey, entity_id, season, amount, {sql_text_to_integer('substring(season, 1, 4)', 'INT')} AS season_start_year
FROM p WHERE amount IS NOT NULL""",

    "q03_fill_and_flag": """
WITH r AS (
  SELECT l_orderkey, max(l_linestatus) AS college, CAST(avg(l_quantity) AS FLOAT) AS draft_year,
    CAST(max(l_linenumber) AS FLOAT) AS draft_pick
  FROM lineitem GROUP BY l_orderkey),
j AS (
  SELECT o_orderkey, coalesce(college, 'None') AS college,
    CAST(trunc(coalesce(draft_year, CAST(-1.0 AS FLOAT))) AS INT) AS draft_year,
    CAST(trunc(coalesce(draft_pick, CAST(-1.0 AS FLOAT))) AS INT) AS draft_pick
  FROM orders LEFT JOIN r ON o_orderkey = CASE WHEN l_orderkey % 3 <> 0 THEN l_orderkey END)
SELECT o_orderkey, college, draft_year, draft_pick, CASE WHEN draft_year = -1 THEN false ELSE true END AS is_drafted
FROM j""",

    "q04_range_to_null": """
WITH v AS (
  SELECT l_orderkey, l_linenumber, CAST(l_discount * 12 AS FLOAT) AS a, CAST(l_tax * 20 AS FLOAT) AS b,
    CAST(l_quantity * 2.5 AS FLOAT) AS c, CAST((l_extendedprice - 50000) / 1000 AS FLOAT) AS d
  FROM lineitem)
SELECT l_orderkey, l_linenumber,
  CASE WHEN CAST(a AS DOUBLE) BETWEEN 0.0 AND 1.0 THEN a END AS shot_pct,
  CASE WHEN CAST(b AS DOUBLE) BETWEEN 0.0 AND 1.5 THEN b END AS efg_pct,
  CASE WHEN CAST(c AS DOUBLE) BETWEEN 0.0 AND 100.0 THEN c END AS usage_pct,
  CASE WHEN CAST(d AS DOUBLE) BETWEEN -50.0 AND 50.0 THEN d END AS win_shares
FROM v""",

    "q05_prefer_aggregate": prefer_sql("lineitem", LI_COLS, ("l_orderkey", "l_linenumber"), "l_returnflag", "'A'"),

    "q06_rates": "WITH " + SS_SQL + f"""
SELECT player_id, season, games, mp, {sql_per_game()},
  """ + ",\n  ".join(f"CASE WHEN mp > 0 THEN {sql_round_ratio(s, 'mp', 4)} END AS {s}_per_min"
                     for s in ("pts", "ast", "trb")) + "\nFROM ss",

    "q07_money_parse": f"WITH {MONEY_CTE}\nSELECT * FROM parsed",

    "q08_consolidate": f"""WITH {MONEY_CTE},
j AS (
  SELECT n_name AS player_id, c_mktsegment AS season, salary,
    CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE concat('T', CAST(c_custkey % 5 AS VARCHAR)) END AS team,
    is_two_way, is_sub_minimum
  FROM parsed LEFT JOIN nation ON c_nationkey = n_nationkey)
SELECT player_id, season, CAST(sum(salary) AS BIGINT) AS salary,
  coalesce(string_agg(DISTINCT team, ' / ' ORDER BY team), '') AS teams,
  bool_or(is_two_way) AS is_two_way, bool_or(is_sub_minimum) AS is_sub_minimum
FROM j GROUP BY player_id, season""",

    "q09_record_split": f"""
WITH g AS (
  SELECT CAST(year(o_orderdate) AS INT) AS y, o_orderpriority AS team,
    count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS f, count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS o,
    count(CASE WHEN o_orderstatus = 'X' THEN 1 END) AS x, count(CASE WHEN o_orderstatus = 'Y' THEN 1 END) AS z
  FROM orders GROUP BY 1, 2),
r AS (
  SELECT {season_label('y')} AS season, team,
    CASE WHEN team = '5-LOW' THEN team
      WHEN team = '1-URGENT' THEN concat(CAST(x AS VARCHAR), '-', CAST(z AS VARCHAR))
      ELSE concat(CAST(f AS VARCHAR), '-', CAST(o AS VARCHAR)) END AS overall
  FROM g),
s AS (
  SELECT season, team, overall,
    {sql_text_to_integer("string_split(overall, '-')[1]", 'INT')} AS wins,
    {sql_text_to_integer("string_split(overall, '-')[2]", 'INT')} AS losses
  FROM r WHERE season IS NOT NULL AND season <> '' AND team IS NOT NULL AND team <> '')
SELECT season, team, overall, wins, losses,
  CASE WHEN wins + losses > 0 THEN {sql_round_ratio('wins', 'wins + losses', 4)} END AS win_pct,
  {sql_text_to_integer('substring(season, 1, 4)', 'INT')} AS season_start_year
FROM s""",

    "q10_map_lookup": """
SELECT c_custkey, r_name,
  CASE r_name WHEN 'AFRICA' THEN 'AFR' WHEN 'AMERICA' THEN 'AME' WHEN 'ASIA' THEN 'ASI' WHEN 'EUROPE' THEN 'EUR'
  END AS region_code
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",

    "q11_normalize_to_cap": """
WITH o AS (SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INT) AS season_start_year FROM orders),
c AS (
  SELECT season_start_year, CASE WHEN season_start_year = 1998 THEN 0.0 ELSE max(o_totalprice) END AS salary_cap
  FROM o GROUP BY season_start_year HAVING season_start_year <> 2001)
SELECT o.o_orderkey, o.o_totalprice, o.season_start_year, c.salary_cap,
  CASE WHEN c.salary_cap IS NOT NULL AND c.salary_cap > 0 THEN round(o.o_totalprice / c.salary_cap, 6) END
    AS salary_pct_of_cap
FROM o LEFT JOIN c ON o.season_start_year = c.season_start_year""",

    "q13_season_start": f"""
WITH s AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN 'N/A'
    ELSE {season_label('CAST(year(o_orderdate) AS INT)')} END AS season
  FROM orders)
SELECT o_orderkey, season, {sql_text_to_integer('substring(season, 1, 4)', 'INT')} AS season_start_year FROM s""",

    "q14_composite_value": "WITH " + CVS_CTE + """
SELECT player_id, season, team_name_abbr, games, mp, salary_d AS player_salary, salary_pct_of_cap,
  production_score, salary_cap_share, composite_value_score
FROM cvs3""",

    "q15_availability": "WITH " + CVS_CTE + """
SELECT player_id, season, games, games_possible, availability_rate, availability_adj_cvs, missed_game_cost
FROM cvs3""",

    "q16_per36": "WITH " + SSX_SQL + """,
q AS (SELECT * FROM ssx WHERE games >= 80 AND player_salary > 0 AND mp > 0 AND ws IS NOT NULL)
SELECT player_id, season, mp / games AS min_per_game, """ + ", ".join(
        f"({s} / mp) * 36 AS {s}_per36" for s in ("pts", "ast", "trb", "stl", "blk", "fg3a", "fg2a", "tov")) + """,
  CAST(player_salary AS DOUBLE) / 1000000.0 AS salary_millions, salary_pct_of_cap AS salary_share
FROM q""",

    "q17_rule_label": "WITH " + SS_SQL + ",\n" + label_cte("ss") + """
SELECT player_id, season, pos, archetype FROM lab""",

    "q18_value_metrics": "WITH " + METRICS_CTE + """
SELECT player_id, season, cost_per_ws, value_score, availability, cost_per_available_ws, composite_index FROM pm""",

    "q19_label_season_rollup": "WITH " + METRICS_CTE + "\n" + ROLLUP_SELECT,

    "q47_topk_heavy_ties": """
SELECT * FROM (SELECT l_returnflag, l_orderkey, l_linenumber, l_quantity,
  CAST(rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC NULLS LAST) AS INTEGER) AS rank FROM lineitem)
WHERE rank <= 3""",
    "q48_quarantined_records": """
WITH c AS (SELECT c_custkey % 10 AS kind, CAST(c_custkey AS VARCHAR) AS k, c_name AS n,
                  CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR) AS b FROM customer)
SELECT k || ',' || CASE WHEN kind = 5 THEN '' ELSE n END || ',' || b AS record, NULL AS field, 'kept' AS reason
FROM c WHERE kind NOT IN (1, 2, 3, 4)
UNION ALL SELECT k || ',' || n || ',n/a', 'c_cents', 'not bigint' FROM c WHERE kind = 1
UNION ALL SELECT k || ',' || n, 'c_cents', 'missing' FROM c WHERE kind = 2
UNION ALL SELECT k || ',' || n || ',' || b || ',extra', NULL, 'more fields than columns' FROM c WHERE kind = 3
UNION ALL SELECT 'x' || k || ',' || n || ',?', 'c_custkey', 'not bigint' FROM c WHERE kind = 4
UNION ALL SELECT 'x' || k || ',' || n || ',?', 'c_cents', 'not bigint' FROM c WHERE kind = 4""",
    "q49_suspect_profile": """
WITH rows_in AS (
  SELECT unnest(['lineitem', 'lineitem by hash']) AS table_name, l_orderkey AS a, nullif(l_linenumber, 7) AS b, TRUE AS two FROM lineitem
  UNION ALL SELECT 'orders', o_orderkey, NULL, FALSE FROM orders),
k AS (SELECT table_name, two, a, b, count(*) AS c FROM rows_in GROUP BY table_name, two, a, b),
n AS (SELECT table_name, two, sum(c) AS total, count(*) AS keys, count_if(c > 1) AS repeated,
        coalesce(sum(CASE WHEN a IS NULL THEN c END), 0) AS null_a, coalesce(sum(CASE WHEN b IS NULL THEN c END), 0) AS null_b
      FROM k GROUP BY table_name, two),
items AS (
  SELECT table_name, 'total_rows' AS item, total AS value, FALSE AS warns FROM n
  UNION ALL SELECT table_name, 'distinct_keys', keys, FALSE FROM n
  UNION ALL SELECT table_name, 'duplicate_rows', total - keys, TRUE FROM n
  UNION ALL SELECT table_name, 'keys_with_duplicates', repeated, TRUE FROM n
  UNION ALL SELECT table_name, CASE WHEN two THEN 'null_l_orderkey' ELSE 'null_o_orderkey' END, null_a, TRUE FROM n
  UNION ALL SELECT table_name, 'null_l_linenumber', null_b, TRUE FROM n WHERE two)
SELECT table_name, item, CAST(value AS BIGINT) AS value, CASE WHEN warns AND value > 0 THEN 'WARN' ELSE 'OK' END AS status FROM items""",
    "q20_topk_per_group": """
SELECT * FROM (
  SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS season_start_year, o_orderpriority, o_totalprice,
    CAST(rank() OVER (PARTITION BY year(o_orderdate), o_orderpriority
                      ORDER BY o_totalprice DESC NULLS LAST) AS INT) AS "rank"
  FROM orders) WHERE "rank" <= 5""",

    "q21_label_distribution": "WITH " + SS_SQL + ",\n" + label_cte("ss") + """
SELECT archetype, "count", row_number() OVER (ORDER BY "count" DESC, archetype) AS place
FROM (SELECT archetype, count(*) AS "count" FROM lab GROUP BY archetype)""",

    "q22_season_report": "WITH " + METRICS_CTE + ",\nroll AS (" + ROLLUP_SELECT + """)
SELECT archetype, player_count, cost_per_ws_millions, avg_value_score, avg_win_shares,
  row_number() OVER (ORDER BY cost_per_ws_millions NULLS FIRST) AS place
FROM roll WHERE season = '1997-98'""",

    "q23_tiers": f"""
WITH o AS (SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INT) AS season_start_year FROM orders),
c AS (SELECT season_start_year, max(o_totalprice) AS salary_cap FROM o GROUP BY season_start_year),
s AS (
  SELECT o.o_orderkey,
    CASE WHEN c.salary_cap IS NOT NULL AND c.salary_cap > 0 THEN round(o.o_totalprice / c.salary_cap, 6) END
      AS salary_pct_of_cap
  FROM o LEFT JOIN c ON o.season_start_year = c.season_start_year)
SELECT o_orderkey, salary_pct_of_cap, {tier_case('salary_pct_of_cap')} AS salary_group
FROM s WHERE salary_pct_of_cap IS NOT NULL AND NOT isnan(salary_pct_of_cap)""",

    "q24_tier_value_score": f"""
WITH li AS (
  SELECT l_orderkey, l_linenumber, l_quantity / 160.0 AS salary_pct_of_cap, l_quantity AS bpm,
    round(l_extendedprice * 100) AS ws_per_48, round(l_discount * 100) AS ts_pct, round(l_tax * 100) AS usg_pct
  FROM lineitem),
r AS (
  SELECT * FROM li WHERE salary_pct_of_cap IS NOT NULL
    AND bpm IS NOT NULL AND NOT isnan(bpm) AND ws_per_48 IS NOT NULL AND NOT isnan(ws_per_48)
    AND ts_pct IS NOT NULL AND NOT isnan(ts_pct) AND usg_pct IS NOT NULL AND NOT isnan(usg_pct)
    AND NOT isnan(salary_pct_of_cap)),
t AS (SELECT *, {tier_case('salary_pct_of_cap')} AS salary_group FROM r),
a AS (
  SELECT salary_group, avg(bpm) AS avg_bpm, avg(ws_per_48) AS avg_ws_per_48, avg(ts_pct) AS avg_ts_pct,
    avg(usg_pct) AS avg_usg_pct
  FROM t GROUP BY salary_group),
dd AS (
  SELECT t.*, a.avg_bpm, a.avg_ws_per_48, a.avg_ts_pct, a.avg_usg_pct,
    t.bpm - a.avg_bpm AS bpm_diff, t.ws_per_48 - a.avg_ws_per_48 AS ws_per_48_diff,
    t.ts_pct - a.avg_ts_pct AS ts_pct_diff, t.usg_pct - a.avg_usg_pct AS usg_pct_diff
  FROM t JOIN a ON t.salary_group = a.salary_group),
s AS (
  SELECT dd.*,
    avg(bpm_diff) OVER () AS m1, stddev_samp(bpm_diff) OVER () AS s1,
    avg(ws_per_48_diff) OVER () AS m2, stddev_samp(ws_per_48_diff) OVER () AS s2,
    avg(ts_pct_diff) OVER () AS m3, stddev_samp(ts_pct_diff) OVER () AS s3,
    avg(usg_pct_diff) OVER () AS m4, stddev_samp(usg_pct_diff) OVER () AS s4
  FROM dd)
SELECT salary_group, l_orderkey, l_linenumber, salary_pct_of_cap, bpm, ws_per_48, ts_pct, usg_pct,
  avg_bpm, avg_ws_per_48, avg_ts_pct, avg_usg_pct, bpm_diff, ws_per_48_diff, ts_pct_diff, usg_pct_diff,
  round(
    0.40 * coalesce((bpm_diff - m1) / nullif(s1, 0), 0)
  + 0.25 * coalesce((ws_per_48_diff - m2) / nullif(s2, 0), 0)
  + 0.20 * coalesce((ts_pct_diff - m3) / nullif(s3, 0), 0)
  + 0.15 * coalesce((usg_pct_diff - m4) / nullif(s4, 0), 0), 6) AS value_score
FROM s""",

    "q25_quality_report": """
WITH li AS (SELECT l_orderkey, nullif(l_linenumber, 7) AS l_linenumber, l_returnflag FROM lineitem),
cleaned AS (""" + prefer_sql("li", "l_orderkey, l_linenumber, l_returnflag", ("l_orderkey", "l_linenumber"),
                             "l_returnflag", "'A'") + """),
n AS (SELECT count(*) AS raw_rows, (SELECT count(*) FROM cleaned) AS clean_rows,
        count_if(l_orderkey IS NULL) AS null_o, count_if(l_linenumber IS NULL) AS null_l FROM li),
k AS (SELECT l_orderkey, l_linenumber, count(*) AS c FROM li GROUP BY l_orderkey, l_linenumber),
kd AS (SELECT sum(c) AS total_rows, count(*) AS distinct_keys, count_if(c > 1) AS dup_keys FROM k)
SELECT 'cleaning' AS report, 'lineitem' AS table_name, 'raw_rows' AS item, CAST(raw_rows AS BIGINT) AS value FROM n
UNION ALL SELECT 'cleaning', 'lineitem', 'clean_rows', CAST(clean_rows AS BIGINT) FROM n
UNION ALL SELECT 'cleaning', 'lineitem', 'dropped_rows', CAST(raw_rows - clean_rows AS BIGINT) FROM n
UNION ALL SELECT 'null_keys', 'lineitem', 'l_orderkey', CAST(null_o AS BIGINT) FROM n
UNION ALL SELECT 'null_keys', 'lineitem', 'l_linenumber', CAST(null_l AS BIGINT) FROM n
UNION ALL SELECT 'duplicates', 'lineitem', 'total_rows', CAST(total_rows AS BIGINT) FROM kd
UNION ALL SELECT 'duplicates', 'lineitem', 'distinct_keys', CAST(distinct_keys AS BIGINT) FROM kd
UNION ALL SELECT 'duplicates', 'lineitem', 'duplicate_rows', CAST(total_rows - distinct_keys AS BIGINT) FROM kd
UNION ALL SELECT 'duplicates', 'lineitem', 'keys_with_duplicates', CAST(dup_keys AS BIGINT) FROM kd""",

    "q26_lookup_filter": "WITH " + CVS_CTE + """
SELECT player_id, name, season, pos, team_name_abbr, composite_value_score
FROM cvs3 WHERE season_start_year IN (1997, 1998) AND pos IN ('PG', 'SG', 'SF')""",

    "q27_wasted_cap": "WITH " + CVS_CTE + """
SELECT team_name_abbr, season, round(sum(missed_game_cost), 2) AS wasted_salary, count(*) AS player_count
FROM cvs3 GROUP BY team_name_abbr, season""",

    "q28_partitioned_sink": "WITH " + METRICS_CTE + """
SELECT player_id, season, season_start_year, archetype, value_score, cost_per_ws FROM pm""",
}

ORACLE["q42_prefer_aggregate_filtered"] = ORACLE["q05_prefer_aggregate"]

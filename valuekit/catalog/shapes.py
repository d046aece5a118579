"""Domain-shaped tables derived from the driver's star-schema tables.

The test tables hold no basketball data, so the catalogue maps them onto the
domain's shapes (FIXTURES.md section 3): supplier x ship-year becomes a
"player-season" row with integer counting stats and FloatType advanced stats.
Each shape exists twice, written separately: as a DataFrame (what the query
runs) and as DuckDB SQL text (what the oracle runs); both use integer
arithmetic so the two engines agree bit for bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table as a DataFrame."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cents(x):
    """round(x * 100) for non-negative two-decimal values, as a long. Same
    result as ``round`` (x * 100 is never near a .5 tie) without the per-row
    BigDecimal work of a double ``round``."""
    return F.floor(x * 100 + 0.5)


def supplier_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ss``: one row per (supplier, ship year) with the stats of its line
    items."""
    c = F.col
    flag = lambda col, value: F.count_if(c(col) == value).cast("int")
    lines = table(spark, sf_dir, "lineitem").groupBy(c("l_suppkey").alias("player_id"), F.year("l_shipdate").alias("y")).agg(
        F.count("*").cast("int").alias("games"), F.sum(c("l_quantity").cast("int")).cast("int").alias("mp"),
        F.sum(F.floor(c("l_extendedprice") / 1000)).cast("int").alias("pts"), F.sum("l_linenumber").cast("int").alias("trb"),
        flag("l_returnflag", "A").alias("ast"), flag("l_returnflag", "R").alias("stl"), flag("l_returnflag", "N").alias("blk"),
        flag("l_linestatus", "F").alias("tov"), F.sum(cents(c("l_discount"))).cast("int").alias("fg3a"),
        F.sum(cents(c("l_tax"))).cast("int").alias("fg2a"))
    suppliers = table(spark, sf_dir, "supplier").select(c("s_suppkey").alias("player_id"), c("s_name").alias("name"), "s_nationkey", "s_acctbal")
    share = lambda x, by: (x / float(by)).cast("float")
    positions = F.array(*[F.lit(p) for p in ("PG", "SG", "SF", "PF", "C", "SF-PF")])
    return lines.join(suppliers, "player_id").withColumns({
        "season": F.concat(c("y").cast("string"), F.lit("-"), F.lpad(((c("y") + 1) % 100).cast("string"), 2, "0")),
        "season_start_year": c("y"), "player_salary": (1_000_000 + cents(F.abs("s_acctbal")) * 10).cast("bigint"),
        "salary_cap": 20_000_000 + 1_000_000 * (c("y") - 1995), "pos": F.element_at(positions, (c("s_nationkey") % 6 + 1).cast("int")),
        "usg_pct": share(15 + c("trb") % 16, 1), "ts_pct": F.when(c("player_id") % 11 != 0, share(50 + c("games") % 15, 100)),
        "ast_pct": share(c("pts") % 45, 1), "blk_pct": share(c("mp") % 60, 10), "orb_pct": share(c("trb") % 12, 1),
        "ws_per_48": share(c("ast") % 25, 100), "fg3a_per_fga_pct": share(c("fg3a") % 60, 100), "ws": share(c("trb") % 120 - 10, 10),
        "vorp": share(c("ast") % 70 - 10, 10), "bpm": share(c("pts") % 200 - 100, 10), "per": share(c("mp") % 300, 10),
    }).drop("s_acctbal")


def supplier_seasons_x(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ssx``: ``ss`` plus a team tag (every 9th supplier is a multi-team
    aggregate row) and a cap share that is NULL for every 13th supplier and
    below 1% for every 17th (FIXTURES.md 3.1)."""
    c = F.col
    share = F.round(c("player_salary") / c("salary_cap"), 6)
    return supplier_seasons(spark, sf_dir).withColumns({
        "team_name_abbr": F.when(c("player_id") % 9 == 0, F.lit("2TM")).otherwise(F.concat(F.lit("N"), c("s_nationkey").cast("string"))),
        "salary_pct_of_cap": F.when(c("player_id") % 13 == 0, F.lit(None)).when(c("player_id") % 17 == 0, share / 100).otherwise(share)})


# ---------------------------------------------------------------- SQL side

SS_SQL = """b AS (
  SELECT l_suppkey AS player_id, CAST(year(l_shipdate) AS INT) AS y,
    CAST(count(*) AS INT) AS games,
    CAST(sum(CAST(l_quantity AS INT)) AS INT) AS mp,
    CAST(sum(CAST(floor(l_extendedprice / 1000) AS INT)) AS INT) AS pts,
    CAST(sum(l_linenumber) AS INT) AS trb,
    CAST(count(CASE WHEN l_returnflag = 'A' THEN 1 END) AS INT) AS ast,
    CAST(count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS INT) AS stl,
    CAST(count(CASE WHEN l_returnflag = 'N' THEN 1 END) AS INT) AS blk,
    CAST(count(CASE WHEN l_linestatus = 'F' THEN 1 END) AS INT) AS tov,
    CAST(sum(CAST(round(l_discount * 100) AS INT)) AS INT) AS fg3a,
    CAST(sum(CAST(round(l_tax * 100) AS INT)) AS INT) AS fg2a
  FROM lineitem GROUP BY l_suppkey, year(l_shipdate)),
ss AS (
SELECT b.*, s_name AS name, s_nationkey,
  concat(CAST(y AS STRING), '-', lpad(CAST((y + 1) % 100 AS STRING), 2, '0')) AS season,
  y AS season_start_year,
  CAST(1000000 + round(abs(s_acctbal) * 100) * 10 AS BIGINT) AS player_salary,
  20000000 + 1000000 * (y - 1995) AS salary_cap,
  CASE s_nationkey % 6 WHEN 0 THEN 'PG' WHEN 1 THEN 'SG' WHEN 2 THEN 'SF'
    WHEN 3 THEN 'PF' WHEN 4 THEN 'C' ELSE 'SF-PF' END AS pos,
  CAST(15 + trb % 16 AS FLOAT) AS usg_pct,
  CASE WHEN player_id % 11 = 0 THEN NULL
    ELSE CAST((50 + games % 15) / CAST(100 AS DOUBLE) AS FLOAT) END AS ts_pct,
  CAST(pts % 45 AS FLOAT) AS ast_pct,
  CAST((mp % 60) / CAST(10 AS DOUBLE) AS FLOAT) AS blk_pct,
  CAST(trb % 12 AS FLOAT) AS orb_pct,
  CAST((ast % 25) / CAST(100 AS DOUBLE) AS FLOAT) AS ws_per_48,
  CAST((fg3a % 60) / CAST(100 AS DOUBLE) AS FLOAT) AS fg3a_per_fga_pct,
  CAST((trb % 120 - 10) / CAST(10 AS DOUBLE) AS FLOAT) AS ws,
  CAST((ast % 70 - 10) / CAST(10 AS DOUBLE) AS FLOAT) AS vorp,
  CAST((pts % 200 - 100) / CAST(10 AS DOUBLE) AS FLOAT) AS bpm,
  CAST((mp % 300) / CAST(10 AS DOUBLE) AS FLOAT) AS per
FROM b JOIN supplier ON s_suppkey = player_id)"""


def sql_round_ratio(num: str, den: str, digits: int) -> str:
    """Spark's ``round(num / den, digits)`` (half-up on the decimal value) for
    non-negative integers, computed exactly with integer division."""
    scale = 10 ** digits
    return (f"(CAST((2 * {scale} * CAST({num} AS BIGINT) + ({den})) // (2 * CAST({den} AS BIGINT)) AS DOUBLE)"
            f" / {scale})")


SSX_SQL = SS_SQL + """,
ssx AS (
SELECT ss.*,
  CASE WHEN player_id % 9 = 0 THEN '2TM' ELSE concat('N', CAST(s_nationkey AS STRING)) END AS team_name_abbr,
  CASE WHEN player_id % 13 = 0 THEN CAST(NULL AS DOUBLE)
       WHEN player_id % 17 = 0 THEN """ + sql_round_ratio("player_salary", "salary_cap", 6) + """ / 100
       ELSE """ + sql_round_ratio("player_salary", "salary_cap", 6) + """ END AS salary_pct_of_cap
FROM ss)"""


def sql_per_game(prefix: str = "") -> str:
    """SQL select-list items for the six per-game rates of D6."""
    return ",\n  ".join(f"{sql_round_ratio(prefix + s, prefix + 'games', 2)} AS {s}_per_game"
                        for s in ("pts", "ast", "trb", "stl", "blk", "tov"))

"""End-to-end timing of the five jobs on domain-shaped data derived from the
driver tables.

    python tools/job_bench.py [/root/testdata/sf0.1]

Spark derives six raw CSV tables in the reference's layouts from the star
schema (written to the shared scratch folder), then the foundation, unify,
composite, archetype and tier jobs run on them exactly as the command line
runs them. Prints one JSON line with per-job seconds and row counts.

Mapping: a part is a player, a ship year a season, a supplier (mod 30) a
team. A part supplied by several teams in one year is a traded player, so
the stats tables get per-team rows plus an 'nTM' aggregate row, as in the
source data.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from valuekit import schemas as K  # noqa: E402
from valuekit.plans import analysis, foundation  # noqa: E402
from valuekit.session import local_session, scratch_path  # noqa: E402
from valuekit.sources import files  # noqa: E402

TEAMS = sorted(set(K.TEAM_CODES.values()))[:30]
NAMES = {v: k for k, v in K.TEAM_CODES.items()}
POSITIONS = ["PG", "SG", "SF", "PF", "C", "G", "F", "SF-PF"]


def _season(y):
    return F.concat(y.cast("string"), F.lit("-"), F.lpad(((y + 1) % 100).cast("string"), 2, "0"))


def _pick(values, idx):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx % len(values) + 1).cast("int"))


def raw_tables(spark: SparkSession, d: str) -> dict:
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    c = F.col
    team_idx = c("l_suppkey") % len(TEAMS)
    # a part has a few lines per year and supplier: scale the counts to a season's size
    per_team = li.groupBy(c("l_partkey").alias("pk"), F.year("l_shipdate").alias("y"), team_idx.alias("t")).agg(
        (F.count(F.lit(1)) * 25).alias("games"), (F.sum(c("l_quantity").cast("int")) * 20).alias("mp"),
        F.sum(F.floor(c("l_extendedprice") / 1000).cast("int")).alias("pts"),
        F.sum("l_linenumber").alias("trb"), F.count_if(c("l_returnflag") == "A").alias("ast"),
        F.count_if(c("l_returnflag") == "R").alias("stl"), F.count_if(c("l_returnflag") == "N").alias("blk"),
        F.count_if(c("l_linestatus") == "F").alias("tov"))
    stat_cols = ["games", "mp", "pts", "trb", "ast", "stl", "blk", "tov"]
    single = per_team.withColumn("team_name_abbr", _pick(TEAMS, c("t"))).drop("t")
    multi = (per_team.groupBy("pk", "y").agg(F.count(F.lit(1)).alias("n"), *[F.sum(s).alias(s) for s in stat_cols])
             .filter(c("n") > 1).withColumn("team_name_abbr", F.concat(F.least(c("n"), F.lit(4)).cast("string"),
                                                                       F.lit("TM"))).drop("n"))
    rows = single.unionByName(multi).select(
        F.concat(F.lit("p"), c("pk").cast("string")).alias("player_id"), _season(c("y")).alias("season"),
        (20 + c("pk") % 15).cast("int").alias("age"), "team_name_abbr", *[c(s).cast("int").alias(s) for s in stat_cols],
        _pick(POSITIONS, c("pk")).alias("pos"))
    stats = rows.select(
        "player_id", "season", "age", "team_name_abbr", F.lit("NBA").alias("comp_name_abbr"), "pos", "games",
        (c("games") / 2).cast("int").alias("games_started"), c("mp"), (c("pts") / 2).cast("int").alias("fg"),
        c("pts").alias("fga"), (F.lit(0.5) + (c("pts") % 7) / 100).cast("float").alias("fg_pct"),
        (c("ast") / 3).cast("int").alias("fg3"), c("ast").alias("fg3a"), F.lit(0.33).cast("float").alias("fg3_pct"),
        (c("pts") / 3).cast("int").alias("fg2"), (c("pts") / 2).cast("int").alias("fg2a"),
        F.lit(0.55).cast("float").alias("fg2_pct"), F.lit(0.52).cast("float").alias("efg_pct"),
        c("tov").alias("ft"), (c("tov") + 2).alias("fta"), F.lit(0.75).cast("float").alias("ft_pct"),
        (c("trb") / 4).cast("int").alias("orb"), (c("trb") / 2).cast("int").alias("drb"), "trb", "ast", "stl", "blk",
        "tov", (c("games") / 3).cast("int").alias("pf"), "pts")
    adv = rows.select(
        "player_id", "season", "age", "team_name_abbr", "pos", c("games").alias("g"), "mp",
        ((c("mp") % 300) / 10).cast("float").alias("per"), ((50 + c("games") % 15) / 100).cast("float").alias("ts_pct"),
        ((c("ast") % 60) / 100).cast("float").alias("fg3a_per_fga_pct"), F.lit(0.3).cast("float").alias("fta_per_fga_pct"),
        (c("trb") % 12).cast("float").alias("orb_pct"), F.lit(15.0).cast("float").alias("drb_pct"),
        F.lit(10.0).cast("float").alias("trb_pct"), (c("pts") % 45).cast("float").alias("ast_pct"),
        F.lit(1.5).cast("float").alias("stl_pct"), ((c("mp") % 60) / 10).cast("float").alias("blk_pct"),
        F.lit(12.0).cast("float").alias("tov_pct"), (15 + c("trb") % 16).cast("float").alias("usg_pct"),
        F.lit(1.0).cast("float").alias("ows"), F.lit(1.0).cast("float").alias("dws"),
        ((c("trb") % 120 - 10) / 10).cast("float").alias("ws"), ((c("ast") % 25) / 100).cast("float").alias("ws_per_48"),
        F.lit(0.5).cast("float").alias("obpm"), F.lit(0.5).cast("float").alias("dbpm"),
        ((c("pts") % 200 - 100) / 10).cast("float").alias("bpm"), ((c("ast") % 70 - 10) / 10).cast("float").alias("vorp"))
    pays = single.select(
        F.concat(F.lit("p"), c("pk").cast("string")).alias("player_id"), _season(c("y")).alias("season"),
        c("team_name_abbr").alias("team"), (1_000_000 + (c("pts") * 7919) % 40_000_000).alias("amount"), "pk")
    salaries = pays.select("player_id", "season", "team", F.when(c("pk") % 7 == 0, F.concat(c("amount").cast("string"),
                                                                                         F.lit(" (TW)")))
                           .when(c("pk") % 11 == 0, F.lit("< Minimum"))
                           .otherwise(c("amount").cast("string")).alias("salary"))
    years = li.select(F.year("l_shipdate").alias("y")).distinct()
    caps = years.select(_season(c("y")).alias("season"), (90_000_000 + 3_000_000 * (c("y") - 1995)).cast("int")
                        .alias("salary_cap"))
    names = F.create_map(*[x for code in TEAMS for x in (F.lit(code), F.lit(NAMES[code]))])
    team_rows = spark.createDataFrame([(i, code) for i, code in enumerate(TEAMS)], "t int, code string")
    standings = (per_team.groupBy("y", "t").agg(F.sum("stl").alias("w"), F.sum("blk").alias("l"))
                 .join(F.broadcast(team_rows), "t")
                 .select(_season(c("y")).alias("season"), names[c("code")].alias("team"),
                         F.concat(c("w").cast("string"), F.lit("-"), c("l").cast("string")).alias("overall")))
    sup = spark.read.parquet(f"{d}/part.parquet")
    profiles = sup.select(
        F.concat(F.lit("p"), c("p_partkey").cast("string")).alias("player_id"), c("p_name").alias("name"),
        F.when(c("p_partkey") % 5 == 0, F.lit(None)).otherwise(c("p_brand")).alias("college"),
        F.when(c("p_partkey") % 4 == 0, F.lit(None)).otherwise((1980 + c("p_partkey") % 40).cast("float"))
        .alias("draft_year"), (1 + c("p_partkey") % 2).cast("float").alias("draft_round"),
        (1 + c("p_partkey") % 60).cast("float").alias("draft_pick"), (70 + c("p_size") % 20).cast("int").alias("height"),
        (180 + c("p_size")).cast("int").alias("weight"), F.lit("USA").alias("country"),
        (1981 + c("p_partkey") % 40).cast("float").alias("nba_debut_year"), (c("p_partkey") % 3).cast("int")
        .alias("all_nba_appearances"))
    return {"player_profiles": profiles, "nba_stats": stats, "nba_salaries": salaries, "nba_salary_cap": caps,
            "nba_advanced_player_stats": adv, "nba_expanded_standings_2000_2026": standings}


def timed(fn):
    t = time.perf_counter()
    out = fn()
    return out, round(time.perf_counter() - t, 3)


def main():
    sf_dir = (sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1").rstrip("/")
    spark = local_session(app="valuekit-job-bench")
    raw_dir = scratch_path(spark, "raw_csv")
    for name, df in raw_tables(spark, sf_dir).items():
        files.write_csv(df, f"{raw_dir}/{K.RAW_TABLES[name][0]}")
    base = scratch_path(spark, "jobs")
    res, rows = {}, {}
    report, res["foundation"] = timed(lambda: foundation.run_foundation(spark, raw_dir, f"{base}/clean"))
    rows.update({f"raw_{r.table_name}": r.raw_rows for r in report.collect()})
    rows["unified"], res["unify"] = timed(lambda: analysis.run_unify(spark, f"{base}/clean", f"{base}/unified"))
    rows["composite"], res["composite"] = timed(lambda: analysis.run_composite(spark, f"{base}/unified", f"{base}/cvs"))
    arch, res["archetypes"] = timed(lambda: analysis.run_archetypes(spark, f"{base}/unified", f"{base}/arch"))
    rows["archetypes"] = arch["qualified_rows"]
    rows["tiers"], res["tiers"] = timed(lambda: analysis.run_tiers(spark, f"{base}/unified", f"{base}/tiers"))
    print(json.dumps({"sf": os.path.basename(sf_dir), "seconds": res, "total": round(sum(res.values()), 3),
                      "rows": rows}))
    spark.stop()


if __name__ == "__main__":
    main()

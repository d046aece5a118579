"""What the unified table leaves in the scratch folder and in shuffles."""

import os
import time

import pytest
from pyspark.sql import functions as F

from valuekit.catalog import domain
from valuekit.operators.dedupe import prefer_tagged_rows
from valuekit.operators.join import unify
from valuekit.plans import foundation
from valuekit.session import ensure_checkpoint_dir

LINES = [(o, 1 + o % 5, 1 + o % 3 + 30 * (o % 2), 1 + o % 4, 5.0, 1000.0 * o, "ANR"[o % 3], "FO"[o % 2], f"199{2 + o % 4}-03-01") for o in range(1, 60)]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, day string"
    spark.createDataFrame(LINES, names).withColumn("l_shipdate", F.col("day").cast("date")).drop("day").write.parquet(f"{d}/lineitem.parquet")
    spark.createDataFrame([(k, f"name {k}", "b", 7) for k in range(1, 7)], "p_partkey long, p_name string, p_brand string, p_size int").write.parquet(f"{d}/part.parquet")
    return d


def scratch(spark):
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {name.rsplit("-", 1)[0] for name in os.listdir(base)}, base


def staged_by(spark, build):
    base = scratch(spark)[1]
    before = set(os.listdir(base))
    build()
    return {name.rsplit("-", 1)[0].removeprefix("staged_") for name in set(os.listdir(base)) - before}


def test_raw_tables_leave_nothing_they_are_derived_from(spark, tables):
    assert staged_by(spark, lambda: domain.raw_tables(spark, tables)) == set(domain.K.RAW_TABLES)


@pytest.mark.parametrize("query", [domain.q12_unify, domain.q44_unify_first])
def test_unified_table_holds_no_raw_facts(spark, tables, query):
    left = staged_by(spark, lambda: query(spark, tables))
    assert left == {"clean_nba_stats", "clean_nba_salaries", "clean_nba_advanced_player_stats",
                    "player_profiles", "nba_salary_cap", "nba_expanded_standings_2000_2026"}


def test_cleaned_in_turn_has_the_rows_of_cleaned(spark, tables):
    want, got = domain.cleaned(spark, tables), domain.cleaned_in_turn(spark, tables)
    assert list(got) == list(domain.K.RAW_TABLES) and set(want) == set(got)
    for name, df in want.items():
        assert got[name].schema.simpleString() == df.schema.simpleString()
        assert sorted(map(str, got[name].collect())) == sorted(map(str, df.collect())), name


def test_staged_writes_leave_no_shuffle_files(spark):
    def files():
        dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
        return {f for d in dirs for _, _, names in os.walk(d.getPath()) for f in names if f.startswith("shuffle_") and f.endswith(".data")}

    before = files()
    df = spark.range(5000, numPartitions=4).groupBy((F.col("id") % 1000).alias("k")).count()
    staged, counts, _ = foundation.stage_raw(spark, {"t": df}, ("t",))
    end = time.time() + 20
    while files() - before and time.time() < end:
        time.sleep(0.2)
    assert counts == {"t": 1000} and staged["t"].count() == 1000
    assert not {f for f in files() - before if f.startswith("shuffle_0_")} and len(files() - before) <= 4  # those of the count above


@pytest.mark.parametrize("words", [1, 64, 1 << 16])
def test_free_words_keep_the_rows(spark, words):
    tags = [None, "2TM", "ATL", "BOS", "ATL"]
    rows = [(i, None if i % 11 == 0 else f"p{i % 60}", None if i % 13 == 0 else f"s{i % 3}", tags[i % 5] if i % 60 < 40 else "ATL") for i in range(600)]
    df = spark.createDataFrame(rows, "id int, player_id string, season string, team string")
    plain, free = (prefer_tagged_rows(df, ["player_id", "season"], "team", ["2TM"], free_words=w) for w in (0, words))
    assert sorted(r.id for r in free.collect()) == sorted(r.id for r in plain.collect())
    with pytest.raises(ValueError):
        prefer_tagged_rows(df, ["player_id"], "team", ["2TM"], filter_words=1, free_words=1)


def test_unify_reads_stats_once_and_joins_profiles_first(spark, tmp_path):
    """Rows with a NULL key take no second pass over the stats, and copies made by repeated keys are not shuffled for the profile."""
    stats = [(2001, "ATL", s, p, i) for i, (p, s) in enumerate([("a", "S"), ("a", "S"), ("b", "S"), (None, "S"), ("a", None), (None, None), ("c", "T")] * 3)]
    spark.createDataFrame(stats, "season_start_year int, team_name_abbr string, season string, player_id string, id int").write.parquet(f"{tmp_path}/stats")
    stats = spark.read.parquet(f"{tmp_path}/stats")
    adv = spark.createDataFrame([("a", "S", 1), ("a", "S", 2), ("c", "U", 3), (None, "S", 4), ("a", None, 5)], "player_id string, season string, ws int")
    sal = spark.createDataFrame([("a", "S", 2001, 7), ("b", "S", 2001, 8), (None, None, 2001, 9)], "player_id string, season string, season_start_year int, player_salary int")
    profiles = spark.createDataFrame([("a", 70), ("a", 71), ("c", 72), (None, 73)], "player_id string, height int")
    caps = spark.createDataFrame([("S", 5)], "season string, league_salary_cap int")
    standings = spark.createDataFrame([(2001, "ATL", 1, 2, 0.3)], "season_start_year int, team_name_abbr string, wins int, losses int, win_pct double")
    out = unify(stats, adv, profiles, sal, caps, standings, advanced_columns=["ws"])
    plain = (stats.join(adv, ["player_id", "season"], "left").join(sal.drop("season_start_year"), ["player_id", "season"], "left")
             .join(profiles, "player_id", "left").join(caps, "season", "left").join(standings, ["season_start_year", "team_name_abbr"], "left").select(*out.columns))
    assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1 and "__dealt#" in next(x for x in plan.splitlines() if "LeftOuter" in x and "__dealt" in x)
    outer = next(i for i, x in enumerate(plan.splitlines()) if "__dealt#" in x and "Join LeftOuter" in x)
    assert any("Join LeftOuter" in x and "player_id#" in x and "season#" not in x for x in plan.splitlines()[outer + 1:])

"""Golden end-to-end: hand-written domain CSVs -> foundation -> unify ->
composite value, archetypes and tiers, exactly as the command line runs them."""

import os

import pytest

from fixture_paths import FIXTURES
from valuekit.plans import analysis, foundation


@pytest.fixture(scope="module")
def built(spark):
    import tempfile
    out = tempfile.mkdtemp(prefix="valuekit-e2e-")
    report = foundation.run_foundation(spark, os.path.join(FIXTURES, "raw"), f"{out}/clean")
    counts = {"unified": analysis.run_unify(spark, f"{out}/clean", f"{out}/unified"),
              "cvs": analysis.run_composite(spark, f"{out}/unified", f"{out}/cvs", n_files=2)}
    reports = analysis.run_archetypes(spark, f"{out}/unified", f"{out}/arch", report_season="2023-24")
    counts["tiers"] = analysis.run_tiers(spark, f"{out}/unified", f"{out}/tiers")
    counts["archetypes"] = reports.pop("qualified_rows")
    reports["counts"] = counts
    return out, {r.table_name: r for r in report.collect()}, reports


def test_key_check_report(spark, built):
    out, _, _ = built
    checks = {(r.table_name, r.item): r.value for r in spark.read.parquet(f"{out}/clean/_reports/key_checks").collect()}
    assert checks[("nba_stats", "duplicate_rows")] == 0 and checks[("nba_stats", "null_player_id")] == 0
    assert checks[("player_profiles", "total_rows")] == 3
    assert checks[("nba_expanded_standings_2000_2026", "duplicate_rows")] == 0  # one row per season and team
    status = {(r.table_name, r.item): r.status for r in spark.read.parquet(f"{out}/clean/_reports/key_checks").collect()}
    assert status[("nba_expanded_standings_2000_2026", "null_team_name_abbr")] == "WARN"  # the unknown team
    assert status[("nba_stats", "null_player_id")] == "OK"


def test_run_all(spark, tmp_out):
    from valuekit.plans import analysis as A
    counts = A.run_all(spark, os.path.join(FIXTURES, "raw"), f"{tmp_out}/all")
    assert (counts["unified"], counts["composite"], counts["archetypes"], counts["tiers"]) == (4, 1, 2, 1)


def test_cleaning_report(built):
    _, rep, _ = built
    assert (rep["player_profiles"].raw_rows, rep["player_profiles"].clean_rows) == (4, 3)
    assert (rep["nba_stats"].raw_rows, rep["nba_stats"].clean_rows) == (7, 4)
    assert rep["nba_salaries"].clean_rows == 4 and rep["nba_salaries"].unparsed_rows >= 1
    assert rep["nba_stats"].unparsed_rows is None
    assert rep["nba_expanded_standings_2000_2026"].clean_rows == 4


def test_cleaned_tables(spark, built):
    out, _, _ = built
    prof = {r.player_id: r for r in spark.read.parquet(f"{out}/clean/player_profiles").collect()}
    assert (prof["p2"].college, prof["p2"].draft_year, prof["p2"].is_drafted) == ("None", -1, False)
    assert (prof["p3"].draft_pick, prof["p1"].is_drafted) == (45, True)
    stats = spark.read.parquet(f"{out}/clean/nba_stats")
    keys = sorted((r.player_id, r.season, r.team_name_abbr) for r in stats.collect())
    assert keys == [("p1", "2023-24", "BOS"), ("p2", "2023-24", "2TM"), ("p3", "2019-20", "BOS"),
                    ("p3", "2023-24", "BOS")]
    p3 = stats.filter("player_id = 'p3' AND season = '2023-24'").collect()[0]
    assert p3.fg_pct is None and p3.pts_per_game == 5.0 and p3.pts_per_min == 0.3333
    sal = {(r.player_id, r.season): r for r in spark.read.parquet(f"{out}/clean/nba_salaries").collect()}
    assert sorted(sal) == [("p1", "2022-23"), ("p1", "2023-24"), ("p2", "2023-24"), ("p3", "2023-24")]
    p2 = sal[("p2", "2023-24")]
    assert (p2.salary, p2.teams, p2.is_two_way, p2.is_sub_minimum) == (8000000, "BOS / LAL", True, False)
    assert sal[("p1", "2022-23")].salary == 1200
    assert sal[("p1", "2023-24")].salary_pct_of_cap == round(30000000 / 136021000, 6)
    assert sal[("p3", "2023-24")].is_sub_minimum is True
    st = {(r.season, r.team): r for r in spark.read.parquet(f"{out}/clean/nba_expanded_standings_2000_2026").collect()}
    assert (st[("2023-24", "Boston Celtics")].win_pct, st[("2023-24", "Boston Celtics")].team_name_abbr) == \
        (0.7805, "BOS")
    assert st[("2023-24", "Unknown Team")].team_name_abbr is None and st[("2023-24", "Unknown Team")].win_pct is None


def test_unified(spark, built):
    out, _, _ = built
    u = spark.read.parquet(f"{out}/unified")
    assert u.columns[:4] == ["season_start_year", "team_name_abbr", "season", "player_id"]
    rows = {(r.player_id, r.season): r for r in u.collect()}
    assert len(rows) == 4
    p1 = rows[("p1", "2023-24")]
    assert (p1.wins, p1.losses, p1.league_salary_cap, p1.player_salary, p1.name) == \
        (64, 18, 136021000, 30000000, "Alpha One")
    assert rows[("p2", "2023-24")].wins is None  # multi-team code has no standings row
    assert rows[("p3", "2019-20")].player_salary is None


def test_composite_value_output(spark, built):
    out, _, _ = built
    cvs = spark.read.parquet(f"{out}/cvs")
    assert len(cvs.columns) == 50
    rows = cvs.collect()
    assert [r.player_id for r in rows] == ["p1"]  # p2 is a 2TM row, p3 has too few games or no salary
    r = rows[0]
    assert r.production_score == pytest.approx(24.17 + 1.2 * 3.83 + 1.5 * 8.0 + 2 * 1.5 + 2 * 0.33 - 3.0)
    assert r.games_possible == 82 and r.availability_rate == pytest.approx(60 / 82)


def test_archetype_outputs(spark, built):
    out, _, reports = built
    players = spark.read.parquet(f"{out}/arch/player_archetype_metrics")
    got = {r.player_id: r.archetype for r in players.collect()}
    assert got == {"p1": "Playmaking Engine", "p2": "Rim Protector"}
    assert os.path.isdir(f"{out}/arch/player_archetype_metrics/season_start_year=2023")
    summary = spark.read.parquet(f"{out}/arch/archetype_season_summary").collect()
    assert sorted((r.archetype, r.player_count) for r in summary) == [("Playmaking Engine", 1), ("Rim Protector", 1)]
    top = spark.read.parquet(f"{out}/arch/archetype_top_players").collect()
    assert sorted(r.archetype_rank for r in top) == [1, 1]
    assert reports["distribution"].count() == 2 and reports["season_report"].count() == 2
    assert reports["counts"] == {"unified": 4, "cvs": 1, "tiers": 1, "archetypes": 2}


def test_tier_output(spark, built):
    out, _, _ = built
    t = spark.read.parquet(f"{out}/tiers").collect()
    assert [(r.player_id, r.salary_group, r.value_score) for r in t] == [("p1", 4.0, 0.0)]


def test_command_line_runs_a_job(spark, tmp_out):
    import subprocess
    import sys
    root = os.path.dirname(FIXTURES.rstrip("/").rsplit("/", 1)[0])
    env = dict(os.environ, PYTHONPATH=root)
    r = subprocess.run([sys.executable, "-m", "valuekit.plans.cli", "foundation", "--input-dir",
                        os.path.join(FIXTURES, "raw"), "--output-dir", f"{tmp_out}/clean", "--local",
                        "--salt-buckets", "3"],
                       capture_output=True, text=True, env=env, timeout=600)
    assert r.returncode == 0, r.stderr[-2000:]
    assert "nba_stats" in r.stdout
    # the salted prefer-aggregate keeps the same rows as the default plan
    keys = sorted((x.player_id, x.season, x.team_name_abbr)
                  for x in spark.read.parquet(f"{tmp_out}/clean/nba_stats").collect())
    assert keys == [("p1", "2023-24", "BOS"), ("p2", "2023-24", "2TM"), ("p3", "2019-20", "BOS"),
                    ("p3", "2023-24", "BOS")]


def test_lookup_prunes_partitions(spark, built):
    from valuekit.operators import lookup as L
    out, _, _ = built
    players = spark.read.parquet(f"{out}/arch/player_archetype_metrics")
    hit = L.filter_results(players, season_start_year=[2023], archetype="Rim Protector")
    plan = hit._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.split("\n") if "FileScan" in line][0]
    assert "PartitionFilters: [isnotnull(season_start_year" in scan and "2023" in scan.split("PartitionFilters")[1]
    assert [r.player_id for r in hit.collect()] == ["p2"]

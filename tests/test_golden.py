"""Golden rows from FIXTURES.md section 2, one test per composite operator."""

import math

import pytest
from pyspark.sql import functions as F

from valuekit import schemas as K
from valuekit.operators import clean as CL
from valuekit.operators import metrics as M
from valuekit.operators import rank as R
from valuekit.operators.dedupe import consolidate, prefer_tagged_rows
from valuekit.operators.rules import archetype_rules
from valuekit.operators.tiers import assign_tiers, tier_value_score
from valuekit.plans import foundation as FD


def test_prefer_tagged_rows_golden(spark):
    rows = [("p", "s", None, 1), ("p", "s", "2TM", 2), ("p", "s", "ATL", 3), (None, "s", "2TM", 4),
            (None, "s", "ATL", 5), ("q", "s", "5TM", 6), ("q", "s", "ATL", 7)]
    df = spark.createDataFrame(rows, "player_id string, season string, team string, rid int")
    kept = prefer_tagged_rows(df, ["player_id", "season"], "team", K.AGGREGATE_TEAM_TAGS)
    assert sorted(r.rid for r in kept.collect()) == [2, 4, 5, 6, 7]


def test_prefer_tagged_rows_plan_has_no_window(spark):
    df = spark.createDataFrame([("a", "s", "2TM")], "player_id string, season string, team string")
    plan = prefer_tagged_rows(df, ["player_id", "season"], "team", ["2TM"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


@pytest.mark.parametrize("text,two_way,sub_min,salary", [
    ("500 (TW)", True, False, 500),
    ("100 < Minimum", False, True, 100),
    ("  7 ", False, False, 7),
    ("1200.0", False, False, 1200),      # non-ANSI cast truncates the fraction
    ("< Minimum", False, True, None),
    ("$1,000", False, False, None),
    ("1e6", False, False, None),
    ("", False, False, None),
    (None, None, None, None),
])
def test_money_text(spark, text, two_way, sub_min, salary):
    df = spark.createDataFrame([(text,)], "salary string")
    out = CL.parse_money_text(df, "salary", "salary",
                              {"is_two_way": K.TWO_WAY_MARK, "is_sub_minimum": K.SUB_MINIMUM_MARK}).collect()
    if salary is None:
        assert out == []
    else:
        assert (out[0].is_two_way, out[0].is_sub_minimum, out[0].salary) == (two_way, sub_min, salary)


def test_consolidate_and_cap_share(spark):
    df = spark.createDataFrame([("a1", "2022-23", "LAL", "700"), ("a1", "2022-23", "BOS", "500 (TW)")],
                               K.SALARIES_SCHEMA)
    sal = FD.clean_nba_salaries(df)
    r = sal.collect()[0]
    assert (r.salary, r.teams, r.is_two_way, r.is_sub_minimum, r.season_start_year) == \
        (1200, "BOS / LAL", True, False, 2022)
    caps = spark.createDataFrame([("2022-23", 10000)], "season string, salary_cap int")
    assert FD.normalize_salary_to_cap(sal, caps).collect()[0].salary_pct_of_cap == 0.12
    zero = spark.createDataFrame([("2022-23", 0)], "season string, salary_cap int")
    assert FD.normalize_salary_to_cap(sal, zero).collect()[0].salary_pct_of_cap is None
    other = spark.createDataFrame([("2021-22", 10)], "season string, salary_cap int")
    assert FD.normalize_salary_to_cap(sal, other).collect()[0].salary_pct_of_cap is None


def test_consolidate_all_null_labels_give_empty_string(spark):
    df = spark.createDataFrame([("k", None, 1), ("k", None, 2)], "k string, team string, v int")
    r = consolidate(df, ["k"], "v", "team").collect()[0]
    assert (r.v, r.teams) == (3, "")


def test_profiles(spark):
    rows = [("p1", "A", None, None, None, None, 80, 200, "USA", None, 0),
            ("p2", "B", "Duke", 2015.0, 1.0, 3.0, 78, 210, "USA", 2016.0, 1),
            ("p3", "C", "X", 2015.9, 1.0, 3.0, 78, 210, "USA", 2016.0, 1),
            ("", "D", "X", 2015.0, 1.0, 3.0, 78, 210, "USA", 2016.0, 1)]
    out = {r.player_id: r for r in FD.clean_player_profiles(spark.createDataFrame(rows, K.PROFILES_SCHEMA)).collect()}
    assert set(out) == {"p1", "p2", "p3"}
    assert (out["p1"].draft_year, out["p1"].college, out["p1"].is_drafted) == (-1, "None", False)
    assert (out["p2"].draft_year, out["p2"].is_drafted) == (2015, True)
    assert out["p3"].draft_year == 2015  # float -> int truncates


def test_standings(spark):
    rows = [("2023-24", "Boston Celtics", "50-32"), ("2023-24", "Unknown Team", "0-0"),
            ("2023-24", "Boston Celtics", "50"), ("N/A", "Boston Celtics", "1-1"), ("", "Boston Celtics", "1-1")]
    out = FD.clean_expanded_standings(spark.createDataFrame(rows, K.STANDINGS_SCHEMA)).collect()
    got = sorted(((r.season, r.team, r.wins, r.losses, r.win_pct, r.team_name_abbr, r.season_start_year) for r in out),
                 key=repr)
    assert got == sorted([
        ("2023-24", "Boston Celtics", 50, 32, 0.6098, "BOS", 2023),
        ("2023-24", "Unknown Team", 0, 0, None, None, 2023),
        ("2023-24", "Boston Celtics", 50, None, None, "BOS", 2023),
        ("N/A", "Boston Celtics", 1, 1, 0.5, "BOS", None),
    ], key=repr)


def test_range_checks(spark):
    df = spark.createDataFrame([(1.0, 1.5, 100.0, -50.0), (1.01, 1.6, 100.5, -50.5), (-0.1, None, float("nan"), 50.0)],
                               "fg_pct float, efg_pct float, usg_pct float, bpm float")
    out = CL.null_outside(df, {"fg_pct": (0.0, 1.0), "efg_pct": (0.0, 1.5), "usg_pct": (0.0, 100.0),
                               "bpm": (-50.0, 50.0)}).collect()
    assert tuple(out[0]) == (1.0, 1.5, 100.0, -50.0)
    assert tuple(out[1]) == (None, None, None, None)
    assert tuple(out[2]) == (None, None, None, 50.0)


def test_carriage_returns_and_start_year(spark):
    df = spark.createDataFrame([("20\r23-24", "a\rb\r", 1)], "season string, t string, n int")
    r = CL.add_season_start_year(CL.strip_carriage_returns(df)).collect()[0]
    assert (r.season, r.t, r.n, r.season_start_year) == ("2023-24", "ab", 1, 2023)


def _cvs_row(spark, season, share, games=41):
    df = spark.createDataFrame(
        [(season, 25.0, 5.0, 5.0, 1.0, 0.5, 3.0, share, games, 30000000.0)],
        "season string, pts_per_game double, trb_per_game double, ast_per_game double, stl_per_game double, "
        "blk_per_game double, tov_per_game double, salary_pct_of_cap double, games int, player_salary double")
    return M.availability(M.composite_value(df)).collect()[0]


def test_composite_value_golden(spark):
    r = _cvs_row(spark, "2023-24", 0.25)
    assert (r.production_score, r.composite_value_score, r.games_possible, r.availability_rate) == (38.5, 154.0, 82, 0.5)
    assert (r.availability_adj_cvs, r.missed_game_cost) == (77.0, 15000000.0)
    r = _cvs_row(spark, "2019-20", 0.25)
    assert r.games_possible == 73 and r.availability_rate == pytest.approx(41 / 73)
    assert r.missed_game_cost == pytest.approx(30e6 * 32 / 73)
    assert _cvs_row(spark, "2023-24", None).composite_value_score == pytest.approx(3850.0)
    assert _cvs_row(spark, "2023-24", 0.004).composite_value_score == pytest.approx(3850.0)
    r = _cvs_row(spark, "2023-24", 0.25, games=84)
    assert (r.availability_rate, r.missed_game_cost) == (1.0, 0.0)


LABEL_COLS = ["pos", "usg_pct", "pts_per36", "ts_pct", "fg3a_per36", "stl_per36", "blk_per36", "ast_per36",
              "ast_pct", "blk_pct", "orb_pct", "trb_per36", "ws_per_48", "fg3a_per_fga_pct"]
LABEL_SCHEMA = ("pos string, usg_pct float, pts_per36 double, ts_pct float, fg3a_per36 double, stl_per36 double, "
                "blk_per36 double, ast_per36 double, ast_pct float, blk_pct float, orb_pct float, trb_per36 double, "
                "ws_per_48 float, fg3a_per_fga_pct float")


@pytest.mark.parametrize("row,label", [
    (("PG", 30, 26, .60, 8, 1.5, .3, 8, 40, .5, 2, 5, .20, .40), "Playmaking Engine"),
    (("SF-PF", 25, 20, .57, 2, 1.5, 1.5, 4, 15, 2.5, 5, 7, .13, .20), "Elite Scorer"),
    (("SF-PF", 15, 10, .50, 1, .5, .2, 4, 10, .5, 3, 5, .05, .10), "Role Player / Glue Guy"),
    (("SF-PF", 15, 10, .50, 1, .5, .2, 2, 10, .5, 3, 5, .05, .10), "3-and-D Wing"),
    ((None, 30, 26, .60, 8, 1.5, .3, 8, 40, .5, 2, 5, .20, .40), "Role Player / Glue Guy"),
])
def test_archetype_golden(spark, row, label):
    row = tuple(float(x) if isinstance(x, (int, float)) else x for x in row)
    df = spark.createDataFrame([row], LABEL_SCHEMA)
    assert archetype_rules().apply(df, "archetype").collect()[0].archetype == label


def test_archetype_float_edges(spark):
    base = ["SF-PF", 15.0, 10.0, 0.50, 1.0, 0.5, 0.2, 4.0, 10.0, 0.5, 3.0, 5.0, 0.05, 0.10]
    ws = list(base)
    ws[12] = 0.12  # float 0.12 < double 0.12: no Two-Way point
    ts = list(base)
    ts[3] = 0.56   # float 0.56 > double 0.56: one Elite point, tie with Glue at 1 -> Elite (earlier)
    df = spark.createDataFrame([tuple(ws), tuple(ts)], LABEL_SCHEMA)
    got = [r.archetype for r in archetype_rules().apply(df, "archetype").collect()]
    assert got == ["Role Player / Glue Guy", "Elite Scorer"]


@pytest.mark.parametrize("share,tier", [(-1.0, 0.0), (0.0, 0.0), (0.0299, 0.0), (0.03, 1.0), (0.07, 2.0),
                                        (0.12, 3.0), (0.18, 4.0), (0.24, 5.0), (0.2999, 5.0), (0.30, 6.0),
                                        (1e9, 6.0), (float("inf"), 6.0)])
def test_tiers(spark, share, tier):
    df = spark.createDataFrame([(share,)], "s double")
    assert assign_tiers(df, "s", "tier").collect()[0].tier == tier


def test_tiers_drop_null_nan_and_raise_below(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "s double")
    assert assign_tiers(df, "s", "tier").count() == 0
    with pytest.raises(Exception):
        assign_tiers(spark.createDataFrame([(-1.5,)], "s double"), "s", "tier").collect()


def test_tier_value_score_golden(spark):
    df = spark.createDataFrame([(0.1, 2.0, 0.2, 0.6, 25.0), (0.1, 1.0, 0.1, 0.5, 20.0), (0.5, 1.0, 0.1, 0.5, 20.0)],
                               "salary_pct_of_cap double, bpm double, ws_per_48 double, ts_pct double, usg_pct double")
    out = {(r.salary_group, r.bpm): r.value_score for r in tier_value_score(df).collect()}
    s = 1 / math.sqrt(2)
    # pooled over all rows: two rows at +-d in tier 2, one row alone in tier 6 (diff 0)
    # global sample std = sqrt(2 d^2 / 2) = d, so z = +-1 and the scores are +-1 (weights sum to 1)
    assert out[(2.0, 2.0)] == pytest.approx(1.0)
    assert out[(2.0, 1.0)] == pytest.approx(-1.0)
    assert out[(6.0, 1.0)] == 0.0
    two = df.filter(F.col("salary_pct_of_cap") < 0.2)
    out2 = sorted(r.value_score for r in tier_value_score(two).collect())
    assert out2 == pytest.approx([-s, s])
    one = df.filter(F.col("salary_pct_of_cap") > 0.2)
    assert [r.value_score for r in tier_value_score(one).collect()] == [0.0]


def test_rank_and_median(spark):
    scores = [9, 9, 8, 7, 6, 5, None]
    df = spark.createDataFrame([("s", "a", float(x) if x is not None else None) for x in scores],
                               "season string, archetype string, value_score double")
    got = sorted((r.value_score is None, -(r.value_score or 0), r.rank)
                 for r in R.top_k_per_group(df, ["season", "archetype"], "value_score", k=5).collect())
    assert [g[2] for g in got] == [1, 1, 3, 4, 5]
    six = spark.createDataFrame([("s", "a", float(x)) for x in (9, 8, 7, 6, 5, 5)],
                                "season string, archetype string, value_score double")
    assert R.top_k_per_group(six, ["season", "archetype"], "value_score", k=5).count() == 6
    med = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4)], "v double")
    assert med.agg(F.percentile_approx("v", 0.5)).collect()[0][0] == 2.0


def test_cost_metrics(spark):
    df = spark.createDataFrame([(10_000_000, 5.0, 3.0, 41, 0.2, 10.0, 5.0, 5.0, 1.0, 1.0, 2.0, 10.0),
                                (10_000_000, 0.0, 3.0, 41, 0.2, 10.0, 5.0, 5.0, 1.0, 1.0, 2.0, 10.0)],
                               "player_salary long, ws float, vorp float, games int, salary_share double, "
                               "pts_per_game double, trb_per_game double, ast_per_game double, stl_per_game double, "
                               "blk_per_game double, tov_per_game double, salary_millions double")
    a, b = M.value_metrics(df).collect()
    assert a.cost_per_ws == 2_000_000.0 and b.cost_per_ws is None
    assert a.value_score == pytest.approx(2.0) and a.availability == 0.5
    assert a.cost_per_available_ws == 4_000_000.0 and b.cost_per_available_ws is None
    assert a.composite_index == pytest.approx((10 + 6 + 7.5 + 2 + 2 - 2) / 10)


def test_tier_value_score_by_group_equals_separate_runs(spark):
    rows = [(s, share, b, w, t, u) for s in ("a", "b") for share, b, w, t, u in
            [(0.1, 2.0, 0.2, 0.6, 25.0), (0.1, 1.0, 0.1, 0.5, 20.0), (0.5, 1.0, 0.1, 0.5, 20.0),
             (0.05, 3.0 if s == "a" else 9.0, 0.3, 0.4, 10.0), (0.05, 1.0, 0.0, 0.7, 30.0)]]
    df = spark.createDataFrame(rows, "season string, salary_pct_of_cap double, bpm double, ws_per_48 double, "
                                     "ts_pct double, usg_pct double")
    grouped = sorted((r.season, r.bpm, r.salary_pct_of_cap, r.value_score)
                     for r in tier_value_score(df, by=["season"]).collect())
    separate = sorted((r.season, r.bpm, r.salary_pct_of_cap, r.value_score)
                      for s in ("a", "b") for r in tier_value_score(df.filter(F.col("season") == s)).collect())
    assert [g[:3] for g in grouped] == [x[:3] for x in separate]
    assert all(math.isclose(g[3], x[3], abs_tol=1e-12) for g, x in zip(grouped, separate))


def test_lookup_helpers(spark):
    from valuekit.operators import lookup as L
    df = spark.createDataFrame([("p1", "Alpha", 2023, "BOS", "2023-24", 100.0), ("p1", "Alpha", 2022, "BOS", "2022-23", 50.0),
                                ("p2", "Beta", 2023, "LAL", "2023-24", 10.0)],
                               "player_id string, name string, season_start_year int, team_name_abbr string, "
                               "season string, missed_game_cost double")
    assert L.filter_results(df, season_start_year=[2023], team_name_abbr="BOS", pos=None).count() == 1
    assert [r.season_start_year for r in L.player_history(df, "Alpha").collect()] == [2022, 2023]
    assert L.player_history(df, "p2").count() == 1
    assert L.select_present(df, ["name", "nope", "player_id"]).columns == ["name", "player_id"]
    got = {(r.team_name_abbr, r.season): (r.wasted_salary, r.player_count) for r in L.wasted_cap(df).collect()}
    assert got == {("BOS", "2023-24"): (100.0, 1), ("BOS", "2022-23"): (50.0, 1), ("LAL", "2023-24"): (10.0, 1)}


def test_observed_drop_count_and_file_bound(spark, tmp_out):
    import glob
    from pyspark.sql import Observation
    from valuekit.sources import files
    obs = Observation("money")
    df = spark.createDataFrame([("1",), ("$2",), ("3 (TW)",), ("< Minimum",)], "salary string")
    out = CL.parse_money_text(df, "salary", "amount", {"is_two_way": K.TWO_WAY_MARK,
                                                       "is_sub_minimum": K.SUB_MINIMUM_MARK}, observation=obs)
    files.write_parquet(out, f"{tmp_out}/m", n_files=1)
    assert obs.get["dropped_amount"] == 2 and obs.get["rows_amount"] == 4
    assert len(glob.glob(f"{tmp_out}/m/*.parquet")) == 1
    assert spark.read.parquet(f"{tmp_out}/m").count() == 2


def test_quality_reports(spark):
    from valuekit.operators import quality as Q
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("b", None)], "k string, n int")
    nulls = {r.column_name: (r.null_count, r.status) for r in Q.null_key_report(df, ["k", "n"], "t").collect()}
    assert nulls == {"k": (1, "WARN"), "n": (1, "WARN")}
    d = Q.duplicate_key_report(df, ["k", "n"], "t").collect()[0]
    assert (d.total_rows, d.distinct_keys, d.duplicate_rows) == (4, 3, 1)
    assert [(r.k, r.n, r["count"]) for r in Q.duplicate_keys(df, ["k", "n"]).collect()] == [("a", 1, 2)]
    s = Q.cleaning_summary({"t": (df, df.filter("k IS NOT NULL"))}).collect()[0]
    assert (s.raw_rows, s.clean_rows, s.dropped_rows) == (4, 3, 1)
    assert Q.preview(df, 2).count() == 2


def test_key_profile_one_pass(spark):
    from valuekit.operators import quality as Q
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("b", None), (None, 2)], "k string, n int")
    got = {r.item: r.value for r in Q.key_profile(df, ["k", "n"], "t").collect()}
    assert got == {"total_rows": 5, "distinct_keys": 3, "duplicate_rows": 2, "keys_with_duplicates": 2,
                   "null_k": 2, "null_n": 1}


def test_shuffle_sizing_respects_explicit_settings(spark, tmp_out):
    from valuekit.plans.tuning import input_bytes, size_shuffles
    keys = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.files.maxPartitionBytes"]
    before = {k: spark.conf.get(k) for k in keys}
    try:
        spark.range(1000).write.parquet(f"{tmp_out}/r")
        assert input_bytes(spark, [f"{tmp_out}/r", f"{tmp_out}/missing"]) > 0
        chosen = size_shuffles(spark, [f"{tmp_out}/r"], target_mb=64)
        assert "spark.sql.shuffle.partitions" in chosen or spark.sparkContext.getConf().contains(
            "spark.sql.shuffle.partitions")
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") in ("64m", str(64 * 1024 * 1024))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_counted_write_of_an_empty_result(spark, tmp_out):
    from valuekit.sources import files
    empty = spark.range(100).select((F.col("id") % 3).alias("y"), F.col("id")).filter(F.col("id") < 0)
    assert files.write_parquet_counted(empty, f"{tmp_out}/e", partition_by=["y"]) == 0
    assert files.write_parquet_counted(empty, f"{tmp_out}/f") == 0
    full = spark.range(100).select((F.col("id") % 3).alias("y"), F.col("id"))
    assert files.write_parquet_counted(full, f"{tmp_out}/g", partition_by=["y"]) == 100


def test_text_to_integer_trims_control_characters(spark):
    from valuekit.functions.columns import text_to_integer
    texts = ["\x015\x01", "5\x00", "\x0b7", " 12.9 ", "-.5", ".", "+", "1..2", "99999999999999999999"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.v for r in df.select("i", text_to_integer("t").alias("v")).orderBy("i").collect()]
    assert got == [5, 5, 7, 12, 0, 0, None, None, None]


def test_tiers_with_a_finite_last_split(spark):
    splits = (0.0, 0.5, 1.0)
    df = spark.createDataFrame([(0.0,), (0.49,), (0.5,), (1.0,)], "s double")
    assert [r.t for r in assign_tiers(df, "s", "t", splits).orderBy("s").collect()] == [0.0, 0.0, 1.0, 1.0]
    with pytest.raises(Exception):
        assign_tiers(spark.createDataFrame([(1.01,)], "s double"), "s", "t", splits).collect()


def test_kept_rows_equal_what_the_operator_keeps(spark):
    from valuekit.operators import quality as Q
    from valuekit.operators.dedupe import prefer_tagged_rows
    rows = [(1, "a", "2TM"), (1, "a", "X"), (1, "b", "X"), (None, "a", "2TM"), (None, "a", "X"), (2, "a", None), (2, "a", "X"), (3, "c", None)]
    df = spark.createDataFrame(rows, "k1 int, k2 string, t string")
    got = {r.item: r.value for r in Q.key_profile(df, ["k1", "k2"], "x", tag_col="t", tags=["2TM"]).collect()}
    assert got["kept_rows"] == prefer_tagged_rows(df, ["k1", "k2"], "t", ["2TM"]).count()


def test_file_number_with_partitions_is_refused(spark, tmp_out):
    from valuekit.sources import files
    df = spark.range(3).withColumn("p", F.col("id"))
    with pytest.raises(ValueError):
        files.write_parquet(df, f"{tmp_out}/x", partition_by=["p"], n_files=4)


def test_strict_projection_names_the_missing_column(spark):
    from valuekit.plans import analysis
    df = spark.createDataFrame([("p", 30, 300, 5.0, "N1", "S", 0.1, *[1.0] * 6)],
                               "player_id string, games int, mp int, player_salary double, team_name_abbr string, season string, "
                               "salary_pct_of_cap double, pts_per_game double, trb_per_game double, ast_per_game double, "
                               "stl_per_game double, blk_per_game double, tov_per_game double")
    with pytest.raises(Exception, match="name"):
        analysis.composite_value_table(df)


def test_quoted_values_in_rules(spark):
    from valuekit.operators.rules import one_of
    df = spark.createDataFrame([("a\\b",), ("it's",), ("x",)], "p string")
    assert [r[0] for r in df.select(F.expr(one_of("p", ("a\\b", "it's")))).collect()] == [True, True, False]

"""A key holding a third of all rows: AQE splits it in the prefer-aggregate
anti-join, and the salted form gives the same rows.

Skew thresholds are lowered so the split shows at test size; broadcasts are
off so the sort-merge path is the one exercised. The input has several map
tasks because AQE splits a skewed partition along map-output boundaries."""

import pytest
from pyspark.sql import functions as F

from valuekit.operators.dedupe import prefer_tagged_rows

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16384",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def skew_conf(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def hot_input(spark):
    # a third of the rows share key (1, 1); every 5th row carries the aggregate tag
    return spark.range(0, 60000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k1"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.lit(2)).alias("k2"),
        F.when(F.col("id") % 5 == 0, F.lit("2TM")).otherwise(F.lit("BOS")).alias("team"),
        F.col("id"))


def expected_ids(rows):
    tagged_keys = {(r.k1, r.k2) for r in rows if r.team == "2TM"}
    return sorted(r.id for r in rows if r.team == "2TM" or (r.k1, r.k2) not in tagged_keys)


def test_hot_key_is_split_by_aqe(spark, skew_conf):
    df = hot_input(spark)
    out = prefer_tagged_rows(df, ["k1", "k2"], "team", ["2TM"])
    got = sorted(r.id for r in out.collect())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan and "LeftAnti" in plan
    assert got == expected_ids(df.collect())


def test_salted_form_matches(spark, skew_conf):
    df = hot_input(spark)
    want = expected_ids(df.collect())
    for kw in ({"salt_buckets": 8}, {"dedupe_keys": True}):
        got = sorted(r.id for r in prefer_tagged_rows(df, ["k1", "k2"], "team", ["2TM"], **kw).collect())
        assert got == want


def unify_inputs(spark, hot):
    """Stats whose key (hot, 'S') holds a third of the rows; right sides with
    repeated and missing keys."""
    rows = spark.range(0, 30000, numPartitions=8)
    pid = F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.concat(F.lit("p"), (F.col("id") % 500).cast("string")))
    stats = rows.select(pid.alias("player_id"), F.when(F.col("id") % 3 == 0, F.lit("S")).otherwise(F.lit("T")).alias("season"),
                        F.lit(2000).alias("season_start_year"), F.concat(F.lit("N"), (F.col("id") % 4).cast("string")).alias("team_name_abbr"), "id")
    keys = spark.range(0, 500, numPartitions=4).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("player_id"), "id")
    twice = keys.withColumn("n", F.explode(F.when(F.col("id") % 7 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    adv = twice.filter("id % 5 <> 0").select("player_id", F.when(F.col("id") == 1, F.lit("S")).otherwise(F.lit("T")).alias("season"),
                                             (F.col("id") * 10 + F.col("n")).alias("ws"))
    sal = twice.filter("id % 3 <> 0").select("player_id", F.when(F.col("id") == 1, F.lit("S")).otherwise(F.lit("T")).alias("season"),
                                             F.lit(2000).alias("season_start_year"), (F.col("id") + F.col("n")).alias("player_salary"))
    adv = adv.unionByName(spark.createDataFrame([(None, "S", 5), ("p2", None, 6)], "player_id string, season string, ws long"))
    profiles = keys.filter("id % 2 = 0").select("player_id", F.col("id").alias("height"))
    caps = spark.createDataFrame([("T", 7), ("S", 8)], "season string, league_salary_cap int")
    standings = spark.createDataFrame([(2000, f"N{i}", i, i, 0.5) for i in range(3)],
                                      "season_start_year int, team_name_abbr string, wins int, losses int, win_pct double")
    return stats, adv, profiles, sal, caps, standings


@pytest.mark.parametrize("hot", ["p1", None])
def test_unify_splits_a_hot_key_and_lets_null_keys_pass(spark, skew_conf, hot):
    from valuekit.operators.join import unify
    stats, adv, profiles, sal, caps, standings = unify_inputs(spark, hot)
    out = unify(stats, adv, profiles, sal, caps, standings, advanced_columns=["ws"])
    got = sorted(map(str, out.collect()))
    plan = out._jdf.queryExecution().executedPlan().toString()
    plain = (stats.join(adv, ["player_id", "season"], "left").join(sal.drop("season_start_year"), ["player_id", "season"], "left")
             .join(profiles, "player_id", "left").join(caps, "season", "left")
             .join(standings, ["season_start_year", "team_name_abbr"], "left").select(*out.columns))
    assert got == sorted(map(str, plain.collect()))
    if hot:
        wide = [line for line in plan.split("\n") if "SortMergeJoin(skew=true)" in line and "player_id" in line and "season" in line]
        assert wide, plan[:3000]


def test_no_job_runs_while_frames_are_built(spark):
    from valuekit.catalog import domain
    import os
    sf = "/root/testdata/sf0.001"
    if not os.path.exists(sf):
        pytest.skip("driver test data not present")
    raw = domain.raw_tables(spark, sf)
    tracker, group = spark.sparkContext.statusTracker(), "building frames"
    spark.sparkContext.setJobGroup(group, group)
    try:
        from valuekit.plans import analysis, foundation
        analysis.unify_cleaned(foundation.clean_all(raw))
        assert list(tracker.getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

"""Bucketed joins, key filters, mergeable rollup states, publication, and key
checks that the unify job obeys."""

import os

import pytest
from fixture_paths import FIXTURES
from pyspark.sql import functions as F

import __spark_entry__ as E
from valuekit.operators import rank as R
from valuekit.operators.dedupe import key_filter, prefer_tagged_rows, split_by_filter
from valuekit.operators.join import first_by_key
from valuekit.plans import analysis, foundation
from valuekit.sources import files, layout, publish

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
def test_bucketed_facts_join_without_a_shuffle(spark, no_broadcast):
    keyed = "hashpartitioning(player_id#"
    plain, bucketed = (plan_of(E.queries()[q](spark, SF)) for q in ("q12_unify", "q43_unify_bucketed"))
    by_key = lambda plan: [x for x in plan.splitlines() if keyed in x and "season#" in x.split(keyed)[1].split(")")[0]]
    assert by_key(plain) and not by_key(bucketed)
    assert bucketed.count("SelectedBucketsCount") == 0 or "Bucketed: true" in bucketed


def test_layout_is_read_from_the_catalog(spark, tmp_out):
    df = spark.range(100).select((F.col("id") % 7).alias("a"), F.col("id").alias("b"))
    for name, buckets in (("layout_x", 4), ("layout_y", 4), ("layout_z", 2)):
        layout.write_bucketed(df, name, f"{tmp_out}/{name}", ["a", "b"], buckets)
    assert layout.bucketing(spark, "layout_x") == (4, ("a", "b")) and layout.bucketing(spark, "no_such_table") is None
    assert layout.colocated(spark, ["layout_x", "layout_y"], ["a", "b"])
    assert not layout.colocated(spark, ["layout_x", "layout_z"], ["a", "b"]) and not layout.colocated(spark, ["layout_x"], ["a"])
    assert sorted(spark.table("layout_x").collect()) == sorted(df.collect())


@pytest.mark.parametrize("words", [1, 16, 1 << 20])
def test_key_filter_keeps_the_rows(spark, words):
    """A third of the rows share a key that is hot on the tagged side; keys and tags may be NULL."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 101 == 0, F.lit(None)).otherwise(F.col("id") % 4000).alias("k"),
        F.when(F.col("id") % 997 == 0, F.lit(None)).when((F.col("id") % 3 == 0) & (F.col("id") % 2 == 0) | (F.col("id") % 50 == 1), "T").otherwise("x").alias("tag"), "id")
    plain, filtered = (prefer_tagged_rows(df, ["k"], "tag", ["T"], filter_words=w) for w in (0, words))
    assert sorted(plain.collect(), key=str) == sorted(filtered.collect(), key=str)
    untagged, keys = df.filter("tag = 'x'"), df.filter("tag = 'T'").select("k")
    table = key_filter(keys, ["k"], words)
    may, certain = split_by_filter(untagged, ["k"], table, words)
    assert table.count() <= words and may.count() + certain.count() == untagged.count()
    assert certain.join(keys, "k", "left_semi").count() == 0
    if words > 16:  # hardly any other row goes to the join
        assert may.count() <= untagged.join(keys, "k", "left_semi").count() + 20


def players(spark, n):
    cost = F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise((F.col("id") * 7919 % 100_003).cast("double"))
    measures = [c for c in R.MEANS if c != "cost_per_ws"]
    return spark.range(n).select(
        F.lit("2000-01").alias("season"), F.lit(2000).alias("season_start_year"),
        F.when(F.col("id") % 40 == 0, "rare").when(F.col("id") % 40 == 1, "none").otherwise("large").alias("archetype"), "id",
        F.when(F.col("id") % 40 != 1, cost).alias("cost_per_ws"), F.col("id").alias("player_salary"),
        *[(F.col("id") % (i + 2)).cast("double").alias(c) for i, c in enumerate(measures)])


def test_states_of_parts_give_the_rollup_of_all(spark):
    df = players(spark, 60_000)
    whole = {r.archetype: r.asDict() for r in R.archetype_season_rollup(df, median_accuracy=1_000_000).collect()}
    parts = [R.rollup_states(df.filter(F.pmod(F.xxhash64("id"), F.lit(5)) == i)) for i in range(5)]
    states = parts[0]
    for p in parts[1:]:
        states = R.merge_states(states.unionByName(p))  # one after the other, as seasons arrive
    two_step = R.rollup_from_states(states)
    assert two_step.columns == R.archetype_season_rollup(df).columns
    for r in two_step.collect():
        for name, value in r.asDict().items():
            if name != "median_cost_per_ws":
                expected = whole[r.archetype][name]
                assert value == expected or value == pytest.approx(expected, rel=1e-12), name
    checks = {r.archetype: r for r in R.median_rank_check(df, two_step).collect()}
    assert checks["large"].n_costs > 10_000 and all(r.median_in_bounds for r in checks.values()) and checks["none"].n_costs == 0
    wrong = two_step.withColumn("median_cost_per_ws", F.col("median_cost_per_ws") * 1.05)
    assert not {r.archetype: r for r in R.median_rank_check(df, wrong).collect()}["large"].median_in_bounds


def test_publication_replaces_touched_partitions_only(spark, tmp_out):
    path = f"{tmp_out}/table"
    row = lambda y, v: (y, v)
    df = lambda rows: spark.createDataFrame(rows, "season int, v string")
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, path)
    publish.publish(df([row(2000, "a"), row(2001, "b"), row(None, "c")]), path, ["season"])
    publish.publish(df([row(2001, "d"), row(2002, "e")]), path, ["season"])
    rows = lambda: sorted(((r.season, r.v) for r in publish.read_published(spark, path).collect()), key=str)
    assert rows() == sorted([(2000, "a"), (2001, "d"), (2002, "e"), (None, "c")], key=str)
    before = rows()
    dying = df([row(2000, "x"), row(2001, "y")]).withColumn("v", F.when(F.col("season") == 2001, F.raise_error(F.lit("killed"))).otherwise(F.col("v")).cast("string"))
    with pytest.raises(Exception, match="killed"):
        publish.publish(dying, path, ["season"])
    assert rows() == before
    old = publish.read_published(spark, path)  # a reader keeps what the pointer had
    publish.publish(df([row(2000, "new")]), path, ["season"])
    assert sorted(r.v for r in old.collect()) == ["a", "c", "d", "e"]
    assert publish.remove_unpublished(spark, path) >= 2
    assert rows() == sorted([(2000, "new"), (2001, "d"), (2002, "e"), (None, "c")], key=str)


def test_unify_obeys_the_key_checks(spark, tmp_out):
    clean = f"{tmp_out}/clean"
    foundation.run_foundation(spark, os.path.join(FIXTURES, "raw"), clean)
    n = spark.read.parquet(f"{clean}/nba_stats").count()
    assert analysis.run_unify(spark, clean, f"{tmp_out}/u0", on_duplicate="refuse") == n
    standings = spark.read.parquet(f"{clean}/nba_expanded_standings_2000_2026")
    matched = spark.read.parquet(f"{tmp_out}/u0").filter("wins is not null").select("season_start_year", "team_name_abbr").distinct()
    again = standings.join(matched, ["season_start_year", "team_name_abbr"]).select(*standings.columns).withColumn("wins", F.lit(99)).collect()
    assert again
    spark.createDataFrame(again, standings.schema).write.mode("append").parquet(f"{clean}/nba_expanded_standings_2000_2026")
    with pytest.raises(analysis.DuplicateKeys, match="standings"):
        analysis.run_unify(spark, clean, f"{tmp_out}/u1", on_duplicate="refuse")
    assert not os.path.exists(f"{tmp_out}/u1")
    assert analysis.run_unify(spark, clean, f"{tmp_out}/u2") > n
    report = {(r.table_name, r.item): r.status for r in spark.read.parquet(f"{tmp_out}/u2_reports/right_keys").collect()}
    assert report["nba_expanded_standings_2000_2026", "duplicate_rows"] == "WARN" and report["player_profiles", "duplicate_rows"] == "OK"
    assert analysis.run_unify(spark, clean, f"{tmp_out}/u3", on_duplicate="first") == n
    with pytest.raises(ValueError):
        analysis.run_unify(spark, clean, f"{tmp_out}/u4", on_duplicate="any")


def test_unify_reads_bucketed_tables_where_they_are(spark, tmp_out):
    clean = f"{tmp_out}/clean"
    foundation.run_foundation(spark, os.path.join(FIXTURES, "raw"), clean)
    tables = files.read_parquet_tables(spark, clean, analysis.CLEANED)
    analysis.bucket_facts(spark, tables, "mech", f"{tmp_out}/tables", 4)
    for name, prefix in (("plain", None), ("bucketed", "mech"), ("absent", "no_such")):
        analysis.run_unify(spark, clean, f"{tmp_out}/{name}", table_prefix=prefix)
    rows = lambda name: sorted(map(str, spark.read.parquet(f"{tmp_out}/{name}").collect()))
    assert rows("plain") == rows("bucketed") == rows("absent")


def test_first_by_key_takes_the_least_row(spark):
    df = spark.createDataFrame([(1, 2.0, None), (1, None, "z"), (1, None, "b"), (None, 1.0, "a"), (2, float("nan"), "x")], "k int, a double, b string")
    assert sorted(map(tuple, first_by_key(df, ["k"]).fillna(-1.0).collect()), key=str)[0] == (1, -1.0, "b") and first_by_key(df, ["k"]).count() == 2

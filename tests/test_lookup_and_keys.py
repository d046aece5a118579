"""Key profiles that group only suspects, and lookups that skip row groups."""

import pytest
from pyspark.sql import functions as F

from valuekit.operators.lookup import filter_results, player_history
from valuekit.operators.quality import key_profile
from valuekit.operators.uniqueness import sketched_key_profile, suspect_profile, suspects
from valuekit.sources.clustered import write_clustered

KEYS = ["a", "b"]


def keyed(spark, n=20000):
    """One key holds a third of the rows, every 50th other one occurs twice,
    and there are NULLs in either column and both, zeros of both signs and NaNs."""
    i = F.col("id")
    hot = i % 3 == 0
    return spark.range(0, n, numPartitions=8).select(
        F.when(hot, "hot").when(i % 101 == 1, None).otherwise(F.concat(F.lit("p"), (i - F.when(i % 50 == 2, 1).otherwise(0)).cast("string"))).alias("a"),
        F.when(hot, F.when(i % 2 == 0, 0.0).otherwise(-0.0)).when(i % 50 < 3, float("nan")).when(i % 7 == 1, None).otherwise(1.5).alias("b"),
        i.alias("hash"))


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("by_hash", [False, True])
@pytest.mark.parametrize("words", [1, 64, 1 << 16])
def test_suspects_give_the_exact_profile(spark, by_hash, words):
    df = keyed(spark)
    expected = rows(key_profile(df, KEYS, "t"))
    assert dict((r[1], r[2]) for r in expected)["keys_with_duplicates"] > 100
    assert rows(suspect_profile(df, KEYS, "t", by_hash, words)) == expected


def test_the_sketch_chooses_a_way_not_a_result(spark):
    df = keyed(spark)
    for shape in (df, df.where("a <> 'hot'"), df.select(F.lit(1).alias("a"), F.lit("x").alias("b")), df.limit(0)):
        for words in (16, 1 << 16):
            assert rows(sketched_key_profile(shape, KEYS, "t", words)) == rows(key_profile(shape, KEYS, "t"))


def test_few_rows_of_a_unique_table_are_suspects(spark):
    df = spark.range(0, 100_000, numPartitions=8).select(F.concat(F.lit("key of a row "), "id").alias("a"))
    n = lambda by_hash: suspects(df, ["a"], by_hash, 1 << 16).where("__suspect").count()
    assert n(False) < 5000 and n(True) == 0


def scanned(df):
    """Rows that the scan of ``df`` hands on, after it has run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    return sum(leaf.metrics().apply("numOutputRows").value() for leaf in _leaves(plan))


def _leaves(plan):
    children = plan.children()
    if plan.getClass().getSimpleName().endswith("QueryStageExec"):
        return _leaves(plan.plan())
    return [plan] if children.isEmpty() else [x for i in range(children.size()) for x in _leaves(children.apply(i))]


def players(spark, n=200_000):
    i = F.col("id")
    # a third of all rows is one player's; names are in no order of the ids
    who = F.when(i % 3 == 0, 77).otherwise(F.pmod(F.xxhash64("id"), F.lit(5000)))
    return (spark.range(0, n, numPartitions=4).withColumn("w", who).select(
        F.when(i % 1000 == 1, None).otherwise(F.format_string("p%05d", "w")).alias("player_id"),
        F.concat(F.lit("name "), F.md5(F.col("w").cast("string"))).alias("name"),
        (1990 + i % 30).cast("int").alias("season_start_year"), F.col("id").alias("__id")))


def test_lookups_read_few_rows_and_find_all(spark, tmp_out):
    df = players(spark)
    laid = write_clustered(df, tmp_out + "/t", ["player_id", "season_start_year"], lookups=["name"], n_files=16)
    assert laid.schema.simpleString() == df.schema.simpleString() and rows(laid.where("player_id is null")) == rows(df.where("player_id is null"))
    name = df.where("player_id = 'p00123'").first()["name"]
    for ask in (lambda t: filter_results(t, player_id="p00123"), lambda t: filter_results(t, name=name),
                lambda t: filter_results(t, player_id=["p00123", "p04000"]),
                lambda t: player_history(t, "p00123").orderBy("__id"), lambda t: player_history(t, name), lambda t: player_history(t, "nobody")):
        assert rows(ask(laid)) == rows(ask(df))
    total = df.count()
    # 16 files; a player lies in one file or, on a border, in two, and one name in a hundred passes a filter by chance
    assert scanned(filter_results(laid, player_id="p00123")) < total / 4
    assert scanned(laid.where(F.col("name") == name)) < total / 2  # some players' rows without an id are in the first file
    assert scanned(player_history(laid, "p00123")) < total / 4
    assert scanned(laid.where("player_id = 'nobody' or name = 'nobody'")) < total / 4


def test_a_hot_player_spreads_over_files(spark, tmp_out):
    write_clustered(players(spark), tmp_out + "/t", ["player_id"], n_files=12)
    sizes = [r["count"] for r in spark.read.parquet(tmp_out + "/t").groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) >= 11 and max(sizes) < 2.5 * 200_000 / 12


def test_empty_table_keeps_its_schema(spark, tmp_out):
    laid = write_clustered(players(spark, 0), tmp_out + "/t", ["player_id"])
    assert laid.isEmpty() and laid.columns == ["player_id", "name", "season_start_year", "__id"]

"""Top-k of hot groups with heavy ties, and malformed records set aside."""

from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from test_skew import skew_conf  # noqa: F401  the fixture
from valuekit.operators.rank import top_k_per_group
from valuekit.operators.topk import best_values, top_k_by_threshold
from valuekit.sources import quarantine
from valuekit.sources.files import load_csv

SCHEMA = StructType([StructField("id", LongType()), StructField("name", StringType()),
                     StructField("n", IntegerType()), StructField("x", DoubleType())])


def scores(spark, n=30000):
    """Group 0 holds a third of the rows, all of them tied on its best value."""
    i = F.col("id")
    return spark.range(0, n, numPartitions=8).select(
        F.when(i % 3 == 0, 0).when(i % 97 == 1, None).otherwise(i % 40 + 1).alias("g"), i,
        F.when(i % 3 == 0, 9.5).when(i % 11 == 0, None).when(i % 501 == 1, float("nan")).when(i % 7 == 1, -0.0)
        .otherwise(F.pmod(F.xxhash64("id"), F.lit(50)).cast("double")).alias("v"), F.lit("old").alias("rank"))


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("k", [1, 5, 300])
def test_same_rows_as_the_window(spark, descending, k):
    df = scores(spark)
    rows = lambda out: Counter(map(str, out.select("g", "id", "v", "rank").collect()))
    assert rows(top_k_by_threshold(df, ["g"], "v", k, descending=descending)) == rows(top_k_per_group(df, ["g"], "v", k, descending=descending))


def test_k_of_zero_and_an_empty_table(spark):
    df = scores(spark)
    assert top_k_by_threshold(df, ["g"], "v", 0).isEmpty()
    out = top_k_by_threshold(df.limit(0), ["g"], "v")
    assert out.isEmpty() and out.columns == ["g", "id", "v", "rank"]


def test_ties_are_one_row_of_the_ranked_side(spark):
    best = best_values(scores(spark), ["g"], "v", 5)
    assert best.groupBy("g").count().agg(F.max("count")).first()[0] <= 5
    assert [r.asDict() for r in best.where("g = 0").collect()][0] == {"g": 0, "v": 9.5, "rank": 1}


def test_hot_ties_are_split(spark, skew_conf):  # noqa: F811
    df = scores(spark, 60000).withColumn("wide", F.sha2(F.col("id").cast("string"), 512))
    out = top_k_by_threshold(df, ["g"], "v", 5)
    assert out.where("g = 0").count() == 20000
    out.collect()
    assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()


LINES = ["1,a,2,0.5", "2,b,x,0.5", "3,c", "4,d,4,1.5,more", "y,,z,", "", "6,,,", "7,\"q,r\",7,1e3", "8,h,9999999999,NaN", "9,i,9,1.5,", "10,\"j,10,1.5"]


def lines(spark, tmp_path, rows=LINES, header=False):
    path = tmp_path / "in"
    path.mkdir()
    (path / "part.csv").write_text("\n".join((["id,name,n,x"] if header else []) + rows) + "\n")
    return str(path)


def test_kept_and_quarantined_with_their_faults(spark, tmp_path):
    path = lines(spark, tmp_path, header=True)
    kept, bad = quarantine.load_csv_quarantined(spark, path, SCHEMA)
    assert sorted(str(tuple(r)) for r in kept.collect()) == sorted(
        ["(1, 'a', 2, 0.5)", "(6, None, None, None)", "(7, 'q,r', 7, 1000.0)"])
    assert {r.raw: [tuple(f) for f in r.faults] for r in bad.collect()} == {
        "2,b,x,0.5": [("n", "not int")], "3,c": [("n", "missing"), ("x", "missing")],
        "10,\"j,10,1.5": [("name", "quote not closed")],
        "4,d,4,1.5,more": [(None, "more fields than columns")],
        "y,,z,": [("id", "not bigint"), ("n", "not int")], "9,i,9,1.5,": [(None, "more fields than columns")], "8,h,9999999999,NaN": [("n", "not int")]}
    assert {tuple(r) for r in quarantine.fault_counts(bad).collect()} == {
        ("n", "not int", 3), ("n", "missing", 1), ("x", "missing", 1), (None, "more fields than columns", 2), ("name", "quote not closed", 1), ("id", "not bigint", 1)}


def test_faults_show_in_columns_that_are_not_read(spark, tmp_path):
    kept, bad = quarantine.load_csv_quarantined(spark, lines(spark, tmp_path), SCHEMA, header="false")
    assert (kept.count(), kept.select("name").count(), bad.count()) == (3, 3, 7)


def test_counts_reconcile(spark, tmp_path):
    path = lines(spark, tmp_path, header=True)
    counts = quarantine.write_quarantined(spark, path, SCHEMA, str(tmp_path / "kept"), str(tmp_path / "bad"))
    assert counts == {"raw": 10, "kept": 3, "quarantined": 7} and counts["raw"] == load_csv(spark, path, SCHEMA).count()


def test_no_lines(spark, tmp_path):
    counts = quarantine.write_quarantined(spark, lines(spark, tmp_path, [], header=True), SCHEMA, str(tmp_path / "k"), str(tmp_path / "b"))
    assert counts == {"raw": 0, "kept": 0, "quarantined": 0}

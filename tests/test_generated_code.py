"""The JIT leaves methods of more than 8,000 bytes of bytecode uncompiled, and a
condition on a derived column holds the whole derivation."""

import re

import pytest

import __spark_entry__ as E
from valuekit.functions import columns as C
from valuekit.plans import foundation
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
JIT_LIMIT = 8000


def method_sizes(spark, df):
    text = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(df._jdf.queryExecution().executedPlan())
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]


@pytest.mark.parametrize("name", ["q44_unify_first", "q31_clean_salaries", "q37_archetype_players"])
def test_generated_methods_can_be_compiled(spark, name):
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = method_sizes(spark, E.queries()[name](spark, SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
    assert sizes and max(sizes) <= JIT_LIMIT


def test_conditions_read_columns(spark):
    plan = E.queries()["q12_unify"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Filter .*(concat\(|element_at\()", plan)


def test_text_to_integer_reads_the_text_once(spark):
    texts = ["12", " -7.5\r", "+3.", ".5", ".", "-.", "+", "", "1e6", "$1", "1,0", "5 5", "9" * 30, "7\n", "7\n8", "\x7f4\x85", "٣", None]
    want = [12, -7, 3, 0, 0, 0, None, None, None, None, None, None, None, 7, None, None, None, None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", C.text_to_integer("t").alias("n"))
    assert [r.n for r in df.orderBy("i").collect()] == want
    text = spark.range(1).select(F.lit("x").alias("t")).select(C.text_to_integer("t"))._jdf.queryExecution().analyzed().toString()
    assert text.count("trim(") <= 2


def test_salary_text_is_parsed_once_a_row(spark):
    """Not once more in a filter, and a cast sees only text that it can read."""
    rows = [("a", "2001-02", "x", "7 (TW)"), ("a", "2001-02", "y", "< Minimum"), ("b", "2001-02", None, "$5"), ("c", "", "x", "1"), ("d", "2001-02", "x", " 8.9\r")]
    df = spark.createDataFrame(rows, "player_id string, season string, team string, salary string")
    out = foundation.clean_nba_salaries(df)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") == 2 and not re.search(r"Filter .*regexp", plan)  # of the salary and of the season
    assert sorted((r.player_id, r.salary, r.teams, r.is_two_way) for r in out.collect()) == [("a", 7, "x", True), ("d", 8, "x", False)]

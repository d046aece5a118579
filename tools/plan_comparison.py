"""Time our plans against the source's plan shapes on line items.

    python tools/plan_comparison.py [/root/testdata/sf0.1]

* rule labels: native staged expressions vs a row-at-a-time Python UDF
  (first-max scorer from the tests);
* tier value score: one pooled aggregate + broadcast vs the pyspark.ml route
  (Bucketizer, group means joined back, VectorAssembler, StandardScaler.fit);
* prefer-aggregate: anti-join on the tagged keys vs the source's distinct keys,
  anti-join and union;
* unify: one wide join on the full-outer-joined right sides vs the source's five
  left joins in a row, on the composite queries' cleaned tables.

Each variant is materialised with the ``noop`` sink; best of three runs.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")  # for the UDF's Python workers

from pyspark.sql import functions as F  # noqa: E402

from valuekit import schemas as K  # noqa: E402
from valuekit.operators.dedupe import prefer_tagged_rows  # noqa: E402
from valuekit.operators.rules import archetype_rules  # noqa: E402
from valuekit.operators.tiers import tier_value_score  # noqa: E402
from valuekit.session import local_session  # noqa: E402


def best_of(df, n=3):
    out = []
    for _ in range(n):
        t = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        out.append(time.perf_counter() - t)
    return round(min(out), 3)


def label_features(li):
    c = F.col
    pos = F.element_at(F.array(*[F.lit(p) for p in ("PG", "SG", "SF", "PF", "C", "SF-PF", "G", "F-C")]),
                       (c("l_suppkey") % 8 + 1).cast("int"))
    return li.select(
        pos.alias("pos"), (15 + c("l_linenumber") * 3).cast("float").alias("usg_pct"),
        (c("l_quantity") % 28).alias("pts_per36"), (0.5 + c("l_discount")).cast("float").alias("ts_pct"),
        (c("l_quantity") % 9).alias("fg3a_per36"), (c("l_partkey") % 25 / 10.0).alias("stl_per36"),
        (c("l_suppkey") % 30 / 10.0).alias("blk_per36"), (c("l_orderkey") % 10).cast("double").alias("ast_per36"),
        (c("l_partkey") % 45).cast("float").alias("ast_pct"), (c("l_orderkey") % 60 / 10.0).cast("float").alias("blk_pct"),
        (c("l_linenumber") * 2).cast("float").alias("orb_pct"), (c("l_orderkey") % 13).cast("double").alias("trb_per36"),
        (c("l_tax") * 3).cast("float").alias("ws_per_48"), (c("l_discount") * 5).cast("float").alias("fg3a_per_fga_pct"))


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(app="valuekit-plan-comparison")
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    res = {}

    feats = label_features(li)
    res["labels_native"] = best_of(archetype_rules().apply(feats, "archetype").groupBy("archetype").count())
    from tests.test_properties import python_label
    cols = ["pos", "usg_pct", "pts_per36", "ts_pct", "fg3a_per36", "stl_per36", "blk_per36", "ast_per36", "ast_pct",
            "blk_pct", "orb_pct", "trb_per36", "ws_per_48", "fg3a_per_fga_pct"]
    udf = F.udf(lambda *r: python_label(list(r)), "string")
    res["labels_python_udf"] = best_of(feats.withColumn("archetype", udf(*cols)).groupBy("archetype").count())

    tier_in = li.select((F.col("l_quantity") / 160.0).alias("salary_pct_of_cap"), F.col("l_quantity").alias("bpm"),
                        F.col("l_extendedprice").alias("ws_per_48"), F.col("l_discount").alias("ts_pct"),
                        F.col("l_tax").alias("usg_pct"))
    res["tiers_native_pooled"] = best_of(tier_value_score(tier_in))

    def ml_route():
        from pyspark.ml.feature import Bucketizer, StandardScaler, VectorAssembler
        from pyspark.ml.functions import vector_to_array
        df = Bucketizer(splits=list(K.TIER_SPLITS), inputCol="salary_pct_of_cap", outputCol="salary_group",
                        handleInvalid="skip").transform(tier_in)
        feats4 = [f for f, _ in K.TIER_FEATURE_WEIGHTS]
        avg = df.groupBy("salary_group").agg(*[F.avg(f).alias(f"avg_{f}") for f in feats4])
        df = df.join(avg, "salary_group").withColumns({f"{f}_diff": F.col(f) - F.col(f"avg_{f}") for f in feats4})
        df = VectorAssembler(inputCols=[f"{f}_diff" for f in feats4], outputCol="raw", handleInvalid="skip").transform(df)
        df = StandardScaler(inputCol="raw", outputCol="z", withMean=True, withStd=True).fit(df).transform(df)
        z = vector_to_array(F.col("z"))
        return df.withColumn("value_score", sum(w * z[i] for i, (_, w) in enumerate(K.TIER_FEATURE_WEIGHTS)))

    t = time.perf_counter()
    ml_df = ml_route()  # includes the eager fit job, as in the source
    fit = time.perf_counter() - t
    res["tiers_ml_pipeline"] = round(best_of(ml_df.drop("raw", "z")) + fit, 3)

    keys = ["l_orderkey", "l_linenumber"]
    base = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")
    res["prefer_anti_join"] = best_of(prefer_tagged_rows(base, keys, "l_returnflag", ["A"]))
    tag = F.col("l_returnflag").isin("A")
    with_tag, without = base.filter(tag), base.filter(~tag)  # the source: distinct keys, anti-join, union
    source = with_tag.unionByName(without.join(with_tag.select(*keys).distinct(), keys, "left_anti"))
    res["prefer_source_shape"] = best_of(source)

    from valuekit.catalog import domain
    from valuekit.operators.join import ADVANCED_COLUMNS
    from valuekit.plans.analysis import unify_cleaned
    from valuekit.session import scratch_path
    clean = {}
    for name, df in domain.cleaned(spark, sf_dir).items():
        path = scratch_path(spark, f"plan_{name}")
        df.write.parquet(path)
        clean[name] = spark.read.parquet(path)
    res["unify_one_wide_join"] = best_of(unify_cleaned(clean))
    both = ["player_id", "season"]
    sal = clean["nba_salaries"].withColumnRenamed("salary", "player_salary").drop("season_start_year")
    five = (clean["nba_stats"].join(clean["nba_advanced_player_stats"].select(*both, *ADVANCED_COLUMNS), both, "left")
            .join(clean["player_profiles"], "player_id", "left").join(sal, both, "left")
            .join(clean["nba_salary_cap"].select("season", F.col("salary_cap").alias("league_salary_cap")), "season", "left")
            .join(clean["nba_expanded_standings_2000_2026"].select("season_start_year", "team_name_abbr", "wins", "losses", "win_pct"),
                  ["season_start_year", "team_name_abbr"], "left"))
    res["unify_source_shape"] = best_of(five)
    print(json.dumps({"sf": os.path.basename(sf_dir), "seconds": res}))
    spark.stop()


if __name__ == "__main__":
    main()

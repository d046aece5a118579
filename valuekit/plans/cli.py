"""One command line for the five jobs.

    spark-submit -m valuekit.plans.cli foundation --input RAW_DIR --output CLEAN_DIR
    spark-submit -m valuekit.plans.cli unify      --input CLEAN_DIR --output UNIFIED
    spark-submit -m valuekit.plans.cli composite  --input UNIFIED --output OUT
    spark-submit -m valuekit.plans.cli archetypes --input UNIFIED --output OUT
    spark-submit -m valuekit.plans.cli tiers      --input UNIFIED --output OUT
    spark-submit -m valuekit.plans.cli all        --input RAW_DIR --output OUT_DIR

Session settings (shuffle partitions, AQE, checkpoint directory) come from
the submitter; ``--local`` builds a local session for trying things out.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from valuekit.plans import analysis, foundation


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="valuekit")
    p.add_argument("job", choices=["foundation", "unify", "composite", "archetypes", "tiers", "all"])
    p.add_argument("--input", "--input-dir", "--input-path", dest="input", required=True)
    p.add_argument("--output", "--output-dir", "--output-path", dest="output", required=True)
    p.add_argument("--files", type=int, default=None, help="bound the number of output files")
    p.add_argument("--salt-buckets", type=int, default=1,
                   help="foundation: spread hot (player, season) keys over this many join partitions")
    p.add_argument("--on-duplicate", choices=["warn", "refuse", "first"], default="warn",
                   help="unify: what to do where a right side repeats a key")
    p.add_argument("--table-prefix", default=None, help="unify: read the facts from bucketed catalog tables of this prefix")
    p.add_argument("--local", action="store_true")
    p.add_argument("--no-sizing", action="store_true", help="keep the session's shuffle settings as they are")
    a = p.parse_args(argv)
    if a.local:
        from valuekit.session import local_session
        spark = local_session()
    else:
        spark = SparkSession.builder.appName(f"valuekit-{a.job}").getOrCreate()
    if not a.no_sizing and not a.local:
        from valuekit.plans.tuning import size_shuffles
        size_shuffles(spark, [a.input])
    if a.job == "all":
        for k, v in analysis.run_all(spark, a.input, a.output, salt_buckets=a.salt_buckets).items():
            print(f"{k}: {v}")
    elif a.job == "foundation":
        foundation.run_foundation(spark, a.input, a.output, salt_buckets=a.salt_buckets).show(truncate=False)
    elif a.job == "unify":
        print(f"rows written: {analysis.run_unify(spark, a.input, a.output, a.on_duplicate, a.table_prefix)}")
    elif a.job == "composite":
        print(f"rows written: {analysis.run_composite(spark, a.input, a.output, n_files=a.files)}")
    elif a.job == "archetypes":
        reports = analysis.run_archetypes(spark, a.input, a.output)
        print(f"qualified player-seasons: {reports.pop('qualified_rows')}")
        for r in reports.values():
            r.show(truncate=False)
    else:
        print(f"rows written: {analysis.run_tiers(spark, a.input, a.output, n_files=a.files)}")


if __name__ == "__main__":
    main()

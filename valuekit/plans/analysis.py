"""The unified table and the three analysis jobs.

Every job reads Parquet, applies operators and writes Parquet. Where one
labelled table feeds several outputs (archetypes), it is written once as its
own result table and read back, instead of being recomputed per output or
cached on executors that may be lost.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit import schemas as K
from valuekit.operators import lookup as L
from valuekit.operators import metrics as M
from valuekit.operators import quality as Q
from valuekit.operators import rank as R
from valuekit.operators.join import unify
from valuekit.operators.rules import archetype_rules
from valuekit.operators.tiers import tier_value_score
from valuekit.sources import files, layout

CLEANED = ("player_profiles", "nba_stats", "nba_advanced_player_stats", "nba_expanded_standings_2000_2026",
           "nba_salaries", "nba_salary_cap")


def unify_cleaned(tables: dict, **how) -> DataFrame:
    """D18 over the cleaned tables (after the two renames of the loader)."""
    sal = tables["nba_salaries"].withColumnRenamed("salary", "player_salary")
    cap = tables["nba_salary_cap"].withColumnRenamed("salary_cap", "league_salary_cap")
    return unify(tables["nba_stats"], tables["nba_advanced_player_stats"], tables["player_profiles"],
                 sal, cap, tables["nba_expanded_standings_2000_2026"], **how)


def write_counted(df: DataFrame, path: str, **kw) -> int:
    """Write and return the row count, observed on the write itself
    (no second job recomputing the output). The observation is named after
    the output path, so jobs running side by side never share a name."""
    return files.write_parquet_counted(df, path, name="rows_" + path.rstrip("/").rsplit("/", 1)[-1], **kw)


#: Right sides of the unified table and the keys they are joined by.
RIGHT_KEYS = {"nba_advanced_player_stats": ("player_id", "season"), "nba_salaries": ("player_id", "season"), "player_profiles": ("player_id",),
              "nba_salary_cap": ("season",), "nba_expanded_standings_2000_2026": ("season_start_year", "team_name_abbr")}
FACTS = ("nba_stats", "nba_advanced_player_stats", "nba_salaries")


class DuplicateKeys(ValueError):
    """A right side of the unified table repeats a key."""


def bucket_facts(spark: SparkSession, tables: dict, prefix: str, path: str, buckets: int) -> dict:
    """The cleaned tables with the three that are keyed by player and season
    bucketed on that key, as catalog tables ``<prefix>_<name>``."""
    return {name: layout.write_bucketed(df, f"{prefix}_{name}", f"{path.rstrip('/')}/{name}", ("player_id", "season"), buckets)
            if name in FACTS else df for name, df in tables.items()}


def right_key_report(tables: dict) -> DataFrame:
    """D15, D16 of every right side by the key it is joined by."""
    parts = [Q.key_profile(tables[name].dropna(subset=list(keys)), keys, name) for name, keys in RIGHT_KEYS.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_unify(spark: SparkSession, input_dir: str, output_path: str, on_duplicate: str = "warn", table_prefix: str | None = None) -> int:
    """D18. The right sides' keys are checked first (Q15); the report is written
    to ``<output>_reports/right_keys``. ``on_duplicate``: warn (join as they are),
    refuse (stop with DuplicateKeys) or first (one row a key). With
    ``table_prefix`` the facts come from bucketed tables of that prefix, where all
    three are there with the same buckets, else from the files."""
    if on_duplicate not in ("warn", "refuse", "first"):
        raise ValueError(f"on_duplicate is warn, refuse or first, not {on_duplicate!r}")
    tables = files.read_parquet_tables(spark, input_dir, CLEANED)
    names = [f"{table_prefix}_{name}" for name in FACTS]
    together = table_prefix is not None and layout.colocated(spark, names, ("player_id", "season"))
    if together:
        tables.update({name: spark.table(f"{table_prefix}_{name}") for name in FACTS})
    reports = f"{output_path.rstrip('/')}_reports/right_keys"
    files.write_parquet(right_key_report(tables), reports, n_files=1)
    repeated = spark.read.parquet(reports).filter("item = 'keys_with_duplicates' AND value > 0").collect()  # one row a table at most
    if repeated and on_duplicate == "refuse":
        raise DuplicateKeys("; ".join(f"{r.table_name}: {r.value} keys occur more than once" for r in repeated))
    how = {"on_duplicate": "first"} if on_duplicate == "first" else {}
    return write_counted(unify_cleaned(tables, colocated=together, **how), output_path)


def composite_value_rows(unified: DataFrame, min_games: int = 20, min_minutes: int = 200,
                         short_seasons=K.SHORT_SEASONS) -> DataFrame:
    """D25 up to the projection: qualify, CVS, availability."""
    df = M.qualify_for_scoring(unified, min_games=min_games, min_minutes=min_minutes)
    df = df.withColumns({"player_salary": F.col("player_salary").cast("double"),
                         "salary_pct_of_cap": F.col("salary_pct_of_cap").cast("double")})
    df = M.composite_value(df)
    return M.availability(df, short_seasons=short_seasons)


def composite_value_table(unified: DataFrame, **kw) -> DataFrame:
    """D25 without the I/O; a missing output column is an error that names it."""
    return composite_value_rows(unified, **kw).select(*K.CVS_COLUMNS)


def player_metrics(unified: DataFrame, min_games: int = 20) -> DataFrame:
    """D37 up to the labelled, scored rows (all intermediate columns kept). The
    rows are observed before and after the rules: that keeps the joins, the rules
    and the metrics apart, whose generated code in one method would be too long
    for the JIT."""
    seen = lambda x, name: x.observe(f"{name}_{uuid.uuid4().hex[:12]}", F.count(F.lit(1)).alias("rows"))
    df = seen(M.per36_rates(M.qualify_for_archetypes(unified, min_games=min_games)), "qualified")
    df = seen(archetype_rules().apply(df, "archetype"), "labelled")
    return M.value_metrics(df)


def player_archetype_table(unified: DataFrame, min_games: int = 20) -> DataFrame:
    return player_metrics(unified, min_games).select(*K.PLAYER_ARCHETYPE_COLUMNS)


def run_composite(spark: SparkSession, input_path: str, output_path: str, n_files: int | None = None) -> int:
    return write_counted(composite_value_table(spark.read.parquet(input_path)), output_path, n_files=n_files)


def run_archetypes(spark: SparkSession, input_path: str, output_path: str, report_season: str = "2023-24",
                   top_k: int = K.TOP_K) -> dict:
    """Write the labelled player table (partitioned by season start
    year), read it back once, then the rollup and top-k tables."""
    out = output_path.rstrip("/")
    n_players = write_counted(player_archetype_table(spark.read.parquet(input_path)),
                              f"{out}/player_archetype_metrics", partition_by=["season_start_year"])
    # a partition column comes back last: restore the table's own order
    players = spark.read.parquet(f"{out}/player_archetype_metrics").select(*K.PLAYER_ARCHETYPE_COLUMNS)
    # The rollup needs ``salary_millions`` and the averaged inputs: all are in the written table.
    rollup = R.archetype_season_rollup(players)
    files.write_parquet(rollup, f"{out}/archetype_season_summary")
    top = R.top_k_per_group(players, ["season", "archetype"], "value_score", k=top_k, rank_col="archetype_rank")
    files.write_parquet(top, f"{out}/archetype_top_players")
    summary = spark.read.parquet(f"{out}/archetype_season_summary")
    reports = {"distribution": R.label_distribution(players), "season_report": R.season_report(summary, report_season)}
    for name, df in reports.items():  # a few rows each
        files.write_parquet(df, f"{out}/_reports/{name}", n_files=1)
    return {"qualified_rows": n_players, **reports}


def tier_value_table(unified: DataFrame, min_games: int = 20, min_minutes: int = 200) -> DataFrame:
    """D44 without the I/O."""
    df = M.qualify_for_scoring(unified, min_games=min_games, min_minutes=min_minutes)
    df = df.withColumns({"player_salary": F.col("player_salary").cast("double"),
                         "salary_pct_of_cap": F.col("salary_pct_of_cap").cast("double")})
    return L.select_present(tier_value_score(df), K.TIER_COLUMNS)


def run_tiers(spark: SparkSession, input_path: str, output_path: str, n_files: int | None = None) -> int:
    return write_counted(tier_value_table(spark.read.parquet(input_path)), output_path, n_files=n_files)


def run_all(spark: SparkSession, raw_dir: str, output_dir: str, salt_buckets: int = 1) -> dict:
    """The whole chain: foundation -> unify -> composite, archetypes, tiers,
    each reading the previous job's written tables. Returns row counts."""
    from valuekit.plans import foundation
    out = output_dir.rstrip("/")
    report = foundation.run_foundation(spark, raw_dir, f"{out}/clean", salt_buckets=salt_buckets)
    counts = {f"clean_{r.table_name}": r.clean_rows for r in report.collect()}
    counts["unified"] = run_unify(spark, f"{out}/clean", f"{out}/unified")
    # the three analyses only read the unified table: run them side by side
    counts.update(foundation.run_concurrently({
        "composite": lambda: run_composite(spark, f"{out}/unified", f"{out}/composite_value_score"),
        "archetypes": lambda: run_archetypes(spark, f"{out}/unified", f"{out}/archetypes")["qualified_rows"],
        "tiers": lambda: run_tiers(spark, f"{out}/unified", f"{out}/salary_tier_value_score"),
    }))
    return counts

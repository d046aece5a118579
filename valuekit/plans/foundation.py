"""Six raw CSV tables -> six cleaned Parquet tables.

Each cleaner is a configuration of generic operators. Plan of the job:

* tables that a cleaner reads more than once (both stats tables, the caps) are
  parsed once into Parquet in the shared checkpoint folder, which is deleted
  when the job ends, also on failure; the others are read straight from CSV.
  Raw rows are counted by an ``Observation`` on the way;
* each cleaned table is written once, its row count observed on that write
  (no cache, no recount), as is the number of salary rows without an amount;
* the key checks (NULL and duplicate keys, one aggregation per table) read
  back only the key columns of the written Parquet, before anything joins them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from valuekit import schemas as K
from valuekit.operators import clean as CL
from valuekit.operators import quality as Q
from valuekit.operators.dedupe import consolidate, prefer_tagged_rows
from valuekit.operators.join import normalize_to_cap
from valuekit.operators.metrics import per_game_rates, per_minute_rates
from valuekit.session import scratch_path
from valuekit.sources import files

PLAYER_SEASON = ("player_id", "season")


def clean_player_profiles(df: DataFrame) -> DataFrame:
    """D3."""
    df = CL.strip_carriage_returns(df)
    df = CL.drop_blank_keys(df, ["player_id"])
    df = CL.fill_defaults(df, K.PROFILE_DEFAULTS)
    df = CL.cast_columns(df, {c: "int" for c in ("draft_year", "draft_round", "draft_pick", "nba_debut_year")})
    return CL.flag_not_sentinel(df, "draft_year", -1, "is_drafted")


def clean_nba_stats(df: DataFrame, aggregate_tags=K.AGGREGATE_TEAM_TAGS, salt_buckets: int = 1, free_words: int = 0) -> DataFrame:
    """Sentinel seasons out, aggregate rows preferred, shooting ranges
    checked, per-game and per-minute rates, season start year."""
    df = CL.strip_carriage_returns(df)
    df = CL.drop_sentinels(df, "season", K.SEASON_SENTINELS)
    df = prefer_tagged_rows(df, PLAYER_SEASON, "team_name_abbr", aggregate_tags, salt_buckets=salt_buckets, free_words=free_words)
    df = CL.null_outside(df, K.SHOOTING_BOUNDS)
    df = per_game_rates(df)
    df = per_minute_rates(df)
    return CL.add_season_start_year(df)


def clean_nba_salaries(df: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Parse salary text, drop rows without an amount, fold traded
    players' rows into one per player-season."""
    df = CL.strip_carriage_returns(df)
    df = CL.drop_blank_keys(df, ["season"])
    df = CL.parse_money_text(df, "salary", "salary",
                             {"is_two_way": K.TWO_WAY_MARK, "is_sub_minimum": K.SUB_MINIMUM_MARK},
                             observation=observation)
    df = consolidate(df, PLAYER_SEASON, "salary", "team", flags=("is_two_way", "is_sub_minimum"),
                     labels_out="teams", sep=K.TEAMS_SEPARATOR)
    return CL.add_season_start_year(df)


def clean_salary_cap(df: DataFrame) -> DataFrame:
    """D10."""
    return CL.add_season_start_year(CL.strip_carriage_returns(df))


def clean_advanced_stats(df: DataFrame, aggregate_tags=K.AGGREGATE_TEAM_TAGS, salt_buckets: int = 1, free_words: int = 0) -> DataFrame:
    """D11."""
    df = CL.strip_carriage_returns(df)
    df = CL.drop_sentinels(df, "season", K.SEASON_SENTINELS)
    df = prefer_tagged_rows(df, PLAYER_SEASON, "team_name_abbr", aggregate_tags, salt_buckets=salt_buckets, free_words=free_words)
    df = CL.null_outside(df, K.ADVANCED_BOUNDS)
    return CL.add_season_start_year(df)


def clean_expanded_standings(df: DataFrame, team_codes=K.TEAM_CODES) -> DataFrame:
    """D12: 'W-L' record split, win share, team code, season start year."""
    df = CL.strip_carriage_returns(df)
    df = CL.drop_blank_keys(df, ["season", "team"])
    df = CL.split_record(df, "overall", "-", ["wins", "losses"])
    df = CL.win_share(df, "wins", "losses", "win_pct")
    df = CL.map_codes(df, "team", team_codes, "team_name_abbr")
    return CL.add_season_start_year(df)


def normalize_salary_to_cap(salaries: DataFrame, caps: DataFrame) -> DataFrame:
    """D13."""
    return normalize_to_cap(salaries, caps, on="season", value_col="salary", cap_col="salary_cap",
                            out="salary_pct_of_cap", digits=6)


def clean_table(name: str, raw: dict, salt_buckets: int = 1, salary_observation: Observation | None = None, free_words: int = 0) -> DataFrame:
    """The cleaned table of that name (lazy); of ``raw`` it reads the table itself,
    and for the salaries the caps. ``salt_buckets`` spreads hot (player, season)
    keys of the prefer-aggregate step, ``free_words`` is the size of its filter of
    keys without an aggregate row, and ``salary_observation`` counts the salary
    rows dropped for want of an amount."""
    df, stats = raw[name], {"salt_buckets": salt_buckets, "free_words": free_words}
    return {
        "player_profiles": lambda: clean_player_profiles(df),
        "nba_stats": lambda: clean_nba_stats(df, **stats),
        "nba_salaries": lambda: normalize_salary_to_cap(clean_nba_salaries(df, salary_observation), clean_salary_cap(raw["nba_salary_cap"])),
        "nba_salary_cap": lambda: clean_salary_cap(df),
        "nba_advanced_player_stats": lambda: clean_advanced_stats(df, **stats),
        "nba_expanded_standings_2000_2026": lambda: clean_expanded_standings(df),
    }[name]()


def clean_all(raw: dict, **how) -> dict:
    """The six cleaned tables from the six raw ones (lazy)."""
    return {name: clean_table(name, raw, **how) for name in KEY_COLUMNS}


KEY_COLUMNS = {
    "player_profiles": ["player_id"],
    "nba_stats": ["player_id", "season"],
    "nba_salaries": ["player_id", "season"],
    "nba_salary_cap": ["season"],
    "nba_advanced_player_stats": ["player_id", "season"],
    "nba_expanded_standings_2000_2026": ["season_start_year", "team_name_abbr"],  # the key unify joins on
}

#: Read more than once by the cleaners.
STAGED = ("nba_stats", "nba_advanced_player_stats", "nba_salary_cap")


def run_concurrently(tasks: dict, max_workers: int = 6) -> dict:
    """Run independent Spark jobs from driver threads: the scheduler fills
    idle task slots of one table's job with another's tasks instead of
    waiting for each job's tail. Results keep the input order."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max(1, min(max_workers, len(tasks)))) as pool:
        futures = {k: pool.submit(fn) for k, fn in tasks.items()}
        return {k: f.result() for k, f in futures.items()}


def stage_raw(spark: SparkSession, raw: dict, names=STAGED) -> tuple[dict, dict, list[str]]:
    """Parse the named raw tables once into Parquet under the shared checkpoint
    folder, concurrently; returns the tables, their row counts and the paths,
    which the caller deletes. What the writes shuffled goes with them."""
    paths = {name: scratch_path(spark, f"staged_{name}") for name in names}
    with files.shuffles_dropped(spark):
        counts = run_concurrently({
            name: (lambda n=name: files.write_parquet_counted(raw[n], paths[n], name=f"raw_{n}", compression="zstd")) for name in names})
    return {name: spark.read.schema(raw[name].schema).parquet(paths[name]) for name in names}, counts, list(paths.values())


def run_foundation(spark: SparkSession, input_dir: str, output_dir: str, salt_buckets: int = 1) -> DataFrame:
    """Clean and write; returns the cleaning report. ``unparsed_rows`` are
    the rows dropped because their salary text holds no amount. The key checks
    are written next to it, each with OK or WARN."""
    raw = files.load_csv_tables(spark, input_dir, K.RAW_TABLES)
    out = output_dir.rstrip("/")
    seen = {name: Observation(f"raw_{name}") for name in raw if name not in STAGED}
    unparsed = Observation("unparsed_salaries")
    staged, raw_counts, scratch = stage_raw(spark, raw)
    try:
        inputs = {name: staged.get(name) if name in staged else df.observe(seen[name], F.count(F.lit(1)).alias("rows"))
                  for name, df in raw.items()}
        cleaned = clean_all(inputs, salt_buckets=salt_buckets, salary_observation=unparsed)
        clean_counts = run_concurrently({
            name: (lambda n=name, df=df: files.write_parquet_counted(df, f"{out}/{n}", name=f"clean_{n}"))
            for name, df in cleaned.items()})
        for name, observation in seen.items():
            raw_counts[name] = files.observed(observation, "rows", raw[name].count)
        dropped = files.observed(unparsed, "dropped_salary", lambda: 0)
    finally:
        files.delete(spark, scratch)
    report = spark.createDataFrame(
        [(n, raw_counts[n], clean_counts[n], raw_counts[n] - clean_counts[n], dropped if n == "nba_salaries" else None)
         for n in cleaned],
        "table_name string, raw_rows bigint, clean_rows bigint, dropped_rows bigint, unparsed_rows bigint")
    checks = None
    for name, keys in KEY_COLUMNS.items():
        r = Q.key_profile(spark.read.parquet(f"{out}/{name}").select(*keys), keys, name)
        checks = r if checks is None else checks.unionByName(r)
    files.write_parquet(report, f"{out}/_reports/cleaning_summary", n_files=1)
    files.write_parquet(checks, f"{out}/_reports/key_checks", n_files=1)
    return report

"""The six raw tables of the domain, derived from the driver's tables with the
faults the cleaners are for, and the composite queries over them.

A part is a player, a ship year a season, a supplier (mod 30) a team. The
statements of :mod:`valuekit.catalog.domain_oracle` derive the same tables on
their own in SQL. Faults: carriage returns, NULL, blank and sentinel keys, NULL
team tags, aggregate rows of up to five teams, measures out of range, repeated
and missing rows on every right side of a join, salary text with marks, control
characters or no number, zero and missing caps, unknown teams, NULL features.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit import schemas as K
from valuekit.catalog.shapes import table
from valuekit.operators import lookup as L
from valuekit.operators import metrics as M
from valuekit.operators import quality as Q
from valuekit.operators import rank as R
from valuekit.operators.dedupe import FILTER_WORDS
from valuekit.plans import analysis, foundation
from valuekit.session import scratch_path
from valuekit.sources import files
from valuekit.sources.clustered import write_clustered
from valuekit.sources.publish import publish, read_published

TEAMS = sorted(set(K.TEAM_CODES.values()))[:30]
NAMES = {v: k for k, v in K.TEAM_CODES.items()}
POSITIONS = ("PG", "SG", "SF", "PF", "C", "G", "F", "SF-PF")
c = F.col


def _pick(values, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def _label(y: Column) -> Column:
    return F.concat(y.cast("string"), F.lit("-"), F.lpad(((y + 1) % 100).cast("string"), 2, "0"))


def _season(pk: Column, y: Column) -> Column:
    """Most rows have a season; four of 37 parts-years are not one."""
    k = (pk + y) % 37
    return (F.when(k == 0, F.lit(None)).when(k == 1, F.lit("")).when(k == 2, F.lit("N/A")).when(k == 3, F.lit("0"))
            .when(pk % 10 == 0, F.concat(_label(y), F.lit("\r"))).otherwise(_label(y)))


def _player(pk: Column, missing: Column | None = None) -> Column:
    """Where ``missing``, an id that no stats row has: a gap in the table."""
    letter = F.lit("p") if missing is None else F.when(missing, F.lit("q")).otherwise(F.lit("p"))
    return F.when(pk % 41 == 0, F.lit(None)).otherwise(F.concat(letter, pk.cast("string")))


def _share(x: Column, mod: int, by: float) -> Column:
    return ((x % mod) / by).cast("float")


def _per_team(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.groupBy(c("l_partkey").alias("pk"), F.year("l_shipdate").alias("y"), (c("l_suppkey") % 30).alias("t")).agg(
        (F.count("*") * 25).cast("int").alias("games"), (F.sum(c("l_quantity").cast("int")) * 20).cast("int").alias("mp"),
        F.sum(F.floor(c("l_extendedprice") / 1000)).cast("int").alias("pts"), F.sum("l_linenumber").cast("int").alias("trb"),
        F.count_if(c("l_returnflag") == "A").cast("int").alias("ast"), F.count_if(c("l_returnflag") == "R").cast("int").alias("stl"),
        F.count_if(c("l_returnflag") == "N").cast("int").alias("blk"), F.count_if(c("l_linestatus") == "F").cast("int").alias("tov"))


COUNTS = ("games", "mp", "pts", "trb", "ast", "stl", "blk", "tov")


def _rows(spark: SparkSession, d: str, base: dict | None = None) -> DataFrame:
    """One row per player, season and team, and one for all teams of a player
    with several."""
    if not base:
        base = {"per_team": (per_team := _per_team(spark, d)), "several": _several(per_team)}
    single = base["per_team"].withColumn("team_name_abbr", F.when(c("pk") % 29 == 0, F.lit(None)).otherwise(_pick(TEAMS, c("t")))).drop("t")
    return single.unionByName(base["several"])


def _several(per_team: DataFrame) -> DataFrame:
    return (per_team.groupBy("pk", "y").agg(F.count("*").alias("n"), *[F.sum(s).cast("int").alias(s) for s in COUNTS])
            .filter("n > 1").withColumn("team_name_abbr", F.concat(F.when(c("pk") % 7 == 0, F.least("n", F.lit(5)))
                                                                   .otherwise(F.least("n", F.lit(4))).cast("string"), F.lit("TM"))).drop("n"))


def raw_stats(spark: SparkSession, d: str, base: dict | None = None) -> DataFrame:
    half = lambda x, n: F.floor(c(x) / n).cast("int")
    return _rows(spark, d, base).select(
        _player(c("pk")).alias("player_id"), _season(c("pk"), c("y")).alias("season"), (20 + c("pk") % 15).cast("int").alias("age"),
        "team_name_abbr", F.lit("NBA").alias("comp_name_abbr"), _pick(POSITIONS, c("pk")).alias("pos"), "games",
        half("games", 2).alias("games_started"), "mp", half("pts", 2).alias("fg"), c("pts").alias("fga"),
        _share(c("pts"), 130, 100.0).alias("fg_pct"), half("ast", 3).alias("fg3"), c("ast").alias("fg3a"),
        _share(c("ast"), 7, 5.0).alias("fg3_pct"), half("pts", 3).alias("fg2"), half("pts", 2).alias("fg2a"),
        _share(c("trb"), 25, 20.0).alias("fg2_pct"), _share(c("trb"), 40, 25.0).alias("efg_pct"), c("tov").alias("ft"),
        (c("tov") + 2).alias("fta"), _share(c("tov"), 5, 4.0).alias("ft_pct"), half("trb", 4).alias("orb"), half("trb", 2).alias("drb"),
        "trb", "ast", "stl", "blk", "tov", half("games", 3).alias("pf"), "pts")


def raw_advanced(spark: SparkSession, d: str, base: dict | None = None) -> DataFrame:
    """Without every fifth player-season (their ids are others); some rows twice, the second time with
    another rating; some ratings NULL, NaN or out of range."""
    pk, y = c("pk"), c("y")
    rows = _rows(spark, d, base).withColumn("copy", F.explode(F.when((pk + y) % 17 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    bpm = (F.when(pk % 23 == 0, F.lit(None)).when(pk % 31 == 0, F.lit(float("nan")))
           .otherwise((c("pts") % 1200 - 600) / 10.0).cast("float"))
    return rows.select(
        _player(pk, (pk + y) % 5 == 0).alias("player_id"), _season(pk, y).alias("season"), (20 + pk % 15).cast("int").alias("age"), "team_name_abbr",
        _pick(POSITIONS, pk).alias("pos"), c("games").alias("g"), "mp", _share(c("mp") + c("copy"), 300, 10.0).alias("per"),
        ((50 + c("games") % 60) / 100.0).cast("float").alias("ts_pct"), _share(c("ast"), 60, 50.0).alias("fg3a_per_fga_pct"),
        F.lit(0.25).cast("float").alias("fta_per_fga_pct"), _share(c("trb"), 12, 1.0).alias("orb_pct"), F.lit(15.0).cast("float").alias("drb_pct"),
        F.lit(10.0).cast("float").alias("trb_pct"), _share(c("pts"), 120, 1.0).alias("ast_pct"), F.lit(1.5).cast("float").alias("stl_pct"),
        _share(c("mp"), 60, 10.0).alias("blk_pct"), F.lit(12.0).cast("float").alias("tov_pct"), _share(c("trb") + 15, 31, 1.0).alias("usg_pct"),
        F.lit(1.0).cast("float").alias("ows"), F.lit(1.0).cast("float").alias("dws"),
        F.when(pk % 19 == 0, F.lit(None)).otherwise((c("trb") % 120 - 10) / 10.0).cast("float").alias("ws"),
        _share(c("ast"), 25, 100.0).alias("ws_per_48"), F.lit(0.5).cast("float").alias("obpm"), F.lit(0.5).cast("float").alias("dbpm"),
        bpm.alias("bpm"), ((c("ast") % 70 - 10) / 10.0).cast("float").alias("vorp"))


def raw_salaries(spark: SparkSession, d: str, base: dict | None = None) -> DataFrame:
    pk, y = c("pk"), c("y")
    amount = (1_000_000 + (c("pts") * 7919) % 40_000_000).cast("string")
    text = (F.when(pk % 7 == 0, F.concat(amount, F.lit(" (TW)"))).when(pk % 11 == 0, F.lit("< Minimum"))
            .when(pk % 13 == 0, F.concat(F.lit(" "), amount, F.lit(" < Minimum"))).when(pk % 17 == 0, F.concat(F.lit("$"), amount))
            .when(pk % 19 == 0, F.concat(amount, F.lit("\x7f"))).when(pk % 23 == 0, F.concat(amount, F.lit(".0\r")))
            .when(pk % 25 == 0, F.concat(amount, F.lit("\x85"))).when(pk % 27 == 0, F.lit("0")).when(pk % 29 == 0, F.lit(None)).otherwise(amount))
    return (base["per_team"] if base else _per_team(spark, d)).select(
        _player(pk, (pk + 2 * y) % 6 == 0).alias("player_id"), _season(pk, y).alias("season"),
        F.when(pk % 33 == 0, F.lit(None)).otherwise(_pick(TEAMS, c("t"))).alias("team"), text.alias("salary"))


def raw_caps(spark: SparkSession, d: str, base: dict | None = None) -> DataFrame:
    """One year without a cap, one with a cap of 0, one twice."""
    y = c("y")
    years = (base["per_team"].select("y") if base else table(spark, d, "lineitem").select(F.year("l_shipdate").alias("y"))).distinct()
    years = years.withColumn("y", F.when(y == 1996, F.lit(2096)).otherwise(y))
    years = years.withColumn("copy", F.explode(F.when(y == 1997, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return years.select(F.when(y % 2 == 0, F.concat(_label(y), F.lit("\r"))).otherwise(_label(y)).alias("season"),
                        F.when(y == 1995, F.lit(0)).otherwise(90_000_000 + 3_000_000 * (y - 1990) + c("copy")).cast("int").alias("salary_cap"))


def raw_standings(spark: SparkSession, d: str, base: dict | None = None) -> DataFrame:
    team = _pick([NAMES[code] for code in TEAMS], c("t"))
    return ((base["per_team"] if base else _per_team(spark, d)).groupBy("y", "t").agg(F.sum("stl").alias("w"), F.sum("blk").alias("l"))
            .select(F.when(c("t") == 3, F.lit("")).otherwise(_label(c("y"))).alias("season"),
                    F.when(c("t").isin(5, 7), F.lit("Unknown Team")).when(c("t") == 6, F.lit(None)).otherwise(team).alias("team"),
                    F.when(c("t") == 8, F.lit("0-0")).when(c("t") == 9, F.lit("none"))
                    .otherwise(F.concat(c("w").cast("string"), F.lit("-"), c("l").cast("string"), F.lit("\r"))).alias("overall")))


def raw_profiles(spark: SparkSession, d: str) -> DataFrame:
    pk = c("p_partkey")
    gap = lambda n, x: F.when(pk % n == 0, F.lit(None)).otherwise(x)
    return table(spark, d, "part").select(
        F.when(pk % 47 == 0, F.lit("")).otherwise(_player(pk, pk % 9 == 0)).alias("player_id"), c("p_name").alias("name"),
        gap(5, c("p_brand")).alias("college"), gap(4, (1980 + pk % 40).cast("float")).alias("draft_year"),
        gap(6, (1 + pk % 2).cast("float")).alias("draft_round"), (1 + pk % 60).cast("float").alias("draft_pick"),
        (70 + c("p_size") % 20).cast("int").alias("height"), (180 + c("p_size")).cast("int").alias("weight"),
        F.when(pk % 10 == 0, F.lit("USA\r")).otherwise(F.lit("USA")).alias("country"), gap(8, (1981 + pk % 40).cast("float")).alias("nba_debut_year"),
        (pk % 3).cast("int").alias("all_nba_appearances"))


def _staged(spark: SparkSession, name: str, df: DataFrame, paths: list | None = None) -> DataFrame:
    """``df`` as files in the shared scratch folder, read back; their path is added to ``paths``."""
    tables, _, at = foundation.stage_raw(spark, {name: df}, (name,))
    if paths is not None:
        paths += at
    return tables[name]


#: The raw tables that need the rows of all teams too; the others need ``per_team`` or the parts alone.
OF_ROWS = ("nba_stats", "nba_advanced_player_stats")


@contextmanager
def _sources(spark: SparkSession, d: str, names) -> Iterator[dict]:
    """The named raw tables, not yet staged. What they have in common is derived
    once, into the shared scratch folder, and deleted at the end: by then they
    are to be staged themselves."""
    paths = []
    try:
        base = {"per_team": _staged(spark, "per_team", _per_team(spark, d), paths)}
        if any(name in OF_ROWS for name in names):
            base["several"] = _staged(spark, "several", _several(base["per_team"]), paths)
        made = {"player_profiles": lambda: raw_profiles(spark, d), "nba_stats": lambda: raw_stats(spark, d, base),
                "nba_salaries": lambda: raw_salaries(spark, d, base), "nba_salary_cap": lambda: raw_caps(spark, d, base),
                "nba_advanced_player_stats": lambda: raw_advanced(spark, d, base),
                "nba_expanded_standings_2000_2026": lambda: raw_standings(spark, d, base)}
        yield {name: made[name]() for name in names}
    finally:
        files.delete(spark, paths)


def raw_tables(spark: SparkSession, d: str, names=K.RAW_TABLES) -> dict:
    """The named ones, as the files the source reads: a cleaner's conditions then
    read columns, where Catalyst would put the whole derivation of a column into
    each of them, below joins and aggregates too, and such methods are too long
    to be compiled."""
    with _sources(spark, d, names) as sources:
        return foundation.stage_raw(spark, sources, list(names))[0]


def cleaned(spark: SparkSession, d: str) -> dict:
    return foundation.clean_all(raw_tables(spark, d))


def cleaned_in_turn(spark: SparkSession, d: str) -> dict:
    """The cleaned tables, those with a row a player and season as files: one
    after another is staged raw, cleaned and written. Its raw rows and what was
    shuffled for them go before the next, so the folder never holds all raw and
    all cleaned rows, nor the shuffles of more than one table."""
    out = {}
    with _sources(spark, d, K.RAW_TABLES) as sources:
        raw = foundation.stage_raw(spark, sources, [name for name in sources if name not in analysis.FACTS])[0]
        for name in analysis.FACTS:
            staged, _, paths = foundation.stage_raw(spark, sources, (name,))
            try:
                out[name] = _staged(spark, f"clean_{name}", foundation.clean_table(name, {**raw, **staged}, free_words=FILTER_WORDS))
            finally:
                files.delete(spark, paths)
    return {name: out[name] if name in out else foundation.clean_table(name, raw) for name in K.RAW_TABLES}


def q29_clean_profiles(spark: SparkSession, d: str) -> DataFrame:
    """D3."""
    return foundation.clean_player_profiles(raw_profiles(spark, d))


def q30_clean_stats(spark: SparkSession, d: str) -> DataFrame:
    """D5 (D4, D6, D7, P7, P16, P17)."""
    return foundation.clean_nba_stats(raw_stats(spark, d))


def q31_clean_salaries(spark: SparkSession, d: str) -> DataFrame:
    """Parsed, folded per player-season, share of the cap."""
    raw = raw_tables(spark, d, ("nba_salaries", "nba_salary_cap"))
    return foundation.normalize_salary_to_cap(foundation.clean_nba_salaries(raw["nba_salaries"]), foundation.clean_salary_cap(raw["nba_salary_cap"]))


def q32_clean_advanced(spark: SparkSession, d: str) -> DataFrame:
    """D11."""
    return foundation.clean_advanced_stats(raw_advanced(spark, d))


def q33_clean_standings(spark: SparkSession, d: str) -> DataFrame:
    """D12."""
    return foundation.clean_expanded_standings(raw_standings(spark, d))


def q34_clean_caps(spark: SparkSession, d: str) -> DataFrame:
    """D10."""
    return foundation.clean_salary_cap(raw_caps(spark, d))


def q35_foundation_report(spark: SparkSession, d: str) -> DataFrame:
    """Raw, clean and dropped rows of each table."""
    raw = raw_tables(spark, d)
    return Q.cleaning_summary({n: (raw[n], df) for n, df in foundation.clean_all(raw).items()})


def unified(spark: SparkSession, d: str) -> DataFrame:
    return analysis.unify_cleaned(cleaned(spark, d))


def q12_unify(spark: SparkSession, d: str) -> DataFrame:
    """D18 (J4-J8) of the six cleaned tables: five left joins whose right sides
    are derived each on its own, with repeated, missing and NULL keys."""
    return analysis.unify_cleaned(cleaned_in_turn(spark, d))


def _round(df: DataFrame, digits: dict) -> DataFrame:
    return df.withColumns({k: F.round(k, n) for k, n in digits.items()})


def q36_composite_table(spark: SparkSession, d: str) -> DataFrame:
    """All 50 columns."""
    return analysis.composite_value_table(unified(spark, d))


def q37_archetype_players(spark: SparkSession, d: str) -> DataFrame:
    """D37, first table: labelled, scored player-seasons."""
    return analysis.player_archetype_table(unified(spark, d))


ROLLUP_DIGITS = {"avg_cost_per_ws": 2, "avg_value_score": 6, "avg_composite_index": 6, "avg_win_shares": 6, "avg_vorp": 6,
                 "avg_per": 6, "avg_salary_millions": 6, "avg_availability": 6, "avg_ts_pct": 6, "avg_bpm": 6,
                 "avg_ws_per_48": 6, "cost_per_ws_millions": 6, "total_archetype_salary_millions": 6}


def q38_archetype_rollup(spark: SparkSession, d: str) -> DataFrame:
    """D37, second table, without the approximate median (its groups are large
    here; q19 checks it where it is exact)."""
    return _round(R.archetype_season_rollup(q37_archetype_players(spark, d)).drop("median_cost_per_ws"), ROLLUP_DIGITS)


def q39_archetype_top(spark: SparkSession, d: str) -> DataFrame:
    """D37, third table: the five best of each season and archetype."""
    return R.top_k_per_group(q37_archetype_players(spark, d), ["season", "archetype"], "value_score", k=K.TOP_K, rank_col="archetype_rank")


TIER_DIGITS = {"avg_bpm": 6, "avg_ws_per_48": 6, "avg_ts_pct": 6, "avg_usg_pct": 6, "bpm_diff": 6, "ws_per_48_diff": 6,
               "ts_pct_diff": 6, "usg_pct_diff": 6, "value_score": 6}


def q40_tier_table(spark: SparkSession, d: str) -> DataFrame:
    """D44 (P12, M1-M4): rows with NULL or NaN features drop out."""
    return _round(analysis.tier_value_table(unified(spark, d)), TIER_DIGITS)


def q41_player_history(spark: SparkSession, d: str) -> DataFrame:
    """The seasons of one player, in order."""
    return L.player_history(q36_composite_table(spark, d), HISTORY_PLAYER).select("player_id", "season", "composite_value_score")


HISTORY_PLAYER = "p14"


def q50_player_history_clustered(spark: SparkSession, d: str) -> DataFrame:
    """D45 on a table clustered by player: few row groups are read."""
    laid = write_clustered(q36_composite_table(spark, d), scratch_path(spark, "clustered"), ["player_id", "season"], lookups=["name"])
    return L.player_history(laid, HISTORY_PLAYER).select("player_id", "season", "composite_value_score")


def q43_unify_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """D18 over bucketed facts: no shuffle for the joins by player and season."""
    path, buckets = scratch_path(spark, "bucketed"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    prefix = "facts_" + path.rsplit("-", 1)[1]
    return analysis.unify_cleaned(analysis.bucket_facts(spark, cleaned(spark, d), prefix, path, buckets), colocated=True)


def q44_unify_first(spark: SparkSession, d: str) -> DataFrame:
    """D18 with D16 obeyed: of each right side one row a key."""
    return analysis.unify_cleaned(cleaned_in_turn(spark, d), on_duplicate="first")


def q45_rollup_states(spark: SparkSession, d: str) -> DataFrame:
    """A4, A5, D33 in two steps: states of each half of the rows are stored, read
    again and merged; the median is held against exact ranks."""
    players = _staged(spark, "players", q37_archetype_players(spark, d))
    half = F.pmod(F.xxhash64("player_id"), F.lit(2)) == 0
    parts = [_staged(spark, f"states{i}", R.rollup_states(players.filter(own))) for i, own in enumerate((half, ~F.coalesce(half, F.lit(False))))]
    rollup = R.rollup_from_states(parts[0].unionByName(parts[1]))
    checked = R.median_rank_check(players, rollup)
    keys = ["season", "season_start_year", "archetype"]
    return _round(rollup.join(checked, keys).drop("median_cost_per_ws"), ROLLUP_DIGITS)


def q46_published_seasons(spark: SparkSession, d: str) -> DataFrame:
    """The cleaned caps and standings of all seasons are published, then
    those of the even years again with their wins doubled."""
    path = scratch_path(spark, "published")
    rows = _staged(spark, "standings", cleaned(spark, d)["nba_expanded_standings_2000_2026"].select("season", "team", "wins", "losses", "season_start_year"))
    publish(rows, path, ["season_start_year"])
    again = rows.withColumn("wins", F.when(c("season_start_year") % 2 == 0, c("wins") * 2))
    publish(again.filter(c("season_start_year") % 2 == 0), path, ["season_start_year"])
    return read_published(spark, path).select(*rows.columns)


QUERIES = {f.__name__: f for f in (
    q43_unify_bucketed, q44_unify_first, q45_rollup_states, q46_published_seasons,
    q12_unify, q29_clean_profiles, q30_clean_stats, q31_clean_salaries, q32_clean_advanced, q33_clean_standings, q34_clean_caps,
    q35_foundation_report, q36_composite_table, q37_archetype_players, q38_archetype_rollup, q39_archetype_top, q40_tier_table,
    q41_player_history, q50_player_history_clustered)}

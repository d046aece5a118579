"""

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the driver's
tables (or shapes Spark derives from them), so its work grows with the data.
The DuckDB statement of the same result is in :mod:`valuekit.catalog.oracle`.
Aggregates of doubles are rounded (per column, to a precision well inside
their magnitude) because two engines sum in different orders; row-level
arithmetic is compared unrounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, IntegerType, StringType, StructField, StructType

from valuekit import schemas as K
from valuekit.catalog.domain import QUERIES as DOMAIN_QUERIES
from valuekit.catalog.shapes import cents, supplier_seasons, supplier_seasons_x, table
from valuekit.functions import columns as C
from valuekit.operators import clean as CL
from valuekit.operators import lookup as L
from valuekit.operators import metrics as M
from valuekit.operators import quality as Q
from valuekit.operators import rank as R
from valuekit.operators.dedupe import FILTER_WORDS, consolidate, prefer_tagged_rows
from valuekit.operators.join import normalize_to_cap
from valuekit.operators.rules import archetype_rules
from valuekit.operators.tiers import assign_tiers, tier_value_score
from valuekit.operators.topk import top_k_by_threshold
from valuekit.operators.uniqueness import sketched_key_profile, suspect_profile
from valuekit.plans.analysis import composite_value_rows
from valuekit.session import scratch_path
from valuekit.sources import files
from valuekit.sources.quarantine import load_csv_quarantined

# Fixed values for the catalogue (test parameters, FIXTURES.md 3).
MIN_GAMES = 80                       # the shapes' games run 53-122, so 20 would filter nothing
SHORT_SEASONS = {"1998-99": 50}
REPORT_SEASON = "1997-98"
REGION_CODES = {"AFRICA": "AFR", "AMERICA": "AME", "ASIA": "ASI", "EUROPE": "EUR"}
MONEY_MARKS = {"is_two_way": K.TWO_WAY_MARK, "is_sub_minimum": K.SUB_MINIMUM_MARK}


def _with_place(df: DataFrame) -> DataFrame:
    """Number the rows of a small sorted report (a few labels) in their order."""
    rows = df.agg(F.collect_list(F.struct(*df.columns)).alias("r"))
    return rows.select(F.posexplode("r").alias("i", "r")).select("r.*", (F.col("i") + 1).alias("place"))


def _season_label(y):
    return F.concat(y.cast("string"), F.lit("-"), F.lpad(((y + 1) % 100).cast("string"), 2, "0"))


def _round_cols(df: DataFrame, digits: dict) -> DataFrame:
    return df.withColumns({c: F.expr(f"round({C.q(c)}, {int(d)})") for c, d in digits.items()})


# ------------------------------------------------------------------ sources

def q01_csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Write customers (some names end in a carriage return) as CSV
    to the shared scratch folder, read back with a fixed schema, strip ``\\r``."""
    cust = table(spark, d, "customer")
    nat = table(spark, d, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    rows = cust.join(nat, cust.c_nationkey == nat.n_nationkey, "left").select(
        "c_custkey",
        F.when(k % 4 == 0, F.concat("c_name", F.lit("\r"))).otherwise(F.col("c_name")).alias("c_name"),
        "c_nationkey",
        F.when(k % 6 == 0, F.concat("n_name", F.lit("\r"))).otherwise(F.col("n_name")).alias("n_name"),
        "c_acctbal", "c_mktsegment",
    )
    path = scratch_path(spark, "q01_csv")
    files.write_csv(rows, path, lineSep="\n", ignoreTrailingWhiteSpace="false", ignoreLeadingWhiteSpace="false")
    schema = StructType([StructField("c_custkey", LongType()), StructField("c_name", StringType()),
                         StructField("c_nationkey", IntegerType()), StructField("n_name", StringType()),
                         StructField("c_acctbal", DoubleType()), StructField("c_mktsegment", StringType())])
    back = files.load_csv(spark, path, schema, lineSep="\n")
    return CL.strip_carriage_returns(back)


# ---------------------------------------------------------- cleaning (narrow)

def _sentinel_rows(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    season = (F.when(k % 7 == 0, F.lit(None)).when(k % 7 == 1, F.lit("")).when(k % 7 == 2, F.lit("N/A"))
              .when(k % 7 == 3, F.lit("0"))
              .otherwise(_season_label(F.lit(1990) + F.col("c_nationkey"))))
    return table(spark, d, "customer").select(
        "c_custkey",
        F.when(k % 10 == 0, F.lit(None)).when(k % 10 == 1, F.lit("")).otherwise(F.col("c_name")).alias("entity_id"),
        season.alias("season"),
        F.when(k % 5 == 0, F.lit("n/a")).otherwise(F.floor("c_acctbal").cast("bigint").cast("string"))
        .alias("amount"),
    )


def q02_key_sentinel_filter(spark: SparkSession, d: str) -> DataFrame:
    """Blank keys and sentinel seasons out, unparseable amounts
    dropped (their number observed on the same pass), start year added."""
    rows = CL.drop_blank_keys(_sentinel_rows(spark, d), ["entity_id"])
    rows = CL.drop_sentinels(rows, "season", K.SEASON_SENTINELS)
    rows = CL.parse_money_text(rows, "amount", "amount", {}, observation=Observation("q02_dropped"))
    return CL.add_season_start_year(rows)


def q03_fill_and_flag(spark: SparkSession, d: str) -> DataFrame:
    """Orders left-joined to the line summary, whose key is moved
    away for one order in three; gaps filled with defaults, floats truncated to
    int, a drafted-style flag."""
    ret = (table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_linestatus").alias("college"),
        F.avg("l_quantity").cast("float").alias("draft_year"),
        F.max("l_linenumber").cast("float").alias("draft_pick"))
        .withColumn("l_orderkey", F.when(F.col("l_orderkey") % 3 != 0, F.col("l_orderkey")).otherwise(-F.col("l_orderkey") - 1)))
    o = table(spark, d, "orders").select("o_orderkey")
    rows = o.join(ret, o.o_orderkey == ret.l_orderkey, "left").drop("l_orderkey")
    rows = CL.fill_defaults(rows, {"college": "None", "draft_year": -1.0, "draft_pick": -1.0})
    rows = CL.cast_columns(rows, {"draft_year": "int", "draft_pick": "int"})
    return CL.flag_not_sentinel(rows, "draft_year", -1, "is_drafted")


def q04_range_to_null(spark: SparkSession, d: str) -> DataFrame:
    """FloatType measures outside their inclusive range become NULL."""
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        (F.col("l_discount") * 12).cast("float").alias("shot_pct"),
        (F.col("l_tax") * 20).cast("float").alias("efg_pct"),
        (F.col("l_quantity") * 2.5).cast("float").alias("usage_pct"),
        ((F.col("l_extendedprice") - 50000) / 1000).cast("float").alias("win_shares"),
    )
    return CL.null_outside(li, {"shot_pct": (0.0, 1.0), "efg_pct": (0.0, 1.5), "usage_pct": (0.0, 100.0),
                                "win_shares": (-50.0, 50.0)})


LINEITEM_COLS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_returnflag", "l_linestatus")


def q05_prefer_aggregate(spark: SparkSession, d: str) -> DataFrame:
    """Per (order, line) keep the 'A'-tagged rows, else the untagged ones."""
    li = table(spark, d, "lineitem").select(*LINEITEM_COLS)
    return prefer_tagged_rows(li, ["l_orderkey", "l_linenumber"], "l_returnflag", ["A"])


def q42_prefer_aggregate_filtered(spark: SparkSession, d: str) -> DataFrame:
    """D4 (J1, J2) with a key filter before the anti-join: the rows of q05."""
    li = table(spark, d, "lineitem").select(*LINEITEM_COLS)
    return prefer_tagged_rows(li, ["l_orderkey", "l_linenumber"], "l_returnflag", ["A"], filter_words=FILTER_WORDS)


def q06_rates(spark: SparkSession, d: str) -> DataFrame:
    """Per-game (2 digits) and per-minute (4 digits) rates."""
    df = M.per_minute_rates(M.per_game_rates(supplier_seasons(spark, d)))
    return df.select("player_id", "season", "games", "mp", *[f"{s}_per_game" for s in K.PER_GAME_STATS],
                     *[f"{s}_per_min" for s in K.PER_MINUTE_STATS])


def _money_rows(spark: SparkSession, d: str) -> DataFrame:
    n = F.floor(F.abs(F.col("c_acctbal"))).cast("bigint").cast("string")
    seg = F.col("c_mktsegment")
    text = (F.when(seg == "MACHINERY", F.concat(n, F.lit(" (TW)")))
            .when(seg == "FURNITURE", F.concat(n, F.lit(" < Minimum")))
            .when(seg == "BUILDING", F.lit("< Minimum"))
            .when(seg == "HOUSEHOLD", F.concat(F.lit("$"), n))
            .when(seg == "AUTOMOBILE", F.concat(n, F.lit(".75")))
            .otherwise(n))
    return table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", text.alias("salary"))


def q07_money_parse(spark: SparkSession, d: str) -> DataFrame:
    """Flags from marker phrases, markers removed, text -> long, rows
    without an amount dropped ('$n' and a bare '< Minimum' go; 'n.75' -> n)."""
    return CL.parse_money_text(_money_rows(spark, d), "salary", "salary", MONEY_MARKS)


def q08_consolidate(spark: SparkSession, d: str) -> DataFrame:
    """A1: parsed amounts summed per (nation, segment), sorted distinct labels
    joined with ' / ', flags OR-ed."""
    parsed = CL.parse_money_text(_money_rows(spark, d), "salary", "salary", MONEY_MARKS)
    nat = table(spark, d, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    rows = parsed.join(nat, parsed.c_nationkey == nat.n_nationkey, "left").select(
        F.col("n_name").alias("player_id"), F.col("c_mktsegment").alias("season"), "salary",
        F.when(k % 11 == 0, F.lit(None)).otherwise(F.concat(F.lit("T"), (k % 5).cast("string"))).alias("team"),
        "is_two_way", "is_sub_minimum")
    return consolidate(rows, ["player_id", "season"], "salary", "team", flags=("is_two_way", "is_sub_minimum"))


def _record_rows(spark: SparkSession, d: str) -> DataFrame:
    st, pr = F.col("o_orderstatus"), F.col("o_orderpriority")
    g = table(spark, d, "orders").groupBy(F.year("o_orderdate").cast("int").alias("y"), pr.alias("team")).agg(
        F.count_if(st == "F").alias("f"), F.count_if(st == "O").alias("o"),
        F.count_if(st == "X").alias("x"), F.count_if(st == "Y").alias("z"))
    t = F.col("team")
    overall = (F.when(t == "5-LOW", t)
               .when(t == "1-URGENT", F.concat(F.col("x").cast("string"), F.lit("-"), F.col("z").cast("string")))
               .otherwise(F.concat(F.col("f").cast("string"), F.lit("-"), F.col("o").cast("string"))))
    return g.select(_season_label(F.col("y")).alias("season"), "team", overall.alias("overall"))


def q09_record_split(spark: SparkSession, d: str) -> DataFrame:
    """D12 core: 'W-L' split into ints (missing or non-numeric part -> NULL),
    win share rounded to 4 digits where any game was played."""
    rows = CL.drop_blank_keys(_record_rows(spark, d), ["season", "team"])
    rows = CL.split_record(rows, "overall", "-", ["wins", "losses"])
    rows = CL.win_share(rows, "wins", "losses", "win_pct")
    return CL.add_season_start_year(rows)


def q10_map_lookup(spark: SparkSession, d: str) -> DataFrame:
    """F8: constant name -> code map; unmapped names give NULL."""
    cust = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    nat = table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    reg = table(spark, d, "region")
    rows = (cust.join(nat, cust.c_nationkey == nat.n_nationkey, "left")
            .join(reg, F.col("n_regionkey") == F.col("r_regionkey"), "left"))
    return CL.map_codes(rows, "r_name", REGION_CODES, "region_code").select("c_custkey", "r_name", "region_code")


def _order_shares(spark: SparkSession, d: str, edge_cases: bool) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice",
                                         F.year("o_orderdate").cast("int").alias("season_start_year"))
    caps = o.groupBy("season_start_year").agg(F.max("o_totalprice").alias("salary_cap"))
    if edge_cases:  # one year with a zero cap, one year without a cap
        caps = (caps.withColumn("salary_cap", F.when(F.col("season_start_year") == 1998, F.lit(0.0))
                                .otherwise(F.col("salary_cap")))
                .filter(F.col("season_start_year") != 2001))
    return normalize_to_cap(o, caps, on="season_start_year", value_col="o_totalprice", cap_col="salary_cap")


def q11_normalize_to_cap(spark: SparkSession, d: str) -> DataFrame:
    """D13 (J3): share of the yearly cap, NULL where the cap is 0 or missing."""
    return _order_shares(spark, d, edge_cases=True)


# ------------------------------------------------------------------- joins

def q13_season_start(spark: SparkSession, d: str) -> DataFrame:
    """D2 (F1): start year from the season label; 'N/A' gives NULL."""
    o = table(spark, d, "orders")
    season = F.when(F.col("o_orderkey") % 50 == 0, F.lit("N/A")).otherwise(
        _season_label(F.year("o_orderdate")))
    return CL.add_season_start_year(o.select("o_orderkey", season.alias("season")))


# ---------------------------------------------------------------- metrics

def _cvs(spark: SparkSession, d: str) -> DataFrame:
    return composite_value_rows(M.per_game_rates(supplier_seasons_x(spark, d)), min_games=MIN_GAMES,
                                short_seasons=SHORT_SEASONS)


def q14_composite_value(spark: SparkSession, d: str) -> DataFrame:
    """Qualified rows, production score, floored share, CVS."""
    return _cvs(spark, d).select("player_id", "season", "team_name_abbr", "games", "mp", "player_salary",
                                 "salary_pct_of_cap", "production_score", "salary_cap_share",
                                 "composite_value_score")


def q15_availability(spark: SparkSession, d: str) -> DataFrame:
    """Games possible (short-season map), capped availability,
    availability-adjusted CVS, missed-game cost."""
    return _cvs(spark, d).select("player_id", "season", "games", "games_possible", "availability_rate",
                                 "availability_adj_cvs", "missed_game_cost")


def q16_per36(spark: SparkSession, d: str) -> DataFrame:
    """P11, D26."""
    df = M.per36_rates(M.qualify_for_archetypes(supplier_seasons_x(spark, d), min_games=MIN_GAMES))
    return df.select("player_id", "season", "min_per_game", *[f"{s}_per36" for s in K.PER36_STATS],
                     "salary_millions", "salary_share")


def _with_stand_in_features(df: DataFrame) -> DataFrame:
    """FIXTURES.md 3.1 stand-ins for the per-36 inputs of the label rules."""
    return df.withColumns({name: F.expr(e) for name, e in (
        ("pts36_in", "CAST(pts % 28 AS DOUBLE)"), ("ast36_in", "CAST(ast % 10 AS DOUBLE)"),
        ("trb36_in", "CAST(trb % 13 AS DOUBLE)"), ("stl36_in", "(stl % 25) / 10.0D"),
        ("blk36_in", "(blk % 30) / 10.0D"), ("fg3a36_in", "CAST(fg3a % 9 AS DOUBLE)"))})


STAND_IN_RULES = dict(pts36="pts36_in", ast36="ast36_in", trb36="trb36_in", stl36="stl36_in",
                      blk36="blk36_in", fg3a36="fg3a36_in")


def _labelled_all(spark: SparkSession, d: str) -> DataFrame:
    df = _with_stand_in_features(supplier_seasons(spark, d))
    return archetype_rules(**STAND_IN_RULES).apply(df, "archetype")


def q17_rule_label(spark: SparkSession, d: str) -> DataFrame:
    """G1 (D27): eight-way rule label as one native expression."""
    return _labelled_all(spark, d).select("player_id", "season", "pos", "archetype")


def _player_metrics(spark: SparkSession, d: str) -> DataFrame:
    df = M.per_game_rates(supplier_seasons_x(spark, d))
    df = M.per36_rates(M.qualify_for_archetypes(df, min_games=MIN_GAMES))
    df = archetype_rules(**STAND_IN_RULES).apply(_with_stand_in_features(df), "archetype")
    return M.value_metrics(df)


def q18_value_metrics(spark: SparkSession, d: str) -> DataFrame:
    """D28-D32."""
    return _player_metrics(spark, d).select("player_id", "season", "cost_per_ws", "value_score", "availability",
                                            "cost_per_available_ws", "composite_index")


ROLLUP_DIGITS = {"avg_cost_per_ws": 2, "avg_value_score": 8, "avg_composite_index": 8, "avg_win_shares": 8,
                 "avg_vorp": 8, "avg_per": 8, "avg_salary_millions": 8, "avg_availability": 8,
                 "avg_ts_pct": 8, "avg_bpm": 8, "avg_ws_per_48": 8, "cost_per_ws_millions": 8,
                 "total_archetype_salary_millions": 8}


def q19_label_season_rollup(spark: SparkSession, d: str) -> DataFrame:
    """D33 (A4-A6): season x archetype rollup with an approximate median."""
    return _round_cols(R.archetype_season_rollup(_player_metrics(spark, d)), ROLLUP_DIGITS)


def q20_topk_per_group(spark: SparkSession, d: str) -> DataFrame:
    """W1, O3 (D34): top 5 orders by price per (year, priority), ties kept."""
    o = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").cast("int").alias("season_start_year"),
                                         "o_orderpriority", "o_totalprice")
    return R.top_k_per_group(o, ["season_start_year", "o_orderpriority"], "o_totalprice", k=5, rank_col="rank")


def q21_label_distribution(spark: SparkSession, d: str) -> DataFrame:
    """A7, O1 (D35), with each row's place in the order."""
    return _with_place(R.label_distribution(_labelled_all(spark, d)))


def q22_season_report(spark: SparkSession, d: str) -> DataFrame:
    """P22, O2 (D36): one season of the rollup, cheapest first."""
    rollup = R.archetype_season_rollup(_player_metrics(spark, d))
    rep = R.season_report(rollup, REPORT_SEASON)
    return _with_place(_round_cols(rep, {"cost_per_ws_millions": 8, "avg_value_score": 8, "avg_win_shares": 8}))


def q23_tiers(spark: SparkSession, d: str) -> DataFrame:
    """M1 (D38): seven left-closed tiers of the yearly price share."""
    shares = _order_shares(spark, d, edge_cases=False)
    return assign_tiers(shares).select("o_orderkey", "salary_pct_of_cap", "salary_group")


def q24_tier_value_score(spark: SparkSession, d: str) -> DataFrame:
    """D39-D43 (P12, A3, J9, A10, M2-M4) on line items: integer-valued features
    so both engines' tier means agree exactly."""
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        (F.col("l_quantity") / 160.0).alias("salary_pct_of_cap"),
        F.col("l_quantity").alias("bpm"),
        cents(F.col("l_extendedprice")).cast("double").alias("ws_per_48"),
        cents(F.col("l_discount")).cast("double").alias("ts_pct"),
        cents(F.col("l_tax")).cast("double").alias("usg_pct"),
    )
    out = tier_value_score(li)
    return _round_cols(out, {"value_score": 6})


def q25_quality_report(spark: SparkSession, d: str) -> DataFrame:
    """D14-D16, A8, A9 on line items, in one long table (report, item, value),
    all from one scan and one aggregation per key (``quality.key_profile``)."""
    li = table(spark, d, "lineitem").select(
        "l_orderkey", F.expr("nullif(l_linenumber, 7)").alias("l_linenumber"), "l_returnflag")
    items = Q.key_profile(li, ["l_orderkey", "l_linenumber"], "lineitem", tag_col="l_returnflag", tags=["A"])
    wide = items.groupBy("table_name").agg(F.map_from_entries(F.collect_list(F.struct("item", "value"))).alias("m"))
    v = lambda name: F.col("m")[name]
    rows = [("cleaning", "raw_rows", v("total_rows")), ("cleaning", "clean_rows", v("kept_rows")),
            ("cleaning", "dropped_rows", v("total_rows") - v("kept_rows"))]
    rows += [("null_keys", k, v(f"null_{k}")) for k in ("l_orderkey", "l_linenumber")]
    rows += [("duplicates", k, v(k)) for k in ("total_rows", "distinct_keys", "duplicate_rows", "keys_with_duplicates")]
    entry = F.explode(F.array(*[F.struct(F.lit(r).alias("report"), F.lit(i).alias("item"), x.alias("value")) for r, i, x in rows]))
    return wide.select("table_name", entry.alias("e")).select("e.report", "table_name", "e.item", "e.value")


def q26_lookup_filter(spark: SparkSession, d: str) -> DataFrame:
    """Season / position filter over the CVS table, schema-tolerant
    projection (a column the table lacks is skipped)."""
    cvs = _cvs(spark, d)
    hit = L.filter_results(cvs, season_start_year=[1997, 1998], pos=["PG", "SG", "SF"], team_name_abbr=None)
    return L.select_present(hit, ["player_id", "name", "season", "pos", "team_name_abbr", "composite_value_score",
                                  "archetype"])


def q27_wasted_cap(spark: SparkSession, d: str) -> DataFrame:
    """Missed-game salary per team and season."""
    return _round_cols(L.wasted_cap(_cvs(spark, d)), {"wasted_salary": 2})


def q28_partitioned_sink(spark: SparkSession, d: str) -> DataFrame:
    """Labelled rows written partitioned by season start year, with a
    bound on a file's rows, read back from the shared scratch folder."""
    df = _player_metrics(spark, d).select("player_id", "season", "season_start_year", "archetype", "value_score",
                                          "cost_per_ws")
    path = scratch_path(spark, "q28_partitioned")
    files.write_parquet(df, path, partition_by=["season_start_year"], max_records_per_file=100_000)
    return spark.read.parquet(path).select("player_id", "season", "season_start_year", "archetype", "value_score",
                                           "cost_per_ws")


def q47_topk_heavy_ties(spark: SparkSession, d: str) -> DataFrame:
    """The three largest quantities per return flag; half of all rows in
    one group and thousands of rows on each place."""
    li = table(spark, d, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_quantity")
    return top_k_by_threshold(li, ["l_returnflag"], "l_quantity", k=3)


def q48_quarantined_records(spark: SparkSession, d: str) -> DataFrame:
    """Customers as CSV lines, four in ten of them malformed; each kept
    record again as a line, each other one once for every fault."""
    kind, key, name = F.col("c_custkey") % 10, F.col("c_custkey").cast("string"), F.col("c_name")
    balance = cents(F.col("c_acctbal")).cast("string")
    line = (F.when(kind == 1, F.concat_ws(",", key, name, F.lit("n/a"))).when(kind == 2, F.concat_ws(",", key, name))
            .when(kind == 3, F.concat_ws(",", key, name, balance, F.lit("extra")))
            .when(kind == 4, F.concat_ws(",", F.concat(F.lit("x"), key), name, F.lit("?")))
            .when(kind == 5, F.concat_ws(",", key, F.lit(""), balance)).otherwise(F.concat_ws(",", key, name, balance)))
    path = scratch_path(spark, "q48_lines")
    table(spark, d, "customer").select(line.alias("value")).write.text(path)
    schema = StructType([StructField("c_custkey", LongType()), StructField("c_name", StringType()), StructField("c_cents", LongType())])
    kept, quarantined = load_csv_quarantined(spark, path, schema, header="false")
    again = kept.select(F.concat_ws(",", "c_custkey", F.coalesce("c_name", F.lit("")), "c_cents").alias("record"),
                        F.lit(None).cast("string").alias("field"), F.lit("kept").alias("reason"))
    return again.unionByName(quarantined.select(F.col("raw").alias("record"), F.explode("faults").alias("f"))
                             .select("record", "f.field", "f.reason"))


def q49_suspect_profile(spark: SparkSession, d: str) -> DataFrame:
    """D15, D16, A9 with only suspects grouped: line items (some line numbers
    NULL, so some keys repeat), by words and by hashes, and orders, which are unique."""
    li = table(spark, d, "lineitem").select("l_orderkey", F.expr("nullif(l_linenumber, 7)").alias("l_linenumber"))
    keys = ["l_orderkey", "l_linenumber"]
    return (sketched_key_profile(li, keys, "lineitem").unionByName(suspect_profile(li, keys, "lineitem by hash", by_hash=True))
            .unionByName(sketched_key_profile(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], "orders")))


QUERIES = {f.__name__: f for f in (
    q01_csv_roundtrip, q02_key_sentinel_filter, q03_fill_and_flag, q04_range_to_null, q05_prefer_aggregate, q42_prefer_aggregate_filtered,
    q06_rates, q07_money_parse, q08_consolidate, q09_record_split, q10_map_lookup, q11_normalize_to_cap,
    q13_season_start, q14_composite_value, q15_availability, q16_per36, q17_rule_label,
    q18_value_metrics, q19_label_season_rollup, q20_topk_per_group, q21_label_distribution,
    q22_season_report, q23_tiers, q24_tier_value_score, q25_quality_report, q26_lookup_filter,
    q27_wasted_cap, q28_partitioned_sink, q47_topk_heavy_ties, q48_quarantined_records, q49_suspect_profile,
)}
QUERIES = dict(sorted({**QUERIES, **DOMAIN_QUERIES}.items()))

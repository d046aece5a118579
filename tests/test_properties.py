"""Equivalence properties: each native operator against a brute-force
statement of the same rule (Python, NumPy or pyspark.ml)."""

import math
import random

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from valuekit import schemas as K
from valuekit.functions.columns import text_to_integer
from valuekit.operators.dedupe import prefer_tagged_rows
from valuekit.operators.rules import archetype_rules
from valuekit.operators.tiers import assign_tiers, tier_value_score

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.sampled_from(["s1", "s2"]),
                          st.sampled_from(["2TM", "3TM", "ATL", "BOS", "5TM", None])), min_size=1, max_size=40))
def test_prefer_tagged_rows_matches_brute_force(spark, rows):
    rows = [(p, s, t, i) for i, (p, s, t) in enumerate(rows)]
    df = spark.createDataFrame(rows, "player_id string, season string, team string, rid int")
    tags = set(K.AGGREGATE_TEAM_TAGS)
    tagged_keys = {(p, s) for p, s, t, _ in rows if t in tags and p is not None and s is not None}
    want = sorted(i for p, s, t, i in rows
                  if t is not None and (t in tags or (p, s) not in tagged_keys))
    for salt in (1, 4):
        got = sorted(r.rid for r in prefer_tagged_rows(df, ["player_id", "season"], "team", K.AGGREGATE_TEAM_TAGS,
                                                       salt_buckets=salt).collect())
        assert got == want


def python_label(r):
    """First-max scorer written from the rule table (test oracle)."""
    keys = ["pos", "usg", "p36", "ts", "f36", "s36", "b36", "a36", "astp", "blkp", "orbp", "t36", "ws48", "fg3r"]
    v = dict(zip(keys, r))
    if any(x is None for x in v.values()):
        return "Role Player / Glue Guy"
    guard, wing, big = v["pos"] in ("PG", "SG", "G"), v["pos"] in ("SF", "SG-SF", "SF-SG", "F"), \
        v["pos"] in ("PF", "C", "C-PF", "PF-C", "F-C")
    sc = [
        ("Elite Scorer", 2 * (v["usg"] >= 25) + 2 * (v["p36"] >= 20) + (v["ts"] >= 0.56)
         + (v["usg"] >= 22 and v["p36"] >= 18)),
        ("3-and-D Wing", 2 * (v["fg3r"] >= 0.45) + (v["f36"] >= 5) + 2 * (v["s36"] + v["b36"] >= 2.5) + wing
         + (v["a36"] < 3.5)),
        ("Playmaking Engine", 3 * (v["astp"] >= 28) + 2 * (v["a36"] >= 7) + guard + (v["usg"] >= 22)),
        ("Rim Protector", 3 * (v["blkp"] >= 4) + 2 * (v["b36"] >= 2) + big + (v["orbp"] >= 8) + (v["t36"] >= 9)),
        ("Stretch Big", 3 * (big and v["fg3r"] >= 0.30) + 2 * (big and v["f36"] >= 3.5) + (v["a36"] < 3)),
        ("Two-Way Anchor", 2 * (v["s36"] + v["b36"] >= 3) + 2 * (v["ws48"] >= 0.12)
         + 2 * (v["blkp"] >= 2.5 and v["s36"] >= 1)),
        ("Combo Guard", 3 * (guard and v["p36"] >= 14 and v["a36"] >= 3.5) + (guard and v["fg3r"] >= 0.30)
         + (guard and v["usg"] < 25)),
        ("Role Player / Glue Guy", 1),
    ]
    best = max(s for _, s in sc)
    return next(n for n, s in sc if s == best)


def _f32(x):
    return None if x is None else float(np.float32(x))


def test_archetype_matches_python_first_max(spark):
    rng = random.Random(7)
    positions = ["PG", "SG", "G", "SF", "SG-SF", "SF-SG", "F", "PF", "C", "C-PF", "PF-C", "F-C", "PG-SG", "SF-PF"]
    rows = []
    for i in range(3000):
        r = [rng.choice(positions), _f32(rng.uniform(10, 35)), rng.uniform(5, 30), _f32(rng.uniform(0.45, 0.65)),
             rng.uniform(0, 10), rng.uniform(0, 3), rng.uniform(0, 4), rng.uniform(0, 11), _f32(rng.uniform(0, 45)),
             _f32(rng.uniform(0, 8)), _f32(rng.uniform(0, 15)), rng.uniform(2, 15), _f32(rng.uniform(-0.1, 0.3)),
             _f32(rng.uniform(0, 0.7))]
        if rng.random() < 0.03:
            r[rng.randrange(len(r))] = None
        if rng.random() < 0.02:
            r[12] = float("nan")
        rows.append(tuple([i] + r))
    schema = ("rid int, pos string, usg_pct float, pts_per36 double, ts_pct float, fg3a_per36 double, "
              "stl_per36 double, blk_per36 double, ast_per36 double, ast_pct float, blk_pct float, orb_pct float, "
              "trb_per36 double, ws_per_48 float, fg3a_per_fga_pct float")
    df = spark.createDataFrame(rows, schema)
    got = {r.rid: r.archetype for r in archetype_rules().apply(df, "archetype").select("rid", "archetype").collect()}
    bad = [i for i, *r in rows if got[i] != python_label(r)]
    assert bad == []


@SETTINGS
@given(st.lists(st.one_of(st.floats(min_value=-1.0, max_value=2.0), st.sampled_from([0.03, 0.07, 0.12, 0.18, 0.24,
                                                                                  0.30, -1.0, float("inf")])),
                min_size=1, max_size=30))
def test_tiers_match_ml_bucketizer(spark, xs):
    from pyspark.ml.feature import Bucketizer
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(xs)], "rid int, s double")
    mine = {r.rid: r.tier for r in assign_tiers(df, "s", "tier").collect()}
    b = Bucketizer(splits=list(K.TIER_SPLITS), inputCol="s", outputCol="tier", handleInvalid="skip")
    ref = {r.rid: r.tier for r in b.transform(df).collect()}
    assert mine == ref


@SETTINGS
@given(st.lists(st.one_of(
    st.from_regex(r"\A[ \t]?[+-]?[0-9]{0,12}(\.[0-9]{0,3})?[ \t]?\Z", fullmatch=True),
    st.builds(lambda a, n, b: f"{a}{n}{b}", st.sampled_from([chr(i) for i in (*range(1, 33), 127, 128, 133, 160)]), st.integers(-99, 99),
              st.sampled_from(["", *[chr(i) for i in (*range(1, 33), 127, 133, 160)]])),
    st.sampled_from(["$1", "1,000", "1e6", "", " ", ".", "-", "+", "12a", "99999999999999999999", "-.5", "1.",
                     "\t42\n", "N/A", "0x10"])), min_size=1, max_size=40))
def test_text_to_integer_matches_non_ansi_cast(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "rid int, t string")
    mine = {r.rid: r.v for r in df.select("rid", text_to_integer("t").alias("v")).collect()}
    prev = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        ref = {r.rid: r.v for r in df.select("rid", F.col("t").cast("bigint").alias("v")).collect()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", prev)
    assert mine == ref


def test_tier_value_score_matches_numpy(spark):
    rng = np.random.default_rng(3)
    n = 400
    share = rng.uniform(-0.5, 0.5, n)
    feats = rng.normal(size=(n, 4)) * np.array([3.0, 0.05, 0.04, 6.0]) + np.array([0.0, 0.1, 0.55, 20.0])
    rows = [(i, float(share[i]), *map(float, feats[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "rid int, salary_pct_of_cap double, bpm double, ws_per_48 double, "
                                     "ts_pct double, usg_pct double")
    got = {r.rid: r.value_score for r in tier_value_score(df).collect()}
    tiers = np.array([sum(x >= s for s in K.TIER_SPLITS[1:-1]) for x in share])
    diffs = np.empty_like(feats)
    for t in np.unique(tiers):
        m = tiers == t
        diffs[m] = feats[m] - feats[m].mean(axis=0)
    z = (diffs - diffs.mean(axis=0)) / diffs.std(axis=0, ddof=1)
    want = z @ np.array([0.40, 0.25, 0.20, 0.15])
    assert all(math.isclose(got[i], want[i], rel_tol=1e-9, abs_tol=1e-12) for i in range(n))


def test_standardize_matches_ml_standard_scaler(spark):
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array
    rng = np.random.default_rng(5)
    rows = [(i, float(rng.uniform(0, 0.4)), *map(float, rng.normal(size=4))) for i in range(300)]
    df = spark.createDataFrame(rows, "rid int, salary_pct_of_cap double, bpm double, ws_per_48 double, "
                                     "ts_pct double, usg_pct double")
    mine = tier_value_score(df)
    cols = ["bpm_diff", "ws_per_48_diff", "ts_pct_diff", "usg_pct_diff"]
    v = VectorAssembler(inputCols=cols, outputCol="raw").transform(mine)
    scaled = StandardScaler(inputCol="raw", outputCol="z", withMean=True, withStd=True).fit(v).transform(v)
    arr = vector_to_array(F.col("z"))
    ref = scaled.select("rid", "value_score", (0.4 * arr[0] + 0.25 * arr[1] + 0.2 * arr[2] + 0.15 * arr[3])
                        .alias("ref")).collect()
    assert all(math.isclose(r.value_score, r.ref, rel_tol=1e-9, abs_tol=1e-12) for r in ref)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["k1", "k2", "k3"]), st.sampled_from(["BOS", "LAL", "ATL", None]),
                          st.integers(min_value=0, max_value=10**9), st.booleans()), min_size=1, max_size=30))
def test_consolidate_matches_brute_force(spark, rows):
    from valuekit.operators.dedupe import consolidate
    df = spark.createDataFrame(rows, "k string, team string, salary long, tw boolean")
    got = {r.k: (r.salary, r.teams, r.tw) for r in consolidate(df, ["k"], "salary", "team", flags=("tw",)).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == k]
        teams = " / ".join(sorted({r[1] for r in mine if r[1] is not None}))
        want[k] = (sum(r[2] for r in mine), teams, any(r[3] for r in mine))
    assert got == want


def _half_up(num: int, den: int, digits: int) -> float:
    from decimal import ROUND_HALF_UP, Decimal
    return float((Decimal(num) / Decimal(den)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


@SETTINGS
@given(st.lists(st.tuples(st.integers(min_value=0, max_value=200), st.integers(min_value=0, max_value=200)),
                min_size=1, max_size=30))
def test_record_split_and_win_share(spark, records):
    from valuekit.operators import clean as CL
    texts = [f"{w}-{l}" for w, l in records] + ["5", "x-3", "-", "7-"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "rid int, overall string")
    out = CL.win_share(CL.split_record(df, "overall", "-", ["wins", "losses"]), "wins", "losses", "win_pct")
    got = {r.rid: (r.wins, r.losses, r.win_pct) for r in out.collect()}
    for i, (w, l) in enumerate(records):
        assert got[i] == (w, l, _half_up(w, w + l, 4) if w + l > 0 else None)
    n = len(records)
    assert got[n] == (5, None, None) and got[n + 1] == (None, 3, None)
    assert got[n + 2] == (None, None, None) and got[n + 3] == (7, None, None)


@SETTINGS
@given(st.lists(st.tuples(st.integers(min_value=1, max_value=60_000_000), st.integers(min_value=0, max_value=3)),
                min_size=1, max_size=30))
def test_cap_share_rounds_half_up(spark, rows):
    from valuekit.operators.join import normalize_to_cap
    caps = {0: 0, 1: 101_869_000, 2: 136_021_000, 3: None}
    df = spark.createDataFrame([(i, s, str(c)) for i, (s, c) in enumerate(rows)], "rid int, salary long, season string")
    cap_df = spark.createDataFrame([(str(k), v) for k, v in caps.items() if v is not None],
                                   "season string, salary_cap int")
    got = {r.rid: r.salary_pct_of_cap for r in normalize_to_cap(df, cap_df).collect()}
    for i, (s, c) in enumerate(rows):
        cap = caps[c]
        assert got[i] == (_half_up(s, cap, 6) if cap else None)

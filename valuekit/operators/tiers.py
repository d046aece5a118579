"""Salary tiers and the tier-relative standardized value score.

Plan shape. The source computes tier means (aggregate + join back), then a
global mean and sample standard deviation of the four differences (a second
full pass, collected to the driver by ``StandardScaler.fit``). Here both come
from **one** partial aggregation over the tier column:

* differences from the own-tier mean sum to zero inside each tier, so their
  global mean is exactly 0;
* the sum of squared differences is the pooled within-tier sum of squares,
  ``sum_t (n_t - 1) * var_samp_t``, so the global sample standard deviation is
  ``sqrt(sum_t (n_t - 1) var_t / (N - 1))``.

The tier table has at most ``len(splits) - 1`` rows (a bound by construction),
so the pooled totals are a window over that tiny table and the table is
broadcast back onto the rows. One shuffle of pre-aggregated rows, no cross
join, no driver round-trip, and a hot tier cannot pile up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valuekit import schemas as K


def bucket_expr(x: Column, splits: Sequence[float]) -> Column:
    """M1 as an expression: bucket index (double) for left-closed buckets, the
    last one also right-closed; values outside [splits[0], splits[-1]] raise."""
    inner = list(splits[1:-1])
    idx = F.lit(0)
    for s in inner:
        idx = idx + F.when(x >= F.lit(float(s)), F.lit(1)).otherwise(F.lit(0))
    out_of_range = (x < F.lit(float(splits[0]))) | (x > F.lit(float(splits[-1])))
    return F.when(
        out_of_range,
        F.raise_error(F.concat(F.lit("value outside bucket splits: "), x.cast("string"))).cast("double"),
    ).otherwise(idx.cast("double"))


def assign_tiers(df: DataFrame, value_col: str = "salary_pct_of_cap", out: str = "salary_group",
                 splits: Sequence[float] = K.TIER_SPLITS) -> DataFrame:
    """Drop rows whose value is NULL or NaN, then add the tier index."""
    x = F.col(value_col)
    kept = df.filter(x.isNotNull() & ~F.isnan(x))
    return kept.withColumn(out, bucket_expr(x, splits))


def tier_value_score(
    df: DataFrame,
    value_col: str = "salary_pct_of_cap",
    features: Sequence[tuple[str, float]] = K.TIER_FEATURE_WEIGHTS,
    tier_col: str = "salary_group",
    splits: Sequence[float] = K.TIER_SPLITS,
    out: str = "value_score",
    by: Sequence[str] = (),
) -> DataFrame:
    """D43 (P12, D38-D42): complete-case filter, tiers, tier means joined back
    (``avg_<f>``), differences (``<f>_diff``), global standardisation with the
    sample standard deviation (0 where it is 0 or undefined) and the weighted
    sum of the standardised differences.

    Deliberate change from the source: rows with a NaN feature are dropped
    with the NULL rows, instead of turning their whole tier's mean into NaN
    and silently skipping that tier.

    ``by`` (default none, as in the source: tiers pool all seasons and the
    standardisation is global) computes tier means and the standardisation
    within each ``by`` group instead, e.g. per season. The tier table then
    has up to groups x tiers rows, which is no longer a fixed bound, so its
    broadcast is left to AQE's run-time size check. Rows whose group value is
    NULL have no group and are dropped.
    """
    names = [f for f, _ in features]
    cond = F.col(value_col).isNotNull()
    for b in by:
        cond = cond & F.col(b).isNotNull()
    for f in names:
        cond = cond & F.col(f).isNotNull() & ~F.isnan(F.col(f))
    rows = assign_tiers(df.filter(cond), value_col, tier_col, splits)

    aggs = [F.count(F.lit(1)).alias("__n")]
    for f in names:
        aggs += [F.avg(f).alias(f"avg_{f}"), F.var_samp(f).alias(f"__var_{f}")]
    by = list(by)
    tiers = rows.groupBy(*by, tier_col).agg(*aggs)

    # over the tier table only: at most len(splits) - 1 rows per group
    everything = Window.partitionBy(*by)
    total_n = F.sum("__n").over(everything)
    pooled = {}
    for f in names:
        ss = F.sum(F.coalesce(F.col(f"__var_{f}") * (F.col("__n") - 1), F.lit(0.0))).over(everything)
        pooled[f"__std_{f}"] = F.sqrt(F.try_divide(ss, (total_n - 1).cast("double")))
    tiers = tiers.withColumns(pooled).drop("__n", *[f"__var_{f}" for f in names])

    joined = rows.join(tiers if by else F.broadcast(tiers), on=[*by, tier_col], how="inner")
    diffs = {f"{f}_diff": F.col(f) - F.col(f"avg_{f}") for f in names}
    joined = joined.withColumns(diffs)

    score = None
    for f, w in features:
        std = F.col(f"__std_{f}")
        z = F.coalesce(F.when(std != 0, F.col(f"{f}_diff") / std), F.lit(0.0))
        term = F.lit(float(w)) * z
        score = term if score is None else score + term
    return joined.withColumn(out, score).drop(*[f"__std_{f}" for f in names])

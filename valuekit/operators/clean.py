"""Row-level cleaning operators (narrow: no shuffle).

Every function is ``DataFrame -> DataFrame`` and builds one projection or one
filter, so Catalyst collapses a chain of them into a single whole-stage-codegen
span and pushes filters into the Parquet/CSV scan where it can.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from valuekit.functions import columns as C


def strip_carriage_returns(df: DataFrame) -> DataFrame:
    """Remove ``\\r`` from every string column in one projection."""
    return df.select(
        *[
            C.strip_cr(f.name).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def add_season_start_year(df: DataFrame, season_col: str = "season", out: str = "season_start_year") -> DataFrame:
    """Int of the first four characters of the season label ('2023-24' -> 2023)."""
    return df.withColumn(out, C.season_start_year(season_col))


def drop_blank_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Keep rows whose key columns are all non-NULL and non-empty."""
    cond = None
    for k in keys:
        c = C.not_blank(k)
        cond = c if cond is None else cond & c
    return df if cond is None else df.filter(cond)


def drop_sentinels(df: DataFrame, column: str, sentinels: Iterable[str]) -> DataFrame:
    """Reject NULL and the given sentinel values of one column."""
    return df.filter(C.not_sentinel(column, sentinels))


def null_outside(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Replace values outside the inclusive [lo, hi] by NULL (NaN too)."""
    return df.withColumns({c: C.within(c, lo, hi) for c, (lo, hi) in bounds.items()})


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace NULLs per column (empty strings stay as they are)."""
    return df.fillna(dict(defaults))


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Plain casts (float -> int truncates toward zero)."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def flag_not_sentinel(df: DataFrame, column: str, sentinel: object, out: str) -> DataFrame:
    """Boolean flag, false only where ``column`` equals the sentinel."""
    return df.withColumn(out, F.when(F.col(column) == F.lit(sentinel), F.lit(False)).otherwise(F.lit(True)))


def parse_money_text(
    df: DataFrame,
    text_col: str,
    out: str,
    marks: Mapping[str, str],
    observation: Observation | None = None,
    drop_text: bool = True,
) -> DataFrame:
    """Parse integer money text that may carry marker phrases.

    ``marks`` maps a flag column name to a literal phrase: the flag is
    ``contains(text, phrase)``, the phrase is removed, the rest is trimmed
    (spaces), ``''`` becomes NULL, a decimal fraction is truncated and
    anything else (``$``, ``,``, exponents) becomes NULL (see
    :func:`valuekit.functions.columns.text_to_integer`).
    Rows without a number are dropped; when an ``Observation`` is given the
    number of dropped rows is recorded on it as ``dropped_<out>`` during the
    same pass that writes the result (no extra job).

    The amount is read once a row: the rows are observed between it and the
    filter, which Catalyst would else push below, with the whole parse in it
    once more, and a filter evaluates each repeated part again.
    """
    text = F.col(text_col)
    stripped = text
    for phrase in marks.values():
        stripped = F.replace(stripped, F.lit(phrase), F.lit(""))
    stripped = F.trim(stripped)
    amount = F.when(F.col("__stripped") == "", F.lit(None)).otherwise(C.text_to_integer("__stripped", "bigint"))
    out_df = df.withColumn("__stripped", stripped).withColumns({**{flag: text.contains(phrase) for flag, phrase in marks.items()}, out: amount})
    out_df = out_df.drop("__stripped").observe(
        f"parsed_{uuid.uuid4().hex[:12]}" if observation is None else observation,
        F.count(F.lit(1)).alias(f"rows_{out}"),
        F.count_if(F.col(out).isNull()).alias(f"dropped_{out}"),
    )
    out_df = out_df.filter(F.col(out).isNotNull())
    return out_df.drop(text_col) if drop_text and text_col != out else out_df


def split_record(df: DataFrame, text_col: str, sep: str, outs: Iterable[str], cast: str = "int") -> DataFrame:
    """split ``'50-32'`` into typed parts; a missing or non-numeric part is NULL."""
    parts = F.split(F.col(text_col), sep)
    return df.withColumns({name: C.text_to_integer(F.get(parts, i), cast) for i, name in enumerate(outs)})


def win_share(df: DataFrame, wins: str, losses: str, out: str, digits: int = 4) -> DataFrame:
    """D12 tail: wins / (wins + losses) rounded, NULL when no game was played."""
    total = F.col(wins) + F.col(losses)
    return df.withColumn(out, F.when(total > 0, F.round(F.col(wins) / total, digits)))


def map_codes(df: DataFrame, key_col: str, mapping: Mapping[str, str], out: str) -> DataFrame:
    """F8: constant map lookup; unmapped or NULL keys give NULL."""
    return df.withColumn(out, C.lookup(mapping, key_col))

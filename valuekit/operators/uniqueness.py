"""Key profile that groups only suspects by their key.

``quality.key_profile`` groups all rows by key. In a table that is (nearly)
unique, no row meets another one there, so every key is shuffled whole. Here a
filter marks the keys that may repeat first, and only these are grouped:

1. a sketch in one job: rows and an estimate of the distinct keys. Where much
   of the table repeats, the filter would mark nearly all of it and map-side
   aggregation already folds the repeats: the plain profile is taken;
2. the filter: 64-bit words with a bit for each key that may repeat. While
   there are few rows a word, it comes from the words alone: rows are counted
   and their bits OR-ed, and a word with more rows than bits holds two rows on
   one bit. What is shuffled is at most ``words`` rows a map task. Beyond that,
   rows are grouped by a 64-bit hash of the key instead of the key, and hashes
   that occur twice set their bits;
3. the profile: unmarked rows are the only ones of their key and are counted in
   their map task; marked rows are grouped by the whole key.

The result does not depend on the way taken: a key that repeats always sets its
own bit, and what else is marked (two keys on one bit) is told apart in step 3.

NULL keys equal each other, as in a grouping. A hot key folds into a row a map
task in every step. An empty table gives zeros.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuekit.operators.dedupe import FILTER_WORDS
from valuekit.operators.quality import key_profile, profile_items

#: Rows a word up to which the words alone give the filter; at 4, about one word in nine is marked by chance.
ROWS_A_WORD = 4
#: Share of rows beyond the distinct keys above which all rows are grouped.
MANY_REPEATS = 0.5


def _placed(df: DataFrame, keys: Sequence[str], words: int) -> DataFrame:
    h = F.xxhash64(*keys)
    return df.select(*keys, h.alias("__hash"), F.pmod(h, F.lit(words)).alias("__word"),
                     F.pmod(F.xxhash64(h, F.lit(1)), F.lit(64)).cast("int").alias("__bit"))


def _words_of_rows(placed: DataFrame) -> DataFrame:
    per_word = placed.groupBy("__word").agg(F.count(F.lit(1)).alias("__rows"), F.expr("bit_or(shiftleft(1L, __bit))").alias("__bits"))
    return per_word.where(F.col("__rows") > F.bit_count("__bits")).select("__word", "__bits")


def _words_of_hashes(placed: DataFrame) -> DataFrame:
    twice = placed.groupBy("__hash", "__word", "__bit").agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > 1)
    return twice.groupBy("__word").agg(F.expr("bit_or(shiftleft(1L, __bit))").alias("__bits"))


def suspects(df: DataFrame, keys: Sequence[str], by_hash: bool = False, words: int = FILTER_WORDS) -> DataFrame:
    """The columns ``keys`` of every row and ``__suspect``: false only where no
    other row has the same key. The filter has at most ``words`` rows, so it is
    broadcast whatever the size of the table."""
    placed = _placed(df, keys, words)
    marks = _words_of_hashes(placed) if by_hash else _words_of_rows(placed)
    hit = F.coalesce(F.expr("(shiftright(__bits, __bit) & 1L) = 1"), F.lit(False))
    return placed.join(F.broadcast(marks), "__word", "left").select(*keys, hit.alias("__suspect"))


def suspect_profile(df: DataFrame, keys: Sequence[str], table: str, by_hash: bool = False, words: int = FILTER_WORDS) -> DataFrame:
    """Steps 2 and 3: the rows of :func:`quality.key_profile`."""
    marked = suspects(df, keys, by_hash, words)
    nulls = [F.count_if(F.col(k).isNull()).alias(f"__null{i}") for i, k in enumerate(keys)]
    group = [F.when(F.col("__suspect"), F.col(k)).alias(f"__key{i}") for i, k in enumerate(keys)]
    per_key = marked.groupBy("__suspect", *group).agg(F.count(F.lit(1)).alias("__rows"), *nulls)
    total = lambda x: F.coalesce(F.sum(x), F.lit(0)).cast("bigint")
    wide = per_key.agg(
        total("__rows").alias("total_rows"),
        total(F.when(F.col("__suspect"), 1).otherwise(F.col("__rows"))).alias("distinct_keys"),
        F.count_if(F.col("__suspect") & (F.col("__rows") > 1)).alias("keys_with_duplicates"),
        *[total(f"__null{i}").alias(f"null_{k}") for i, k in enumerate(keys)],
    ).withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_keys"))
    return profile_items(wide, keys, table)


def sketch(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Number of rows and, within about 2 %, of distinct keys."""
    row = df.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*keys), 0.02)).first()
    return row[0], row[1]


def sketched_key_profile(df: DataFrame, keys: Sequence[str], table: str, words: int = FILTER_WORDS) -> DataFrame:
    """All three steps; runs the sketch when called."""
    rows, distinct = sketch(df, keys)
    if rows - distinct > MANY_REPEATS * rows:
        return key_profile(df, keys, table)
    return suspect_profile(df, keys, table, by_hash=rows > ROWS_A_WORD * words, words=words)

"""Key-level de-duplication operators.

``prefer_tagged_rows`` (D4) keeps, per key, the rows carrying an aggregate tag
and falls back to the untagged rows only where no tagged row exists.

Plan shape, chosen for skew: the untagged rows are anti-joined against the
keys of the tagged rows. AQE turns the anti-join into a broadcast hash join
when the key side is small at run time; otherwise it stays a sort-merge join
whose skewed partitions (a key holding a third of all rows) AQE splits
across tasks. That split needs a plain shuffle on both sides, so by default
the key side is not de-duplicated first: a ``distinct`` would hand its own
hash partitioning to the join, and Spark then skips the skew split (checked in
``tests/test_skew.py``). A sort-merge anti-join buffers only the first
matching key row, so duplicate keys cost shuffle bytes, not memory;
``dedupe_keys=True`` pre-aggregates them for inputs with many tagged rows per
key. Tagged rows themselves are never shuffled. A window
``max(tag) over (partition by key)`` would shuffle every row and buffer a hot
key's whole group in one task, so it is not used.

``consolidate`` (A1) folds several rows per key into one with a sum, a sorted
distinct label list and OR-ed flags; all of it is partial-aggregated.
"""

from __future__ import annotations

import operator
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of 64 bits in a key filter: 64 million bits, a table of at most 16 MB.
FILTER_WORDS = 1 << 20


def _place(keys: Sequence[str], words: int) -> tuple[Column, Column]:
    """Word and bit of a key in a key filter."""
    h = F.xxhash64(*keys)
    return F.pmod(h, F.lit(words)), F.pmod(F.xxhash64(h, F.lit(1)), F.lit(64)).cast("int")


def key_filter(keyed: DataFrame, keys: Sequence[str], words: int = FILTER_WORDS) -> DataFrame:
    """A Bloom filter of one hash over the keys as a table (word, bits) of at
    most ``words`` rows, whatever the number of keys: bits are OR-ed before the
    shuffle; keys with a NULL match nothing and are left out. With m different keys about m / (64 * words) of all others pass it
    too."""
    word, bit = _place(keys, words)
    return (keyed.dropna(subset=list(keys)).select(word.alias("__word"), bit.alias("__bit"))
            .groupBy("__word").agg(F.expr("bit_or(shiftleft(1L, __bit))").alias("__bits")))


def split_by_filter(df: DataFrame, keys: Sequence[str], filter_table: DataFrame, words: int = FILTER_WORDS) -> tuple[DataFrame, DataFrame]:
    """Rows whose key may be in the filter, and rows whose key is not. The
    filter is broadcast: its size has a fixed bound."""
    word, bit = _place(keys, words)
    marked = df.withColumns({"__word": word, "__bit": bit}).join(F.broadcast(filter_table), "__word", "left")
    hit = F.coalesce(F.expr("(shiftright(__bits, __bit) & 1L) = 1"), F.lit(False))
    return marked.filter(hit).select(*df.columns), marked.filter(~hit).select(*df.columns)


def prefer_tagged_rows(df: DataFrame, keys: Sequence[str], tag_col: str, tags: Iterable[str],
                       salt_buckets: int = 1, dedupe_keys: bool = False, filter_words: int = 0, free_words: int = 0) -> DataFrame:
    """D4 (P8, P9, A2, J1/J2, U1).

    Keeps every row whose ``tag_col`` is in ``tags`` plus every row whose tag
    is not in ``tags`` and whose key has no tagged row. A NULL tag makes the
    membership test NULL, so such rows fall out of both branches; a NULL key
    never matches in the anti-join, so untagged rows with a NULL key stay.

    ``salt_buckets > 1`` spreads every key over that many join partitions
    without relying on AQE: each untagged row picks a bucket from a hash of its
    other columns (deterministic, so a retried task sends rows to the same
    place), and the distinct key set is copied once per bucket with
    ``explode`` (a generator, not a join). The result is the same rows.

    ``filter_words > 0`` builds a key filter of the tagged rows first: untagged
    rows that it excludes, most of them where few keys have a tagged row, are kept
    without a shuffle, and only the others go to the anti-join. It costs two
    more scans of the narrow key columns and pays where shuffled bytes dominate.

    ``free_words > 0`` is for tables where most keys do have a tagged row: the keys
    alone are anti-joined first, and a key filter of those without a tagged row
    leaves out untagged rows that cannot stay before they are shuffled. Rows that
    pass it are still anti-joined, so what it lets through too much changes
    nothing; those with a NULL key stay and are not joined. At most one of the
    two filters is used.
    """
    if filter_words and free_words:
        raise ValueError("filter_words and free_words exclude each other")
    keys = list(keys)
    is_tagged = F.col(tag_col).isin(list(tags))
    tagged = df.filter(is_tagged)
    tagged_keys = tagged.select(*keys)
    if dedupe_keys or salt_buckets > 1:
        tagged_keys = tagged_keys.distinct()
    untagged, certain = df.filter(~is_tagged), None
    if filter_words:
        untagged, certain = split_by_filter(untagged, keys, key_filter(tagged_keys, keys, filter_words), filter_words)
    if free_words:
        null_key = reduce(operator.or_, (F.col(k).isNull() for k in keys))
        free = untagged.select(*keys).join(tagged_keys, on=keys, how="left_anti")
        certain, untagged = untagged.filter(null_key), untagged.filter(~null_key)
        untagged, _ = split_by_filter(untagged, keys, key_filter(free, keys, free_words), free_words)
    if salt_buckets > 1:
        others = [c for c in df.columns if c not in keys] or keys
        untagged = untagged.withColumn("__salt", F.pmod(F.xxhash64(*others), F.lit(salt_buckets)).cast("int"))
        tagged_keys = tagged_keys.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
        kept = untagged.join(tagged_keys, on=keys + ["__salt"], how="left_anti").drop("__salt")
    else:
        kept = untagged.join(tagged_keys, on=keys, how="left_anti")
    return tagged.unionByName(kept) if certain is None else tagged.unionByName(certain).unionByName(kept)


def consolidate(
    df: DataFrame,
    keys: Sequence[str],
    measure: str,
    label_col: str,
    flags: Sequence[str] = (),
    labels_out: str = "teams",
    sep: str = " / ",
) -> DataFrame:
    """A1: one row per key: ``sum(measure)``, sorted distinct labels joined by
    ``sep`` (``''`` when every label is NULL) and ``bool_or`` of each flag."""
    aggs = [
        F.sum(measure).alias(measure),
        F.concat_ws(sep, F.array_sort(F.collect_set(label_col))).alias(labels_out),
    ]
    aggs += [F.bool_or(f).alias(f) for f in flags]
    return df.groupBy(*keys).agg(*aggs)

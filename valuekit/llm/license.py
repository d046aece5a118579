"""Operator 3: license scan by diagonal voting, DataFrame functions only.

Every two consecutive words of a text are joined to the places where a
template holds the same two words (hash first, then the words themselves).
A hit at word ``pos`` for template place ``tpos`` votes for the diagonal
``pos - tpos``; diagonals are counted map-side first. Short phrases count as
found where one diagonal holds all their places, which is an exact match.
For longer notices each diagonal merges with those after it up to half the
template's length, so that inserted or lost words do no harm: the span then has
at most the template's word pairs plus half. It is verified by its share of
different template places. Copies that follow each other are spans of their own.

The broadcast side is the table of template places below: a fixed size.

Defined results: null texts are empty; a text of fewer than two words has no
hits; repeated rows each get their row (rows are told apart by their place in
the input); other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit.llm.common import read_table, text_or_empty

# The phrases that must be found, with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Opening words of common notices, at most 63 words each, with
# the labels this method adds.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit-notice",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache-notice",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl-notice",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-notice",
    "this source code form is subject to the terms of the mozilla public license": "mpl-notice",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc-notice",
    "this is free and unencumbered software released into the public domain": "unlicense-notice",
    "this work is licensed under a creative commons": "cc-notice",
    "all rights reserved": "all-rights-reserved",
}

#: Diagonals at most this share of a notice's word pairs apart merge.
MAX_DRIFT = 0.5
#: Share of a notice's word pairs that must be found.
MIN_COVERAGE = 0.6

NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_array(text: Column) -> Column:
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(lowered, NOT_A_WORD), "")


def template_places(spark: SparkSession, phrases: dict[str, str], notices: dict[str, str]) -> DataFrame:
    rows = []
    for is_phrase, templates in ((True, phrases), (False, notices)):
        for text, label in templates.items():
            words = text.split(" ")
            if not 2 <= len(words) <= 64:
                raise ValueError(f"a template has 2 to 64 words: {text!r}")
            rows += [(len(rows), is_phrase, label, text, len(words) - 1, i, f"{a} {b}")
                     for i, (a, b) in enumerate(zip(words, words[1:]))]
    return (spark.createDataFrame(rows, "n int, is_phrase boolean, label string, template string, n_pairs int, tpos int, t_pair string")
            .drop("n").withColumn("t_hash", F.xxhash64("t_pair")))


def diagonals(docs: DataFrame, places: DataFrame) -> DataFrame:
    """One row for each text, template and diagonal with hits, and one with
    null template for the text itself: rid, doc_id, n_words, is_phrase, label,
    template, n_pairs, diagonal, found (bit per template place), lo."""
    words = (docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
                         word_array(text_or_empty()).alias("words"))
             .withColumn("n_words", F.size("words").cast("long")))
    count = F.greatest(F.col("n_words").cast("int") - 1, F.lit(0))
    pairs = words.select("rid", "doc_id", "n_words", F.posexplode_outer(F.zip_with(
        F.slice("words", 1, count), F.slice("words", 2, count), lambda a, b: F.concat_ws(" ", a, b))).alias("pos", "pair"))
    hits = (pairs.withColumn("hash", F.xxhash64("pair"))
            .join(F.broadcast(places), (F.col("hash") == F.col("t_hash")) & (F.col("pair") == F.col("t_pair")), "left"))
    return (hits.groupBy("rid", "doc_id", "n_words", "is_phrase", "label", "template", "n_pairs",
                         (F.col("pos") - F.col("tpos")).alias("diagonal"))
            .agg(F.bit_or(F.when(F.col("tpos").isNotNull(), F.expr("shiftleft(1L, tpos)"))).alias("found"),
                 F.min(F.when(F.col("tpos").isNotNull(), F.col("pos"))).alias("lo")))


def license_scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES,
                 max_drift: float = MAX_DRIFT, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """One row per text: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score (1 where a phrase stands; else the largest
    share of a verified notice span; else 0)."""
    voted = diagonals(docs, template_places(docs.sparkSession, phrases, notices))
    # A template's diagonals in units of its length, so that one frame fits all.
    merged = voted.withColumn("n_merged", F.expr(f"""bit_count(bit_or(found) OVER (
        PARTITION BY rid, template ORDER BY diagonal / n_pairs RANGE BETWEEN CURRENT ROW AND {float(max_drift)}D FOLLOWING))"""))
    share = F.col("n_merged") / F.col("n_pairs")
    base = F.col("is_phrase") & (F.bit_count("found") == F.col("n_pairs"))
    notice = ~F.col("is_phrase") & (share >= min_coverage)
    joined = lambda cond: F.concat_ws(",", F.array_sort(F.collect_set(F.when(cond, F.col("label")))))
    return (merged.groupBy("rid", "doc_id", "n_words")
            .agg(F.coalesce(F.sum(F.when(base, 1)), F.lit(0)).cast("long").alias("n_base"),
                 F.min(F.when(base, F.col("lo"))).cast("long").alias("first_word"),
                 F.max(F.when(base, F.col("lo"))).cast("long").alias("last_word"),
                 joined(base).alias("base_labels"), joined(base | notice).alias("labels"),
                 F.coalesce(F.max(F.when(base, F.lit(1.0)).when(notice, share)), F.lit(0.0)).alias("score"))
            .drop("rid"))


def op3_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read_table(spark, sf_dir, "documents"))


def _values(templates: dict[str, str], is_phrase: bool) -> str:
    return ", ".join(f"({'TRUE' if is_phrase else 'FALSE'}, '{label}', '{text}')" for text, label in templates.items())


ORACLE_SQL = f"""
WITH templates(is_phrase, label, template) AS (VALUES {_values(PHRASES, True)}, {_values(NOTICES, False)}),
places AS (
  SELECT is_phrase, label, template, len(string_split(template, ' ')) - 1 AS n_pairs,
         unnest(range(0, len(string_split(template, ' ')) - 1)) AS tpos, string_split(template, ' ') AS tw FROM templates),
words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
pairs AS (SELECT doc_id, unnest(range(0, greatest(len(w) - 1, 0))) AS pos, w FROM words),
hits AS (
  SELECT doc_id, is_phrase, label, template, n_pairs, pos, tpos, pos - tpos AS diagonal
  FROM (SELECT doc_id, pos, w[pos + 1] AS a, w[pos + 2] AS b FROM pairs) p
  JOIN places ON a = tw[tpos + 1] AND b = tw[tpos + 2]),
diags AS (
  SELECT doc_id, is_phrase, label, template, n_pairs, diagonal, min(pos) AS lo, bit_or(1::BIGINT << tpos) AS found
  FROM hits GROUP BY ALL),
judged AS (
  SELECT *, is_phrase AND bit_count(found) = n_pairs AS base, bit_count(merged) / n_pairs AS share,
         NOT is_phrase AND bit_count(merged) / n_pairs >= {MIN_COVERAGE} AS notice
  FROM (SELECT *, bit_or(found) OVER (PARTITION BY doc_id, template ORDER BY diagonal / n_pairs
                                      RANGE BETWEEN CURRENT ROW AND {MAX_DRIFT}::DOUBLE FOLLOWING) AS merged FROM diags) d),
by_doc AS (
  SELECT doc_id, count(*) FILTER (WHERE base) AS n_base, min(lo) FILTER (WHERE base) AS first_word,
         max(lo) FILTER (WHERE base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base OR notice) AS labels,
         max(CASE WHEN base THEN 1.0::DOUBLE WHEN notice THEN share END) AS score
  FROM judged GROUP BY doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0)::DOUBLE AS score
FROM words w LEFT JOIN by_doc USING (doc_id)
"""

"""Operator 10: toxicity by a factorisation machine over hashed terms.

Every distinct lower-cased word of a text is one term; the factors learn pairs
of terms that a sum of single weights misses.

Defined results: null and empty texts are scored as texts without terms (the
base rate); any length is read whole; repeated rows each get their row; without
labelled rows every score is 0.5; other columns are carried or ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit.llm import fm
from valuekit.llm.common import WordHashes, byte_words, held_out, read_table, ship

ship(__name__)

THRESHOLD = 0.7


def term_features(text: str, words: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms; a word also counts without the marks around it."""
    found = {w.strip(b".,;:!?\"'()[]") for w in set(byte_words(text))}
    found.discard(b"")
    return np.sort(words.array(list(found))), np.zeros(0)


def toxicity_model(docs: DataFrame, labels: DataFrame) -> fm.Model:
    return fm.train(fm.training_rows(docs, labels, "toxic", ~held_out("doc_id", 3, 1)), term_features)


def score_toxicity(docs: DataFrame, model: fm.Model, *keep: str, **names) -> DataFrame:
    return fm.apply(docs, model, term_features, THRESHOLD, *keep, **names)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = score_toxicity(docs, toxicity_model(docs, read_table(spark, sf_dir, "labels")), "doc_id")
    return scored.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", "predicted")

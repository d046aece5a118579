"""Operator 7: quality classifier, a factorisation machine over hashed words,
structure statistics and metadata (the text's length).

Defined results: null and empty texts have no words and zero statistics and
are scored like any other; any length is read whole; repeated rows each get
their row; without labelled rows every score is 0.5; labels, lang, source and
doc_id are never read for a score.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit.llm import fm
from valuekit.llm.common import WordHashes, held_out, read_table, ship

ship(__name__)

THRESHOLD = 0.3

UPPER, LETTER, DIGIT, MARK, PIPE, SPACE = range(6)


def _classes() -> np.ndarray:
    table = np.zeros((6, 256), np.int32)
    table[UPPER, 65:91] = 1
    table[LETTER, 65:91] = table[LETTER, 97:123] = table[LETTER, 128:] = 1
    table[DIGIT, 48:58] = 1
    table[MARK, [ord(c) for c in "!#$%&*@^~=+<>{}\\_"]] = 1
    table[PIPE, ord("|")] = 1
    table[SPACE, [9, 11, 12, 13, 32]] = 1
    return table


def structure(data: bytes, hashes: np.ndarray) -> np.ndarray:
    """Statistics of the whole text and of its worst line. Lines are split at
    newlines; shares are by bytes; hashes: its words in order."""
    n, n_words = len(data), len(hashes)
    if n == 0 or n_words == 0:
        return np.zeros(20)
    table = kept_classes()
    raw = np.frombuffer(data, np.uint8)
    starts = np.concatenate([[0], np.flatnonzero(raw == 10) + 1])
    starts = starts[starts < n]
    length = np.diff(np.append(starts, n))
    per_line = np.stack([np.add.reduceat(table[c][raw], starts) for c in range(6)])
    total = per_line.sum(1)
    solid = np.maximum(length - per_line[SPACE], 1)
    long_lines = solid >= 12
    worst = lambda v: float(v[long_lines].max()) if long_lines.any() else 0.0
    same = hashes[1:] == hashes[:-1]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(np.int8), [0]])))
    run = int((edges[1::2] - edges[::2]).max()) if len(edges) else 0
    distinct, counts = np.unique(hashes, return_counts=True)
    lines = [x for x in data.split(b"\n") if x]
    return np.array([
        np.log1p(n), np.log1p(n_words), n / n_words,
        total[UPPER] / max(total[LETTER], 1), total[DIGIT] / n, total[MARK] / n, total[PIPE] / n,
        worst(per_line[UPPER] / np.maximum(per_line[LETTER], 1)), worst(per_line[DIGIT] / solid),
        worst(per_line[MARK] / solid), worst(per_line[PIPE] / solid),
        same.mean() if len(same) else 0.0, np.log1p(run), min(run / 5, 1.0),
        len(distinct) / n_words, counts.max() / n_words,
        len(set(lines)) / max(len(lines), 1), np.log1p(length.max()), np.log1p(total[MARK]), np.log1p(total[PIPE]),
    ])


_TABLE: list[np.ndarray] = []


def kept_classes() -> np.ndarray:
    if not _TABLE:
        _TABLE.append(_classes())
    return _TABLE[0]


def word_features(text: str, words: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    data = text.encode("utf-8", "surrogatepass")
    hashes = words.array(data.lower().split())
    return np.unique(hashes), structure(data, hashes)


def quality_model(docs: DataFrame, labels: DataFrame) -> fm.Model:
    return fm.train(fm.training_rows(docs, labels, "quality", ~held_out("doc_id", 5, 0)), word_features)


def score_quality(docs: DataFrame, model: fm.Model, *keep: str, **names) -> DataFrame:
    return fm.apply(docs, model, word_features, THRESHOLD, *keep, **names)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = score_quality(docs, quality_model(docs, read_table(spark, sf_dir, "labels")), "doc_id")
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")

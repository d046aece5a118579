"""Factorisation machine on hashed words and dense statistics.

score = sigmoid(b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j); the pair
sum is computed in linear time as half of (sum_i v_i x_i)^2 - sum_i (v_i x_i)^2,
added over the factors.

Training uses a bounded sample: at most ``max_rows`` labelled rows, those with
the smallest hash of doc_id. Their features are made on the executors, one
task fits the model on them, and the model (at most ``max_terms`` terms) is
the only thing that reaches the driver. Every document is scored whole.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from valuekit.llm.common import WordHashes, kept_in_process, ship

ship(__name__)

#: At most so many labelled rows are used for fitting.
MAX_ROWS = 20_000
#: At most so many hashed terms have weights: each seen in MIN_DOCS rows, and
#: tied to the label by a chi-square statistic of at least MIN_CHI2.
MAX_TERMS = 1 << 14
MIN_DOCS = 3
MIN_CHI2 = 15.0
RANK = 4
EPOCHS = 40
BATCH = 256
RATE = 0.15
DECAY = 1e-5

Features = Callable[[str, WordHashes], tuple[np.ndarray, np.ndarray]]


def training_rows(docs: DataFrame, labels: DataFrame, label: str, usable, max_rows: int = MAX_ROWS) -> DataFrame:
    """text, y of the bounded sample: of the documents with a label, those with
    the smallest hashes of doc_id and text, however often a doc_id repeats. Rows
    without doc_id or label take no part; a doc_id that is labelled twice counts
    twice."""
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & usable)
              .select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(max_rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    joined = texts.join(F.broadcast(chosen), "doc_id").withColumn("h", F.xxhash64("doc_id", "text"))
    return joined.orderBy("h", "doc_id", "y").limit(max_rows).select("text", "y")


class Model:
    def __init__(self, terms, mean, scale, bias, weight, factors):
        self.terms, self.mean, self.scale = terms, mean, scale  # terms: sorted hashes
        self.bias, self.weight, self.factors = bias, weight, factors

    def row(self, hashes: np.ndarray, dense: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Feature indexes and values: terms first, then the statistics."""
        n = len(self.terms)
        at = np.minimum(np.searchsorted(self.terms, hashes), max(n - 1, 0))
        at = at[self.terms[at] == hashes] if n else at[:0]
        values = np.clip((dense - self.mean) / self.scale, -4, 4)
        return (np.concatenate([at, n + np.arange(len(dense))]),
                np.concatenate([np.ones(len(at)), values]))

    def score(self, hashes: np.ndarray, dense: np.ndarray) -> float:
        at, x = self.row(hashes, dense)
        vx = self.factors[at] * x[:, None]
        z = self.bias + self.weight[at] @ x + 0.5 * float((vx.sum(0) ** 2 - (vx ** 2).sum(0)).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def telling_terms(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> np.ndarray:
    """The hashed terms that get weights, sorted."""
    if not rows:
        return np.zeros(0, np.uint64)
    seen, at = np.unique(np.concatenate([h for h, _ in rows]), return_inverse=True)
    n, n1 = len(y), y.sum()
    both = np.bincount(at, np.repeat(y, [len(h) for h, _ in rows]), len(seen))
    count = np.bincount(at, minlength=len(seen)).astype(float)
    spread = count * (n - count) * n1 * (n - n1)
    chi2 = n * (both * n - count * n1) ** 2 / np.maximum(spread, 1e-9)
    good = np.flatnonzero((count >= MIN_DOCS) & (chi2 >= MIN_CHI2))
    return seen[np.sort(good[np.argsort(-chi2[good], kind="stable")[:MAX_TERMS]])]


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, rank: int = RANK, epochs: int = EPOCHS,
        seed: int = 7) -> Model:
    """Minibatch AdaGrad on log loss, both classes of equal weight. Rows with no label of one class, or no
    rows at all, give a model that returns the (smoothed) base rate."""
    n_dense = len(rows[0][1]) if rows else 0
    terms = telling_terms(rows, y)
    dense = np.array([d for _, d in rows]).reshape(len(rows), n_dense)
    mean = dense.mean(0) if rows else np.zeros(n_dense)
    scale = np.where(dense.std(0) > 1e-9, dense.std(0), 1.0) if rows else np.ones(n_dense)
    size = len(terms) + n_dense
    rng = np.random.default_rng(seed)
    rate = (y.sum() + 1) / (len(y) + 2)
    model = Model(terms, mean, scale, float(np.log(rate / (1 - rate))), np.zeros(size),
                  rng.normal(0, 0.01, (size, rank)))
    if len(rows) == 0 or y.min() == y.max():
        model.factors[:] = 0
        return model
    model.bias = 0.0
    mass = np.where(y > 0.5, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    table = [model.row(h, d) for h, d in rows]
    g_bias, g_w, g_v = 1e-6, np.full(size, 1e-6), np.full((size, rank), 1e-6)
    for _ in range(epochs):
        order = rng.permutation(len(table))
        for lo in range(0, len(order), BATCH):
            batch = [table[i] for i in order[lo:lo + BATCH]]
            at, x = np.concatenate([b[0] for b in batch]), np.concatenate([b[1] for b in batch])
            row = np.repeat(np.arange(len(batch)), [len(b[0]) for b in batch])
            sums = lambda v: np.bincount(row, v, len(batch))
            v = model.factors[at]
            vx = v * x[:, None]
            s = np.stack([sums(vx[:, f]) for f in range(rank)], 1)
            z = model.bias + sums(model.weight[at] * x) + 0.5 * ((s ** 2).sum(1) - sums((vx ** 2).sum(1)))
            own = order[lo:lo + BATCH]
            err = mass[own] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[own])
            e = err[row] * x / len(batch)
            grad = np.bincount(at, e, size) + DECAY * model.weight
            g_w += grad ** 2
            model.weight -= RATE * grad / np.sqrt(g_w)
            for f in range(rank):
                grad = np.bincount(at, e * (s[row, f] - vx[:, f]), size) + DECAY * model.factors[:, f]
                g_v[:, f] += grad ** 2
                model.factors[:, f] -= 0.2 * RATE * grad / np.sqrt(g_v[:, f])
            grad = err.mean()
            g_bias += grad ** 2
            model.bias -= RATE * grad / np.sqrt(g_bias)
    return model


def train(rows: DataFrame, features: Features) -> Model:
    """Fit on ``rows`` (text, y): features on the executors, then one task."""
    def extract(batches):
        words = kept_in_process(("words",), WordHashes)
        for batch in batches:
            made = [features(t.as_py(), words) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([h.tobytes() for h, _ in made], pa.binary()),
                 pa.array([d.tobytes() for _, d in made], pa.binary()), batch.column(1)], ["h", "d", "y"])

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["h", "d", "y"])  # whatever order the rows arrive in
        made = [(np.frombuffer(h, np.uint64), np.frombuffer(d)) for h, d in zip(frame.h, frame.d)]
        model = fit(made, frame.y.to_numpy(float))
        return pd.DataFrame({"model": [pickle.dumps([model.terms, model.mean, model.scale, model.bias,
                                                     model.weight.astype(np.float32), model.factors.astype(np.float32)])]})

    made = rows.mapInArrow(extract, "h binary, d binary, y double")
    got = made.groupBy(F.lit("all").alias("g")).applyInPandas(solve, "model binary").collect()
    if got:
        return Model(*pickle.loads(got[0].model))
    probe = features("", WordHashes())[1]
    return fit([], np.zeros(0)) if not len(probe) else Model(
        np.zeros(0, np.uint64), np.zeros(len(probe)), np.ones(len(probe)), 0.0, np.zeros(len(probe)), np.zeros((len(probe), 1)))


def apply(docs: DataFrame, model: Model, features: Features, threshold: float, *keep: str,
          names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """``keep`` columns plus, under ``names``, the score and whether it reaches
    the threshold (1 or 0); one row per input row, whole texts, null texts as
    empty."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most MAX_TERMS terms
    schema = StructType([*(docs.schema[c] for c in keep), StructField(names[0], DoubleType()), StructField(names[1], IntegerType())])

    text = keep.index("text") if "text" in keep else len(keep)  # goes to Python once

    def run(batches):
        words, model = kept_in_process(("words",), WordHashes), sent.value
        for batch in batches:
            scores = np.array([model.score(*features(t.as_py() or "", words)) for t in batch.column(text)], float)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                                             [*keep, *names])

    return docs.select(*keep, *([] if "text" in keep else ["text"])).mapInArrow(run, schema)

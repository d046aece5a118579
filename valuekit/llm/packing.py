"""Operator 4: packing token sequences by non-negative least squares.

Every document becomes its ids and an end id, cut at multiples of the window
of 4,096; what is left is a piece of 1 to 4,095 ids. The histogram of piece
lengths (at most 4,096 numbers) is all that reaches the driver. There, shallow
combinations of at most three different lengths that fill a window exactly are
enumerated, non-negative least squares finds how often to repeat each so that
together they use up the histogram, the counts are rounded down to what is
there, and the rest goes round again with new combinations. Pieces that no
combination takes are packed greedily, best fit first, in groups.

A piece finds its place by its rank among the pieces of its length: its index
within its input partition plus the number of such pieces in earlier
partitions. No task holds all pieces of a length, however common it is.

Defined results: null and empty texts are the end id alone; a document that
exactly fills windows has no rest; texts of any length are tokenised whole;
repeated rows are documents of their own; other columns are ignored.
"""

from __future__ import annotations

import os
from collections import Counter
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from valuekit.llm.common import kept_in_process, read_table, ship, staged, text_or_empty

ship(__name__)

WINDOW = 4096
END_ID = 2
#: Combinations tried for each length in a round, and rounds at most.
PER_LENGTH = 3
ROUNDS = 12
STEPS = 400
GROUP = 5000


class WordIds(dict):
    """Word -> its ids as little-endian unsigned 32-bit bytes. Words are cut at
    ASCII white space, which the tokenizer drops and never reads across; new
    words are tokenised together. Texts with an added token are not cut."""

    def __init__(self, path: str, limit: int = 800_000):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.limit = limit

    def learn(self, words: set[bytes]) -> None:
        new = [w for w in words if w not in self]
        if len(self) + len(new) > self.limit:
            self.clear()
            new = list(words)
        for at in range(0, len(new), 2048):
            part = [w.decode("utf-8", "surrogatepass") for w in new[at:at + 2048]]
            encoded = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            first = np.cumsum([0, *(len(w) + 1 for w in part)])
            owner = np.searchsorted(first, [o[0] for o in encoded.offsets], "right") - 1
            cut = np.searchsorted(owner, np.arange(len(part) + 1)) * 4
            ids = np.array(encoded.ids, "<u4").tobytes()
            for i, w in enumerate(new[at:at + 2048]):
                self[w] = ids[cut[i]:cut[i + 1]]

    def text(self, text: str) -> bytes:
        if any(a in text for a in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        words, out = text.encode("utf-8", "surrogatepass").split(), []
        for at in range(0, len(words), 100_000):
            part = words[at:at + 100_000]
            self.learn(set(part))
            out.append(b"".join(map(self.__getitem__, part)))
        return b"".join(out)


def pieces_of(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, part, idx (index among the
    pieces of this length in this input partition)."""
    def run(batches):
        coder = kept_in_process(("word ids", path), lambda: WordIds(path))
        part, seen, end = TaskContext.get().partitionId(), Counter(), END_ID.to_bytes(4, "little")
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = coder.text(text.as_py()) + end
                n = len(ids) // 4
                for start in range(0, n, window):
                    length = min(window, n - start)
                    rows.append((doc_id, start, length, crc32(memoryview(ids)[4 * start:4 * (start + length)]), n, part, seen[length]))
                    seen[length] += 1
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(7)],
                                             ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "idx"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part long, idx long")


def combinations(left: np.ndarray, window: int, rng: np.random.Generator, per_length: int) -> list[dict[int, int]]:
    """Multisets of at most three lengths that fill the window exactly, each
    length present often enough in ``left``."""
    there = np.flatnonzero(left)
    chance = np.cumsum(left[there]) / left[there].sum()
    found = {}
    for first in there:
        most = min(int(left[first]), window // int(first))
        for _ in range(per_length * 6):
            a = int(rng.integers(1, most + 1))
            rest = window - a * int(first)
            second = int(there[min(int(np.searchsorted(chance, rng.random())), len(there) - 1)])
            b = 0 if rest < second else int(rng.integers(0, min(int(left[second]), rest // second) + 1))
            third = rest - b * second
            use = Counter({int(first): a})
            if b:
                use[second] += b
            if third:
                if third >= len(left) or not left[third]:
                    continue
                use[third] += 1
            if all(left[n] >= m for n, m in use.items()):
                found[tuple(sorted(use.items()))] = dict(use)
                if len(found) >= per_length * len(there):
                    return list(found.values())
    return list(found.values())


def least_squares(uses: list[dict[int, int]], left: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """x >= 0 that brings the lengths used by x repeats closest to ``left``, by
    accelerated projected gradient steps on length-scaled rows."""
    col = np.repeat(np.arange(len(uses)), [len(u) for u in uses])
    row = np.array([n for u in uses for n in u])
    val = np.array([m for u in uses for m in u.values()], float)
    scale = 1 / np.sqrt(np.maximum(left, 1))
    val, target = val * scale[row], left * scale
    apply = lambda x: np.bincount(row, val * x[col], len(left))
    back = lambda r: np.bincount(col, val * r[row], len(uses))
    v = np.ones(len(uses))
    for _ in range(20):
        v = back(apply(v))
        norm = np.linalg.norm(v)
        v /= norm
    x = y = np.zeros(len(uses))
    t = 1.0
    for _ in range(steps):
        nxt = np.maximum(y - back(apply(y) - target) / (1.05 * norm), 0)
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = nxt + (t - 1) / t_next * (nxt - x)
        x, t = nxt, t_next
    return x


def plan(histogram: np.ndarray, window: int = WINDOW) -> list[tuple[dict[int, int], int]]:
    """(combination, repeats) pairs that never use more than is there."""
    left = histogram.astype(np.int64).copy()
    out = []
    if left[window]:
        out.append(({window: 1}, int(left[window])))
        left[window] = 0
    rng = np.random.default_rng(4)
    for _ in range(ROUNDS):
        before = left.sum()
        if not before:
            break
        uses = combinations(left, window, rng, PER_LENGTH)
        if not uses:
            break
        x = least_squares(uses, left)
        taken = np.zeros(len(uses), np.int64)
        for pick in (np.floor(x), np.full(len(uses), np.inf)):  # rounded; then greedily what still fits
            for i in np.argsort(-x, kind="stable"):
                most = min(int(left[n]) // m for n, m in uses[i].items())
                k = int(min(most, pick[i]))
                if k:
                    taken[i] += k
                    for n, m in uses[i].items():
                        left[n] -= k * m
        out += [(uses[i], int(k)) for i, k in enumerate(taken) if k]
        if left.sum() > 0.98 * before:
            break
    return out


class Places:
    """Where the piece of a length and rank goes, from the plan."""

    def __init__(self, planned: list[tuple[dict[int, int], int]]):
        used, rows, sequence = Counter(), [], 0
        for uses, repeats in planned:
            offset = 0
            for n, m in uses.items():
                rows.append((n << 44 | used[n], used[n], used[n] + m * repeats, m, sequence, offset))
                used[n] += m * repeats
                offset += n * m
            sequence += repeats
        self.n_sequences = sequence
        self.taken = used
        rows.sort()
        self.key, self.lo, self.hi, self.m, self.sequence, self.offset = (
            np.array([r[i] for r in rows], np.int64) for i in range(6))

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """sequence (-1: none) and offset."""
        if not len(self.key):
            return np.full(len(length), -1), np.zeros(len(length), np.int64)
        at = np.maximum(np.searchsorted(self.key, length << 44 | rank, "right") - 1, 0)
        good = (self.key[at] >> 44 == length) & (rank < self.hi[at])
        step = rank - self.lo[at]
        return (np.where(good, self.sequence[at] + step // self.m[at], -1),
                np.where(good, self.offset[at] + step % self.m[at] * length, 0))


def best_fit(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, longest first into the fullest bin."""
    order = np.argsort(-lengths, kind="stable")
    open_bins: list[list[int]] = [[] for _ in range(window + 1)]  # by free space
    free = np.zeros(window + 1, bool)
    bins, offsets, n = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    for i in order:
        size = int(lengths[i])
        step = int(free[size:].argmax())
        if free[size + step]:
            space = size + step
            b = open_bins[space].pop()
            free[space] = bool(open_bins[space])
        else:
            b, space, n = n, window, n + 1
        bins[i], offsets[i] = b, window - space
        if space > size:
            open_bins[space - size].append(b)
            free[space - size] = True
    return bins, offsets


COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset. Sequences are gapless from offset 0."""
    pieces = staged(pieces_of(docs, path, window), "pieces")
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = np.zeros(window + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most one row for each length of a window
        histogram[r.length] = r.n
    places = Places(plan(histogram, window))
    rest = int(histogram.sum() - sum(places.taken.values()))
    groups = max(1, -(-rest // GROUP))
    before = counts.withColumn("before", F.sum("n").over(
        Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).fillna(0, ["before"]).drop("n")
    ranked = pieces.join(before, ["length", "part"]).select(*COLUMNS[:5], (F.col("before") + F.col("idx")).alias("rank"))

    def place(batches):
        for batch in batches:
            length, rank = batch.column(2).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = places.find(length, rank)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset), pa.array((rank + length) % groups)],
                                             [*COLUMNS, "g"])

    placed = staged(ranked.mapInArrow(place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, g long"), "placed")

    def pack_rest(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "start", "ids_crc32"], kind="stable")
        bins, offsets = best_fit(frame["length"].to_numpy(), window)
        frame["sequence_id"] = places.n_sequences + bins * groups + frame["g"]
        frame["offset"] = offsets
        return frame[COLUMNS]

    left = (placed.where("sequence_id < 0").groupBy("g")
            .applyInPandas(pack_rest, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"))
    return placed.where("sequence_id >= 0").select(*COLUMNS).union(left)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))

"""Operator 2: improbable-feature digests of documents.

A feature is a window of 32 bytes. Its entropy falls into one of 1,001 bins,
and the rarer a bin is in the corpus (counted over every window of every
document), the better the rank of its features; windows of very low entropy
have no rank. In each run of 32 consecutive features the best one, the
leftmost among equals, scores a point, and features with at least 8 points are
selected; texts of fewer than 128 features take runs of 8 and 2 points. They go into a chain of Bloom filters of 2,048 bits, five bits a
feature and at most 160 new features a filter.

Likeness of two digests: bits that two filters share, less what chance makes
them share, over the most they could share; each filter takes its best partner,
filters weigh by their features, and both directions are averaged.

Documents meet their next one (descending doc_id, ties by a hash of the text,
null doc_id last; the first after the last) by range: the range bounds are
percentiles of doc_id, each range is sorted in its task, and the first row of a
range is also sent to the range before it. Texts are shuffled once.

Defined results: null texts are empty; texts without a ranked feature have an
empty digest; two empty digests are alike (1), an empty and another one are not
(0); a text shorter than a window is one feature; a single document is its own
next; repeated rows are documents of their own; other columns are ignored.
"""

from __future__ import annotations

import base64
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit.llm.common import kept_in_process, mix, odd_multipliers, partitions_for, read_table, ship, text_or_empty
from valuekit.llm.substring import Powers, sliding_min

ship(__name__)

WINDOW = 32
#: (run length, least points) for texts with at least so many features.
RUNS = {128: (32, 8), 1: (8, 2)}
BINS = 1001
LEAST_BIN = 100
FILTER_BITS = 2048
FILTER_FEATURES = 160
HASHES = 5
BLOCK = 1 << 20
SCALE = 1 << 20


def _tables():
    c = np.arange(WINDOW + 1, dtype=np.float64)
    g = np.zeros(WINDOW + 1)
    g[1:] = c[1:] * np.log2(c[1:])
    g = np.round(g * SCALE).astype(np.int64)
    return {"step": np.concatenate([[0], np.diff(g)]), "g": g, "byte": mix(odd_multipliers(256, 11)),
            "powers": Powers(0x9E3779B97F4A7C15)}


def tables():
    return kept_in_process(("fingerprint",), _tables)


def entropy_bins(x: np.ndarray) -> np.ndarray:
    """Bin of every window of the bytes ``x`` (n - 63 of them), in exact
    integer arithmetic. Window sums slide: the count of the byte that leaves
    and of the one that enters give each change."""
    n = len(x)
    ahead, behind = np.ones(n, np.uint8), np.ones(n, np.uint8)  # equal bytes within the window, itself included
    for j in range(1, WINDOW):
        if j >= n:
            break
        same = (x[j:] == x[:-j]).view(np.uint8)
        ahead[:-j] += same
        behind[j:] += same
    t = tables()
    first = t["g"][np.bincount(x[:WINDOW], minlength=256)].sum()
    change = t["step"][behind[WINDOW:]] - t["step"][ahead[:n - WINDOW]]
    total = first + np.concatenate([np.zeros(1, np.int64), np.cumsum(change)])
    most = t["g"][WINDOW]
    return ((most - total) * (BINS - 1) // most).astype(np.int32)


def blocks(texts: list[bytes]):
    """Groups of texts of at most BLOCK bytes (or one longer text)."""
    group, size = [], 0
    for i, text in enumerate(texts):
        if group and size + len(text) > BLOCK:
            yield group
            group, size = [], 0
        group.append(i)
        size += len(text)
    if group:
        yield group


def histogram(texts: list[bytes]) -> np.ndarray:
    """Windows in each bin."""
    counts = np.zeros(BINS, np.int64)
    own = [t for t in texts if len(t) >= WINDOW]
    for group in blocks(own):
        x = np.frombuffer(b"".join(own[i] for i in group), np.uint8)
        bins = entropy_bins(x)
        inside = np.ones(len(x), bool)
        for end in np.cumsum([len(own[i]) for i in group]):
            inside[end - WINDOW + 1:end] = False
        counts += np.bincount(bins[inside[:len(bins)]], minlength=BINS)
    return counts


def ranks(counts: np.ndarray) -> np.ndarray:
    """Rank of each bin, 0 the rarest; ties to the higher entropy. Bins below
    LEAST_BIN and bins never seen get the last rank, BINS: never selected."""
    rank = np.full(BINS, BINS, np.int64)
    usable = np.flatnonzero((counts > 0) & (np.arange(BINS) >= LEAST_BIN))
    rank[usable[np.lexsort((-usable, counts[usable]))]] = np.arange(len(usable))
    return rank


def select(texts: list[bytes], rank: np.ndarray) -> list[np.ndarray]:
    """Hashes of each text's selected features, in order, each once."""
    out: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(texts)
    t = tables()
    for group in blocks(texts):
        long = [i for i in group if len(texts[i]) >= WINDOW]
        for i in group:
            if 0 < len(texts[i]) < WINDOW:
                x = np.frombuffer(texts[i], np.uint8)
                out[i] = mix((t["byte"][x] * t["powers"].grown(len(x))[0][:len(x)]).sum(keepdims=True, dtype=np.uint64))
        if not long:
            continue
        x = np.frombuffer(b"".join(texts[i] for i in long), np.uint8)
        ends = np.cumsum([len(texts[i]) for i in long])
        starts = np.concatenate([[0], ends[:-1]])
        up, down = t["powers"].grown(len(x) + 1)
        rolled = np.concatenate([np.zeros(1, np.uint64), np.cumsum(t["byte"][x] * up[:len(x)], dtype=np.uint64)])
        order = rank[entropy_bins(x)]
        key = (order << 40) | np.arange(len(order))
        points = {}
        for run, least in RUNS.values():
            points[run] = np.zeros(len(x), np.int32)
            if len(key) >= run:
                best = sliding_min(key, run)
                inside = np.zeros(len(x) + 1, np.int32)
                many = ends - starts >= WINDOW + run - 1
                np.add.at(inside, starts[many], 1)
                np.add.at(inside, ends[many] - (WINDOW + run - 2), -1)
                best = best[np.cumsum(inside)[:len(best)] > 0]
                points[run] = np.bincount(best[(best >> 40) < BINS] & ((1 << 40) - 1), minlength=len(x))
        for i, lo, hi in zip(long, starts, ends):
            last = hi - WINDOW + 1
            run, least = next(v for n, v in RUNS.items() if last - lo >= n)
            if last - lo < run:  # not even one run: the best feature, if it has a rank
                at = np.array([lo + int(key[lo:last].argmin())])
                at = at[order[at] < BINS]
            else:
                at = lo + np.flatnonzero(points[run][lo:last] >= least)
            h = mix((rolled[at + WINDOW] - rolled[at]) * down[at])
            _, where = np.unique(h, return_index=True)
            out[i] = h[np.sort(where)]
    return out


Digest = tuple[np.ndarray, np.ndarray]  # features of each filter; filters x bytes


def chain(hashes: np.ndarray) -> Digest:
    n = -(-len(hashes) // FILTER_FEATURES)
    bits = np.zeros((n, FILTER_BITS), np.uint8)
    own = np.arange(len(hashes)) // FILTER_FEATURES
    for j in range(HASHES):
        bits[own, (hashes >> np.uint64(11 * j)) & np.uint64(FILTER_BITS - 1)] = 1
    return np.bincount(own, minlength=n), bits


def as_text(digest: Digest) -> str:
    counts, bits = digest
    return ".".join(f"{c}:{base64.b64encode(np.packbits(b).tobytes()).decode()}" for c, b in zip(counts, bits))


def likeness(a: Digest, b: Digest) -> float:
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    fa, fb = a[1].astype(np.float32), b[1].astype(np.float32)
    shared = (fa @ fb.T).astype(np.float64)
    miss = (1 - 1 / FILTER_BITS) ** HASHES
    chance = FILTER_BITS * np.outer(1 - miss ** a[0], 1 - miss ** b[0])
    most = np.minimum.outer(fa.sum(1), fb.sum(1)).astype(np.float64)
    score = np.clip((shared - chance) / np.maximum(most - chance, 1e-9), 0, 1)
    return float(min(1.0, (score.max(1) @ a[0] / a[0].sum() + score.max(0) @ b[0] / b[0].sum()) / 2))


def corpus_ranks(docs: DataFrame) -> np.ndarray:
    """Ranks from the windows of all documents; the counts are 1,001 numbers."""
    def run(batches):
        counts = np.zeros(BINS, np.int64)
        for batch in batches:
            counts += histogram([t.as_py().encode("utf-8", "surrogatepass") for t in batch.column(0)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BINS, dtype=np.int32)), pa.array(counts)], ["bin", "n"])

    got = docs.select(text_or_empty().alias("text")).mapInArrow(run, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(BINS, np.int64)
    for r in got:
        counts[r.bin] = r.n
    return ranks(counts)


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
LAST = -(1 << 63)


def with_next(docs: DataFrame, n_ranges: int) -> DataFrame:
    """The documents dealt into sorted ranges: pid, guest, doc_id, text. A guest
    is the row that follows the range's last one."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.withColumn("o", F.coalesce("doc_id", F.lit(LAST)))
    shares = [i / n_ranges for i in range(1, n_ranges)]
    bounds = sorted(set(rows.select(F.percentile_approx("o", shares, 10_000)).first()[0] or []), reverse=True) if shares else []
    pid = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]).cast("array<long>"), lambda b: b > F.col("o"))) if bounds else F.lit(0)
    rows = rows.withColumn("pid", pid).withColumn("h", F.xxhash64("text"))
    firsts = sorted((r.pid, -r.m.neg, r.m.h) for r in rows.groupBy("pid").agg(
        F.min(F.struct((-F.greatest("o", F.lit(LAST + 1))).alias("neg"), "h")).alias("m")).collect())  # one row a range
    guests = [(firsts[i - 1][0], o, h) for i, (_, o, h) in enumerate(firsts)]
    marks = rows.sparkSession.createDataFrame(guests, "to int, go long, gh long")  # one row a range
    rows = rows.join(F.broadcast(marks), (F.greatest("o", F.lit(LAST + 1)) == F.col("go")) & (F.col("h") == F.col("gh")), "left")
    own = F.struct(F.col("pid").cast("int").alias("pid"), F.lit(0).alias("guest"))
    copies = F.when(F.col("to").isNotNull(), F.array(own, F.struct(F.col("to").alias("pid"), F.lit(1).alias("guest")))).otherwise(F.array(own))
    dealt = rows.withColumn("copy", F.explode(copies)).select("copy.pid", "copy.guest", "doc_id", "o", "h", "text")
    return (dealt.repartition(n_ranges, "pid").sortWithinPartitions("pid", "guest", F.desc("o"), "h")
            .select("pid", "guest", "doc_id", "text"))


def fingerprints(docs: DataFrame) -> DataFrame:
    rank = corpus_ranks(docs)

    def digest_all(rows: list[tuple]):
        """Results for rows[:-1]; the last is only a neighbour."""
        texts = [r[3] for r in rows]
        edited = [a[:len(a) - len(a) // 3] + b[:len(a) // 3] for a, b in zip(texts, texts[1:])]
        data = [t.encode("utf-8", "surrogatepass") for t in texts + edited]
        chains = [chain(h) for h in select(data, rank)]
        own, changed = chains[:len(texts)], chains[len(texts):]
        for i, r in enumerate(rows[:-1]):
            yield (r[2], len(texts[i]), sha256(data[len(texts) + i]).hexdigest(), as_text(own[i]), as_text(changed[i]),
                   likeness(own[i], changed[i]), likeness(own[i], own[i + 1]))

    def batched(rows: list[tuple]):
        out = list(digest_all(rows))
        return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], kind) for i, kind in enumerate(
            (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()))],
            [f.split()[0] for f in SCHEMA.split(", ")])

    def run(batches):
        held, size, done = [], 0, False  # rows of one range; done: its guest has come
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[-1][0] != row[0]:
                    held, size, done = [], 0, False  # the guest closed the range before
                if done:
                    continue
                held.append(row)
                size += len(row[3])
                done = bool(row[1])
                if done or size > BLOCK // 2:
                    if len(held) > 1:
                        yield batched(held)
                    held, size = held[-1:], len(row[3])

    return with_next(docs, partitions_for(docs.sparkSession)).mapInArrow(run, SCHEMA)


def op2_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read_table(spark, sf_dir, "documents"))

"""Operator 9: hierarchical Pitman-Yor language model.

Restaurants form a tree: each word before has its own, those of one class of
words share one of 16, these share four parents, these share the restaurant of
single words, and that one has the uniform base over the known words and one
unknown. Customers are the training tokens; each table of a restaurant is a
customer of its parent. Gibbs sweeps resample the tables of every word in every
restaurant given the parent's predictive probability and the restaurants'
totals; probabilities are averaged over the sweeps after the first ones.
Discounts come from the counts of words seen once and twice.

Data flow: documents are read once into chunks of about CHUNK characters, each
with its distinct words. Chunks ask for their distinct pairs only. Pairs are
dealt by the hash of the word and packed, so a pair that is everywhere is one
entry of a chunk, not one of a token. All seatings of a word depend on other
words only through the restaurants' totals: those of the words before are summed
by hash range between rounds and sent to the parts that have the word, the
others (52 numbers) are summed on the driver. Answers go back to their chunk,
where the documents are scored.

The base score takes exact counts from the same answers.

Defined results: null, empty and all-blank texts are the end token alone; a
null doc_id counts as the empty text for the fold; repeated rows are documents
of their own and each count; without training rows every probability is the
base's; other columns are ignored.
"""

from __future__ import annotations

import zlib
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit.llm.common import WordHashes, byte_words, deleted_at_exit, dropped, held_out, kept_in_process, partitions_for, read_table, ship, staged, text_or_empty
from valuekit.session import scratch_path

ship(__name__)

CHUNK = 16_000_000
FINE, COARSE = 16, 4
START = FINE - 1
STRENGTH = 1.0
ROUNDS = 3
BURN_IN, SAMPLES = 2, 3
EXACT = 48  # customers seated one by one; later ones in growing blocks

# Totals of the restaurants, summed over all words.
C2, T2 = slice(0, FINE), slice(FINE, 2 * FINE)
C1, T1 = slice(2 * FINE, 2 * FINE + COARSE), slice(2 * FINE + COARSE, 2 * FINE + 2 * COARSE)
C0, T0 = 2 * FINE + 2 * COARSE, 2 * FINE + 2 * COARSE + 1
VOCABULARY, TOKENS = T0 + 1, T0 + 2
ONCE, TWICE = slice(T0 + 3, T0 + 6), slice(T0 + 6, T0 + 9)  # by level: fine, coarse, single words
N_TOTALS = T0 + 9
PAIRS_ONCE, PAIRS_TWICE = N_TOTALS, N_TOTALS + 1
N_SUMS = N_TOTALS + 2


class Contexts(dict):
    """word -> class of it as the word before: a hash of its last two bytes."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 400_000:
            self.clear()
        self[word] = c = crc32(word[-2:]) % START
        return c


def packed(a: np.ndarray) -> bytes:
    """Compressed, all first bytes of the numbers before all second ones."""
    return zlib.compress(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes(), 1)


def unpacked(blob: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(blob), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def steps(a: np.ndarray) -> bytes:
    """Packed differences of unsigned numbers that mostly ascend."""
    return packed(np.diff(a, prepend=a.dtype.type(0)))


def unstepped(blob: bytes, kind) -> np.ndarray:
    return np.cumsum(unpacked(blob, kind), dtype=kind)


def ranges(ids: np.ndarray, parts: int) -> np.ndarray:
    """Where each hash range of the sorted ids begins, and the end."""
    part = ((ids >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    return np.searchsorted(part, np.arange(parts + 1))


def chunk_rows(docs: DataFrame, chunk_chars: int) -> DataFrame:
    """One row a chunk: ids, held-out marks and token ends of its documents,
    its distinct words (hashes with the word's class in the last four bits) and
    its tokens (as places in the sorted words)."""
    def close(seq: int, ids, held, tokens, ends):
        words, at = np.unique(np.concatenate(tokens), return_inverse=True)
        chunk = TaskContext.get().partitionId() << 32 | seq
        columns = [[chunk], [ids], [held], [np.array(ends, np.int64).tobytes()], [packed(at.astype(np.uint32))], [steps(words)]]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), *[pa.binary()] * 3]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                          ["chunk", "ids", "held", "ends", "tokens", "words"])

    def run(batches):
        hashes, classes = kept_in_process(("words",), WordHashes), kept_in_process(("contexts",), Contexts)
        seq, size, ids, held, tokens, ends = 0, 0, [], [], [], []
        for batch in batches:
            for doc_id, out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                words = byte_words(text.as_py())
                ids.append(doc_id)
                held.append(out)
                own = np.fromiter([*map(classes.__getitem__, words), START], np.uint64, len(words) + 1)
                tokens.append(hashes.array([*words, b""]) & ~np.uint64(FINE - 1) | own)  # no word is empty: this is the end token
                ends.append((ends[-1] if ends else 0) + len(words) + 1)
                size += len(text.as_py()) + 100
                if size >= chunk_chars:
                    yield close(seq, ids, held, tokens, ends)
                    seq, size, ids, held, tokens, ends = seq + 1, 0, [], [], [], []
        if ids:
            yield close(seq, ids, held, tokens, ends)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id", 7, 2).alias("held"), text_or_empty().alias("text"))
            .mapInArrow(run, "chunk long, ids array<long>, held array<boolean>, ends binary, tokens binary, words binary"))


def pairs_of(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct (word << 32 | word before) of a chunk, and the place of
    each token in them. The word before a document's first one is the end token."""
    before = np.concatenate([tokens[-1:], tokens[:-1]])  # a chunk ends with an end token, as every document does
    return np.unique(tokens.astype(np.uint64) << np.uint64(32) | before, return_inverse=True)


LOW = np.uint64(0xFFFFFFFF)


def requests(chunks: DataFrame, parts: int) -> DataFrame:
    """p, chunk, words, per, us, who, counts: each chunk's words dealt by hash
    range, with the words that stand before them (``who``: places in ``us``;
    ``per``: how many for each word) and the training counts of the pairs."""
    def run(batches):
        for batch in batches:
            for chunk, held, ends, tokens, words in zip(*(c.to_pylist() for c in batch.columns)):
                words, tokens = unstepped(words, np.uint64), unpacked(tokens, np.uint32)
                keys, at = pairs_of(tokens)
                train = np.repeat(~np.array(held), np.diff([0, *np.frombuffer(ends, np.int64)]))
                counts = np.bincount(at[train], minlength=len(keys)).astype(np.uint32)
                word, before = (keys >> np.uint64(32)).astype(np.int64), (keys & LOW).astype(np.int64)
                cut = ranges(words, parts)
                pair = np.searchsorted(word, cut)
                rows = []
                for p in np.flatnonzero(np.diff(cut)):
                    a, b, lo, hi = cut[p], cut[p + 1], pair[p], pair[p + 1]
                    there = np.zeros(len(words), bool)
                    there[before[lo:hi]] = True
                    place = np.cumsum(there) - 1
                    rows.append((int(p), chunk, steps(words[a:b]), packed(np.bincount(word[lo:hi] - a).astype(np.uint32)), steps(words[there]),
                                 steps(place[before[lo:hi]].astype(np.uint32)), packed(counts[lo:hi])))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64() if i < 2 else pa.binary()) for i in range(7)],
                                                 ["p", "chunk", "words", "per", "us", "who", "counts"])

    return chunks.select("chunk", "held", "ends", "tokens", "words").mapInArrow(
        run, "p long, chunk long, words binary, per binary, us binary, who binary, counts binary")


def seat(customers: np.ndarray, new: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables after seating each dish's customers: the next one opens a table
    with odds ``new`` to (seated - discount * tables)."""
    flat, a = customers.ravel(), new.ravel()
    tables = (flat > 0).astype(np.int64)
    active, n = np.flatnonzero(flat > 1), 1
    while len(active):
        block = 1 if n < EXACT else n // 4
        many = np.minimum(block, flat[active] - n)
        p = np.clip(a[active] / (a[active] + n - discount * tables[active]), 0, 1)
        tables[active] += rng.random(len(active)) < p if block == 1 else rng.binomial(many, p)
        n += block
        active = active[flat[active] > n]
    return tables.reshape(customers.shape)


class Seating:
    """Table counts of the words of one part."""

    def __init__(self, counts: np.ndarray, totals: np.ndarray, seed: int):
        self.c2, self.totals = counts, totals
        self.t2 = (counts > 0).astype(np.int64)
        self.rng = np.random.default_rng(seed)
        self.up(lambda c: (c > 0).astype(np.int64))
        once, twice = totals[ONCE], totals[TWICE]
        self.d = np.clip(once / np.maximum(once + 2 * twice, 1), 0.1, 0.95)

    def up(self, tables0, tables1=None):
        self.c1 = self.t2.reshape(len(self.t2), COARSE, FINE // COARSE).sum(2)
        self.t1 = (tables1 or tables0)(self.c1)
        self.c0 = self.t1.sum(1)
        self.t0 = tables0(self.c0)

    def predictive(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        z, d = self.totals, self.d
        base = 1.0 / (z[VOCABULARY] + 1)
        p0 = (self.c0 - d[2] * self.t0 + (STRENGTH + d[2] * z[T0]) * base) / (STRENGTH + z[C0])
        p1 = (self.c1 - d[1] * self.t1 + (STRENGTH + d[1] * z[T1]) * p0[:, None]) / (STRENGTH + z[C1])
        above = np.repeat(p1, FINE // COARSE, axis=1)
        p2 = (self.c2 - d[0] * self.t2 + (STRENGTH + d[0] * z[T2]) * above) / (STRENGTH + z[C2])
        return p0, p1, p2

    def sweep(self) -> None:
        z, d = self.totals, self.d
        base = 1.0 / (z[VOCABULARY] + 1)
        p0, p1, _ = self.predictive()
        self.t2 = seat(self.c2, (STRENGTH + d[0] * z[T2]) * np.repeat(p1, FINE // COARSE, axis=1), d[0], self.rng)
        self.up(lambda c: seat(c, np.full(c.shape, (STRENGTH + d[2] * z[T0]) * base), d[2], self.rng),
                lambda c: seat(c, (STRENGTH + d[1] * z[T1]) * p0[:, None], d[1], self.rng))

    def sums(self) -> np.ndarray:
        out = np.zeros(N_TOTALS)
        out[C2], out[T2], out[C1], out[T1] = self.c2.sum(0), self.t2.sum(0), self.c1.sum(0), self.t1.sum(0)
        out[C0], out[T0] = self.c0.sum(), self.t0.sum()
        total = self.c2.sum(1)
        out[VOCABULARY], out[TOKENS] = (total > 0).sum(), total.sum()
        out[ONCE] = [(x == 1).sum() for x in (self.c2, self.c1, self.c0)]
        out[TWICE] = [(x == 2).sum() for x in (self.c2, self.c1, self.c0)]
        return out


class PairSeating:
    """Table counts of all pairs of one part: a restaurant for each word before,
    whose tables are the customers of its class's restaurant in ``above``."""

    def __init__(self, row, totals: np.ndarray, seed: int, heard: np.ndarray | None = None):
        per, us = unpacked(row.per, np.uint32), unstepped(row.us, np.uint64)
        self.n, self.who = len(per), unstepped(row.who, np.uint32)
        self.word = np.repeat(np.arange(self.n), per)
        self.cell = self.word * FINE + (us & np.uint64(FINE - 1)).astype(np.int64)[self.who]
        self.c3 = unpacked(row.counts, np.uint32).astype(np.int64)
        self.t3 = (self.c3 > 0).astype(np.int64)
        self.us, self.rng = us, np.random.default_rng([seed, 3])
        self.all_c, self.all_t = self.by_context() if heard is None else heard
        once, twice = totals[PAIRS_ONCE], totals[PAIRS_TWICE]
        self.d = float(np.clip(once / max(once + 2 * twice, 1), 0.1, 0.95))
        self.above = Seating(self.customers(), totals[:N_TOTALS], seed)

    def customers(self) -> np.ndarray:
        return np.bincount(self.cell, self.t3, self.n * FINE).astype(np.int64).reshape(-1, FINE)

    def by_context(self) -> np.ndarray:
        """Customers and tables of this part's words in each restaurant."""
        return np.stack([np.bincount(self.who, x, len(self.us)) for x in (self.c3, self.t3)])

    def new(self) -> np.ndarray:
        return (STRENGTH + self.d * self.all_t[self.who]) * self.above.predictive()[2].ravel()[self.cell]

    def predictive(self) -> np.ndarray:
        return (self.c3 - self.d * self.t3 + self.new()) / (STRENGTH + self.all_c[self.who])

    def sweep(self) -> None:
        self.t3 = seat(self.c3, self.new(), self.d, self.rng)
        self.above.c2 = self.customers()
        self.above.sweep()

    def seen(self) -> np.ndarray:
        return np.bincount(self.word, self.c3, self.n).astype(np.int64)

    def sums(self) -> np.ndarray:
        out, seen = np.zeros(N_SUMS), self.seen()
        out[:N_TOTALS] = self.above.sums()
        out[[PAIRS_ONCE, PAIRS_TWICE]] = (self.c3 == 1).sum(), (self.c3 == 2).sum()
        out[VOCABULARY], out[TOKENS] = (seen > 0).sum(), seen.sum()
        return out


def word_table(asked: DataFrame) -> DataFrame:
    """One row a part: its words, their pairs and training counts (as in
    ``requests``, over all chunks), and for each chunk the places of its pairs."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        words, us = ([unstepped(b, np.uint64) for b in frame[c]] for c in ("words", "us"))
        known, contexts = np.unique(np.concatenate(words)), np.unique(np.concatenate(us))
        keys = []
        for w, u, per, who in zip(words, us, frame.per, frame.who):
            word = np.repeat(np.searchsorted(known, w).astype(np.uint64), unpacked(per, np.uint32))
            keys.append(word << np.uint64(32) | np.searchsorted(contexts, u).astype(np.uint64)[unstepped(who, np.uint32)])
        ends = np.cumsum([len(x) for x in keys])
        keys, at = np.unique(np.concatenate(keys), return_inverse=True)
        counts = np.bincount(at, np.concatenate([unpacked(b, np.uint32) for b in frame.counts]), len(keys)).astype(np.uint32)
        per = np.bincount((keys >> np.uint64(32)).astype(np.int64), minlength=len(known)).astype(np.uint32)
        places = [steps(x.astype(np.uint32)) for x in np.split(at, ends[:-1])]
        return pd.DataFrame({"p": [int(frame.p.iloc[0])], "per": [packed(per)], "us": [steps(contexts)],
                             "who": [steps((keys & LOW).astype(np.uint32))], "counts": [packed(counts)],
                             "chunks": [frame.chunk.tolist()], "places": [places]})

    return asked.groupBy("p").applyInPandas(
        run, "p long, per binary, us binary, who binary, counts binary, chunks array<long>, places array<binary>")


def add_up(said: DataFrame) -> np.ndarray:
    row = said.agg(*[F.coalesce(F.sum(F.col("sums")[i]), F.lit(0.0)).alias(f"s{i}") for i in range(N_SUMS)]).first()
    return np.array(list(row), float)


def by_part(df: DataFrame, key: str, parts: int, name: str) -> DataFrame:
    """Written once into ``parts`` buckets of ``key`` in the shared folder: the
    rounds read the columns they need and do not deal them again."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    table = "buckets_" + path.rstrip("/").rsplit("/", 1)[-1].replace("-", "_")
    (df.write.bucketBy(parts, key).option("compression", "zstd").option("path", path)
     .format("parquet").saveAsTable(table))
    deleted_at_exit(spark, path)
    return spark.table(table)


def context_places(table: DataFrame, parts: int) -> DataFrame:
    """q, places: for each hash range of words before, the parts (p) that have
    some of them, and which of the range's words these are (at)."""
    def ask(frames):
        for frame in frames:
            for p, us in zip(frame.p, frame.us):
                us = unstepped(us, np.uint64)
                cut = ranges(us, parts)
                yield pd.DataFrame([(p, int(q), steps(us[cut[q]:cut[q + 1]])) for q in np.flatnonzero(np.diff(cut))], columns=["p", "q", "us"])

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        us = [unstepped(b, np.uint64) for b in frame.us]
        _, at = np.unique(np.concatenate(us), return_inverse=True)
        split = np.split(at.astype(np.uint32), np.cumsum([len(u) for u in us])[:-1])
        return pd.DataFrame({"q": [int(frame.q.iloc[0])], "p": [frame.p.tolist()], "at": [[steps(x) for x in split]]})

    return (table.select("p", "us").mapInPandas(ask, "p long, q long, us binary")
            .groupBy("q").applyInPandas(run, "q long, p array<long>, at array<binary>"))


SAID = "p long, sums array<double>, parts array<struct<q: long, n: binary>>"


def said_by(seating: PairSeating, p: int, parts: int) -> tuple:
    """What a part tells the others: sums, and customers and tables by context,
    dealt by hash range."""
    n, cut = seating.by_context().astype(np.int64), ranges(seating.us, parts)
    return p, seating.sums().tolist(), [{"q": int(q), "n": packed(n[:, cut[q]:cut[q + 1]])} for q in np.flatnonzero(np.diff(cut))]


def first_said(table: DataFrame, parts: int) -> DataFrame:
    def run(frames):
        for frame in frames:
            yield pd.DataFrame([said_by(PairSeating(row, np.ones(N_SUMS), 0), int(row.p), parts) for row in frame.itertuples()],
                               columns=["p", "sums", "parts"])

    return table.select("p", "per", "us", "who", "counts").mapInPandas(run, SAID)


def heard_of(said: DataFrame, places: DataFrame) -> DataFrame:
    """p, q, n: the totals of the contexts that part p has in range q."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        n = dict(zip(left.p, left.n))
        at = [unstepped(b, np.uint32) for b in right["at"].iloc[0]]
        own = np.concatenate([unpacked(n[p], np.int64).reshape(2, -1) for p in right.p.iloc[0]], axis=1)
        totals = np.stack([np.bincount(np.concatenate(at), x).astype(np.int64) for x in own])
        return pd.DataFrame({"p": right.p.iloc[0], "q": int(right.q.iloc[0]), "n": [packed(totals[:, x]) for x in at]})

    return (said.select("p", F.explode("parts").alias("x")).select("p", "x.q", "x.n").groupBy("q")
            .cogroup(places.groupBy("q")).applyInPandas(run, "p long, q long, n binary"))


def seating_of(left: pd.DataFrame, right: pd.DataFrame, totals: np.ndarray) -> PairSeating:
    heard = np.concatenate([unpacked(b, np.int64).reshape(2, -1) for b in right.sort_values("q").n], axis=1)
    return PairSeating(left.iloc[0], totals, int(left.p.iloc[0]), heard)


def resampled(table: DataFrame, heard: DataFrame, totals: np.ndarray, parts: int) -> DataFrame:
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        seating = seating_of(left, right, totals)
        for _ in range(BURN_IN):
            seating.sweep()
        return pd.DataFrame([said_by(seating, int(left.p.iloc[0]), parts)], columns=["p", "sums", "parts"])

    return table.select("p", "per", "us", "who", "counts").groupBy("p").cogroup(heard.groupBy("p")).applyInPandas(run, SAID)


def answers(table: DataFrame, heard: DataFrame, totals: np.ndarray) -> DataFrame:
    """chunk, p, logs (log10 of the averaged probability, by pair), seen
    (training count, by word): for every request, in its order."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        seating, mean, out = seating_of(left, right, totals), 0.0, []
        for i in range(BURN_IN + SAMPLES):
            seating.sweep()
            if i >= BURN_IN:
                mean = mean + seating.predictive() / SAMPLES
        logs, seen, p = np.log10(mean).astype(np.float32), seating.seen(), int(left.p.iloc[0])
        for chunk, places in zip(left.chunks.iloc[0], left.places.iloc[0]):
            at = unstepped(places, np.uint32)
            word = seating.word[at]
            first = np.concatenate([[True], word[1:] != word[:-1]])
            out.append((int(chunk), p, packed(logs[at]), packed(seen[word[first]])))
        return pd.DataFrame(out, columns=["chunk", "p", "logs", "seen"])

    return (table.groupBy("p").cogroup(heard.groupBy("p"))
            .applyInPandas(run, "chunk long, p long, logs binary, seen binary"))


SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scored(chunks: DataFrame, answered: DataFrame, totals: np.ndarray) -> DataFrame:
    n, v = int(totals[TOKENS]), int(totals[VOCABULARY])

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        row, right = left.iloc[0], right.sort_values("p")
        logs = np.concatenate([unpacked(b, np.float32) for b in right.logs]).astype(np.float64)
        seen = np.concatenate([unpacked(b, np.int64) for b in right.seen])
        token = unpacked(row.tokens, np.uint32)
        at = pairs_of(token)[1]
        ends = np.frombuffer(row.ends, np.int64)
        starts = np.concatenate([[0], ends[:-1]])
        by_doc = lambda x: np.add.reduceat(x, starts)
        return pd.DataFrame({"doc_id": pd.array(row.ids, "Int64"), "held_out": list(row.held), "n_tokens": ends - starts,
                             "n_known": by_doc((seen > 0).astype(np.int64)[token]), "train_tokens": n,
                             "base_score": by_doc(np.log10((seen + 1) / (n + v + 1))[token]), "score": by_doc(logs[at])})

    return (chunks.select("chunk", "ids", "held", "ends", "tokens").groupBy("chunk")
            .cogroup(answered.groupBy("chunk")).applyInPandas(run, SCHEMA))


def language_model_scores(docs: DataFrame, chunk_chars: int = CHUNK) -> DataFrame:
    """One row per document, see SCHEMA."""
    chunks = staged(chunk_rows(docs, chunk_chars), "chunks")
    parts = partitions_for(docs.sparkSession)
    table = by_part(word_table(requests(chunks, parts)), "p", parts, "words")
    places = by_part(context_places(table, parts), "q", parts, "places")
    said = staged(first_said(table, parts), "said")
    totals = add_up(said)
    exact = totals.copy()  # tokens and vocabulary do not depend on the seating
    for _ in range(ROUNDS):
        before, said = said, staged(resampled(table, heard_of(said, places), totals, parts), "said")
        totals = add_up(said)
        dropped(before)
    return scored(chunks, answers(table, heard_of(said, places), totals), exact)


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_scores(read_table(spark, sf_dir, "documents"))

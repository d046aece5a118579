"""Operator 1: nearest neighbours by shifted space-filling curves.

Largest inner product becomes smallest distance by the usual extra coordinate
(vectors scaled to the largest norm, queries to length 1). Each of several
orderings projects the vectors on a few random directions, shifts them and sorts
them along a Hilbert curve; Spark range-partitions the keys. A query meets the
rows in a window of neighbouring blocks of each ordering; the blocks' rows are
reranked by the exact inner product of the original vectors in double precision,
and the best of all windows are merged.

The window is a share of the rows. Vectors of 64 independent components have no
low-dimensional neighbourhoods, so a curve needs wide windows to reach a recall
of 0.9 (README has measured figures); vectors with structure can take a smaller
share. Blocks and query groups have fixed sizes, so no task grows with the table.

Equal vectors are one class that carries its smallest ids, as many as a result
can need, and each distinct vector is searched once.

Scale and centre of the projections come from at most SAMPLE rows (smallest hash
of vec_id); every row is indexed.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components take no part, nor do vectors of another length than the most common
one; rows without vec_id take no part; rows that repeat vec_id and vector count
once; ties go to the smaller vec_id; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from valuekit.llm.common import partitions_for, read_table, ship, staged

ship(__name__)

K = 20
EVERY = 20
ORDERINGS = 6
DIRECTIONS = 4
BITS = 12
WINDOW = 0.34
BLOCK = 1024
QUERY_GROUP = 4096
SAMPLE = 10_000


def hilbert_keys(grid: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of each row of integer coordinates below
    2^bits (the axes-to-transpose transform, all rows at once)."""
    x = grid.astype(np.uint64).T.copy()
    d, one = len(x), np.uint64(1)
    for level in range(bits - 1, 0, -1):
        bit, low = one << np.uint64(level), (one << np.uint64(level)) - one
        for i in range(d):
            turn = (x[i] & bit) > 0
            swap = np.where(turn, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turn, low, swap)
            if i:
                x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[d - 1] >> np.uint64(level)) & one > 0, (one << np.uint64(level)) - one, np.uint64(0))
    x ^= flip
    key = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << one) | ((x[i] >> np.uint64(level)) & one)
    return key


class Curves:
    """The orderings: directions, shifts and scales."""

    def __init__(self, sample: np.ndarray, largest: float, seed: int = 3):
        rng = np.random.default_rng(seed)
        width = sample.shape[1] + 1
        self.largest = largest
        self.directions = [np.linalg.qr(rng.normal(size=(width, min(DIRECTIONS, width))))[0] for _ in range(ORDERINGS)]
        lifted = self.lift(sample, False)
        self.centre = [(lifted @ d).mean(0) for d in self.directions]
        self.scale = [np.maximum((lifted @ d).std(0), 1e-9) for d in self.directions]
        self.shift = [rng.random(d.shape[1]) for d in self.directions]

    def lift(self, x: np.ndarray, as_query: bool) -> np.ndarray:
        norm = np.linalg.norm(x, axis=1)
        if as_query:
            return np.column_stack([x / norm[:, None], np.zeros(len(x))])
        return np.column_stack([x / self.largest, np.sqrt(np.maximum(1 - (norm / self.largest) ** 2, 0))])

    def keys(self, x: np.ndarray, as_query: bool) -> list[np.ndarray]:
        lifted, out = self.lift(x, as_query), []
        for d, centre, scale, shift in zip(self.directions, self.centre, self.scale, self.shift):
            unit = ((lifted @ d - centre) / scale + 4 + shift) / 9
            out.append(hilbert_keys((np.clip(unit, 0, 1 - 1e-9) * (1 << BITS)).astype(np.int64), BITS).view(np.int64))
        return out


def usable_vectors(table: DataFrame) -> DataFrame:
    """vec_id, v (array of double) of the rows that take part, each once."""
    v = F.col("embedding").cast("array<double>")
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and size(v) > 0")
    rows = rows.where("forall(v, x -> x is not null and abs(x) < double('infinity')) and exists(v, x -> x <> 0)")
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    return rows.where(F.size("v") == (common[0].n if common else 0)).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))


def entries(classes: DataFrame, curves: Curves) -> DataFrame:
    """One row per ordering and class, and one more where it is a query:
    o, key, c, is_query, ids, v (bytes)."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array(batch.column(1).to_pylist(), np.float64)
            asks, blobs = np.array(batch.column(3).to_pylist(), bool), [row.tobytes() for row in x]
            for as_query, chosen in ((False, np.arange(len(x))), (True, np.flatnonzero(asks))):
                if not len(chosen):
                    continue
                ids = pa.array([[] if as_query else i for i in batch.column(2).take(pa.array(chosen)).to_pylist()], pa.list_(pa.int64()))
                for o, key in enumerate(curves.keys(x[chosen], as_query)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(chosen), o, np.int32)), pa.array(key), batch.column(0).take(pa.array(chosen)),
                         pa.array(np.full(len(chosen), as_query)), ids, pa.array([blobs[i] for i in chosen], pa.binary())],
                        ["o", "key", "c", "is_query", "ids", "v"])

    return classes.select("c", "v", "ids", "asks").mapInArrow(
        run, "o int, key long, c long, is_query boolean, ids array<long>, v binary")


def ranked(rows: DataFrame, partitions: int) -> tuple[DataFrame, int]:
    """``rows`` with their place in the order of (o, key), and their number.
    Each task numbers its range; the ranges' sizes give the rest."""
    def number(batches):
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(np.arange(n, n + batch.num_rows))],
                [*batch.schema.names, "part", "idx"])
            n += batch.num_rows

    order = ("o", "key", "c", "is_query")
    numbered = staged(rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order).mapInArrow(
        number, "o int, key long, c long, is_query boolean, ids array<long>, v binary, part int, idx long"), "curves")
    sizes = {r.part: r["count"] for r in numbered.groupBy("part").count().collect()}  # one number a partition
    offset, total = {}, 0
    for part in sorted(sizes):
        offset[part] = total
        total += sizes[part]
    before = numbered.sparkSession.createDataFrame(list(offset.items()) or [(0, 0)], "part int, before long")
    return numbered.join(F.broadcast(before), "part").withColumn("rank", F.col("before") + F.col("idx")), total


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, ties to smaller ids, each id once."""
    order = np.lexsort((ids, -scores))
    _, first = np.unique(ids[order], return_index=True)
    return order[np.sort(first)[:k]]


def nearest(table: DataFrame, k: int = K, window: float = WINDOW) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by
    EVERY, its k nearest found."""
    spark = table.sparkSession
    rows = staged(usable_vectors(table).dropDuplicates(["vec_id", "v"]).withColumn("c", F.xxhash64("v")), "vectors")
    first = F.row_number().over(Window.partitionBy("c").orderBy("vec_id"))
    few = rows.withColumn("n", first).where(F.col("n") <= k + 1).drop("n")
    asks = rows.where(F.col("vec_id") % EVERY == 0).select("c").distinct().withColumn("asks", F.lit(True))
    classes = staged(few.groupBy("c").agg(F.min("v").alias("v"), F.array_sort(F.collect_list("vec_id")).alias("ids"))
                     .join(asks, "c", "left").withColumn("asks", F.coalesce("asks", F.lit(False))), "classes")
    sample = [r.v for r in classes.orderBy(F.xxhash64("c")).limit(SAMPLE).select("v").collect()]  # bounded
    schema = "query_id long, rank int, vec_id long, score double"
    if not sample:
        return spark.createDataFrame([], schema)
    largest = classes.select(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))).first()[0]
    curves = Curves(np.array(sample), largest)
    placed, total = ranked(entries(classes, curves), partitions_for(spark))
    each = max(1, total // ORDERINGS)  # entries of one ordering
    blocks = -(-each // BLOCK)
    radius = max(1, int(np.ceil(window / 2 * blocks)))
    groups = max(1, int(np.ceil(placed.where("is_query and o = 0").count() * min(1, (2 * radius + 1) / blocks) / QUERY_GROUP)))
    placed = placed.withColumn("block", F.least(F.floor((F.col("rank") - F.col("o") * each) / BLOCK), F.lit(blocks - 1)))
    start = F.greatest(F.lit(0), F.least(F.col("block") - radius, F.lit(blocks - 1 - 2 * radius)))
    own = lambda *names: [F.col(n).alias(n) for n in names]  # noqa: E731  the two sides come from one table
    asked = (placed.where("is_query").withColumn("g", F.pmod("c", F.lit(groups).cast("long")))
             .select(*own("o", "g", "c", "v"), F.explode(F.sequence(start, F.least(start + 2 * radius, F.lit(blocks - 1)))).alias("block")))
    there = placed.where("not is_query").select(*own("o", "block", "ids", "v"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("g"))

    def rerank(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(rows):
            x = np.array([np.frombuffer(b) for b in rows.v])
            ids, q_all = list(rows.ids), np.array([np.frombuffer(b) for b in queries.v])
            longest = np.sqrt((x * x).sum(1).max())
            for lo in range(0, len(q_all), 512):
                rough = q_all[lo:lo + 512] @ x.T
                take = min(len(x), k + 1)
                kth = -np.partition(-rough, take - 1, axis=1)[:, take - 1]
                for q, c, products, least in zip(q_all[lo:lo + 512], queries.c.iloc[lo:lo + 512], rough, kth):
                    # All that rounding cannot tell from the last one stay, so ties go by vec_id.
                    slack = 4 * len(q) * np.finfo(float).eps * np.sqrt(q @ q) * longest
                    at = np.flatnonzero(products >= least - slack)
                    exact = (x[at] * q).sum(1)
                    found = np.concatenate([ids[i] for i in at])
                    scores = np.repeat(exact, [len(ids[i]) for i in at])
                    keep = best(found, scores, k + 1)
                    out.append((c, found[keep].tolist(), scores[keep].tolist()))
        return pd.DataFrame(out, columns=["c", "ids", "scores"])

    found = (asked.groupBy("o", "block", "g").cogroup(there.groupBy("o", "block", "g"))
             .applyInPandas(rerank, "c long, ids array<long>, scores array<double>"))

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        ids, scores = np.concatenate(list(frame.ids)), np.concatenate(list(frame.scores))
        keep = best(ids, scores, k + 1)
        return pd.DataFrame({"c": [frame.c.iloc[0]], "ids": [ids[keep].tolist()], "scores": [scores[keep].tolist()]})

    merged = found.groupBy("c").applyInPandas(merge, "c long, ids array<long>, scores array<double>")
    queries = rows.where(F.col("vec_id") % EVERY == 0).select(F.col("vec_id").alias("query_id"), "c")
    hits = F.slice(F.filter(F.arrays_zip("ids", "scores"), lambda h: h["ids"] != F.col("query_id")), 1, k)
    return (queries.join(merged, "c").select("query_id", F.posexplode(hits).alias("at", "h"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("h.ids").alias("vec_id"), F.col("h.scores").alias("score")))


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"))

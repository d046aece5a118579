"""Ranks and running digests inside groups of any size.

A table is range-partitioned by (group, order) and sorted inside its
partitions, so a group may span many of them. Each task numbers its own run of
a group; one boundary row a partition says where the run of the next one goes
on. No group has to fit into one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuekit.llm.common import partitions_for, ship, staged

ship(__name__)

#: Odd bases of the two running sums, sum(term * base^rank) modulo 2^64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
WORD = 1 << 64


def signed(x: int) -> int:
    x %= WORD
    return x - WORD if x >= WORD >> 1 else x


def powers(base: int, n: int) -> np.ndarray:
    p = np.full(max(n, 1), base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


class Runs:
    """Numbers the rows of consecutive batches inside runs of equal keys."""

    def __init__(self, terms: int):
        self.last, self.count, self.runs, self.sums = None, 0, 0, [np.uint64(0)] * terms

    def number(self, key: pa.Array, terms: list[np.ndarray]):
        n = len(key)
        new = np.ones(n, bool)
        new[1:] = pc.not_equal(key.slice(1), key.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        new[0] = self.runs == 0 or key[0].as_py() != self.last
        at = np.arange(n)
        rank = at - np.maximum.accumulate(np.where(new, at, -self.count))
        run = np.cumsum(new) + self.runs
        out = []
        for j, t in enumerate(terms):
            scaled = t * powers(BASES[j], int(rank.max()) + 1)[rank]
            total = np.cumsum(scaled, dtype=np.uint64)
            start = np.maximum.accumulate(np.where(new, at, 0))
            before = np.where(run == self.runs, self.sums[j], np.uint64(0) - (total[start] - scaled[start]))
            total = total + before
            out.append((total, total - scaled))
            self.sums[j] = total[-1]
        head = run == 1
        self.last, self.count, self.runs = key[n - 1].as_py(), int(rank[-1]) + 1, int(run[-1])
        return rank, head, out


def ranked(df: DataFrame, key: str, order: list[str], keep: list[str], name: str, terms: tuple[str, ...] = ()) -> DataFrame:
    """``keep``, ``key`` (never null), rank (from 0, by ``order`` inside the
    key; rows equal in all of ``order`` in any order) and for each of ``terms``
    (long columns) t the running sums t_upto and t_before of t * base^rank."""
    spark = df.sparkSession
    keep = [c for c in keep if c != key]
    placed = (df.withColumn("row of input", F.monotonically_increasing_id())  # splits repeated rows between partitions
              .repartitionByRange(partitions_for(spark), key, *order, "row of input").sortWithinPartitions(key, *order)
              .select(key, *keep))
    sums = [f"{t}_{end}" for t in terms for end in ("upto", "before")]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema)
    schema = f"{columns}, rank long, head boolean, part int" + "".join(f", {s} long" for s in sums)
    names, n_terms = placed.columns, len(terms)
    at = [names.index(t) for t in terms]

    def number(batches):
        runs, part = Runs(n_terms), TaskContext.get().partitionId()
        for batch in batches:
            if batch.num_rows:
                rank, head, out = runs.number(batch.column(0), [batch.column(i).to_numpy().view(np.uint64) for i in at])
                made = [pa.array(rank, pa.int64()), pa.array(head), pa.array(np.full(len(rank), part, np.int32))]
                made += [pa.array(x.view(np.int64)) for pair in out for x in pair]
                yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*names, "rank", "head", "part", *sums])

    local = staged(placed.mapInArrow(number, schema), name)
    # one row a partition: its first key, and its last key with the length and sums of that key's run
    ends = local.groupBy("part").agg(F.min(key).alias("first"), F.max(F.struct(key, "rank", *[f"{t}_upto" for t in terms])).alias("last"))
    carried, moved = None, []
    for row in sorted(ends.collect(), key=lambda r: r["part"]):
        same = carried is not None and carried[0] == row["first"]
        if same:
            moved.append((row["part"], carried[1], *map(signed, carried[2])))
        last = list(row["last"])
        n, total = last[1] + 1, [x % WORD for x in last[2:]]
        if same and last[0] == row["first"]:  # all of the partition goes on with the run before it
            total = [(c + t * pow(b, carried[1], WORD)) % WORD for c, t, b in zip(carried[2], total, BASES)]
            n += carried[1]
        carried = (last[0], n, total)
    kept = [key, *keep]
    if not moved:
        return local.select(*kept, "rank", *sums)
    starts = spark.createDataFrame(moved, "part int, shift long" + "".join(f", {t}_shift long" for t in terms))
    joined = local.join(F.broadcast(starts), "part", "left").withColumn("shift", F.when(F.col("head"), F.coalesce("shift", F.lit(0))).otherwise(0))
    if not terms:
        return joined.select(*kept, (F.col("rank") + F.col("shift")).alias("rank"))
    known = {r[0]: r[1:] for r in moved}

    def shifted(batches):
        for batch in batches:
            cols = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            rank, head = cols["rank"].to_numpy(), cols["head"].to_numpy(zero_copy_only=False)
            made = {s: cols[s].to_numpy().view(np.uint64).copy() for s in sums}
            shift, part = cols["shift"].to_numpy(), cols["part"].to_numpy()
            for p in np.unique(part[head & (shift > 0)]).tolist():
                rows = head & (part == p)
                n, *totals = known[p]
                for j, t in enumerate(terms):
                    for end in ("upto", "before"):
                        s = made[f"{t}_{end}"]
                        s[rows] = s[rows] * np.uint64(pow(BASES[j], n, WORD)) + np.uint64(totals[j] % WORD)
            yield pa.RecordBatch.from_arrays([*(cols[c] for c in kept), pa.array(rank + shift), *(pa.array(made[s].view(np.int64)) for s in sums)],
                                             [*kept, "rank", *sums])

    return joined.select(*kept, "rank", "head", "part", "shift", *sums).mapInArrow(shifted, f"{columns}, rank long" + "".join(f", {s} long" for s in sums))

"""Operator 13: prefix trie of conversations, totals by time-forward processing.

A node is a distinct sequence of the first d turns. Each turn's row gets the
running digests of its sequence and of the one before it, which name its node
and the node's parent; a grouped count makes the nodes. Ranks and running
digests come from range partitions (``ranks``), so one conversation may hold any
share of the rows.

Totals of subtrees travel up the trie:

* a subtree with fewer than SHARD rows below a larger one is a shard's work. Its
  nodes come sorted by level, deepest first; each takes the messages of its
  children out of a priority queue and sends its own totals to its parent's
  place in the order. The queue spills sorted runs of messages to a task's
  temporary file when it is full, so a shard's memory is bounded;
* the totals of the shards' roots are combined by parent before they are
  shuffled, and the nodes above, at most (turns of a conversation) / SHARD for
  each row, are processed likewise, across shard roots;
* what only one conversation has below SHARD rows or more is a chain without
  copies: one leaf and nothing saved, so a very long conversation adds no work.

The members that end at a node are written in ascending order into pieces of a
few thousand ids by range partitions; one pass over a node's pieces makes the
digest, holding one piece at a time.

Digests of sequences are two 64-bit sums of turn hashes by powers of odd bases;
equal ones count as equal sequences.

Defined results: rows without conv_id belong to no conversation; equal turns are
ordered by role, then text; repeated rows are turns of their own; ``%`` keeps
the sign of a negative conv_id; a table without conversations has no nodes;
other columns are not read.
"""

from __future__ import annotations

import heapq
import struct
import tempfile
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit.llm.common import partitions_for, read_table, ship, staged
from valuekit.llm.ranks import BASES, WORD, ranked, signed

ship(__name__)

GROUP = 20
HEADS = 4
SHARD = 2048
#: Messages that a priority queue holds in memory.
QUEUE = 200_000
RUNS = 32
PIECE = 4096
TURN = "d long, k1 long, k2 long, p1 long, p2 long, w long"


class SpillingQueue:
    """A priority queue of (level, key, key, leaves, saved, children); when it
    holds more than ``limit`` messages it writes them out as a sorted run."""

    def __init__(self, limit: int = QUEUE):
        self.limit, self.heap, self.runs, self.made = limit, [], [], 0
        self.record = struct.Struct("<6q")

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.limit:
            if len(self.runs) == RUNS:  # one run of all, so few files are open
                self.runs = [self.written(heapq.merge(*(self.whole(first, messages) for first, _, messages in self.runs)))]
            heap, self.heap = sorted(self.heap), []
            heapq.heappush(self.runs, self.written(heap))

    def whole(self, first, messages):
        yield first
        yield from messages

    def written(self, messages) -> tuple:
        """A sorted run in a file of the task's own, gone with it."""
        run = tempfile.TemporaryFile()
        for m in messages:
            run.write(self.record.pack(*m))
        run.seek(0)
        rest, self.made = self.read(run), self.made + 1
        return next(rest), self.made, rest

    def read(self, run):
        while part := run.read(self.record.size * 4096):
            yield from self.record.iter_unpack(part)
        run.close()

    def take(self, key: tuple) -> tuple[int, int, int]:
        """The sums of all messages for ``key``."""
        leaves = saved = children = 0
        while self.heap and self.heap[0][:3] == key:
            _, _, _, a, b, c = heapq.heappop(self.heap)
            leaves, saved, children = leaves + a, saved + b, children + c
        while self.runs and self.runs[0][0][:3] == key:
            (_, _, _, a, b, c), i, messages = self.runs[0]
            leaves, saved, children = leaves + a, saved + b, children + c
            following = next(messages, None)
            if following is None:
                heapq.heappop(self.runs)
            else:
                heapq.heapreplace(self.runs, (following, i, messages))
        return leaves, saved, children


def time_forward(nodes: DataFrame, limit: int = QUEUE) -> DataFrame:
    """Totals of nodes (s1, s2: the shard's root; d, k1, k2, p1, p2, conv_id,
    n_convs, w and m_leaves, m_saved, m_children from below the shard), which
    come sorted by shard and level, deepest first."""
    schema = "s1 long, s2 long, d long, k1 long, k2 long, p1 long, p2 long, conv_id long, n_convs long, n_children long, n_leaves long, saved long"

    def run(batches):
        shard, queue = None, SpillingQueue(limit)
        for batch in batches:
            out = []
            for s1, s2, d, k1, k2, p1, p2, conv, n, w, leaves, saved, children in zip(*(c.to_pylist() for c in batch.columns)):
                if (s1, s2) != shard:
                    shard, queue = (s1, s2), SpillingQueue(limit)
                a, b, c = queue.take((-d, k1, k2))
                leaves, saved, children = leaves + a, saved + b + (n - 1) * w, children + c
                leaves = leaves or 1
                if (k1, k2) != shard and d:
                    queue.push((1 - d, p1, p2, leaves, saved, 1))
                out.append((s1, s2, d, k1, k2, p1, p2, conv, n, children, leaves, saved))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], [f.split()[0] for f in schema.split(", ")])

    return (nodes.select("s1", "s2", "d", "k1", "k2", "p1", "p2", "conv_id", "n_convs", "w", "m_leaves", "m_saved", "m_children")
            .sortWithinPartitions("s1", "s2", F.desc("d"), "k1", "k2").mapInArrow(run, schema))


def placed_turns(convs: DataFrame) -> DataFrame:
    """conv_id, rank, d1, d2, w and the running digests of the original turns."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    src = (convs.where(F.col("conv_id").isNotNull())
           .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
           .withColumns({"d1": F.xxhash64("role", "text"), "d2": F.xxhash64(F.lit(13), "role", "text"),
                         "w": F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long")}))
    return ranked(src, "conv_id", ["turn", "role", "text"], ["d1", "d2", "w"], "turns", terms=("d1", "d2"))


def rebuilding(rows: DataFrame) -> DataFrame:
    """Of each conversation: n (turns after rebuilding), taken (the turns of its
    group's first conversation, as nodes), h, move (places its own turns move),
    a1, a2 (what their running digests move by)."""
    heads = F.array_sort(F.collect_list(F.when(F.col("rank") < HEADS - 1, F.struct("rank", "d1", "d2", "w"))))
    convs = rows.groupBy("conv_id").agg((F.max("rank") + 1).alias("len"), heads.alias("own"))
    convs = convs.withColumn("first", F.col("conv_id") - F.col("conv_id") % GROUP)
    convs = staged(convs, "conversations")
    firsts = convs.where(F.col("conv_id") == F.col("first")).select("first", F.col("own").alias("given"))
    h = (F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % HEADS).cast("int")
    schema = f"conv_id long, n long, h long, move long, a1 long, a2 long, taken array<struct<{TURN.replace(' ', ':')}>>".replace(",:", ", ")

    def run(batches):
        for batch in batches:
            out = []
            for conv, length, own, given, h in zip(*(c.to_pylist() for c in batch.columns)):
                given, k, before = (given or [])[:h], [0, 0], [0, 0]
                taken = []
                for p, t in enumerate(given):
                    past = list(k)
                    k = [(x + t[name] * pow(b, p, WORD)) % WORD for x, name, b in zip(k, ("d1", "d2"), BASES)]
                    taken.append({"d": p + 1, "k1": signed(k[0]), "k2": signed(k[1]), "p1": signed(past[0]), "p2": signed(past[1]), "w": t["w"]})
                move = len(given) - h
                for p, t in enumerate(own[:h]):
                    before = [x + t[name] * pow(b, p, WORD) for x, name, b in zip(before, ("d1", "d2"), BASES)]
                a = [signed(x - y * pow(b, move, WORD)) for x, y, b in zip(k, before, BASES)]
                out.append({"conv_id": conv, "n": len(given) + max(length - h, 0), "h": h, "move": move, "a1": a[0], "a2": a[1], "taken": taken})
            if out:
                yield pa.RecordBatch.from_pylist(out, batch_schema)

    node = pa.struct([(c, pa.int64()) for c in ("d", "k1", "k2", "p1", "p2", "w")])
    batch_schema = pa.schema([(c, pa.int64()) for c in ("conv_id", "n", "h", "move", "a1", "a2")] + [("taken", pa.list_(node))])
    return convs.join(firsts, "first", "left").select("conv_id", "len", "own", "given", h.alias("h")).mapInArrow(run, schema)


def rebuilt_turns(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """conv_id, n and the node of every turn of the rebuilt conversations."""
    def run(batches):
        scale = [{m: np.uint64(pow(b, m, WORD)) for m in range(-HEADS, 1)} for b in BASES]
        for batch in batches:
            conv, n, rank, w, move, *rest = batch.columns
            u = [x.to_numpy().view(np.uint64) for x in rest]  # a1, a2, then upto and before of both digests
            m = move.to_numpy()
            keys = []
            for j in (0, 1):
                g = np.array([scale[j][x] for x in m.tolist()], np.uint64)
                keys.append(((u[j] + g * u[2 + 2 * j]).view(np.int64), (u[j] + g * u[3 + 2 * j]).view(np.int64)))
            yield pa.RecordBatch.from_arrays([conv, n, pa.array(rank.to_numpy() + m + 1), *(pa.array(keys[j][end]) for end in (0, 1) for j in (0, 1)), w],
                                             ["conv_id", "n", "d", "k1", "k2", "p1", "p2", "w"])

    own = (rows.join(convs.drop("taken"), "conv_id").where(F.col("rank") >= F.col("h"))
           .select("conv_id", "n", "rank", "w", "move", "a1", "a2", "d1_upto", "d1_before", "d2_upto", "d2_before")
           .mapInArrow(run, f"conv_id long, n long, {TURN}"))
    given = convs.select("conv_id", "n", F.explode("taken").alias("t")).select("conv_id", "n", "t.*")
    return own.unionByName(given)


def end_digests(ends: DataFrame) -> DataFrame:
    """k1, k2, ends_sha256: of the conversations (conv_id) that end at a node."""
    def pieces(batches):
        key, ids = None, []

        def close():
            return key[0], key[1], ids[0], ",".join(map(str, ids))

        for batch in batches:
            out = []
            for k1, k2, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if (k1, k2) != key or len(ids) == PIECE:
                    if ids:
                        out.append(close())
                    key, ids = (k1, k2), []
                ids.append(conv)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["k1", "k2", "at", "ids"])
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in close()], ["k1", "k2", "at", "ids"])

    def hashes(batches):
        key, h = None, None
        for batch in batches:
            out = []
            for k1, k2, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)):
                if (k1, k2) == key:
                    h.update(b"," + ids.as_py().encode())
                    continue
                if key:
                    out.append((*key, h.hexdigest()))
                key, h = (k1, k2), sha256(ids.as_py().encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["k1", "k2", "ends_sha256"])
        if key:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, h.hexdigest())], ["k1", "k2", "ends_sha256"])

    n = partitions_for(ends.sparkSession)
    made = (ends.select("k1", "k2", "conv_id").repartitionByRange(n, "k1", "k2", "conv_id").sortWithinPartitions("k1", "k2", "conv_id")
            .mapInArrow(pieces, "k1 long, k2 long, at long, ids string"))
    return (made.repartition(n, "k1", "k2").sortWithinPartitions("k1", "k2", "at")
            .mapInArrow(hashes, "k1 long, k2 long, ends_sha256 string"))


def prefix_trie(convs: DataFrame, shard: int = SHARD, limit: int = QUEUE) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    node = ["d", "k1", "k2"]
    rows = placed_turns(convs)
    plan = staged(rebuilding(rows), "rebuilding")
    turns = staged(rebuilt_turns(rows, plan), "rebuilt")
    nodes = turns.groupBy(*node).agg(F.min(F.struct("p1", "p2", "w")).alias("x"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
                                     F.sum(F.col("n") - F.col("d") + 1).alias("weight"))
    nodes = staged(nodes.select(*node, "x.p1", "x.p2", "x.w", "conv_id", "n_convs", "weight"), "nodes")
    root = plan.agg(F.lit(0).cast("long").alias("d"), F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"), F.lit(0).cast("long").alias("p1"),
                    F.lit(0).cast("long").alias("p2"), F.lit(0).cast("long").alias("w"), F.min("conv_id").alias("conv_id"),
                    F.count("*").alias("n_convs")).where("n_convs > 0")
    first_conv = root.first()
    if first_conv is None:
        return nodes.select("conv_id", F.col("d").alias("depth"), F.col("w").alias("parent_conv_id"), "n_convs", F.col("w").alias("n_children"),
                            F.col("w").alias("n_leaves"), F.col("w").alias("saved_tokens"), F.lit("").alias("ends_sha256"))
    nothing = {c: F.lit(0).cast("long") for c in ("m_leaves", "m_saved", "m_children")}
    large = F.col("weight") >= shard

    # the root of a small subtree, on each conversation's way the first node that is not large
    steps = turns.join(nodes.where(large).select(*node), node, "left_semi").groupBy("conv_id").agg(F.count("*").alias("large"))
    roots = (turns.select("conv_id", *node).join(steps, "conv_id", "left").where(F.col("d") == F.coalesce("large", F.lit(0)) + 1)
             .select("conv_id", F.col("k1").alias("s1"), F.col("k2").alias("s2")))
    small = nodes.where(~large).join(roots, "conv_id").withColumns(nothing).repartition(partitions_for(convs.sparkSession), "s1", "s2")
    small = staged(time_forward(small, limit), "small")

    chains = nodes.where(large & (F.col("n_convs") == 1))
    top = nodes.where(large & (F.col("n_convs") > 1)).drop("weight").unionByName(root)
    sent = (small.where((F.col("k1") == F.col("s1")) & (F.col("k2") == F.col("s2"))).select("d", "p1", "p2", "n_leaves", "saved")
            .union(chains.select("d", "p1", "p2", F.lit(1).cast("long"), F.lit(0).cast("long"))))
    sent = (sent.groupBy((F.col("d") - 1).alias("d"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
            .agg(F.sum("n_leaves").alias("m_leaves"), F.sum("saved").alias("m_saved"), F.count("*").alias("m_children")))
    top = top.join(sent, node, "left").fillna(0, ["m_leaves", "m_saved", "m_children"]).withColumns({"s1": F.lit(0).cast("long"), "s2": F.lit(0).cast("long")})
    top = time_forward(top.repartition(1), limit)
    done = ["d", "k1", "k2", "p1", "p2", "conv_id", "n_convs", "n_children", "n_leaves", "saved"]
    chains = chains.withColumns({"n_children": F.lit(1).cast("long"), "n_leaves": F.lit(1).cast("long"), "saved": F.lit(0).cast("long")})
    every = staged(small.select(*done).union(top.select(*done)).union(chains.select(*done)), "totals")

    ends = turns.where("d = n").select("k1", "k2", "conv_id").union(plan.where("n = 0").select(F.lit(0).cast("long"), F.lit(0).cast("long"), "conv_id"))
    labelled = every.join(staged(end_digests(ends), "ends"), ["k1", "k2"], "left")
    parents = every.where("d > 0").select((F.col("d") + 1).alias("d"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent"))
    parent = F.when(F.col("d") == 1, F.lit(first_conv["conv_id"])).otherwise(F.col("parent")).cast("long")
    # nodes right below the root need no join
    upper = labelled.where("d <= 1").withColumn("parent", F.lit(None).cast("long"))
    lower = labelled.where("d > 1").join(parents, ["d", "p1", "p2"], "left").select(*upper.columns)
    return (upper.union(lower)
            .select("conv_id", F.col("d").alias("depth"), parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest())).alias("ends_sha256")))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read_table(spark, sf_dir, "conversations"))


_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(str_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda a, b:
    list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""

ORACLE_SQL = f"""
WITH turns AS (
  SELECT conv_id AS c, md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS t,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS w,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, {_CRC} % 4 AS h FROM (SELECT DISTINCT c FROM turns)),
parts AS (
  SELECT convs.c, 0 AS part, i, t, w FROM convs JOIN turns ON turns.c = convs.c - convs.c % 20 WHERE i < h
  UNION ALL SELECT convs.c, 1, i, t, w FROM convs JOIN turns ON turns.c = convs.c WHERE i >= h),
paths AS (
  SELECT c, w, row_number() OVER p AS d, md5(string_agg(t, '') OVER (PARTITION BY c ORDER BY part, i ROWS UNBOUNDED PRECEDING)) AS k
  FROM parts WINDOW p AS (PARTITION BY c ORDER BY part, i)),
all_paths AS (SELECT c, w, d, k FROM paths UNION ALL SELECT c, 0, 0, '' FROM convs),
lengths AS (SELECT c, max(d) AS n FROM all_paths GROUP BY c),
nodes AS (SELECT d, k, min(c) AS conv_id, count(*) AS n_convs, any_value(w) AS w FROM all_paths GROUP BY d, k),
up AS (  -- every node with itself and the nodes above it, on the way of its smallest member
  SELECT n.d, n.k, n.conv_id, n.n_convs, n.w, a.d AS above_d, a.k AS above FROM nodes n JOIN all_paths a ON a.c = n.conv_id AND a.d <= n.d),
children AS (SELECT above AS k, above_d AS d, count(*) AS n_children FROM up WHERE above_d = d - 1 GROUP BY above, above_d),
totals AS (
  SELECT above AS k, above_d AS d, sum((n_convs - 1) * w)::BIGINT AS saved_tokens, count(*) FILTER (n_children IS NULL) AS n_leaves
  FROM (SELECT up.*, n_children FROM up LEFT JOIN children USING (k, d)) GROUP BY above, above_d),
ends AS (SELECT k, d, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS e FROM all_paths JOIN lengths USING (c) WHERE d = n GROUP BY k, d)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens,
       coalesce(e, sha256('')) AS ends_sha256
FROM nodes n JOIN totals USING (k, d) LEFT JOIN children USING (k, d) LEFT JOIN ends USING (k, d)
LEFT JOIN (SELECT up.k, up.d, x.conv_id FROM up JOIN nodes x ON x.k = above AND x.d = above_d WHERE above_d = up.d - 1) p USING (k, d)
"""

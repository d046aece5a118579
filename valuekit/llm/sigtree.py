"""Operator 11: Jaccard join of word n-grams by signature trees.

Documents with equal shingle sets form one class. A class has a signature: a
bitmap of 1,024 bits, one hash of each shingle. A tree's node holds the OR of
the bitmaps below it, the range of their set sizes, and the largest number of
shingles that a bitmap below it holds beyond its set bits (``loss``). What two
sets below two nodes can share is then at most

    min(loss, loss) + bits that both nodes have

and a pair of nodes whose bound does not reach the similarity for its smallest
sizes is pruned with all that is below it (dual traversal).

Where trees stand:

* forest: two sets can only be similar if they share one of their first
  n - ceil(s * n) + 1 shingles in an order common to all. Each such shingle that
  several classes of similar size share is a tree over these classes. The order
  puts shingles that are frequent in a sample last; the sample (SAMPLE rows,
  chosen by hash) only shapes the order, any order finds all pairs;
* what survives in the forest ties classes to groups, never to pairs of rows;
  the groups' connected components are the candidates;
* each component gets one more tree: blocks of classes by size are its nodes.
  Spark joins the nodes of neighbouring size bands and prunes them by the same
  bound; the remaining pairs of blocks are units. A unit first gets the counts
  of its classes: how many shingles of a set fall into each of n / 20 to n / 10
  buckets. Two sets share at most the sum of the smaller counts, which is far
  from their sizes also where all bits of a long set's bitmap are taken; only
  classes that some other class of the unit may be similar to stay. Then the
  unit gets their full sets, some 100 times as long, counts all intersections
  and returns a spanning star of each linked group.

A list of more than LONG classes is tied to its smallest class as it is, in
many tasks, without a tree; its blocks are pruned in the component's tree.

Exact: no link is lost, since all bounds are upper bounds; links are confirmed
on 64-bit hashes of the shingles. A component whose m classes are all alike
needs (m / BLOCK)^2 / 2 units.

Defined results: null, empty and all-blank texts have no shingles and link with
nothing; fewer words than a shingle form one shingle; rows that repeat a doc_id
are documents of their own; a component takes the smallest doc_id that is not
null; other columns are not read.
"""

from __future__ import annotations

import math
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from valuekit.llm.common import WordHashes, dropped, kept_in_process, partitions_for, read_table, ship, staged, text_or_empty
from valuekit.llm.components import components
from valuekit.llm.minhash import class_id, linked, sets_of, shingle_set

ship(__name__)

SHINGLE = 5
SIMILARITY = 0.8
#: The contract of the query op11_sigtree and its SQL.
QUERY_SHINGLE, QUERY_SIMILARITY = 4, 0.85
WORDS = 16  # of 64 bits in a bitmap
FANOUT = 8
BLOCK = 512
#: Shingles that a block may hold on average of its classes.
BLOCK_SHINGLES = 2_000_000
LONG = 4096
SAMPLE, SAMPLE_SHINGLES, FREQUENT = 4000, 4096, 8
_ONE = np.uint64(1)


def bitmap(shingles: np.ndarray) -> np.ndarray:
    out = np.zeros(WORDS, np.uint64)
    at = shingles & np.uint64(64 * WORDS - 1)
    np.bitwise_or.at(out, (at >> np.uint64(6)).astype(np.int64), _ONE << (at & np.uint64(63)))
    return out


def prefix_length(n: int, percent: int) -> int:
    return n + percent * -n // 100 + 1  # n - ceil(percent * n / 100) + 1


def need(a, b, percent: int):
    """Times (100 + percent): what sets of these sizes have to share."""
    return percent * (a + b)


class Tree:
    """Signature tree over classes sorted by size; level 0 are the classes."""

    def __init__(self, n: np.ndarray, bits: np.ndarray):
        self.levels = [(n, n, n - np.bitwise_count(bits).sum(1, dtype=np.int64), bits)]
        while len(self.levels[-1][0]) > 1:
            lo, hi, loss, bits = self.levels[-1]
            at = np.arange(0, len(lo), FANOUT)
            self.levels.append((lo[at], np.maximum.reduceat(hi, at), np.maximum.reduceat(loss, at), np.bitwise_or.reduceat(bits, at, axis=0)))

    def possible(self, level: int, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        """Which pairs of nodes may hold a pair that is similar enough."""
        lo, hi, loss, bits = self.levels[level]
        both = np.bitwise_count(bits[a] & bits[b]).sum(1, dtype=np.int64)
        most = np.minimum(np.minimum(loss[a], loss[b]) + both, np.minimum(hi[a], hi[b]))
        return ((100 + percent) * most >= need(lo[a], lo[b], percent)) & (100 * hi[a] >= percent * lo[b])


def similar_pairs(n: np.ndarray, rest: np.ndarray, most: np.ndarray, bits: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of classes (the smaller one first) may be similar enough."""
    x, y = bits[a], bits[b]
    loss = np.minimum(n[a] - np.bitwise_count(x).sum(1, dtype=np.int64), n[b] - np.bitwise_count(y).sum(1, dtype=np.int64))
    shared = np.minimum(loss + np.bitwise_count(x & y).sum(1, dtype=np.int64), np.minimum(rest[a], rest[b]))
    shared = np.minimum(shared, np.maximum(most[a], most[b]))
    return ((100 + percent) * shared >= need(n[a], n[b], percent)) & (100 * n[a] >= percent * n[b])


def groups(n: np.ndarray, rest: np.ndarray, most: np.ndarray, bits: np.ndarray, percent: int) -> np.ndarray:
    """A label for each class; classes that may be similar, by dual traversal,
    get one. ``rest``: what a class can share by the place of the shingle,
    ``most``: by its count of shared first shingles; of a pair, the larger holds."""
    tree, label = Tree(n, bits), np.arange(len(n))
    stack = [(len(tree.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, a, b = stack.pop()
        if len(a) > 4096:  # depth first, in parts: memory stays bounded
            stack.append((level, a[4096:], b[4096:]))
            a, b = a[:4096], b[:4096]
        if level:
            span = FANOUT ** level
            first, last = label[a * span], label[np.minimum((b + 1) * span, len(n)) - 1]
            whole = first == last  # perhaps one group already
            if whole.any():
                low, high = np.minimum.reduceat(label, np.arange(0, len(n), span)), np.maximum.reduceat(label, np.arange(0, len(n), span))
                whole &= (low[a] == high[a]) & (low[b] == high[b])
            a, b = a[~whole], b[~whole]
        else:
            apart = label[a] != label[b]
            a, b = a[apart], b[apart]
        if not len(a):
            continue
        keep = tree.possible(level, a, b, percent)
        a, b = a[keep], b[keep]
        if level == 0:
            keep = (100 + percent) * np.minimum(np.minimum(rest[a], rest[b]), np.maximum(most[a], most[b])) >= need(n[a], n[b], percent)
            for x, y in zip(a[keep].tolist(), b[keep].tolist()):
                p, q = label[x], label[y]
                if p != q:
                    label[label == max(p, q)] = min(p, q)
            continue
        size = len(tree.levels[level - 1][0])
        i, j = (x.ravel() for x in np.meshgrid(np.arange(FANOUT), np.arange(FANOUT), indexing="ij"))
        below_a, below_b = (a[:, None] * FANOUT + i).ravel(), (b[:, None] * FANOUT + j).ravel()
        keep = (below_a < size) & (below_b < size) & ((below_a < below_b) | ((below_a == below_b) & (level > 1)))
        stack.append((level - 1, below_a[keep], below_b[keep]))
    return label


def frequent_shingles(docs: DataFrame, k: int) -> np.ndarray:
    """Sorted hashes of the shingles that several rows of the sample share."""
    def run(batches):
        words = kept_in_process(("words",), WordHashes)
        for batch in batches:
            for text in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(text.as_py(), k, words)[:SAMPLE_SHINGLES].view(np.int64))], ["s"])

    sample = (docs.select(text_or_empty().alias("text"), F.xxhash64(F.col("doc_id").cast("long"), "text").alias("h")).orderBy("h").limit(SAMPLE)
              .select("text").repartition(partitions_for(docs.sparkSession)))
    found = sample.mapInArrow(run, "s long").groupBy("s").agg(F.count("*").alias("c")).where(F.col("c") >= FREQUENT).select("s")
    return np.sort(found.toPandas()["s"].to_numpy(np.int64).view(np.uint64))


def signatures(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, n, c (the class: a digest of the set), bits, first (the first
    shingles in the common order, 32 bits of each) and rare (how many of the
    set are not frequent)."""
    frequent = frequent_shingles(docs, k)

    def run(batches):
        words = kept_in_process(("words",), WordHashes)
        for batch in batches:
            out = []
            for text in batch.column(1):
                s = shingle_set(text.as_py(), k, words)
                if not len(s):
                    out.append((0, 0, [], [], 0))
                    continue
                at = np.minimum(np.searchsorted(frequent, s), max(len(frequent) - 1, 0))
                often = frequent[at] == s if len(frequent) else np.zeros(len(s), bool)
                first = np.concatenate([s[~often], s[often]])[:prefix_length(len(s), percent)]
                out.append((len(s), class_id(md5(s.tobytes()).digest()), bitmap(s).view(np.int64), (first >> np.uint64(32)).astype(np.uint32).view(np.int32),
                            len(s) - int(often.sum())))
            kinds = (pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds))],
                                             ["doc_id", "n", "c", "bits", "first", "rare"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
            .mapInArrow(run, "doc_id long, n int, c long, bits array<long>, first array<int>, rare int"))


def forest_ties(lists: DataFrame, percent: int) -> DataFrame:
    """u, v: ties of classes that may be similar, from rows (s, n, c, i, most,
    bits): the trees of the shingles s. ``most``: what a class can share at all."""
    def run(batches):
        held = None

        def tied(n, c, i, most, bits):
            label = groups(n, n - i, most, bits, percent) if len(n) > 1 else np.zeros(1, np.int64)
            away = label != np.arange(len(n))
            return c[away], c[label[away]]

        for batch in batches:
            cols = [batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.int64), batch.column(2).to_numpy(),
                    batch.column(3).to_numpy().astype(np.int64), batch.column(4).to_numpy(), batch.column(5).flatten().to_numpy().view(np.uint64).reshape(-1, WORDS)]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            s, rest = cols[0], cols[1:]
            edge = np.concatenate([[0], np.flatnonzero(s[1:] != s[:-1]) + 1, [len(s)]]) if len(s) else np.zeros(1, np.int64)
            a = edge[:-2][np.diff(edge[:-1]) == 2]  # lists of two classes, which most are, at once
            a = a[similar_pairs(rest[0], rest[0] - rest[2], rest[3], rest[4], a, a + 1, percent)] if len(a) else a
            u, v = [rest[1][a + 1]], [rest[1][a]]
            longer = np.flatnonzero(np.diff(edge[:-1]) > 2)
            for lo, hi in zip(edge[longer].tolist(), edge[longer + 1].tolist()):
                a, b = tied(*(x[lo:hi] for x in rest))
                u.append(a)
                v.append(b)
            lo = int(edge[-2]) if len(s) else 0
            while len(s) - lo > LONG:  # one list: a part of it is tied to the row that goes on
                c = rest[1][lo:lo + LONG]
                u.append(c)
                v.append(np.full(len(c), rest[1][lo + LONG]))
                lo += LONG
            held = [x[lo:] for x in cols]
            yield _ties(u, v)
        if held is not None and len(held[0]):
            a, b = tied(*held[1:])
            yield _ties([a], [b])

    def _ties(u, v):
        u, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (u, v))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return (lists.repartition(partitions_for(lists.sparkSession), "s").sortWithinPartitions("s", "n", "c")
            .select("s", "n", "c", "i", "most", "bits").mapInArrow(run, "u long, v long"))


def candidates(rows: DataFrame, percent: int) -> DataFrame:
    """u, v: ties between classes, such that similar ones are connected."""
    classes = rows.where("n > 0").select("c", "n", "first", "rare").dropDuplicates(["c"])
    lists = classes.select("c", "n", "rare", F.posexplode("first").alias("i", "s")).withColumn("often", F.col("i") >= F.col("rare")).drop("rare")
    lists = staged(lists, "lists")
    # frequent shingles are few (FREQUENT rows of the sample have each): their lists are counted, long ones are tied as they are
    hubs = lists.where("often").groupBy("s").agg(F.count("*").alias("size"), F.min("c").alias("hub")).where(F.col("size") > LONG).select("s", "hub")
    hubs = staged(hubs, "hubs")
    long_ties = lists.where("often").join(hubs, "s").where("c <> hub").select(F.col("c").alias("u"), F.col("hub").alias("v"))
    short = lists.where(~F.col("often")).unionByName(lists.where("often").join(hubs, "s", "left_anti")).drop("often")
    by_size = Window.partitionBy("s").orderBy("n")
    near = (100 * F.lag("n").over(by_size) >= percent * F.col("n")) | (100 * F.col("n") >= percent * F.lead("n").over(by_size))
    shared = short.withColumn("near", near).where("near").drop("near")
    shared = staged(shared, "shared")
    # Of two sets, take the one whose first shingles end earlier in the order: those that the other set has are among the other's first ones, too. So
    # it shares at most those that a class of similar size has (held) and what is behind the first; for a pair the larger of both bounds holds.
    held = shared.select("c").union(lists.where("often").join(hubs, "s", "left_semi").select("c")).groupBy("c").agg(F.count("*").alias("held"))
    sizes = rows.where("n > 0").select("c", "n", "bits").dropDuplicates(["c"]).join(held, "c")
    first = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1
    bits = sizes.select("c", (F.col("held") + F.col("n") - first).cast("long").alias("most"), "bits")
    ties = staged(forest_ties(shared.join(bits, "c"), percent).where("u <> v").distinct().union(long_ties), "ties")
    dropped(lists, hubs, shared)
    return ties


def units(found: DataFrame, percent: int) -> DataFrame:
    """root, i, j, own, c: the classes of each pair of blocks of a component that
    may hold similar ones, and the block of each. ``found``: root, c, n, bits. Blocks are nodes of the
    component's tree, which Spark joins by size band and prunes by the bound."""
    whole = found.groupBy("root").agg(((F.count("*") <= BLOCK) & (F.sum("n") <= BLOCK_SHINGLES)).alias("whole"))
    band = F.floor(F.log("n") / -math.log(percent / 100)).cast("int")  # a component that fits into one block is one
    sized = found.join(staged(whole, "whole"), "root").withColumn("band", F.when(F.col("whole"), 0).otherwise(band))
    parts = sized.groupBy("root", "band").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("parts"))
    dealt = (sized.join(staged(parts, "parts"), ["root", "band"])
             .withColumn("part", F.when(F.col("parts") == 1, 0).otherwise(F.pmod(F.xxhash64("c"), F.col("parts"))).cast("int")))
    dealt = staged(dealt.select("root", "band", "part", "c", "n", "bits"), "dealt")
    count = sum((F.bit_count(F.col("bits")[w]) for w in range(WORDS)), F.lit(0))
    nodes = dealt.groupBy("root", "band", "part").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.max(F.col("n") - count).alias("loss"), *(F.bit_or(F.col("bits")[w]).alias(f"b{w}") for w in range(WORDS)))
    nodes = staged(nodes, "tree-nodes")
    upper = nodes.select("root", F.explode(F.array(F.col("band"), F.col("band") + 1, F.col("band") + 2)).alias("other"), F.struct("band", "part").alias("i"),
                         *(F.col(x).alias(f"i_{x}") for x in ("lo", "hi", "loss", *(f"b{w}" for w in range(WORDS)))))
    lower = nodes.withColumn("j", F.struct("band", "part")).withColumnRenamed("band", "other")
    both = sum((F.bit_count(F.col(f"b{w}").bitwiseAND(F.col(f"i_b{w}"))) for w in range(WORDS)), F.lit(0))
    most = F.least(F.least("loss", "i_loss") + both, F.col("hi"), F.col("i_hi"))
    pairs = (upper.join(lower, ["root", "other"]).where("i <= j").where(100 * F.col("i_hi") >= percent * F.col("lo"))
             .where((100 + percent) * most >= percent * (F.col("lo") + F.col("i_lo"))).select("root", "i", "j"))
    sides = pairs.select("root", "i", "j", F.explode(F.when(F.col("i") == F.col("j"), F.array("i")).otherwise(F.array("i", "j"))).alias("own"))
    sides = sides.select("root", "i", "j", F.col("own.band").alias("band"), F.col("own.part").alias("part"))
    return dealt.select("root", "band", "part", "c").join(staged(sides, "sides"), ["root", "band", "part"]).select(
        "root", "i", "j", F.struct("band", "part").alias("own"), "c")


def counts(shingles: np.ndarray) -> np.ndarray:
    """Shingles by bucket, a power of two of buckets, at most 20 a bucket on
    average; counts above 255 are cut there, ``possible_classes`` adds the rest."""
    buckets = 1 << max(4, math.ceil(math.log2(max(len(shingles), 1) / 20)))
    return np.minimum(np.bincount((shingles & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets), 255).astype(np.uint8)


def possible_classes(n: np.ndarray, own: np.ndarray, counted: list[np.ndarray], percent: int) -> np.ndarray:
    """Which classes of a unit may be similar to another one that it has to be
    held against: one of the other block, or any where there is one block alone
    (``own``: whether a class is of the first block)."""
    both_blocks, size = not own.all(), np.array([len(x) for x in counted])
    keep = np.zeros(len(n), bool)
    cut = n - np.array([int(x.sum(dtype=np.int64)) for x in counted])
    levels = {}  # of each number of buckets, the counts of the classes that have as many or more, folded
    for b in np.unique(size).tolist():
        at = np.flatnonzero(size >= b)
        levels[b] = at, np.stack([counted[x].reshape(-1, b).sum(0, dtype=np.int32) for x in at])
    for x in range(len(n)):
        at, folded = levels[int(size[x])]  # pairs are looked at from the class with fewer buckets
        other = (at != x) & (own[at] != own[x] if both_blocks else True)
        other &= (100 * np.minimum(n[at], n[x]) >= percent * np.maximum(n[at], n[x])) & ~(keep[at] & keep[x])
        y = np.flatnonzero(other)
        if len(y):
            me = folded[np.searchsorted(at, x)]
            shared = np.minimum(folded[y], me).sum(1, dtype=np.int64) + np.minimum(cut[at[y]], cut[x])
            near = at[y[(100 + percent) * shared >= need(n[at[y]], n[x], percent)]]
            keep[near] = True
            keep[x] |= len(near) > 0
    return keep


def possible_units(dealt: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """root, unit, c: the rows of the units whose class may be similar to
    another of its unit, by their counts."""
    def count(batches):
        for batch in batches:
            s = [x.values.to_numpy().view(np.uint64) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in s], pa.int64()), pa.array([counts(x).tobytes() for x in s], pa.binary())],
                                             ["c", "n", "counts"])

    def run(batches):
        key, held = None, []

        def close():
            own = np.array([x[2] == x[0] for x in held])
            keep = possible_classes(np.array([x[4] for x in held], np.int64), own, [np.frombuffer(x[5], np.uint8) for x in held], percent)
            kept = [x for x, stays in zip(held, keep) if stays]
            return pa.RecordBatch.from_arrays([pa.array([key[0]] * len(kept), pa.int64()), pa.array([key[1]] * len(kept), pa.string()),
                                               pa.array([x[3] for x in kept], pa.int64())], ["root", "unit", "c"])

        for batch in batches:
            for root, unit, *row in zip(*(batch.column(x).to_pylist() for x in range(8))):
                if (root, unit) != key:
                    if len(held) > 1:
                        yield close()
                    key, held = (root, unit), []
                held.append(row)
        if len(held) > 1:
            yield close()

    counted = sets.select("c", "s").mapInArrow(count, "c long, n long, counts binary")
    place = lambda x: F.format_string("%d %d", f"{x}.band", f"{x}.part")
    rows = dealt.join(counted, "c").select("root", F.concat_ws(" ", place("i"), place("j")).alias("unit"), place("i").alias("i"), place("j").alias("j"),
                                           place("own").alias("own"), "c", "n", "counts")
    return (rows.repartition(partitions_for(dealt.sparkSession), "root", "unit").sortWithinPartitions("root", "unit", "c")
            .mapInArrow(run, "root long, unit string, c long"))


def confirmed(rows: DataFrame, percent: int) -> DataFrame:
    """u, v: linked classes, from rows (root, unit, c, s) of the units."""
    def run(batches):
        key, classes, sets = None, [], []

        def close():
            found = linked(classes, sets, percent)
            return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["u", "v"])

        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            for k, c, s in zip(keys, batch.column(2).to_pylist(), batch.column(3)):
                if k != key:
                    if len(sets) > 1:
                        yield close()
                    key, classes, sets = k, [], []
                classes.append(c)
                sets.append(s.values.to_numpy())
        if len(sets) > 1:
            yield close()

    return (rows.select("root", "unit", "c", "s").repartition(partitions_for(rows.sparkSession), "root", "unit")
            .sortWithinPartitions("root", "unit", "c").mapInArrow(run, "u long, v long"))


def jaccard_components(docs: DataFrame, k: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per document."""
    percent = round(similarity * 100)
    rows = staged(signatures(docs, k, percent), "signatures")
    loose = staged(components(candidates(rows, percent)), "candidates")
    classes = rows.where("n > 0").groupBy("c").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"))
    found = staged(loose.select(F.col("node").alias("c"), "root").join(rows.where("n > 0").select("c", "n", "bits").dropDuplicates(["c"]), "c"), "found")
    reps = classes.join(found.select("c"), "c", "left_semi")
    sets = staged(sets_of(docs, reps, k), "sets")
    near = possible_units(units(found, percent), sets, percent)
    links = staged(confirmed(near.join(sets, "c"), percent), "links")
    rooted = classes.join(components(links), F.col("c") == F.col("node"), "left").select("c", "doc_id", F.coalesce("root", "c").alias("root"))
    least = staged(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")), "least")
    by_class = staged(rooted.join(least, "root").select("c", "component_id"), "by-class")
    return (rows.withColumn("c", F.when(F.col("n") > 0, F.col("c"))).join(by_class, "c", "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))


def op11_sigtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents"), k=QUERY_SHINGLE, similarity=QUERY_SIMILARITY)


ORACLE_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reach.doc_id, links.v FROM reach JOIN links ON reach.r = links.u)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT doc_id, min(r) AS c FROM reach GROUP BY doc_id) USING (doc_id)
"""

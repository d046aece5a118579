"""Operator 8: near-duplicates by min-max hashing.

Each permutation of the shingle space gives two signature values, the smallest
and the largest image of a document's shingles; both agree between two
documents with probability equal to their Jaccard similarity, so half the hash
evaluations give a signature of the same length. Signatures are cut into bands;
documents that share a band are candidates, and every link is confirmed on the
full sets of shingles.

Groups are never expanded into pairs of rows:

* documents with equal shingle sets form one class, which one member stands for;
* in each band bucket every class is tied to the bucket's smallest one, and the
  connected components of these ties hold all candidates of each of their
  classes;
* a component is dealt into blocks of about BLOCK classes (fewer, if they have
  more than BLOCK_SHINGLES shingles) by hash, and each pair
  of blocks is one unit of work: it gets the full sets of both blocks, counts
  all intersections at once (shingles of few classes by their short lists,
  frequent ones by a matrix product) and returns only a spanning star of each
  group of linked classes. No unit holds more than two blocks, however large a
  component is;
* the components of these links are the result.

A band takes ROWS of the signature's values, drawn at random for each band. A
pair at similarity 0.8 exactly shares no band with a probability of about 1e-6.

Defined results: null, empty and all-blank texts have no shingles, link with
nothing and are kept; fewer words than a shingle form one shingle; rows that
repeat a doc_id are documents of their own and each get their row; a component
takes the smallest doc_id that is not null, and a row without doc_id is kept
only if its component has none; other columns are not read.
"""

from __future__ import annotations

from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit.llm.common import WordHashes, byte_words, kept_in_process, mix, odd_multipliers, read_table, ship, staged, text_or_empty, window_hashes
from valuekit.llm.components import components

ship(__name__)

SHINGLE = 5
#: The contract of the query op8_minhash and its SQL.
QUERY_SHINGLE = 4
SIMILARITY = 0.8
PERMUTATIONS = 120
BANDS, ROWS = 72, 7
BLOCK = 512
#: Shingles that the classes of a block have on average at most, one class excepted.
BLOCK_SHINGLES = 2_000_000
#: Shingles that at most so many classes of a unit share are counted by lists.
FEW = 24
SEED = 20_011


def shingle_set(text: str | None, k: int, words: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    hashes = words.array(byte_words(text))
    if 0 < len(hashes) < k:
        return mix(np.array([hashes @ odd_multipliers(len(hashes), SEED + len(hashes))], np.uint64))
    return np.unique(window_hashes(hashes, k, SEED))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minimum and maximum of each permutation, next to each other."""
    a, b = odd_multipliers(PERMUTATIONS, 1), odd_multipliers(PERMUTATIONS, 2)
    low, high = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64), np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(shingles), 4096):
        part = shingles[at:at + 4096]
        for j in range(0, PERMUTATIONS, 8):
            image = part[None, :] * a[j:j + 8, None] + b[j:j + 8, None]
            low[j:j + 8] = np.minimum(low[j:j + 8], image.min(1))
            high[j:j + 8] = np.maximum(high[j:j + 8], image.max(1))
    return np.stack([low, high], 1).ravel()


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """One 64-bit key a band, different for different bands."""
    chosen = np.random.default_rng(SEED).permuted(np.tile(np.arange(2 * PERMUTATIONS), (BANDS, 1)), axis=1)[:, :ROWS]
    rows = mix(signature(shingles))[chosen] * odd_multipliers(ROWS, 3)[None, :]
    return mix(rows.sum(1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def text_digest() -> Column:
    """With doc_id, tells rows apart that differ; a null text counts as empty."""
    return F.unhex(F.md5(F.encode(text_or_empty(), "UTF-8")))


def digests(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, c (the class: a digest of the set), bands, t (a digest of the text)."""
    def run(batches):
        words = kept_in_process(("words",), WordHashes)
        for batch in batches:
            out = []
            for text in batch.column(1):
                s = shingle_set(text.as_py(), k, words)
                out.append((len(s), class_id(md5(s.tobytes()).digest()), band_keys(s) if len(s) else []))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
                 pa.array([x[2] for x in out], pa.list_(pa.int64())), batch.column(2)], ["doc_id", "n_shingles", "c", "bands", "t"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), text_digest().alias("t"))
            .mapInArrow(run, "doc_id long, n_shingles long, c long, bands array<long>, t binary"))


#: Stands for a null doc_id in a join: such rows are all looked at.
NO_ID = -(1 << 63)


def sets_of(docs: DataFrame, reps: DataFrame, k: int) -> DataFrame:
    """c, s: the full shingle sets of the classes in ``reps`` (c, doc_id)."""
    def run(batches):
        words = kept_in_process(("words",), WordHashes)
        for batch in batches:
            sets = [shingle_set(t.as_py(), k, words) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([class_id(md5(s.tobytes()).digest()) for s in sets], pa.int64()),
                                              pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["c", "s"])

    chosen = (docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), text_or_empty().alias("text"))
              .join(reps.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id")), "id", "left_semi"))
    return chosen.select("text").mapInArrow(run, "c long, s array<long>").dropDuplicates(["c"])


def class_id(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of the sets."""
    n = len(sets)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(x) for x in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.concatenate([[True], values[1:] != values[:-1]])
    group = np.cumsum(new) - 1
    shared = np.bincount(group)
    both = np.zeros(n * n)
    few = (shared[group] > 1) & (shared[group] <= FEW)
    g, o = group[few], owner[few]
    for step in range(1, FEW):
        same = g[step:] == g[:-step] if step < len(g) else np.zeros(0, bool)
        if not same.any():
            break
        both += np.bincount(o[:-step][same] * n + o[step:][same], minlength=n * n)
    both = both.reshape(n, n)
    both = both + both.T
    many = shared[group] > FEW
    if many.any():
        column = np.unique(group[many], return_inverse=True)[1]
        o = owner[many]
        for lo in range(0, int(column.max()) + 1, 4096):
            part = (column >= lo) & (column < lo + 4096)
            has = np.zeros((n, min(4096, int(column.max()) + 1 - lo)), np.float32)
            has[o[part], column[part] - lo] = 1
            both += has @ has.T
    return both


def linked(classes: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A star for each group of sets that links of enough similarity connect."""
    size = np.array([len(x) for x in sets], float)
    both = intersections(sets)
    link = 100 * both >= percent * (size[:, None] + size[None, :] - both)
    np.fill_diagonal(link, True)
    label = np.arange(len(sets))
    while True:
        least = np.where(link, label[None, :], len(sets)).min(1)
        if (least == label).all():
            break
        label = least
    return [(classes[i], classes[k]) for i, k in enumerate(label) if i != k and classes[i] != classes[k]]


def confirmed(units: DataFrame, percent: int) -> DataFrame:
    """u, v: linked classes, from rows (root, i, j, c, s) of the units."""
    def run(batches):
        key, classes, sets = None, [], []

        def close():
            found = linked(classes, sets, percent) if len(sets) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["u", "v"])

        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            for k, c, s in zip(keys, batch.column(3).to_pylist(), batch.column(4)):
                if k != key:
                    if len(sets) > 1:
                        yield close()
                    key, classes, sets = k, [], []
                classes.append(c)
                sets.append(s.values.to_numpy())
        if len(sets) > 1:
            yield close()

    return (units.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "c")
            .select("root", "i", "j", "c", "s").mapInArrow(run, "u long, v long"))


def grouped(docs: DataFrame, k: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """The digests of the documents, and their classes (c) with the first row of
    each by doc_id, nulls last, and text (doc_id, t) and the component (root)."""
    percent = round(similarity * 100)
    rows = staged(digests(docs, k), "minmax")
    classes = staged(rows.where("n_shingles > 0").groupBy("c")
                     .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t", "bands", "n_shingles")).alias("m"))
                     .select("c", *(F.col(f"m.{x}").alias(x) for x in ("doc_id", "t", "bands", "n_shingles"))), "classes")
    banded = classes.select("c", F.explode("bands").alias("bucket"))
    first = banded.groupBy("bucket").agg(F.min("c").alias("hub"), F.max("c").alias("last")).where("hub < last").select("bucket", "hub")
    # written first, here and below: a join right on the aggregate would take over its partitions and could not split a hot key
    ties = banded.join(staged(first, "buckets"), "bucket").where("c <> hub").select(F.col("c").alias("u"), F.col("hub").alias("v"))
    loose = staged(components(ties), "candidates")

    loose = loose.join(classes.select(F.col("c").alias("node"), "n_shingles"), "node")
    blocks = staged(loose.groupBy("root").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).alias("blocks")), "blocks")
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    dealt = (loose.join(blocks, "root").withColumn("own", own)
             .select("root", F.col("node").alias("c"), "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
             .select("root", "c", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))
    sets = sets_of(docs, classes.join(loose, F.col("c") == F.col("node"), "left_semi"), k)
    links = staged(confirmed(dealt.join(sets, "c"), percent), "links")
    roots = components(links)

    return rows, staged(classes.select("c", "doc_id", "t").join(roots, F.col("c") == F.col("node"), "left")
                        .select("c", "doc_id", "t", F.coalesce("root", "c").alias("root")), "rooted")


def first_of_each(docs: DataFrame, k: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, t (text_digest()): the row that stays of each component, the
    smallest doc_id (null only if the component has none) and of its texts the
    one with the smallest digest; and all rows without shingles."""
    rows, rooted = grouped(docs, k, similarity)
    first = rooted.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t")).alias("m"))
    return first.select("m.doc_id", "m.t").union(rows.where("n_shingles = 0").select("doc_id", "t"))


def near_duplicates(docs: DataFrame, k: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per document."""
    rows, rooted = grouped(docs, k, similarity)
    least = staged(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")), "least")
    by_class = rooted.join(least, "root").select("c", "component_id")
    return (rows.join(by_class, "c", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), k=QUERY_SHINGLE)


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
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reach.doc_id, links.v FROM reach JOIN links ON reach.r = links.u)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c AS component_id, d.doc_id = c AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT doc_id, min(r) AS c FROM reach GROUP BY doc_id) USING (doc_id)
"""

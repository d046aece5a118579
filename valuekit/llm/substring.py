"""Operator 6: removal of repeated passages by De Bruijn compaction.

The k-mers are windows of 35 consecutive words. Consecutive k-mers that share
their least 8-gram (their anchor) form one edge of the graph, a path without
branches inside one document: (anchor, digest of the words the path spans).
Equal k-mers have equal anchors, so only paths of one anchor can share a k-mer:

* an anchor with one path that occurs once holds no repeat and is dropped;
* a path that occurs at least twice is a repeated nonbranching path: it is
  compacted to one edge with its source coordinates, and all its k-mers repeat;
* what is left are anchors where paths branch. Their different paths, one
  occurrence each, are opened into k-mers, which a grouped count compares.

Path rows carry source coordinates (row, first word, number of k-mers), with
which the repeated spans are cut from the documents at the end. Digests are
two independent 64-bit sums over the word hashes, plus the length.

A path in which its anchor occurs twice (text with a short period) may repeat
k-mers inside itself; it is opened into one path for each k-mer at once.

Shuffled are the paths (about one for 14 words), never the k-mers; counts are
combined before the shuffle, so a passage that a third of all documents share
costs no task more than its own rows.

Defined results: null, empty and all-blank texts have no words and an empty
kept text; texts of fewer than 35 words stay whole; rows that repeat are copies
of each other, so all their k-mers repeat; rows are told apart by doc_id and
text, other columns are ignored.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from valuekit.llm.common import WordHashes, kept_in_process, mix, read_table, ship, staged, text_or_empty, window_hashes

ship(__name__)

WINDOW = 35
ANCHOR = 8
SPAN = 1 << 32
SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd bases of the two digests


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:len(x) - span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


class Powers:
    """Running powers of an odd base and of its inverse modulo 2^64."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def grown(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, b in (("up", self.base), ("down", self.inverse)):
                p = np.full(size, b, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))
        return self.up, self.down


def span_digests(hashes: np.ndarray, first: np.ndarray, length: np.ndarray, powers: list[Powers]) -> list[np.ndarray]:
    """Two digests of the words [first, first + length) of a document."""
    out = []
    for p in powers:
        up, down = p.grown(len(hashes) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes) * up[:len(hashes)], dtype=np.uint64)])
        out.append(mix((total[first + length] - total[first]) * down[first] + length.astype(np.uint64)).view(np.int64))
    return out


def paths(hashes: np.ndarray, k: int, m: int, powers: list[Powers]):
    """anchor, two digests, first k-mer and number of k-mers of each path."""
    n = len(hashes) - k + 1
    grams = window_hashes(hashes, m, 5)
    least = sliding_min(grams, k - m + 1)
    first = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
    count = np.diff(np.append(first, n))
    anchor = least[first]
    # does the anchor occur twice among the grams a path spans?
    width = k - m + 1
    periodic = count > width
    look = first[:, None] + np.arange(2 * width)[None, :]
    inside = look < (first + np.minimum(count, width + 1) + width - 1)[:, None]
    periodic |= ((grams[np.minimum(look, len(grams) - 1)] == anchor[:, None]) & inside).sum(1) > 1
    if periodic.any():
        each = np.repeat(np.arange(len(first)), np.where(periodic, count, 1))
        step = np.arange(len(each)) - np.concatenate([[0], np.cumsum(np.where(periodic, count, 1))])[each]
        first, anchor, count = first[each] + step, anchor[each], np.where(periodic[each], 1, count[each])
    d1, d2 = span_digests(hashes, first, count + k - 1, powers)
    return anchor.view(np.int64), d1, d2, first.astype(np.int32), count.astype(np.int32)


def _row_key() -> Column:
    return F.xxhash64("doc_id", "text").alias("rid")


def _source(docs: DataFrame) -> DataFrame:
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
            .select(_row_key(), "doc_id", "text"))


def path_table(source: DataFrame, k: int, m: int) -> DataFrame:
    def run(batches):
        words, powers = kept_in_process(("words",), WordHashes), [Powers(s) for s in SEEDS]
        for batch in batches:
            made, size = [], 0
            for rid, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                hashes = words.array((text.as_py()).encode("utf-8", "surrogatepass").split())
                if len(hashes) >= k:
                    a, d1, d2, first, count = paths(hashes, k, m, powers)
                    made.append((a, d1, d2, np.full(len(a), rid, np.int64), first, count))
                    size += len(a)
                if size > 200_000:
                    yield _batch(made)
                    made, size = [], 0
            if made:
                yield _batch(made)

    def _batch(made):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*made)], ["a", "d1", "d2", "rid", "first", "n"])

    return source.select("rid", "text").mapInArrow(run, "a long, d1 long, d2 long, rid long, first int, n int")


def opened(source: DataFrame, chosen: DataFrame, k: int) -> DataFrame:
    """The k-mers of the chosen paths (rid, first, n): two digests, rid, at."""
    def run(batches):
        words, powers = kept_in_process(("words",), WordHashes), [Powers(s) for s in SEEDS]
        for batch in batches:
            for rid, text, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                hashes = words.array(text.as_py().encode("utf-8", "surrogatepass").split())
                at = np.concatenate([np.arange(s["first"], s["first"] + s["n"]) for s in spans])
                d1, d2 = span_digests(hashes, at, np.full(len(at), k), powers)
                yield pa.RecordBatch.from_arrays([pa.array(d1), pa.array(d2), pa.array(np.full(len(at), rid, np.int64)),
                                                  pa.array(at.astype(np.int32))], ["k1", "k2", "rid", "at"])

    by_row = chosen.groupBy("rid").agg(F.collect_set(F.struct("first", "n")).alias("spans"))
    return (source.select("rid", "text").join(by_row, "rid").select("rid", "text", "spans")
            .mapInArrow(run, "k1 long, k2 long, rid long, at int"))


def repeated_spans(source: DataFrame, k: int = WINDOW, m: int = ANCHOR) -> DataFrame:
    """rid, spans: of each row with repeats, first * SPAN + n of its k-mers
    [first, first + n) that occur elsewhere. A row's spans are all its paths of
    shared anchors, less those whose path occurs nowhere else, and the single
    k-mers of these that do."""
    table = staged(path_table(source, k, m), "paths")
    shared = (table.groupBy("a").agg(F.count("*").alias("c"), F.min("d1").alias("lo"), F.max("d1").alias("hi"))
              .where("c > 1").select("a", (F.col("lo") != F.col("hi")).alias("branching")))
    # written first: a join right on the aggregate would take over its partitions and could not split a hot anchor
    shared = staged(table.join(staged(shared, "anchors"), "a"), "shared-paths")
    edges = (shared.where("branching").groupBy("a", "d1", "d2", "n")
             .agg(F.count("*").alias("c"), F.min(F.struct("rid", "first")).alias("source")))
    edges = staged(edges, "edges")
    # a path that occurs once is its own source: no join is needed to find its row
    alone = edges.where("c = 1").select(F.col("source.rid").alias("rid"), F.col("source.first").alias("first"), "n")
    kmers = staged(opened(source, edges.select(F.col("source.rid").alias("rid"), F.col("source.first").alias("first"), "n"), k), "kmers")
    again = staged(kmers.groupBy("k1", "k2").agg(F.count("*").alias("c")).where("c > 1").select("k1", "k2"), "again")
    single = kmers.join(again, ["k1", "k2"], "left_semi").select("rid", F.col("at").alias("first"), F.lit(1).alias("n"))
    # a span is one long, so the differences of a row's lists go through hash sets
    span = (F.col("first").cast("long") * SPAN + F.col("n")).alias("span")
    rows = (shared.select("rid", span, F.lit("shared").alias("kind"))
            .union(alone.select("rid", span, F.lit("alone"))).union(single.select("rid", span, F.lit("single"))))
    of = lambda kind: F.collect_set(F.when(F.col("kind") == kind, F.col("span"))).alias(kind)
    spans = rows.groupBy("rid").agg(of("shared"), of("alone"), of("single"))
    return spans.select("rid", F.array_union(F.array_except("shared", "alone"), "single").alias("spans")).where("size(spans) > 0")


CUT = StructType([StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept_sha256", StringType()),
                  StructField("kept_text", StringType())])


def cut_repeats(docs: DataFrame, k: int = WINDOW) -> DataFrame:
    """The columns of ``docs`` and, as struct ``cut``: n_words, n_removed,
    kept_sha256 and kept_text (the kept words joined by one space)."""
    source = _source(docs)
    spans = staged(repeated_spans(source, k), "spans")
    carried = docs.withColumn("rid of row", F.xxhash64(F.col("doc_id").cast("long"), text_or_empty()))
    schema = StructType([*docs.schema.fields, StructField("cut", CUT)])

    def run(batches):
        for batch in batches:
            out = []
            for text, cuts in zip(batch.column(0), batch.column(1).to_pylist()):
                words = text.as_py().encode("utf-8", "surrogatepass").split()
                kept = words
                if cuts:
                    edge = np.zeros(len(words) + 1, np.int32)
                    first, n = np.divmod(np.array(cuts), SPAN)
                    np.add.at(edge, first, 1)
                    np.add.at(edge, first + n + k - 1, -1)
                    kept = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
                joined = b" ".join(kept)
                out.append({"n_words": len(words), "n_removed": len(words) - len(kept), "kept_sha256": sha256(joined).hexdigest(),
                            "kept_text": joined.decode("utf-8", "surrogatepass")})
            kind = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string())])
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(out, kind)], [f.name for f in schema])

    spans = spans.select(F.col("rid").alias("rid of row"), F.col("spans").alias("spans of row"))
    return (carried.join(spans, "rid of row", "left")
            .select(text_or_empty().alias("text of row"), "spans of row", *docs.columns).mapInArrow(run, schema))


def remove_repeats(docs: DataFrame, k: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return cut_repeats(rows, k).select("doc_id", "cut.n_words", "cut.n_removed", "cut.kept_sha256")


def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"))


ORACLE_SQL = """
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 33)) AS p, w FROM words WHERE len(w) >= 35),
hashed AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 34], ' ')) AS h FROM windows),
again AS (SELECT doc_id, p FROM hashed JOIN (SELECT h FROM hashed GROUP BY h HAVING count(*) > 1) USING (h)),
removed AS (SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS i FROM again),
lost AS (SELECT doc_id, list(i) AS gone, count(*) AS n FROM removed GROUP BY doc_id),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM placed ANTI JOIN removed USING (doc_id, i) GROUP BY doc_id)
SELECT words.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

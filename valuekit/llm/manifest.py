"""Operator 12: Merkle manifest of a dataset with nested-interval labels.

Every row is a leaf; inside its source it has a rank by doc_id, and a node of
level L covers the leaf ranks [lo, hi) of up to 16^L leaves. Intervals nest, so
the tree needs no pointers:

* up: nodes of one level that fall into the same interval of the next one
  become its children, and their digest is the parent's;
* down: a node finds its parent by a join on the level's bucket (source,
  lo / 16^(L+1)) with containment of the intervals, and takes over the parent's
  path to the root. What the parent's interval holds besides the node's own
  interval are its siblings, in front of it and behind it;
* the subroots, one a source, are the leaves of one more tree of the same kind.

A path is an array of (before, after): the siblings' digests at each level,
joined. Only one row of every 16 leaves carries a path, and a parent has at most
16 children, so no join key is hot, whatever share of the rows a source has.
Ranks come from range partitions, which a large source may span (``ranks``);
what is shuffled is digests, not texts. The number of rounds is the tree's
height (9 levels for 10^10 leaves of a source).

Defined results: null fields count as ``-``, other columns are not read; rows
that repeat a doc_id are leaves of their own, ordered by their digest; a row
without doc_id comes first and is not tampered; an empty table has no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit.llm.common import read_table, staged
from valuekit.llm.ranks import ranked

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def canonical(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:``, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def lowered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def leaves(docs: DataFrame) -> DataFrame:
    """src (the source, so marked that null comes first), doc_id, leaf, and
    tampered: the digest with the text's A-Z lowered where the document is
    tampered with, else null."""
    fields = {c: canonical(F.col(c)) for c in FIELDS}
    hit = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0
    changed = {**fields, "text": canonical(lowered(F.col("text")))}
    return docs.select(F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("src"), F.col("doc_id").cast("long").alias("doc_id"),
                       digest(*fields.values()).alias("leaf"), F.when(hit, digest(*changed.values())).alias("tampered"))


def runs(nodes: DataFrame, level: int, *payload: str) -> DataFrame:
    """The families of one level: up to 16 nodes (tree, size, lo, hi, h) in one
    interval of the next level, in order, and the digest of their parent."""
    step = FANOUT ** (level + 1)
    kids = F.array_sort(F.collect_list(F.struct("lo", "hi", "h", *payload)))
    return (nodes.groupBy("tree", "size", F.floor(F.col("lo") / step).alias("bucket")).agg(kids.alias("kids"))
            .withColumns({"lo": F.col("bucket") * step, "hi": F.element_at("kids", -1).hi,
                          "h": F.when(F.col("size") > FANOUT ** level, F.sha2(F.concat_ws("", "kids.h"), 256))}))


def forest(nodes: DataFrame, name: str, *payload: str) -> list[DataFrame]:
    """Families by level, up to those with one parent a tree. ``h`` of a family
    is null where its only node is the top of the tree."""
    height, largest = 0, nodes.agg(F.max("size")).first()[0] or 0
    while FANOUT ** height < largest:
        height += 1
    levels = []
    for level in range(max(height, 1)):
        levels.append(staged(runs(nodes, level, *(payload if level == 0 else ())), f"{name}-{level}"))
        nodes = levels[-1].where("h is not null").select("tree", "size", "lo", "hi", "h")
        nodes = nodes.where(F.col("size") > FANOUT ** (level + 1))  # single ones are the tops
    return levels


def tops(levels: list[DataFrame]) -> DataFrame:
    """tree, top: the digest at the top of each tree."""
    found = [x.where(F.col("size") <= FANOUT ** (i + 1)).select("tree", F.coalesce("h", F.element_at("kids", 1).h).alias("top"))
             for i, x in enumerate(levels)]
    out = found[0]
    for x in found[1:]:
        out = out.union(x)
    return out


def steps(kids: str, lo: Column, hi: Column) -> Column:
    """The siblings of the node [lo, hi) among ``kids``: what the parent's
    interval holds in front of it and behind it."""
    before = F.concat_ws("", F.transform(F.filter(kids, lambda k: k.hi <= lo), lambda k: k.h))
    after = F.concat_ws("", F.transform(F.filter(kids, lambda k: k.lo >= hi), lambda k: k.h))
    return F.struct(before.alias("before"), after.alias("after"))


def paths(levels: list[DataFrame], above: DataFrame | None = None) -> DataFrame:
    """The families of level 0 with ``path``: the steps of their parent up to
    the root. ``above``: tree, path of the tree's top, and what else its nodes
    carry; without it, the tops are roots."""
    down, carried = None, [c for c in above.columns if c != "tree"] if above else ["path"]
    for level in range(len(levels) - 1, -1, -1):
        family, step = levels[level], FANOUT ** (level + 2)
        out = family.where(F.col("size") <= FANOUT ** (level + 1))
        out = out.join(above, "tree").select(*family.columns, *carried) if above else out.withColumn("path", no_steps())
        if down is not None:
            up = down.select(F.col("tree").alias("up_tree"), F.col("bucket").alias("up_bucket"), F.col("lo").alias("up_lo"), F.col("hi").alias("up_hi"),
                             F.col("kids").alias("up_kids"), *(F.col(c).alias(f"up_{c}") for c in carried))
            inside = (F.col("tree") == F.col("up_tree")) & (F.floor(F.col("lo") / step) == F.col("up_bucket"))
            inside &= (F.col("lo") >= F.col("up_lo")) & (F.col("hi") <= F.col("up_hi"))
            own = steps("up_kids", F.col("lo"), F.col("hi"))
            # only families below the top have a parent in a family
            out = out.union(family.where(F.col("size") > FANOUT ** (level + 1)).join(up, inside)
                            .select(*family.columns, *(F.concat(F.array(own), "up_path").alias("path") if c == "path" else F.col(f"up_{c}").alias(c)
                                                        for c in carried)))
        down = out
    return down


def own_path() -> Column:
    """The path of ``own``, one of the ``kids`` of a family with its ``path``."""
    here = F.concat(F.array(steps("kids", F.col("own.lo"), F.col("own.hi"))), "path")
    return F.when(F.col("size") > 1, here).otherwise(F.col("path"))


def no_steps() -> Column:
    """The path of a root."""
    return F.filter(F.array(F.struct(F.lit("").alias("before"), F.lit("").alias("after"))), lambda s: F.lit(False))


def fold(leaf: Column, path: Column) -> Column:
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s.before, h, s.after), 256))


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: one
    row per document."""
    made = staged(leaves(docs), "leaves")
    placed = ranked(made, "src", ["doc_id", "leaf"], ["doc_id", "leaf", "tampered"], "leaf-ranks")
    sizes = placed.groupBy("src").agg(F.count("*").alias("size"))
    sources = staged(sizes, "sizes")
    whole = ranked(sources.withColumn("all", F.lit(0)), "all", ["src"], ["src", "size"], "source-ranks")
    nodes = (placed.join(sources, "src")
             .select(F.col("src").alias("tree"), "size", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), F.col("leaf").alias("h"), "doc_id", "tampered"))
    levels = forest(staged(nodes, "nodes"), "families", "doc_id", "tampered")

    subroots = tops(levels)
    n_sources = sources.count()
    upper = (whole.join(subroots.withColumnRenamed("tree", "src"), "src")
             .select(F.lit("").alias("tree"), F.lit(n_sources).cast("long").alias("size"), F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"),
                     F.col("top").alias("h"), "src"))
    crown = forest(staged(upper, "subroots"), "crown", "src")
    root = F.lit((tops(crown).first() or [None, None])[1]).cast("string")
    above = (paths(crown).select("size", "kids", "path", F.explode("kids").alias("own"))
             .select(F.col("own.src").alias("tree"), own_path().alias("path"), F.col("own.h").alias("subroot")))
    each = (paths(levels, staged(above, "above")).select("size", "kids", "path", "subroot", F.explode("kids").alias("own"))
            .select(F.col("own.doc_id").alias("doc_id"), F.col("own.h").alias("leaf"), F.col("own.tampered").alias("tampered"), "subroot",
                    own_path().alias("path")))
    siblings = F.concat_ws("", F.transform("path", lambda s: F.concat(s.before, s.after)))
    return (each.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("path")))
            .select("doc_id", "leaf", "subroot", root.alias("root"), F.sha2(siblings, 256).alias("proof_sha256"), "folded_root",
                    (F.col("folded_root") == root).alias("verified")))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(read_table(spark, sf_dir, "documents"))


def _hash_of(fields: dict[str, str]) -> str:
    return "sha256(" + " || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR)::VARCHAR || ':' || {v} END" for c, v in fields.items()) + ")"


_FIELDS = {c: f"{c}::VARCHAR" for c in FIELDS}
_LOWER = {**_FIELDS, "text": "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"}
_CRC = """
  list_reduce(list_prepend(4294967295, list_transform(str_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda a, b:
    list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: xor(x >> 1, (x & 1) * 3988292384)))"""

#: Levels are unrolled by recursion: a tree's nodes of each level, and from
#: each leaf up with its digest and its siblings'.
ORACLE_SQL = f"""
WITH RECURSIVE made AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, {_hash_of(_FIELDS)} AS leaf,
         CASE WHEN xor({_CRC}, 4294967295) % 5 = 0 THEN {_hash_of(_LOWER)} END AS tampered FROM documents),
base AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM made),
up AS (
  SELECT tree, 0 AS level, i, n, leaf AS h FROM base
  UNION ALL
  SELECT tree, level + 1, i // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY i)) FROM up WHERE n > 1 GROUP BY tree, level, i // 16, n),
subroots AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM up WHERE n = 1),
crown AS (
  SELECT 0 AS level, i, n, h FROM subroots
  UNION ALL
  SELECT level + 1, i // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY i)) FROM crown WHERE n > 1 GROUP BY level, i // 16, n),
steps AS (
  SELECT a.tree, a.level, a.i, a.n, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before,
         coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS after
  FROM (SELECT tree, level, i, n FROM up UNION ALL SELECT NULL, level, i, n FROM crown) a
  JOIN (SELECT tree, level, i, h FROM up UNION ALL SELECT NULL, level, i, h FROM crown) b
    ON a.tree IS NOT DISTINCT FROM b.tree AND a.level = b.level AND a.i // 16 = b.i // 16
  WHERE a.n > 1 GROUP BY a.tree, a.level, a.i, a.n),
moves AS (
  SELECT tree, level, i, tree AS to_tree, level + 1 AS to_level, i // 16 AS to_i, (n + 15) // 16 AS to_n, before, after FROM steps
  UNION ALL SELECT u.tree, u.level, u.i, NULL, 0, s.i, s.n, NULL, '' FROM up u JOIN subroots s ON u.tree = s.tree WHERE u.n = 1),
walk AS (
  SELECT doc_id, leaf, tree AS own, tree, 0 AS level, i, n, coalesce(tampered, leaf) AS cur, '' AS proof FROM base
  UNION ALL
  SELECT doc_id, leaf, own, to_tree, to_level, to_i, to_n, CASE WHEN before IS NULL THEN cur ELSE sha256(before || cur || after) END,
         proof || coalesce(before, '') || after
  FROM walk JOIN moves ON walk.tree IS NOT DISTINCT FROM moves.tree AND walk.level = moves.level AND walk.i = moves.i)
SELECT doc_id, leaf, s.h AS subroot, r.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = r.h AS verified
FROM walk JOIN subroots s ON walk.own = s.tree, (SELECT h FROM crown WHERE n = 1) r WHERE walk.tree IS NULL AND walk.n = 1
"""

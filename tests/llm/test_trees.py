"""The tree operators (signature trees, Merkle manifest, conversation trie)
against brute force, with nulls, empty and long texts, ties, repeated rows,
empty tables and clashing column names."""

import random
import re
import zlib
from hashlib import sha256

import numpy as np
import pytest
from brute import brute_components, near_rows, text_of
from pyspark.sql import functions as F

from valuekit.llm import manifest, ranks, sigtree, trie


def jaccard(docs, **how):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in sigtree.jaccard_components(docs, **how).collect()), key=str)


@pytest.mark.parametrize("block, long, fanout", [(512, 4096, 8), (4, 3, 2)])
def test_signature_trees_match_brute_force(docs_of, monkeypatch, block, long, fanout):
    for name, value in (("BLOCK", block), ("LONG", long), ("FANOUT", fanout)):
        monkeypatch.setattr(sigtree, name, value)
    passage = text_of(random.Random(4), 40, 10**6)
    rows = near_rows() + [(400 + i, passage + " " + text_of(random.Random(i), 10 + 3 * i, 10**6)) for i in range(30)]  # one passage, many texts
    for k, percent in ((4, 85), (5, 80)):
        assert jaccard(docs_of(rows), k=k, similarity=percent / 100) == sorted((x[:3] for x in brute_components(rows, k, percent)), key=str)


def test_signature_trees_of_an_empty_table(docs_of):
    assert jaccard(docs_of([])) == []
    assert jaccard(docs_of([(1, None), (2, "")])) == [(1, 0, 1), (2, 0, 2)]


def test_pruned_pairs_are_below_the_similarity():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 300).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[rng.permutation(300)[:rng.integers(200, 300)]], rng.integers(0, 2**63, rng.integers(1, 60)).astype(np.uint64)]))
            for _ in range(70)] + [np.unique(rng.integers(0, 2**63, rng.integers(1, 400)).astype(np.uint64)) for _ in range(70)]
    sets.sort(key=len)
    n = np.array([len(s) for s in sets])
    label = sigtree.groups(n, n, n, np.stack([sigtree.bitmap(s) for s in sets]), 85)
    linked = [(i, j) for i in range(140) for j in range(i) if 185 * len(np.intersect1d(sets[i], sets[j])) >= 85 * (n[i] + n[j])]
    assert linked and all(label[i] == label[j] for i, j in linked)
    assert len(set(label.tolist())) > 60


def test_counts_bound_long_sets():
    """Bitmaps of 3,000 shingles are full; their counts still tell sets apart, and lose no link."""
    rng = np.random.default_rng(4)
    draw = lambda k: rng.integers(0, 2**63, k).astype(np.uint64)
    base = draw(3000)
    sets = [np.unique(draw(int(k))) for k in rng.integers(2500, 3500, 40)]
    sets += [np.unique(np.concatenate([base[rng.permutation(3000)[:2870]], draw(100)])) for _ in range(6)]
    sets += [np.unique(draw(10)), np.unique(np.concatenate([sets[3], draw(300)])), np.uint64(4096) * np.arange(1, 5001, dtype=np.uint64),
             np.uint64(4096) * np.arange(200, 5201, dtype=np.uint64)]  # the last two are all in one bucket
    n = np.array([len(s) for s in sets])
    linked = [(i, j) for i in range(len(sets)) for j in range(i) if 185 * len(np.intersect1d(sets[i], sets[j])) >= 85 * (n[i] + n[j])]
    counted = [sigtree.counts(s) for s in sets]
    keep = sigtree.possible_classes(n, np.ones(len(sets), bool), counted, 85)
    assert {x for pair in linked for x in pair} == set(np.flatnonzero(keep).tolist()) and 8 <= keep.sum() <= 12
    own = np.arange(len(sets)) % 2 == 0  # two blocks: links between them stay
    keep = sigtree.possible_classes(n, own, counted, 85)
    assert all(keep[i] and keep[j] for i, j in linked if own[i] != own[j]) and keep.sum() <= 12


def merkle(rows):
    """Rows of the manifest by plain lists."""
    def h(*parts):
        return sha256("".join(parts).encode()).hexdigest()

    def leaf(doc):
        return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in doc))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([h(*levels[-1][i:i + 16]) for i in range(0, len(levels[-1]), 16)])
        return levels

    def way(levels, i):
        for nodes in levels[:-1]:
            at = i // 16 * 16
            yield nodes[at:i], nodes[i + 1:at + 16]
            i //= 16

    by_source = {}
    for doc in rows:
        by_source.setdefault(doc[1], []).append(doc)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in sources:
        by_source[s].sort(key=lambda d: (d[0] is not None, d[0] or 0, leaf(d)))
        trees.append(tree([leaf(d) for d in by_source[s]]))
    crown = tree([t[-1][0] for t in trees])
    out = []
    for k, s in enumerate(sources):
        for i, doc in enumerate(by_source[s]):
            path = [*way(trees[k], i), *way(crown, k)]
            cur = leaf(doc)
            if doc[0] is not None and zlib.crc32(str(doc[0]).encode()) % 5 == 0 and doc[4]:
                cur = leaf((*doc[:4], re.sub("[A-Z]", lambda m: m.group().lower(), doc[4])))
            for before, after in path:
                cur = h(*before, cur, *after)
            out.append((doc[0], trees[k][0][i], trees[k][-1][0], crown[-1][0], h(*(x for step in path for side in step for x in side)), cur, cur == crown[-1][0]))
    return sorted(out, key=str)


def leaf_rows():
    rng = random.Random(7)
    rows = [(i, f"s{i % 40}" if i % 3 else "hot", "en", i, f"Text É {i} " + text_of(rng, i % 5)) for i in range(900)]
    rows += [(None, None, None, None, None), (None, "hot", None, 3, "NO id"), (5, None, "x", None, ""), (5, "alone", None, 1, None), (-7, "", "de", 1, "A" * 50_000),
             (901, "hot", "", 0, "Same"), (901, "hot", "", 0, "Same"), (901, "hot", "", 0, "Other"), (902, "é", None, 2, "É"), (903, "z\U0001F600", None, 2, "B")]
    return rows


def manifest_of(spark, rows):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    docs = spark.createDataFrame(rows, schema).withColumns({c: F.lit("x") for c in ("leaf", "size", "rank", "tree", "path", "kids", "own")}).repartition(5)
    return sorted((tuple(r) for r in manifest.manifest(docs).collect()), key=str)


def test_manifest_matches_brute_force(spark):
    rows = leaf_rows()
    got = manifest_of(spark, rows)
    assert got == merkle(rows)
    assert 0 < sum(not r[6] for r in got) < len(got) / 3


@pytest.mark.parametrize("rows", [[], [(1, "a", None, 1, "One")], [(i, "a", None, 1, "One") for i in range(17)], [(i, f"s{i}", None, 1, "t") for i in range(20)]])
def test_small_manifests(spark, rows):
    assert manifest_of(spark, rows) == merkle(rows)


def trie_rows(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    members, ends, rebuilt = {}, {}, {}
    for c, ts in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        first = c - int(np.fmod(c, 20))
        rebuilt[c] = (*convs.get(first, [])[:h], *ts[h:])
        for d in range(len(rebuilt[c]) + 1):
            members.setdefault(rebuilt[c][:d], []).append(c)
        ends.setdefault(rebuilt[c], []).append(c)
    out = []
    for key, cs in members.items():
        below = [k for k in members if k[:len(key)] == key]
        children = [k for k in below if len(k) == len(key) + 1]
        leaves = [k for k in below if not any(len(x) == len(k) + 1 and x[:len(k)] == k for x in members)]
        saved = sum((len(members[k]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) for k in below if k)
        out.append((min(cs), len(key), min(members[key[:-1]]) if key else None, len(cs), len(children), len(leaves), saved,
                    sha256(",".join(map(str, sorted(ends.get(key, [])))).encode()).hexdigest()))
    return sorted(out, key=str)


def conversation_rows():
    rng = random.Random(2)
    rows = []
    for c in [*range(-45, 0, 3), *range(70)]:
        for turn in range(rng.randrange(1, 7)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), f"say {rng.randrange(2)} x \x1c y"))
    rows += [(None, 0, "user", "nobody"), (200, None, None, None), (200, 0, "user", ""), (200, 0, "user", "b"), (200, 0, "assistant", "b"), (200, 0, "user", "b")]
    rows += [(300 + i, t, "user", "same words in all") for i in range(25) for t in range(5)]  # a third has one content
    rows += [(400, t, "user", f"long {t % 3}") for t in range(150)] + [(403, t, "user", "x " * 30_000) for t in range(2)]
    return rows


def trie_of(spark, rows, **how):
    convs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    convs = convs.withColumns({c: F.lit("x") for c in ("d", "k1", "rank", "w", "n", "saved")}).repartition(4)
    df = trie.prefix_trie(convs, **how)
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("shard, limit", [(trie.SHARD, trie.QUEUE), (6, 2), (40, 1)])
def test_trie_matches_brute_force(spark, shard, limit):
    rows = conversation_rows()
    assert trie_of(spark, rows, shard=shard, limit=limit) == trie_rows(rows)


@pytest.mark.parametrize("rows", [[], [(None, 1, "a", "b")], [(7, 0, "user", "hi")], [(20, 0, None, None)] * 3])
def test_small_tries(spark, rows):
    assert trie_of(spark, rows) == trie_rows(rows)


def test_queue_spills_and_sums():
    rng, queue, sums = random.Random(1), trie.SpillingQueue(limit=10), {}
    for _ in range(500):
        key = (-rng.randrange(3), rng.randrange(9) - 4, rng.randrange(3))
        message = (rng.randrange(5), rng.randrange(5), 1)
        queue.push((*key, *message))
        sums[key] = tuple(a + b for a, b in zip(sums.get(key, (0, 0, 0)), message))
    assert 1 < len(queue.runs) <= trie.RUNS < queue.made
    assert [queue.take(k) for k in sorted(sums)] == [sums[k] for k in sorted(sums)]


def test_ranks_of_a_group_that_spans_partitions(spark):
    rows = [("hot" if i % 3 else f"g{i % 7}", i * 7919 % 1000, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, o long, t long").repartition(6)
    got = {(r.g, r["rank"]): (r.o, r.t_upto, r.t_before) for r in ranks.ranked(df, "g", ["o", "t"], ["o", "t"], "test", terms=("t",)).collect()}
    for g in {g for g, _, _ in rows}:
        total = 0
        for rank, (o, t) in enumerate(sorted((o, t) for x, o, t in rows if x == g)):
            before, total = total, (total + t * pow(ranks.BASES[0], rank, ranks.WORD)) % ranks.WORD
            assert got[g, rank] == (o, ranks.signed(total), ranks.signed(before))
    assert len(got) == 3000

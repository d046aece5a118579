"""Models, tokenizers, packing and the search against brute force, round trips
and held-out accuracy."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from valuekit.llm import ann, bpe, fm, lm, packing, quality, toxicity
from valuekit.llm.common import WordHashes

ODD_TEXTS = ["", None, " ", "a", "Hello  world\n\n  don't we'll é中文😀", "<|endoftext|>a<|endoftext|> b", "a" * 5000, " " * 3000 + "x", "ab" * 4000,
             "１２３ 456", "\x00\x1c\x85 nbsp\xa0", "!?" * 3000, "中" * 4000, "x y z " * 9000]


def test_bpe_equals_the_library(docs_of):
    path = P.path("byte_bpe_50k.json")
    rows = list(enumerate(ODD_TEXTS)) + [(0, "again"), (0, "again"), (None, "no id")]
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.bpe_round_trip(docs_of(rows), path).collect())
    library = Tokenizer.from_file(path)
    from hashlib import sha256
    expected = Counter()
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected[(i, len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(),
                  sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())] += 1
    assert got == expected
    assert bpe.bpe_round_trip(docs_of([]), path).collect() == []


def test_bpe_decoding_of_broken_bytes_and_streaming():
    coder = bpe.Transducer(P.path("byte_bpe_50k.json"), window=64)
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rng = random.Random(0)
    for _ in range(50):
        ids = [rng.randrange(50257) for _ in range(20)]
        assert "".join(coder.decode(ids)) == library.decode(ids, skip_special_tokens=False)
    text = "".join(rng.choice(" ab\n中é'st") for _ in range(20000))
    assert coder.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_packing_holds_every_id_once(docs_of):
    path = P.path("word_bpe_49k.json")
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["the", "of", "Größe", "x1", "don't"]) for _ in range(rng.choice([3, 50, 700, 5000])))) for i in range(80)]
    rows += [(100 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(200, "same"), (200, "same"), (None, "no id")]
    got = packing.pack(docs_of(rows), path).collect()
    library = Tokenizer.from_file(path)
    expected = Counter()
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        for start in range(0, len(ids), 4096):
            part = np.array(ids[start:start + 4096], "<u4")
            expected[(i, start, len(part), zlib.crc32(part.tobytes()), len(ids))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == expected
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert packing.pack(docs_of([]), path).collect() == []


def test_plan_uses_what_is_there_and_wastes_little():
    rng = np.random.default_rng(0)
    histogram = np.zeros(4097, np.int64)
    histogram[1:4097] = rng.poisson(3, 4096)
    histogram[777] = 5000  # a hot length
    places = packing.Places(packing.plan(histogram))
    used = np.zeros(4097, np.int64)
    for n, k in places.taken.items():
        used[n] = k
    assert (used <= histogram).all() and used.sum() > 0.5 * histogram.sum()
    full = Counter()
    for n in np.flatnonzero(used):
        sequence, offset = places.find(np.full(used[n], n), np.arange(used[n]))
        assert (sequence >= 0).all()
        for s in sequence:
            full[int(s)] += int(n)
        assert places.find(np.array([n]), np.array([used[n]]))[0][0] == -1
    assert set(full.values()) == {4096}


def test_best_fit_fills_bins():
    lengths = np.random.default_rng(1).integers(1, 4096, 500)
    bins, offsets = packing.best_fit(lengths, 4096)
    for b in set(bins):
        parts = sorted(zip(offsets[bins == b], lengths[bins == b]))
        assert all(o == sum(x for _, x in parts[:i]) for i, (o, _) in enumerate(parts)) and sum(x for _, x in parts) <= 4096


def labelled(spark, docs_of, label):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        words = [f"w{rng.randrange(300)}" for _ in range(60)]
        bad = i % 4 == 0
        if bad and label == "toxic":
            words[rng.randrange(60)] = rng.choice(["idiot", "scum"])
            words[rng.randrange(60)] = "trash"
        if bad and label == "quality":
            words = [w + "%%%" for w in words[:30]] + ["| "] * 10
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad if label == "toxic" else not bad)))
    rows += [(1000, None), (1001, ""), (1002, "w1 " * 100_000), (3, rows[3][1]), (None, "w1")]
    return docs_of(rows), spark.createDataFrame(labels + [(None, 1), (5000, None)], f"doc_id long, {label} int"), dict(labels), len(rows)


def test_toxicity_held_out(spark, docs_of):
    docs, labels, truth, n = labelled(spark, docs_of, "toxic")
    out = toxicity.score_toxicity(docs, toxicity.toxicity_model(docs, labels), "doc_id").collect()
    assert len(out) == n and all(0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_quality_held_out(spark, docs_of):
    docs, labels, truth, n = labelled(spark, docs_of, "quality")
    out = quality.score_quality(docs, quality.quality_model(docs, labels), "doc_id").collect()
    assert len(out) == n and all(0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_models_without_labels_and_documents(spark, docs_of):
    empty = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    docs = docs_of([(1, "a b"), (2, None)])
    assert {r.score for r in toxicity.score_toxicity(docs, toxicity.toxicity_model(docs, empty), "doc_id").collect()} == {0.5}
    assert {r.score for r in quality.score_quality(docs, quality.quality_model(docs, empty), "doc_id").collect()} == {0.5}
    none = docs_of([])
    assert toxicity.score_toxicity(none, toxicity.toxicity_model(none, empty), "doc_id").collect() == []


def test_pair_sum_identity():
    rng = np.random.default_rng(0)
    model = fm.Model(np.arange(5, dtype=np.uint64), np.zeros(2), np.ones(2), 0.1, rng.normal(size=7), rng.normal(size=(7, 3)))
    hashes, dense = np.array([1, 3, 4, 99], np.uint64), np.array([0.5, -1.0])
    at, x = model.row(hashes, dense)
    z = 0.1 + model.weight[at] @ x + sum(model.factors[at[i]] @ model.factors[at[j]] * x[i] * x[j]
                                         for i in range(len(at)) for j in range(i))
    assert math.isclose(model.score(hashes, dense), 1 / (1 + math.exp(-z)))


def test_interactions_are_learned():
    """A pair that is bad only together."""
    rng = np.random.default_rng(0)
    rows, y = [], []
    for _ in range(1500):
        a, b = rng.random(2) < 0.4
        terms = {int(t) for t in rng.integers(10, 60, 5)} | ({1} if a else set()) | ({2} if b else set())
        rows.append((np.array(sorted(terms), np.uint64), np.zeros(0)))
        y.append(float(a and b))
    model = fm.fit(rows, np.array(y))
    assert np.mean([(model.score(*r) >= 0.5) == (t == 1) for r, t in zip(rows, y)]) > 0.97


def test_language_model_base_and_gain(docs_of):
    rng = random.Random(6)
    vocabulary = [f"w{int(rng.paretovariate(0.8))}" for _ in range(5000)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(60))) for i in range(300)]
    rows += [(400, None), (401, ""), (402, "The THE the"), (402, "The THE the"), (None, "w1"), (403, "w1 " * 20000)]
    got = lm.language_model_scores(docs_of(rows), chunk_chars=20000).collect()
    assert len(got) == len(rows)
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    tokens = [(i, (t or "").encode().lower().split() + [None]) for i, t in rows]
    counts = Counter(w for i, ws in tokens for w in ws if not held(i))
    n, v = sum(counts.values()), len(counts)
    expected = Counter((i, held(i), len(ws), sum(counts[w] > 0 for w in ws), n,
                        round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in tokens)
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == expected
    out = [r for r in got if r.held_out and r.n_tokens > 30]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert lm.language_model_scores(docs_of([])).collect() == []


def test_probabilities_of_a_seating_sum_to_one():
    rng = np.random.default_rng(3)
    counts = np.vstack([rng.poisson(2, (200, lm.FINE)), np.zeros((1, lm.FINE), int)])  # the last is the unknown word
    seating = lm.Seating(counts, np.ones(lm.N_TOTALS), 1)
    seating.totals = seating.sums()
    for _ in range(3):
        seating.sweep()
        seating.totals = seating.sums()
        assert np.allclose(seating.predictive()[2].sum(0), 1)
        assert (seating.t2 <= seating.c2).all() and ((seating.c2 > 0) == (seating.t2 > 0)).all()


def test_ties_go_to_smaller_ids(spark):
    """199 different vectors as near as the 20th: more than any list of a few."""
    rows = [(0, [1.0, 0.0, 0.0])] + [(i, [1.0, float(i), 0.5]) for i in range(199, 0, -1) if i % 20]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = sorted((r.rank, r.vec_id, r.score) for r in ann.nearest(table, window=1.0).collect())
    assert got == [(n + 1, i, 1.0) for n, i in enumerate([i for i in range(1, 23) if i % 20][:20])]


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1500, 16)) * rng.uniform(0.5, 2, (1500, 1))
    x[700:760] = x[40]  # equal vectors: ties go to the smaller id
    rows = [(i, [float(v) for v in row], 0) for i, row in enumerate(x)]
    rows += [(2000, None, 0), (2020, [0.0] * 16, 0), (2040, [float("nan")] * 16, 0), (2060, [1.0] * 3, 0), (None, rows[0][1], 0), rows[40], (2080, [], 0),
             (2100, [None] + [1.0] * 15, 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, c int").repartition(4)
    got = {}
    for r in ann.nearest(table, window=0.9).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(got) == list(range(0, 1500, 20))
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21)) and q not in {f[1] for f in found}
        scores = (x * x[q]).sum(1)
        assert all(math.isclose(s, scores[v], rel_tol=1e-12) for _, v, s in found)
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        order = [i for i in np.lexsort((np.arange(1500), -scores)) if i != q][:20]
        hits += len(set(order) & {f[1] for f in found})
    assert hits >= 0.9 * 20 * len(got)
    assert ann.nearest(table.limit(0)).collect() == []


def test_hilbert_neighbours_touch():
    grid = np.array([(a, b) for a in range(16) for b in range(16)])
    order = grid[np.argsort(ann.hilbert_keys(grid, 4))]
    assert len(set(ann.hilbert_keys(grid, 4).tolist())) == 256
    assert (np.abs(np.diff(order, axis=0)).sum(1) == 1).all()

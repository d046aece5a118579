"""Every word before has a restaurant of its own."""

import random
import zlib
from types import SimpleNamespace

import numpy as np

from valuekit.llm import lm


def test_what_follows_a_word_is_learned(docs_of):
    """400 words before of one class, each followed by a word of its own."""
    rng = random.Random(9)
    pairs = [f"a{i}zz b{rng.randrange(10**6)}" for i in range(400)]
    rows = [(i, " ".join(rng.choice(pairs) for _ in range(100))) for i in range(400)]
    got = [r for r in lm.language_model_scores(docs_of(rows), chunk_chars=20000).collect() if r.held_out]
    per_pair = sum(r.score for r in got) / sum(r.n_tokens // 2 for r in got)
    assert len(got) == sum(zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows)
    assert per_pair > np.log10(1 / 400) - 0.5  # the first word of a pair is free, the second one is known


def test_probabilities_after_a_word_sum_to_one():
    """All words after each of 40 words before."""
    rng = np.random.default_rng(3)
    us = np.sort(rng.integers(0, 2**63, 40).astype(np.uint64))
    counts = rng.poisson(0.7, (200, 40)).astype(np.uint32)
    counts[-1] = 0  # the unknown word
    row = SimpleNamespace(per=lm.packed(np.full(200, 40, np.uint32)), us=lm.steps(us), counts=lm.packed(counts),
                          who=lm.steps(np.tile(np.arange(40, dtype=np.uint32), 200)))
    seating = lm.PairSeating(row, np.ones(lm.N_SUMS), 1)
    for _ in range(3):
        seating.sweep()
        seating.all_c, seating.all_t = seating.by_context()
        totals = seating.sums()
        seating.above.totals = totals[:lm.N_TOTALS]
        assert totals[lm.TOKENS] == counts.sum() and totals[lm.VOCABULARY] == (counts.sum(1) > 0).sum()
        assert np.allclose(seating.predictive().reshape(200, 40).sum(0), 1)
        assert (seating.t3 <= seating.c3).all() and ((seating.c3 > 0) == (seating.t3 > 0)).all()

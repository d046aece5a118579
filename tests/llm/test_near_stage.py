"""The near_duplicates stage against a brute force for five words."""

import random

import corpus_pipeline as pipeline
import pytest
from brute import brute_components, near_rows, text_of

from valuekit.llm import minhash


def edited(words, *places):
    return " ".join(f"e{i}" if i in places else w for i, w in enumerate(words))


def test_stage_links_on_five_words(spark, docs_of):
    """Two scattered edits of 80 words are above 0.8 on four words, below it on five."""
    words = text_of(random.Random(8), 80, 10**6).split()
    rows = list({i: (i, t) for i, t in near_rows() if i is not None}.values())
    rows += [(200, edited(words)), (201, edited(words, 20, 60)), (202, edited(words, 40))]
    kept = {r.doc_id for r in pipeline.drop_near_duplicates(spark, docs_of(rows), "").collect()}
    assert kept == {d for d, _, _, stays in brute_components(rows, k=5) if stays}
    assert {200, 201} <= kept and 202 not in kept
    assert kept != {d for d, _, _, stays in brute_components(rows, k=4) if stays}


@pytest.mark.parametrize("block", [512, 4])
@pytest.mark.parametrize("k", [None, 4])
def test_operator_matches_brute_force(docs_of, k, block, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = near_rows()
    found = minhash.near_duplicates(docs_of(rows), **({"k": k} if k else {})).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found), key=str) == brute_components(rows, k=k or 5)


def test_one_row_of_each_component_stays(spark, docs_of):
    """Null and repeated ids: (a) null ids next to an empty text without id,
    (b) one id with two texts, one of them a near copy of another document."""
    words = [text_of(random.Random(n), 80, 10**6).split() for n in range(20, 26)]
    base = [" ".join(w) for w in words]
    rows = near_rows() + [
        (None, ""), (None, None), (None, " "), (None, " "), (300, None), (300, None),
        (301, base[0]), (None, base[0]), (None, edited(words[0], 40)),
        (None, base[1]), (None, base[1]), (None, edited(words[1], 30)), (None, edited(words[1], 50)),
        (302, base[2]), (303, base[3]), (303, edited(words[2], 10)),
        (304, base[4]), (304, edited(words[4], 70)), (304, base[5])]
    got = [(r.doc_id, r.text) for r in pipeline.drop_near_duplicates(spark, docs_of(rows), "").collect()]
    assert len(got) == len(set(got)) and set(got) <= set(rows)
    blank = {r for r in rows if not (r[1] or "").split()}
    assert {r for r in got if r in blank} == blank
    least, of = {}, components_of(rows, 5)
    for (doc_id, _), c in zip(rows, of):
        if c is not None:
            least[c] = min([x for x in (least.get(c), doc_id) if x is not None], default=None)
    at = {row: c for row, c in zip(rows, of)}
    stays = [(at[r], r[0]) for r in got if r not in blank]
    assert sorted(stays, key=str) == sorted(least.items(), key=str)


def components_of(rows, k):
    """The component of each row, None for rows without a word."""
    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    sets, of = [shingles(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = of[i], of[j]
                of = [b if x == a else x for x in of]
    return [c if s else None for c, s in zip(of, sets)]

"""Operators on texts against brute force, with the edge cases they define:
nulls, empty and long texts, ties, repeated rows, empty tables."""

import random
import re
from collections import Counter
from hashlib import sha256

import pytest

from brute import brute_components, near_rows, text_of

from valuekit.llm import fingerprint, license, minhash, substring
from valuekit.llm.common import WordHashes


def brute_repeats(rows, k=35):
    words = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i:i + k]) for w in words for i in range(len(w) - k + 1))
    out = []
    for (doc_id, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - k + 1):
            if seen[tuple(w[i:i + k])] > 1:
                gone.update(range(i, i + k))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), sha256(kept).hexdigest()))
    return sorted(out, key=str)


def repeat_rows():
    rng = random.Random(3)
    passage = text_of(rng, 60, 10**6)
    rows = [(i, text_of(rng, 20, 10**6) + " " + passage + "\n" + text_of(rng, 30 + i, 10**6)) for i in range(12)]
    rows += [(20, "a " * 200), (21, "x y z " * 50), (22, text_of(rng, 34, 3)), (23, passage + " " + passage), (24, None), (25, ""),
             (26, " \t\n"), (27, rows[0][1]), (27, rows[0][1]), (None, passage), (28, text_of(rng, 30000, 5)), (29, text_of(rng, 400, 2))]
    edited = rows[1][1].split()
    edited[40] = "other"
    return rows + [(30, " ".join(edited)), (31, "u\xa0v\x1c " * 40)]


def test_repeated_passages_match_brute_force(docs_of):
    rows = repeat_rows()
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring.remove_repeats(docs_of(rows)).collect()), key=str)
    assert got == brute_repeats(rows)


def test_repeats_of_an_empty_table(docs_of):
    assert substring.remove_repeats(docs_of([])).collect() == []


def test_cut_keeps_columns_that_clash(docs_of):
    out = substring.cut_repeats(docs_of(repeat_rows()))
    assert out.columns == ["doc_id", "text", "score", "c", "spans", "cut"]
    assert {r.spans for r in out.collect()} == {"z"}


@pytest.mark.parametrize("block", [512, 4])
def test_near_duplicates_match_brute_force(docs_of, block, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = near_rows()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs_of(rows), k=4).collect()), key=str)
    assert got == brute_components(rows)


def test_near_duplicates_of_an_empty_table(docs_of):
    assert minhash.near_duplicates(docs_of([])).collect() == []


def test_intersections_count_lists_and_products_alike():
    import numpy as np
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.int64)) for _ in range(70)]
    got = minhash.intersections(sets)
    for i in range(70):
        for j in range(70):
            if i != j:
                assert got[i, j] == len(np.intersect1d(sets[i], sets[j]))


def test_min_and_max_agree_as_often_as_the_sets_overlap():
    words = WordHashes()
    a = [f"w{i}" for i in range(1000)]
    s = [minhash.shingle_set(" ".join(a[lo:lo + 800]), 1, words) for lo in (0, 100)]
    same = (minhash.signature(s[0]) == minhash.signature(s[1])).mean()
    assert abs(same - 700 / 900) < 0.12


def test_notices_that_follow_each_other(docs_of):
    notice = next(t for t, label in license.NOTICES.items() if label == "mit-notice")
    words = notice.split()
    rows = [(1, "All rights reserved. All rights reserved."), (2, "all rights reserved " * 50), (3, "all rights were reserved"),
            (4, notice + " " + notice), (5, " ".join(words[:8] + ["so", "to", "say", "it", "all"] + words[8:])),
            (6, " ".join(words[:5] + ["x"] * 40 + words[5:])), (7, "reserved all rights all reserved"), (8, " ".join(words[:7]))]
    got = {r.doc_id: (r.labels, r.score) for r in license.license_scan(docs_of(rows)).collect()}
    pairs = len(words) - 1
    assert got == {1: ("all-rights-reserved", 1.0), 2: ("all-rights-reserved", 1.0), 3: ("", 0.0), 4: ("mit-notice", 1.0),
                   5: ("mit-notice", (pairs - 1) / pairs), 6: ("mit-notice", (pairs - 5) / pairs), 7: ("", 0.0), 8: ("", 0.0)}


def test_licenses(docs_of):
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated files"
    rows = [(1, "Under the MIT License, or Apache\nLICENSE; mit license"), (2, None), (3, ""), (4, "mit"), (5, "GNU General Public License cc by"),
            (6, notice), (7, "gnu general license"), (8, "é" * 10 + " mit license " * 3000), (9, "x mit license"), (9, "x mit license"), (None, "cc-by"),
            (10, "all rights reserved")]
    got = sorted(license.license_scan(docs_of(rows)).collect(), key=str)
    expected = []
    for doc_id, text in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        at = sorted((i, label) for phrase, label in license.PHRASES.items() for i in range(len(words))
                    if words[i:i + len(phrase.split())] == phrase.split())
        expected.append((doc_id, len(words), len(at), at[0][0] if at else None, at[-1][0] if at else None,
                         ",".join(sorted({label for _, label in at}))))
    assert sorted([(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got], key=str) == sorted(expected, key=str)
    by = {r.doc_id: r for r in got}
    assert by[6].labels == "mit-notice" and 0.6 <= by[6].score < 1 and by[10].labels == "all-rights-reserved"
    assert by[5].labels == "cc-by,gpl" and by[7].labels == "" and by[7].score == 0.0


def test_fingerprints(docs_of):
    rng = random.Random(1)
    rows = [(i, text_of(rng, 30 * (i % 7), 5000)) for i in range(60)] + [(60, None), (61, "short"), (61, "short"), (62, "é" * 5000), (None, "no id")]
    got = fingerprint.fingerprints(docs_of(rows)).collect()
    assert len(got) == len(rows)
    texts = {}
    for r in got:
        texts.setdefault(r.n_chars, set()).add(r.fingerprint)
    order = sorted([(i, t or "") for i, t in rows if i is not None], key=lambda x: -x[0])
    expected = Counter()
    order = sorted(((i if i is not None else -(1 << 63)), t or "") for i, t in rows)[::-1]
    ids = [i for i, _ in order]
    if len(set(ids)) == len(ids):
        raise AssertionError("the fixture repeats a doc_id")
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        k = len(t) // 3
        expected[(None if i == -(1 << 63) else i, len(t), sha256((t[:len(t) - k] + nxt[:k]).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == expected
    same = [r for r in got if r.doc_id == 61]
    assert same[0].fingerprint == same[1].fingerprint and max(r.near_next for r in same) == 1.0
    long = [r for r in got if r.n_chars > 600 and r.doc_id != 62]
    assert sum(r.near_edited for r in long) / len(long) > 0.5 and sum(r.near_next for r in long) / len(long) < 0.1


def test_fingerprints_of_one_and_of_no_document(docs_of):
    assert fingerprint.fingerprints(docs_of([])).collect() == []
    (row,) = fingerprint.fingerprints(docs_of([(5, "only one")])).collect()
    assert row.near_next == 1.0


def test_entropy_bins_match_counting():
    import math

    import numpy as np
    x = np.random.default_rng(2).integers(97, 105, 500).astype(np.uint8)
    for i, b in enumerate(fingerprint.entropy_bins(x)):
        counts = Counter(x[i:i + fingerprint.WINDOW].tolist())
        h = math.log2(fingerprint.WINDOW) - sum(c * math.log2(c) for c in counts.values()) / fingerprint.WINDOW
        assert abs(b - h / math.log2(fingerprint.WINDOW) * 1000) <= 1.001

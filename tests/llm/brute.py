"""Texts and brute-force versions that several tests of this folder share."""

import random


def text_of(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def brute_components(rows, k=4, percent=80):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return frozenset([tuple(w)] if 0 < len(w) < k else [tuple(w[i:i + k]) for i in range(len(w) - k + 1)])
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least.setdefault(find(i), []).append(doc_id)
    least = {r: min((x for x in ids if x is not None), default=None) for r, ids in least.items()}
    return sorted([(d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(rows)], key=str)


def near_rows():
    rng = random.Random(5)
    rows, n = [], 0
    for group in range(6):
        base = text_of(rng, 80, 10**6).split()
        for _ in range(10):
            copy = list(base)
            for _ in range(rng.randrange(6)):
                copy[rng.randrange(80)] = f"e{rng.randrange(10**6)}"
            rows.append((n, " ".join(copy)))
            n += 1
    rows += [(100, None), (101, ""), (102, "one two"), (103, "ONE  two"), (104, "one two three"), (105, rows[0][1]), (105, rows[0][1]),
             (None, rows[1][1]), (None, "alone and without id here"), (106, text_of(rng, 20000, 10**6)), (107, "\n")]
    return rows

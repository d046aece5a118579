"""Components against a union by hand: chains, stars, rings, repeats, hubs."""

import random

import pytest

from valuekit.llm.components import components, only_stars


def by_hand(edges):
    root = {x: x for e in edges for x in e}

    def top(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for u, v in edges:
        a, b = sorted((top(u), top(v)))
        root[b] = a
    return sorted((x, top(x)) for x in root)


rng = random.Random(3)
SHAPES = {
    "chain": [(i, i + 1) for i in range(40)],
    "shuffled chain": (lambda p: list(zip(p, p[1:])))(rng.sample(range(60), 60)),
    "stars": [(100 * (i % 5), 100 * (i % 5) + i + 1) for i in range(90)],
    "star around its largest": [(1000, i) for i in range(50)],
    "ring and hub": [(i, (i + 1) % 60) for i in range(60)] + [(7, 1000 + i) for i in range(400)],
    "random": [e for e in ((rng.randrange(-400, 400), rng.randrange(-400, 400)) for _ in range(350)) if e[0] != e[1]],
    "repeats": [(5, 3), (3, 5), (5, 3), (9, 5)],
    "two parents": [(3, 1), (3, 2)],
    "none": [],
}


@pytest.mark.parametrize("shape", SHAPES)
def test_same_roots(spark, shape):
    edges = spark.createDataFrame(SHAPES[shape], "u long, v long")
    assert sorted(map(tuple, components(edges).collect())) == by_hand(SHAPES[shape])


def test_only_stars(spark):
    stars = lambda rows: only_stars(spark.createDataFrame(rows, "u long, v long"))
    assert stars([]) and stars([(5, 1), (6, 1), (9, 8)])
    assert not stars([(3, 1), (3, 2)]) and not stars([(3, 2), (2, 1)])

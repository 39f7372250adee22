"""Centroid clustering against plain rounds over all centroids."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from pulsewatch.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, cluster string, label int"


def brute(rows, k, size, rounds, seed=3):
    kept = [
        (i, [math.floor(Fraction(x) * 1024) for x in v])
        for i, v in rows
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]

    def key(row):
        return (row[0] is None, hashlib.sha256(f"{seed}:{row[0]}".encode()).hexdigest(), row[1])

    centres = [v for _, v in sorted(kept, key=key)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(centres))

    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in kept]
        for i in range(len(centres)):
            mine = [v for (_, v), c in zip(kept, at, strict=True) if c == i]
            if mine:
                centres[i] = [sum(column) // len(mine) for column in zip(*mine, strict=True)]
    out = []
    for i, v in kept:
        d, c = nearest(v)
        out.append((i, c, d, hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest()))
    inertia = sum(d for _, _, d, _ in out)
    return sorted(
        ((i, c, d, sum(e for _, o, e, _ in out if o == c), inertia, sha) for i, c, d, sha in out), key=str
    )


def found(spark, rows, **options):
    table = spark.createDataFrame([(i, v, "x", 0) for i, v in rows], SCHEMA)
    return sorted((tuple(r)[:6] for r in centroids.clustered(table, **options).collect()), key=str)


@pytest.mark.parametrize(("k", "rounds"), [(4, 3), (1, 2), (7, 10)])
def test_equals_a_comparison_with_all(spark, k, rounds):
    draw = random.Random(k)
    rows = [(i, [draw.gauss(i % 5, 0.4) - 2 for _ in range(6)]) for i in range(120)]
    rows += [(200, None), (201, []), (202, [1.0] * 5), (203, [1.0] * 5 + [None]), (204, [math.nan] * 6), (205, [math.inf] * 6)]
    rows += [(None, [0.5] * 6), *rows[:3], rows[0]]
    assert found(spark, rows, clusters=k, size=6, rounds=rounds) == brute(rows, k, 6, rounds)


def test_ties_few_vectors_and_empty_tables(spark):
    assert found(spark, [], clusters=3, size=2, rounds=2) == []
    assert found(spark, [(1, [0.1])], clusters=3, size=2, rounds=2) == []
    rows = [(i, [float(x), 0.0]) for i, x in enumerate([0, 2, 1, 1, 1, 0, 2])]
    assert found(spark, rows, clusters=9, size=2, rounds=4) == brute(rows, 9, 2, 4)


def test_large_components_are_exact_and_beyond_64_bits_null(spark):
    rows = [(i, [2.0**40 + i, -(2.0**39) * i]) for i in range(5)]
    got = found(spark, rows, clusters=2, size=2, rounds=1)
    exact = brute(rows, 2, 2, 1)
    assert [(r[0], r[1], r[5]) for r in got] == [(r[0], r[1], r[5]) for r in exact]
    assert [r[2] for r in got] == [r[2] if r[2] < 1 << 63 else None for r in exact]
    huge = [(1, [1.7e308, 0.0]), (2, [-1.7e308, 0.0]), (3, [9e23, 1.0])]
    assert [r[0] for r in found(spark, huge, clusters=2, size=2, rounds=1)] == [3]


def test_the_walk_stops_early_and_never_too_early():
    draw = np.random.default_rng(1)
    middles = draw.integers(-4000, 4000, (40, 8))
    vectors = middles[draw.integers(0, 40, 500)] + draw.integers(-20, 20, (500, 8))
    number, distance, computed = centroids.assigned(vectors, middles.astype(object))
    every = ((vectors[:, None] - middles[None]) ** 2).sum(2)
    assert (number == every.argmin(1)).all() and (distance == every.min(1)).all()
    assert computed < 500 * 40 / 3
    same = np.zeros((5, 8), np.int64)
    assert (centroids.assigned(vectors[:7], same)[0] == 0).all()

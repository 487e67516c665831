"""Clusters against plain k-means in whole numbers."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from navloom.llm import clustering


def whole(vector, width):
    if vector is None or len(vector) != width or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(1024 * x) for x in vector]


def brute(rows, k, rounds, width, seed=3):
    kept = [(i, v) for i, x in rows if (v := whole(x, width)) is not None]
    name = lambda i: "" if i is None else str(i)
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{name(r[0])}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in start[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centres = [
            [sum(x) // len(groups[n]) for x in zip(*groups[n])] if n in groups else c for n, c in enumerate(centres)
        ]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    fits = lambda n: n if n < 1 << 63 else None
    own, out = {}, []
    for _, c, d in found:
        own[c] = own.get(c, 0) + d
    for i, c, d in found:
        text = ",".join(map(str, centres[c]))
        out.append((i, c, fits(d), fits(own[c]), fits(sum(own.values())), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(table, **options):
    return sorted(map(tuple, clustering.with_inertia(*clustering.clusters(table, **options)).collect()), key=str)


@pytest.mark.parametrize("n, spread, far", [(3, 1.0, 1), (400, 0.1, 1), (300, 3.0, 1), (120, 0.5, 3e6), (60, 1.0, 1e15)])
def test_clusters(spark, n, spread, far):
    """Few vectors, tight and loose clouds, components whose squares pass a long."""
    chance = np.random.default_rng(n)
    width, centres = 12, chance.normal(size=(5, 12))
    rows = [(i, [float(far * x) for x in centres[i % 5] + spread * chance.normal(size=width)]) for i in range(n)]
    rows += [(10_000 + i, rows[0][1]) for i in range(4)] + [(1, rows[1][1]), (None, rows[2][1])]
    bad = [(1, None), (2, [math.nan] * 12), (3, [math.inf] * 12), (4, [1.0]), (5, []), (6, [None] * 12), (7, [1.0] * 13)]
    frame = spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<double>").repartition(3)
    frame = frame.select("*", *[F.lit(1).alias(c) for c in ("v", "cluster", "distance", "apex", "c")])
    assert rows_of(frame, k=8, rounds=4, width=width) == brute(rows, 8, 4, width)


def test_equal_vectors_and_empty_clusters(spark):
    rows = [(i, [float(i % 2), 0.5]) for i in range(50)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert rows_of(frame, k=6, rounds=3, width=2) == brute(rows, 6, 3, 2)
    assert rows_of(frame.limit(0)) == []
    assert rows_of(frame) == []


def test_bounds_hold_and_filter():
    """Bounds enclose the distances, and most whole vectors are not compared."""
    chance = np.random.default_rng(7)
    centres = 1000 * chance.normal(size=(8, 64))
    vectors = np.floor(centres[chance.integers(0, 8, 2000)] + 60 * chance.normal(size=(2000, 64))).astype(np.int64)
    simplex = clustering.Simplex(vectors[:300])
    assert len(simplex.pivots) == clustering.PIVOTS
    apexes = simplex.apexes(vectors)
    none = np.zeros(len(vectors))
    low, high = clustering.bounds(apexes, apexes[:50], none)
    real = np.sqrt(((vectors[:, None] - vectors[None, :50]).astype(float) ** 2).sum(-1))
    slack = 0.01
    assert (low <= real + slack).all() and (real <= high + slack).all()
    whole_centres = np.floor(centres).astype(np.int64)
    best, distance, compared = clustering.nearest(vectors, apexes, whole_centres, simplex)
    every = clustering.squares(vectors[:, None], whole_centres[None])
    assert (best == every.argmin(1)).all() and (distance == every.min(1)).all()
    assert compared < 1.5 * len(vectors)


def test_pivots_in_a_line_give_one_dimension():
    line = np.arange(40)[:, None] * np.ones((1, 5), np.int64)
    simplex = clustering.Simplex(line)
    assert len(simplex.pivots) == 2
    same = clustering.Simplex(np.ones((9, 5), np.int64))
    assert len(same.pivots) == 1 and np.allclose(same.apexes(line)[:, 0], np.sqrt(5) * np.abs(np.arange(40) - 1))

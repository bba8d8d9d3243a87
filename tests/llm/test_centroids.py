"""Clusters against plain rounds over all distances."""

import hashlib
import math

import numpy as np
import pytest

from trailmetrics.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, label string"


def plain(rows, k=16, rounds=3, seed=1):
    """(vec_id, cluster, distance, centroid, cluster inertia, inertia), from Python's integers."""
    points = [
        (i, tuple(math.floor(64 * x) for x in v))
        for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]

    def order(point):
        return ("g" if point[0] is None else hashlib.sha256(f"{seed}:{point[0]}".encode()).hexdigest(), point[1])

    middles = [v for _, v in sorted(points, key=order)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(middles))

    for _ in range(rounds):
        groups = {}
        for _, v in points:
            groups.setdefault(nearest(v)[1], []).append(v)
        for c, own in groups.items():
            middles[c] = tuple(sum(x) // len(own) for x in zip(*own))
    found = [(i, *nearest(v)[::-1]) for i, v in points]
    of = {}
    for _, c, d in found:
        of[c] = of.get(c, 0) + d
    return sorted(
        ((i, c, d, list(middles[c]), of[c], sum(of.values())) for i, c, d in found), key=repr
    )


def clusters(spark, scratch, rows, **options):
    frame = spark.createDataFrame([(i, v, "own") for i, v in rows], SCHEMA)
    found = centroids.cluster(frame, scratch, **options).select(
        "vec_id",
        "__llm_cluster",
        "__llm_distance",
        "__llm_centroid",
        "__llm_cluster_inertia",
        "__llm_inertia",
    )
    return sorted((tuple(row) for row in found.collect()), key=repr)


def vectors(seed, count, spread=1.0):
    random = np.random.default_rng(seed)
    middles = random.normal(size=(5, 64))
    return [
        (i, (middles[i % 5] + spread * random.normal(size=64)).tolist()) for i in range(count)
    ]


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_against_plain_rounds(spark, scratch, spread):
    rows = vectors(1, 150, spread)
    assert clusters(spark, scratch, rows) == plain(rows)


def test_other_numbers_of_clusters_and_rounds(spark, scratch):
    rows = vectors(2, 60)
    assert clusters(spark, scratch, rows, k=3, rounds=1, seed=9) == plain(rows, 3, 1, 9)
    assert clusters(spark, scratch, rows[:2]) == plain(rows[:2])


def test_rows_that_are_left_out_ties_and_repeated_rows(spark, scratch):
    one = [1.0] * 64
    rows = [
        (1, None),
        (2, []),
        (3, [1.0] * 63),
        (4, [1.0] * 65),
        (5, [None] + [1.0] * 63),
        (6, [math.nan] + [1.0] * 63),
        (7, [-math.inf] + [1.0] * 63),
        (8, one),
        (8, one),
        (None, one),
        (None, [0.5] * 64),
        (9, [0.0] * 64),
        (9, [-0.01] * 64),
        (10, [1e-300] * 64),
    ]
    found = clusters(spark, scratch, rows, k=4)
    assert found == plain(rows, 4) and len(found) == 7
    assert clusters(spark, scratch, rows, k=16) == plain(rows)


def test_empty_table(spark, scratch):
    assert clusters(spark, scratch, []) == []
    assert clusters(spark, scratch, [(1, None)]) == []


def test_large_components_are_exact(spark, scratch):
    """Beyond 2**24, sums of squares of coefficients do not fit 64 bits."""
    rows = [(i, [float(2**20 + i * j % 7) for j in range(64)]) for i in range(20)]
    rows += [(i + 20, [-float(2**20)] * 64) for i in range(3)]
    assert clusters(spark, scratch, rows, k=4) == plain(rows, 4)


def test_centroids_are_left_out_early():
    """Vectors near a centroid need few coefficients of the others, and lose none of equals."""
    random = np.random.default_rng(3)
    middles = random.integers(-300, 300, (16, 64))
    points = np.repeat(middles, 20, axis=0) + random.integers(-9, 9, (320, 64))
    found, distances = centroids.nearest(points, middles)
    every = ((points[:, None] - middles[None]) ** 2).sum(axis=2)
    assert (found == every.argmin(axis=1)).all() and (distances == every.min(axis=1)).all()
    twice = np.concatenate([middles, middles])
    assert (centroids.nearest(points, twice)[0] == found).all()


def test_transform_is_exact_and_coarse_first():
    random = np.random.default_rng(4)
    a, b = random.integers(-1000, 1000, (2, 1, 64))
    difference = centroids.transform(a) - centroids.transform(b)
    assert (difference**2).sum() == 64 * ((a - b) ** 2).sum()
    changes = [(np.diff(row) != 0).sum() for row in centroids._SIGNS.T[centroids._COARSE_FIRST]]
    assert changes == list(range(64))

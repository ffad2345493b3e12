import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException

from glosswork.llm import simplex_clusters as s

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, dims, k=8, rounds=10, salt="3"):
    kept = []
    for i, v, _ in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, tuple(math.floor(1024 * float(np.float32(x))) for x in v)))
    mark = lambda i: hashlib.sha256(f"{salt}:{i}".encode()).hexdigest()
    centroids = [q for _, q in sorted(kept, key=lambda r: (r[0] is None, mark(r[0]), r[1]))[:k]]
    far = lambda q, c: sum((a - b) ** 2 for a, b in zip(q, c, strict=True))
    place = lambda q: min((far(q, c), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for _, q in kept:
            groups.setdefault(place(q)[1], []).append(q)
        for n, own in groups.items():
            centroids[n] = tuple(sum(x) // len(own) for x in zip(*own, strict=True))
    placed = [(i, *place(q)) for i, q in kept]
    every = sum(d for _, d, _ in placed)
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        ((i, n, d, sum(e for _, e, m in placed if m == n), every, sha[n]) for i, d, n in placed), key=str
    )


def vectors(seed, n, dims, spread=1.0, lumps=5):
    rng = random.Random(seed)
    middle = [[rng.gauss(0, spread) for _ in range(dims)] for _ in range(lumps)]
    return [(i, [m + rng.gauss(0, 0.2) for m in rng.choice(middle)], 0) for i in range(n)]


@pytest.mark.parametrize("seed,n,dims", [(1, 300, 64), (2, 200, 5), (3, 12, 64), (4, 5, 3)])
def test_as_brute_force(spark, seed, n, dims):
    rows = vectors(seed, n, dims)
    got = s.clusters(spark.createDataFrame(rows, SCHEMA), dims=dims)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, dims)


def test_odd_rows(spark):
    rows = vectors(5, 60, 4)
    same = [0.25, -0.5, 0.0, 1.0]
    rows += [(100 + i, same, 1) for i in range(40)] + [(7, same, 1)] * 3 + [(None, same, 1), (None, [9.0, 9.0, 9.0, 9.0], 1)]
    bad = [None, [], [1.0] * 3, [1.0] * 5, [1.0, None, 0.0, 0.0], [float("nan")] * 4, [0.0, float("-inf"), 0.0, 0.0]]
    rows += [(200 + i, v, 1) for i, v in enumerate(bad)]
    got = s.clusters(spark.createDataFrame(rows, SCHEMA), dims=4)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 4)


def test_all_equal_all_dropped_and_empty(spark):
    equal = [(i, [1.0, 2.0], 0) for i in range(20)]
    got = s.clusters(spark.createDataFrame(equal, SCHEMA), dims=2)
    assert sorted(map(tuple, got.collect()), key=str) == brute(equal, 2)
    for rows in ([], [(1, None, 0)]):
        out = s.clusters(spark.createDataFrame(rows, SCHEMA), dims=2)
        assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
        assert out.count() == 0


def test_clashing_columns(spark):
    rows = vectors(6, 30, 3)
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS q", "3 AS cluster", "4 AS mark", "5 AS apex")
    assert sorted(map(tuple, s.clusters(frame, dims=3).collect()), key=str) == brute(rows, 3)


def test_components_out_of_range_are_told(spark):
    with pytest.raises(PySparkException, match="beyond"):
        s.clusters(spark.createDataFrame([(1, [1e30, 0.0], 0)], SCHEMA), dims=2).collect()
    most = [(1, [131072.0, -131072.0], 0), (2, [-131072.0, 131072.0], 0), (3, [131071.0, 0.0], 0)]
    got = s.clusters(spark.createDataFrame(most, SCHEMA), dims=2, k=2)
    assert sorted(map(tuple, got.collect()), key=str) == brute(most, 2, 2)


@pytest.mark.parametrize("seed,size", [(1, 600), (2, 1 << 20), (3, 1 << 26), (4, 3)])
def test_bounds_hold_and_the_filter_is_exact(seed, size):
    rng = np.random.default_rng(seed)
    lumps = rng.integers(-size, size, (6, 16))
    rows = np.clip(lumps[rng.integers(0, 6, 500)] + rng.integers(-size // 9 - 1, size // 9 + 1, (500, 16)), -(1 << 27), 1 << 27)
    simplex, centroids = s.Simplex(rows[:64]), rows[100:112]
    apex, centres = simplex.apex(rows), simplex.apex(centroids)
    far = ((rows[:, None] - centroids) ** 2).sum(axis=2)
    low, up = s._bounds(apex, centres)
    assert (low <= far).all() and (far <= up).all()
    found, compared = s.nearest(rows, apex, centroids, centres)
    assert (found == far.argmin(axis=1)).all() and compared < 500 * 12


def test_the_filter_spares_exact_distances(spark):
    seen = []
    s.clusters(spark.createDataFrame(vectors(8, 400, 64, spread=3.0, lumps=8), SCHEMA), seen=seen).collect()
    assert seen and all(n < 400 * 8 / 2 for n in seen)

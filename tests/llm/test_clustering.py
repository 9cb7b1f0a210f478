import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from traceframe.llm import clustering


def brute(rows, dim, k, rounds, seed=3):
    """(id, vector) in plain Python; per row cluster and distance, and the centroids."""
    kept = [(i, [math.floor(1024 * x) if abs(x) < 2**53 else int(x) * 1024 for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    cents = [v for _, v in sorted(kept, key=key)[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents))
    for _ in range(rounds):
        groups = [[] for _ in cents]
        for _, v in kept:
            groups[near(v)[1]].append(v)
        cents = [[sum(c) // len(g) for c in zip(*g)] if g else old for g, old in zip(groups, cents)]
    return [(i, *near(v)[::-1]) for i, v in kept], cents


def frame(spark, rows):
    schema = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(DoubleType())),
                         StructField("cluster", StringType()), StructField("distance", StringType())])
    return spark.createDataFrame([(*r, "own", "own") for r in rows], schema)


def vectors(n, dim, seed=1, scale=1.0):
    rng = np.random.default_rng(seed)
    middles = rng.standard_normal((5, dim))
    return [(i, [float(x) for x in scale * (middles[i % 5] + 0.4 * rng.standard_normal(dim))]) for i in range(n)]


@pytest.mark.parametrize("scale", [1.0, 1e9, 1e160])
def test_against_plain_python(spark, scale):
    rows = vectors(400, 4, scale=scale)
    rows += [rows[0], rows[0], (None, rows[3][1]), (900, None), (901, []), (902, [1.0] * 3), (903, [1.0, None, 2.0, 3.0]),
             (904, [math.nan, 1.0, 1.0, 1.0]), (905, [math.inf, 1.0, 1.0, 1.0]), (906, [0.0] * 4)]
    found, centroids = clustering.cluster(frame(spark, rows).repartition(5), dimensions=4, k=6, rounds=7)
    want, cents = brute(rows, 4, 6, 7)
    assert centroids == cents
    fits = lambda x: x if x < 1 << 63 else None
    want = [(i, c, fits(d)) for i, c, d in want]
    out = clustering.with_inertia(found, centroids).collect()
    assert sorted(map(repr, want)) == sorted(repr((r["vec_id"], r["cluster"], r["distance"])) for r in out)
    far = any(d is None for _, _, d in want)
    for r in out:
        own = [d for _, c, d in want if c == r["cluster"]]
        assert r["cluster_inertia"] == (None if None in own or sum(own) >= 1 << 63 else sum(own))
        assert r["inertia"] == (None if far or sum(d for *_, d in want) >= 1 << 63 else sum(d for *_, d in want))
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, cents[r["cluster"]])).encode()).hexdigest()


def test_few_rows_and_none(spark):
    rows = vectors(3, 4)
    found, centroids = clustering.cluster(frame(spark, rows), dimensions=4, k=8)
    assert len(centroids) == 3 and sorted(r["cluster"] for r in found.collect()) == [0, 1, 2]
    same = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(20)]
    found, centroids = clustering.cluster(frame(spark, same), dimensions=4, k=5)
    assert {(r["cluster"], r["distance"]) for r in found.collect()} == {(0, 0)} and len(centroids) == 5
    found, centroids = clustering.cluster(frame(spark, rows).limit(0), dimensions=4)
    assert centroids == [] and clustering.with_inertia(found, centroids).count() == 0


def test_walk_finds_the_nearest_and_saves_distances():
    rng = np.random.default_rng(2)
    for trial in range(30):
        k = int(rng.integers(1, 40))
        cents = rng.integers(-20, 20, (k, 2)).tolist()  # many ties
        points = rng.integers(-25, 25, (300, 2))
        away = ((points[:, None] - np.array(cents)) ** 2).sum(2)
        near, best, measured = clustering.Centroids(cents).nearest(points, start=int(rng.integers(k)))
        assert (near == away.argmin(1)).all() and (best == away.min(1)).all()
        assert measured <= k * len(points)
    middles = rng.integers(-(10**6), 10**6, (200, 3))
    points = middles[rng.integers(200, size=1000)] + rng.integers(-50, 50, (1000, 3))
    assert clustering.Centroids(middles.tolist()).nearest(points)[2] < 1000 * 200 / 2


def test_floor_is_exact():
    values = np.array([[0.1, -0.1, 1 / 1024, -1 / 2048], [5e-324, -5e-324, 3.0, -0.0]])
    assert clustering.whole(values).tolist() == [[102, -103, 1, -1], [0, -1, 3072, 0]]
    big = np.array([[1e300, -1e300, 2.0**53 + 2, 0.5]])
    assert clustering.whole(big).tolist() == [[int(1e300) * 1024, -int(1e300) * 1024, (2**53 + 2) * 1024, 512]]


def test_sums_are_dealt_by_centroid_before_the_shuffle(spark):
    rows = clustering.usable(frame(spark, vectors(50, 4)), "vec_id", "embedding", 4)
    assert rows.count() == 50 and rows.select(F.size("v")).distinct().count() == 1

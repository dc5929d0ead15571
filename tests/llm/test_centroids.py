"""Centroid clustering against full search in Python integers."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest

from nocturne.llm import centroids
from nocturne.llm.shared import Scratch

SHAPE = "vec_id long, embedding array<double>, label int, cluster string, distance string"


def brute(rows, k, rounds, dims, scale):
    """(vec_id, cluster, distance, cluster_inertia, inertia, sha256) of each kept row."""
    kept = [(i, [math.floor(Fraction(x) * scale) for x in e]) for i, e in rows if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    points = [list(v) for _, v in order[:k]]
    if not points:
        return []

    def nearest():
        return [min((sum((a - b) ** 2 for a, b in zip(v, p, strict=True)), c) for c, p in enumerate(points)) for _, v in kept]

    for _ in range(rounds):
        at = [c for _, c in nearest()]
        for c in range(len(points)):
            if own := [v for (_, v), a in zip(kept, at, strict=True) if a == c]:
                points[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = nearest()
    per = {}
    for d, c in found:
        per[c] = per.get(c, 0) + d
    sha = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    return sorted((i, c, d, per[c], sum(per.values()), sha[c]) for (i, _), (d, c) in zip(kept, found, strict=True))


def run(spark, rows, parts=3, **how):
    df = spark.createDataFrame([(i, None if e is None else [None if x is None else float(x) for x in e], 0, "clash", "clash") for i, e in rows], SHAPE).repartition(parts)
    return centroids.cluster(df, Scratch(spark), **how)


def told(df):
    return sorted(tuple(r)[:6] for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_full_search_and_skips(spark, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (12, 16))
    rows = [(i, (centres[i % 12] + rng.normal(0, 0.15, 16)).tolist()) for i in range(600)]
    got = run(spark, rows, k=20, dims=16)
    assert told(got) == brute(rows, 20, 5, 16, 256)
    assert got.agg({"computed": "sum"}).collect()[0][0] < 0.5 * 6 * 20 * 600  # what full search reckons


def test_ties_repeats_and_kinds_of_rows(spark):
    grid = [[a / 256, b / 256] for a in range(-4, 5) for b in range(-4, 5)]
    rows = list(enumerate(grid)) + list(enumerate(grid[:20])) + [(7, grid[50]), (900, None), (901, []), (902, [1.0]), (903, [1.0, None]), (904, [float("nan"), 1.0]), (905, [1.0, float("inf")]), (906, [0.0, 0.0, 0.0])]
    assert told(run(spark, rows, k=9, dims=2)) == brute(rows, 9, 5, 2, 256)


def test_one_vector_holds_a_third(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [0.5] * 4 if i % 3 == 0 else rng.normal(0, 1, 4).tolist()) for i in range(300)]
    assert told(run(spark, rows, k=5, dims=4)) == brute(rows, 5, 5, 4, 256)


def test_few_vectors_and_none(spark):
    rows = [(1, [1.0, 2.0]), (2, [3.0, 4.0])]
    assert told(run(spark, rows, k=5, dims=2)) == brute(rows, 5, 5, 2, 256)
    empty = run(spark, [(1, None)], k=5, dims=2)
    assert empty.count() == 0 and empty.columns[:6] == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_huge_components_are_exact(spark):
    rows = [(i, [x, y]) for i, (x, y) in enumerate([(1e300, -1e300), (1e300, -9e299), (2.0, 3.0), (2.5, 3.5), (1e7, 1e7), (1e7 + 1, 1e7), (-1e15, 4.0), (1.7e308, 1.7e308), (0.0, 0.0)])]
    want = brute(rows, 4, 5, 2, 256)
    got = told(run(spark, rows, k=4, dims=2))
    assert [(r[0], r[1], r[5]) for r in got] == [(r[0], r[1], r[5]) for r in want]
    assert [r[2] for r in got] == [min(r[2], centroids.LONG) for r in want]


def test_null_ids_are_kept(spark):
    rows = [(i, [float(i), 1.0]) for i in range(5)] + [(None, [2.2, 1.0])]
    got = run(spark, rows, k=3, dims=2).collect()
    assert len(got) == 6 and [r.cluster for r in got if r.vec_id is None] == [r.cluster for r in got if r.vec_id == 2]


def test_bounds_are_outward():
    rng = np.random.default_rng(5)
    s = rng.integers(0, 2**50, 1000).astype(float)
    up, down = centroids.upper_roots(s), centroids.lower_roots(s)
    for x, u, d in zip(s, up, down, strict=True):
        assert Fraction(u) ** 2 >= int(x) and (d == 0 or Fraction(d) ** 2 <= int(x))
    assert (centroids.down32(down).astype(float) <= down).all()
    for x in (0, 1, 2**4000, 10**700 + 1):
        assert centroids.lower_roots(np.array([x], object))[0] <= centroids.upper_roots(np.array([x], object))[0]


def test_query_over_the_table(spark, sf_dir):
    from nocturne.llm.queries import QUERIES

    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op12_centroids"](spark, sf_dir).collect())) == brute(rows, 40, 5, 64, 256)

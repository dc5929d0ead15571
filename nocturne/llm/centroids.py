"""Centroid clustering of whole-number vectors with Elkan's bounds.

Every vector keeps an upper bound on the distance to its centroid and a lower bound on that to each
centroid. A distance is reckoned only if neither bound nor half the distance between two centroids
shows that the other centroid is farther. Comparisons are strict and bounds are rounded outwards, so
a centroid at the same distance is never passed over: ties go to the smaller number, and every round
gives what full search would give. Distances that decide are exact integers.

A round is one pass over the vectors (map side only) that stores their state, and one over the stored
state that adds up each cluster: partial sums a task, then a grouped sum. The driver holds the
centroids alone, k times the components. Sums travel in limbs of 30 bits, so no size of
component can overflow them. Each round's table is written to the shared folder; a lost
executor costs the tasks it ran.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch

LIMB = 30
LONG = 2**63 - 1
PIECE = 4096  # vectors that are reckoned together
STATE = "id {kind}, packed binary, large string, cluster int, upper double, lower binary, distance long, computed long"


# --- exact distances and outward bounds ---------------------------------------------------------


def exact_limit(dims: int) -> int:
    """Components up to this size have squared distances that doubles hold exactly, in any order of sums."""
    return math.isqrt(2**50 // max(1, dims))


def squares(rows: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances: doubles of whole numbers if both are within the limit, else Python integers."""
    if rows.dtype == object or centroid.dtype == object:
        return ((_whole(rows) - _whole(centroid)) ** 2).sum(1)
    gap = rows - centroid
    return np.einsum("ij,ij->i", gap, gap)


def _whole(x: np.ndarray) -> np.ndarray:
    return x if x.dtype == object else x.astype(np.int64).astype(object)


def _root(square: int, up: bool) -> float:
    try:
        root = float(math.isqrt(square) + up)
    except OverflowError:
        return math.inf if up else 1.7e308
    return math.nextafter(root, math.inf if up else 0.0)


def upper_roots(square: np.ndarray) -> np.ndarray:
    """Not below the root."""
    if square.dtype == object:
        return np.array([_root(int(s), True) for s in square], float)
    return np.nextafter(np.sqrt(square), np.inf)


def lower_roots(square: np.ndarray) -> np.ndarray:
    """Not above the root, and not below 0."""
    if square.dtype == object:
        return np.array([_root(int(s), False) for s in square], float)
    return np.maximum(np.nextafter(np.sqrt(square), -np.inf), 0.0)


def down32(x: np.ndarray) -> np.ndarray:
    """As float32, not above x."""
    with np.errstate(over="ignore"):
        short = x.astype(np.float32)
    over = short > x
    short[over] = np.nextafter(short[over], np.float32(-np.inf))
    return short


class Centroids:
    """k centroids with half their distances from each other and how far each moved since the last round."""

    def __init__(self, points: list[list[int]], before: list[list[int]] | None = None):
        self.limit = exact_limit(len(points[0]) if points else 1)
        self.points = [self._array(p) for p in points]
        halves = np.zeros((len(points), len(points)))
        for i, p in enumerate(self.points):
            for j, q in enumerate(self.points):
                if j > i:
                    halves[i, j] = halves[j, i] = lower_roots(squares(p[None, :], q))[0] / 2
        self.halves = np.maximum(np.nextafter(halves, -np.inf), 0.0)
        np.fill_diagonal(self.halves, 0.0)
        gaps = [squares(self._array(a)[None, :], self._array(b)) for a, b in zip(points, before or points, strict=True)]
        self.moved = np.array([0.0 if a == b else upper_roots(g)[0] for g, a, b in zip(gaps, points, before or points, strict=True)])

    def _array(self, p: list[int]) -> np.ndarray:
        small = all(abs(x) <= self.limit for x in p)
        return np.array(p, float if small else object)


def assign(rows: np.ndarray, at: np.ndarray, upper: np.ndarray, lower: np.ndarray, centroids: Centroids) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(cluster, upper, lower, distances reckoned) of rows after the centroids moved; bounds are changed in place.

    ``at``, ``upper`` and ``lower`` are those of the last round; a new vector comes with cluster 0,
    an infinite upper bound and lower bounds of 0.
    """
    n, k = lower.shape
    at, best, exact = at.copy(), np.zeros(n, object if rows.dtype == object else float), np.zeros(n, bool)
    calls = np.zeros(n, np.int64)
    moved = centroids.moved
    upper = np.where(moved[at] > 0, np.nextafter(upper + moved[at], np.inf), upper)
    still = np.isinf(moved)
    lower[:, ~still] = np.where(moved[~still] > 0, np.maximum(np.nextafter(lower[:, ~still] - moved[~still], -np.inf), 0.0), lower[:, ~still])
    lower[:, still] = 0.0
    if k > 1:
        nearest = (centroids.halves + np.where(np.eye(k, dtype=bool), np.inf, 0.0)).min(1)
        awake = np.flatnonzero(~(upper < nearest[at]))
    else:
        awake = np.zeros(0, np.int64)

    def tighten(which: np.ndarray) -> None:
        """The exact distance from each of these rows to its centroid."""
        nonlocal best
        for c in np.unique(at[which]):
            own = which[at[which] == c]
            d = squares(rows[own], centroids.points[c])
            if d.dtype == object and best.dtype != object:
                best = best.astype(object)
            best[own], upper[own], lower[own, c], exact[own] = d, upper_roots(d), lower_roots(d), True
            calls[own] += 1

    for c in range(k if len(awake) else 0):
        def open_(which: np.ndarray, c: int = c) -> np.ndarray:
            return which[(at[which] != c) & ~(upper[which] < lower[which, c]) & ~(upper[which] < centroids.halves[at[which], c])]

        near = open_(awake)
        if len(loose := near[~exact[near]]):
            tighten(loose)
            near = open_(near)
        if not len(near):
            continue
        d = squares(rows[near], centroids.points[c])
        calls[near] += 1
        lower[near, c] = lower_roots(d)
        if d.dtype == object and best.dtype != object:
            best = best.astype(object)
        wins = (d < best[near]) | ((d == best[near]) & (c < at[near]))
        won = near[wins.astype(bool)]
        at[won], best[won], upper[won] = c, d[wins.astype(bool)], upper_roots(d[wins.astype(bool)])
    return at, upper, lower, calls


# --- rows of the state table ---------------------------------------------------------------------


def whole(x: float, scale: int) -> int:
    """floor(scale * x) of a double, also where the product is beyond the doubles."""
    return math.floor(x * scale) if abs(x) < 1e300 else int(x) * scale


def limbs(x: int) -> Iterator[tuple[int, int]]:
    """(place, part) with x = sum of part * 2^(30 place); parts have the sign of x."""
    sign, x, place = (-1 if x < 0 else 1), abs(x), 0
    while x:
        yield place, sign * (x & ((1 << LIMB) - 1))
        x, place = x >> LIMB, place + 1


def _points(batch: pa.RecordBatch, dims: int) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
    """(places of small rows, their matrix, the large rows' components) of a batch with packed and large."""
    packed, large = batch.column("packed"), batch.column("large")
    small = np.flatnonzero(packed.is_valid().to_numpy(zero_copy_only=False))
    joined = b"".join(packed.drop_null().to_pylist())
    return small, np.frombuffer(joined, "<i4").reshape(len(small), dims).astype(float), [[int(v) for v in t.split(",")] for t in large.drop_null().to_pylist()]


def packed_integers(rows: DataFrame, dims: int, scale: int) -> DataFrame:
    """id, packed (little-endian 32-bit components) or large (decimal, where they don't fit exact doubles)."""
    limit = exact_limit(dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, dims)
            with np.errstate(over="ignore"):
                scaled = np.floor(flat * scale)
            small = (np.abs(scaled) <= limit).all(1)
            packed = [x.tobytes() if s else None for x, s in zip(np.where(small[:, None], scaled, 0).astype("<i4"), small, strict=True)]
            large = [None if s else ",".join(str(whole(v, scale)) for v in x.tolist()) for x, s in zip(flat, small, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary()), pa.array(large, pa.string())], ["id", "packed", "large"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    usable = rows.where(F.expr(f"size(embedding) = {dims} and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"))
    return usable.select("vec_id", F.col("embedding").cast("array<double>")).mapInArrow(run, f"id {kind}, packed binary, large string")


def _step(state: DataFrame, points: list[list[int]], before: list[list[int]] | None, last: bool, kind: str) -> DataFrame:
    """The state after one assignment; ``before``: the centroids of the last one. With ``last``, exact distances too."""
    k, dims, fresh = len(points), len(points[0]), before is None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = Centroids(points, before)
        for whole_batch in batches:
            for start in range(0, whole_batch.num_rows, PIECE):
                batch = whole_batch.slice(start, PIECE)
                n = batch.num_rows
                at, upper, lower = np.zeros(n, np.int64), np.full(n, np.inf), np.zeros((n, k))
                done = np.zeros(n, np.int64)
                if not fresh:
                    at, upper = batch.column("cluster").to_numpy().astype(np.int64), batch.column("upper").to_numpy().copy()
                    lower = np.frombuffer(b"".join(batch.column("lower").to_pylist()), "<f4").reshape(n, k).astype(float)
                    done = batch.column("computed").to_numpy().copy()
                small, matrix, large = _points(batch, dims)
                big = np.setdiff1d(np.arange(n), small)
                distance: list[int | None] = [None] * n
                for where, rows in ((small, matrix), (big, np.array(large, object).reshape(len(big), dims))):
                    if len(where):
                        at[where], upper[where], lower[where], calls = assign(rows, at[where], upper[where], lower[where], centroids)
                        done[where] += calls
                        for c in np.unique(at[where]) if last else ():
                            own = np.flatnonzero(at[where] == c)
                            for i, d in zip(where[own], squares(rows[own], centroids.points[c]), strict=True):
                                distance[i] = min(LONG, int(d))
                packed_lower = pa.array([x.tobytes() for x in down32(lower).astype("<f4")], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("packed"), batch.column("large"), pa.array(at, pa.int32()), pa.array(upper), packed_lower, pa.array(distance, pa.int64()), pa.array(done)],
                    ["id", "packed", "large", "cluster", "upper", "lower", "distance", "computed"],
                )

    return state.mapInArrow(run, STATE.format(kind=kind))


def _sums(state: DataFrame, k: int, dims: int) -> dict[int, tuple[int, list[int]]]:
    """cluster: (vectors, exact sums of components). At most k times (components + 1) rows and their limbs come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], int] = {}
        for batch in batches:
            at = batch.column("cluster").to_numpy()
            small, matrix, large = _points(batch, dims)
            for c in np.unique(at[small]).tolist():
                own = matrix[at[small] == c].astype(np.int64)  # within 32 bits each, so a batch sums up in 64
                for d, v in enumerate(own.sum(0).tolist()):
                    total[c, d] = total.get((c, d), 0) + v
                total[c, dims] = total.get((c, dims), 0) + len(own)
            big = np.setdiff1d(np.arange(batch.num_rows), small)
            for c, x in zip(at[big].tolist(), large, strict=True):
                for d, v in enumerate([*x, 1]):
                    total[c, d] = total.get((c, d), 0) + v
        out = [(c, d, place, part) for (c, d), v in total.items() for place, part in limbs(v)]
        names, kinds = ["cluster", "dim", "limb", "part"], [pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names)

    partial = state.select("packed", "large", "cluster").mapInArrow(run, "cluster int, dim int, limb int, part long")
    found = {c: [0] * (dims + 1) for c in range(k)}
    for r in partial.groupBy("cluster", "dim", "limb").agg(F.sum("part").alias("part")).collect():
        found[r["cluster"]][r["dim"]] += int(r["part"]) << (LIMB * r["limb"])
    return {c: (x[dims], x[:dims]) for c, x in found.items()}


def cluster(rows: DataFrame, scratch: Scratch, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: str = "2:") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 and computed of each kept vector.

    ``computed`` counts the exact distances that all rounds reckoned for the vector (full search: k a
    round). Kept are vectors of ``dims`` components, none null or non-finite; others give no row, nor does an
    empty table. Rows that repeat an id are vectors of their own; where first centroids tie by id, the smaller
    components go first. A null id is kept and comes last among first centroids. With fewer than k kept
    vectors each begins as a centroid. Distances and inertias beyond the long range show its end;
    clusters are exact for any finite component.
    """
    spark, kind = rows.sparkSession, rows.schema["vec_id"].dataType.simpleString()
    state = packed_integers(rows, dims, scale)
    order = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256)
    first = state.orderBy(order.asc_nulls_last(), F.col("packed").asc_nulls_last(), "large").limit(k).collect()  # k rows
    points = [np.frombuffer(r["packed"], "<i4").tolist() if r["packed"] is not None else [int(v) for v in r["large"].split(",")] for r in first]
    shape = f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, computed long"
    if not points:
        return spark.createDataFrame([], shape)
    before = None
    for i in range(rounds + 1):
        state = scratch.put(_step(state, points, before, i == rounds, kind), f"state_{i}")
        if i:
            scratch.drop(f"state_{i - 1}")
        if i < rounds:
            sums = _sums(state, len(points), dims)
            before, points = points, [[s // n for s in total] if (n := sums[c][0]) and (total := sums[c][1]) else points[c] for c in range(len(points))]
    held = lambda x: max(-LONG - 1, min(LONG, int(x)))
    per = {r["cluster"]: r["s"] for r in state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}  # k rows
    digest = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    table = [(c, held(s), held(sum(per.values(), Decimal(0))), digest[c]) for c, s in per.items()]
    totals = spark.createDataFrame(table, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.join(F.broadcast(totals), "cluster").select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "computed")

"""Seeds and matches by tiles against plain loops, near the poles, over RA 0 and with frames of one time."""

import numpy as np
import pytest

from nocturne.operators import discovery
from nocturne.operators.components import Workspace

from .test_discovery import brute_tracks

DET = "det_idx long, frame_index long, time_min double, ra double, dec double"


def wrap(d):
    return (d + 180) % 360 - 180


def separation(a, b):
    d1, d2, da = np.radians(a[4]), np.radians(b[4]), np.radians(b[3] - a[3])
    return np.degrees(np.arctan2(np.hypot(np.cos(d2) * np.sin(da), np.cos(d1) * np.sin(d2) - np.sin(d1) * np.cos(d2) * np.cos(da)), np.sin(d1) * np.sin(d2) + np.cos(d1) * np.cos(d2) * np.cos(da))) * 3600


def brute(rows, max_speed, tol):
    seeds, found = set(), {}
    for a in rows:
        for b in rows:
            dt = b[2] - a[2]
            if b[1] <= a[1] or dt <= 0 or not 0 < separation(a, b) / dt <= max_speed:
                continue
            seeds.add((a[0], b[0]))
            v_ra, v_dec = wrap(b[3] - a[3]) / dt, (b[4] - a[4]) / dt
            for c in rows:
                if c[1] in (a[1], b[1]):
                    continue
                p_ra, p_dec = a[3] + v_ra * (c[2] - a[2]), a[4] + v_dec * (c[2] - a[2])
                if abs(wrap(c[3] - p_ra)) * np.cos(np.radians(c[4])) < tol and abs(c[4] - p_dec) < tol:
                    found[a[0], b[0], c[1]] = min(c[0], found.get((a[0], b[0], c[1]), c[0]))
    return seeds, found


def field(kind, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(90):
        f = i % 6
        t = {"far": 3000.0 * f, "same": 8.0 * (f // 2), "each": 8.0 * f + float(rng.integers(0, 3))}.get(kind, 8.0 * f)
        if kind == "pole":
            ra, dec = float(rng.uniform(0, 360)), float(rng.choice([-1, 1]) * rng.uniform(89.9, 90))
        elif kind == "far":
            ra, dec = float(rng.uniform(0, 360)), float(np.degrees(np.arcsin(rng.uniform(-1, 1))))
        else:
            ra, dec = float(rng.uniform(359.95, 360.05) % 360), float(60 + rng.uniform(-0.03, 0.03))
        rows.append((i, f, t, ra, dec))
    return rows


@pytest.mark.parametrize(("kind", "max_speed", "tol"), [("zero", 8.0, 0.004), ("pole", 20.0, 0.03), ("far", 40.0, 12.0), ("same", 10.0, 0.006), ("each", 8.0, 0.005)])
def test_tiles_equal_plain_loops(spark, kind, max_speed, tol):
    rows = field(kind, 11)
    seeds, found = brute(rows, max_speed, tol)
    assert len(seeds) > 50 and len(found) > 5
    dets = spark.createDataFrame([*rows, (900, 0, None, 1.0, 60.0), (901, 1, 8.0, None, 60.0)], DET)
    assert sorted((r.a, r.b) for r in discovery.seed_pairs(dets, max_speed).collect()) == sorted(seeds)
    got = [((r.a, r.b, r.frame_c), r.c) for r in discovery.first_matches(dets, max_speed, tol).collect()]
    assert len(got) == len(found) and dict(got) == found
    points = {}
    for a, b, _ in found:
        points[a, b] = points.get((a, b), 2) + 1
    assert {(r.a, r.b): r.points for r in discovery.tracklet_points(dets, max_speed, tol).collect()} == points


def test_pairs_of_a_crowded_spot_are_not_stored(spark, monkeypatch):
    """Seeds grow with the square of the density; what is written does not."""
    rng = np.random.default_rng(3)
    rows = [(i, i % 6, 8.0 * (i % 6), 100 + float(rng.uniform(0, 0.004)), 10 + float(rng.uniform(0, 0.004))) for i in range(300)]
    stored, put = {}, Workspace.put

    def counting(self, df, name, by=None):
        out = put(self, df, name, by)
        stored[name] = out.count()
        return out

    monkeypatch.setattr(Workspace, "put", counting)
    dets = spark.createDataFrame(rows, DET)
    assert discovery.seed_pairs(dets, 4.0).count() > 30_000
    assert discovery.first_matches(dets, 4.0, 0.002).count() > 100_000
    assert sum(stored.values()) < 10 * len(rows)


def test_whole_runs_of_matches(spark):
    """Copies of a spot: the least number of a run that lies in the box as a whole, and of one that does so in part."""
    rows = [(100 * f + 7 * k % 20, f, 8.0 * f, 100 + 0.002 * f + (0.0 if k < 15 else 0.00199), 10.0) for f in range(4) for k in range(20)]
    _, found = brute(rows, 3.0, 0.001)
    got = {(r.a, r.b, r.frame_c): r.c for r in discovery.first_matches(spark.createDataFrame(rows, DET), 3.0, 0.001).collect()}
    assert got == found


def test_a_free_match_behind_a_used_one(spark):
    """Two movers side by side: a box holds detections of both, and the second one takes what the first left."""
    rows = [(10 * f + k, f, 8.0 * f, (359.995 + 0.004 * f + 0.0008 * k) % 360, 5 + 0.0003 * f) for f in range(4) for k in range(2)]
    rng = np.random.default_rng(1)
    rows += [(100 + i, i % 4, 8.0 * (i % 4), float(rng.uniform(359.97, 360.03) % 360), float(5 + rng.uniform(-0.01, 0.01))) for i in range(60)]
    got = {}
    for least in (2, 3, 4):
        settings = discovery.Settings(max_motion_arcsec_per_min=3.0, min_tracklet_points=least)
        got = {}
        for r in discovery.link_movers(spark.createDataFrame(rows, DET), settings).collect():
            got.setdefault(r.track, []).append(r.det_idx)
        assert sorted(map(sorted, got.values())) == brute_tracks(rows, 3.0, 2.5 * 2.5 / 3600, least)

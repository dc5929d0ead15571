"""Clusters, tracks, variability and ranks against plain versions."""

import itertools
import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from nocturne.operators import discovery, pointings
from nocturne.operators.components import Workspace, connected_components
from nocturne.plans import views

DET = "det_idx long, frame_index long, time_min double, ra double, dec double"
SRC = "frame_index long, id long, time_min double, ra double, dec double, snr double, fwhm double, ellipticity double, flag_edge boolean, flag_saturated boolean, mag_inst double, mag_calib double, mag_err double"


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(50, 51), (52, 51), (60, 60), (70, None)], "u long, v long")
    for native in (False, True):
        assert {r.node: r.root for r in connected_components(edges, native=native).collect()} == {**dict.fromkeys(range(31), 0), 50: 50, 51: 50, 52: 50}
        assert connected_components(edges.limit(0), native=native).count() == 0


def test_components_of_a_long_path(spark):
    n = 20_000
    path = spark.range(n).select(F.xxhash64("id").alias("u"), F.xxhash64(F.col("id") + 1).alias("v"))
    work = Workspace(spark)
    got = connected_components(path, work).agg(F.count("*").alias("n"), F.count_distinct("root").alias("roots"), F.min("node").alias("least"), F.max("root").alias("root")).first()
    assert (got.n, got.roots) == (n + 1, 1) and got.least == got.root
    work.clear()
    assert not Path(work.root).exists()


@pytest.mark.parametrize(("adaptive", "parts"), [("true", 4), ("true", 8), ("true", 200), ("false", 4), ("false", 8), ("false", 200)])
def test_numbers_are_dense_at_any_partitioning(spark, adaptive, parts):
    rows = views.sky(spark, "/root/testdata/sf0.1").unionByName(views.sky(spark, "/root/testdata/sf0.1").withColumn("frame_index", F.col("frame_index") + 10))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", adaptive), spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        work = Workspace(spark)
        got = work.put(discovery.numbered(rows, "frame_index", "id", work=work), "got")
        n = rows.count()
        seen = got.agg(F.count("*").alias("n"), F.count_distinct("det_idx").alias("distinct"), F.min("det_idx").alias("lo"), F.max("det_idx").alias("hi")).first()
        assert n > 1_000_000 and tuple(seen) == (n, n, 0, n - 1)
        key = F.struct("frame_index", "id")
        ends = got.groupBy(F.floor(F.col("det_idx") / 10_000).alias("g")).agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.min_by(key, "det_idx").alias("first"), F.max_by(key, "det_idx").alias("last")).orderBy("g").collect()
        assert all(r.lo == r.first and r.hi == r["last"] for r in ends) and all(a.hi <= b.lo for a, b in zip(ends, ends[1:], strict=False))  # some rows repeat
        work.clear()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_no_cluster_holds_two_detections_of_a_frame(spark):
    rows = [(0, 0, 0.0, 10.0, 0.0), (1, 0, 0.0, 10 + 2 / 3600, 0.0), (2, 1, 8.0, 10 + 1.2 / 3600, 0.0), (3, 2, 16.0, 10 + 0.9 / 3600, 0.0), (4, 1, 8.0, 50.0, 0.0)]
    got = {r.det_idx: r.cluster for r in discovery.constrained_clusters(spark.createDataFrame(rows, DET), 2.5).collect()}
    assert got[2] == got[3] and got[0] != got[1] and got[4] == 4
    assert sorted(got) == [0, 1, 2, 3, 4]


def brute_clusters(rows, radius):
    """Pairs by distance and indices, merged if they share no frame."""
    n = len(rows)
    ra, dec = (np.radians(np.array([r[k] for r in rows])) for k in (3, 4))
    y = np.hypot(np.cos(dec) * np.sin(ra - ra[:, None]), np.cos(dec)[:, None] * np.sin(dec) - np.sin(dec)[:, None] * np.cos(dec) * np.cos(ra - ra[:, None]))
    sep = np.degrees(np.arctan2(y, np.sin(dec)[:, None] * np.sin(dec) + np.cos(dec)[:, None] * np.cos(dec) * np.cos(ra - ra[:, None]))) * 3600
    at, frames = list(range(n)), {i: {rows[i][1]} for i in range(n)}
    for _, i, j in sorted((sep[i, j], i, j) for i in range(n) for j in range(i + 1, n) if sep[i, j] <= radius):
        x, z = sorted((at[i], at[j]))
        if x != z and not frames[x] & frames[z]:
            frames[x] |= frames.pop(z)
            at = [x if c == z else c for c in at]
    return dict(enumerate(at))


@pytest.mark.parametrize(("seed", "width", "most"), [(0, 60, 20_000), (2, 15, 5), (4, 12, 0)])
def test_clusters_equal_the_greedy_order(spark, seed, width, most):
    """Scattered fields, and ones so crowded that all detections hang together, with and without rounds of least pairs."""
    rng = np.random.default_rng(seed)
    rows = [(i, int(rng.integers(0, 6)), 0.0, (359.999 + float(rng.uniform(0, width)) / 3600) % 360, 1 + float(rng.uniform(0, width)) / 3600) for i in range(120)]
    rows += [(120, 7, 0.0, 10.0, 1.0), (121, 7, 0.0, 10.0, 1.0), (122, 8, 0.0, 10.0, 1.0)]
    got = {r.det_idx: r.cluster for r in discovery.constrained_clusters(spark.createDataFrame(rows, DET), 2.5, pairs_a_group=most).collect()}
    assert got == brute_clusters(rows, 2.5)


def test_a_crowded_field_pairs_few_detections(spark, monkeypatch):
    """Bands of rising radius give the greedy order, with exact copies too, and never hold all pairs of the radius."""
    monkeypatch.setattr(discovery, "PAIRS_AT_ONCE", 0, raising=False)
    rng = np.random.default_rng(6)
    at = [(int(rng.integers(0, 5)), 359.9999 + float(rng.uniform(0, 3)) / 3600, -1 + float(rng.uniform(0, 3)) / 3600) for _ in range(230)]
    rows = [(i, f, 0.0, ra % 360, dec) for i, (f, ra, dec) in enumerate(at + at[:20])] + [(250, 1, 0.0, None, 1.0)]
    seen, put = {}, Workspace.put

    def counting(self, df, name, by=None):
        stored = put(self, df, name, by)
        seen[name] = stored.count() if name.startswith("edges") else 0
        return stored

    monkeypatch.setattr(Workspace, "put", counting)
    got = {r.det_idx: r.cluster for r in discovery.constrained_clusters(spark.createDataFrame(rows, DET), 2.5).collect()}
    assert got.pop(250) == 250 and got == brute_clusters(rows[:-1], 2.5)
    assert 0 < sum(seen.values()) < 10 * len(rows)  # all pairs within the radius are more than 20,000


def test_a_chain_of_falling_distances(spark):
    """The worst order for rounds: each pair waits for the next one."""
    rows, at = [], 20.0
    for i in range(14):
        rows.append((i, i % 40, 0.0, at, 0.0))
        at += (2.0 - 0.1 * i) / 3600
    got = {r.det_idx: r.cluster for r in discovery.constrained_clusters(spark.createDataFrame(rows, DET), 2.5, pairs_a_group=0).collect()}
    assert got == brute_clusters(rows, 2.5)


def brute_tracks(rows, max_speed, tol, least):
    """Seeds in order of frames and rows; other frames give their first match; members are used once."""
    wrap = lambda d: (d + 180) % 360 - 180
    rows = sorted(rows, key=lambda r: (r[1], r[0]))
    used, out = set(), []
    for a in rows:
        for b in rows:
            if a[0] in used:
                break
            if b[1] <= a[1] or b[0] in used or b[2] <= a[2]:
                continue
            dt = b[2] - a[2]
            d1, d2, da = np.radians(a[4]), np.radians(b[4]), np.radians(b[3] - a[3])
            sep = np.degrees(np.arctan2(np.hypot(np.cos(d2) * np.sin(da), np.cos(d1) * np.sin(d2) - np.sin(d1) * np.cos(d2) * np.cos(da)), np.sin(d1) * np.sin(d2) + np.cos(d1) * np.cos(d2) * np.cos(da))) * 3600
            if not 0 < sep / dt <= max_speed:
                continue
            track = [a, b]
            for f in sorted({r[1] for r in rows} - {a[1], b[1]}):
                for c in (r for r in rows if r[1] == f and r[0] not in used):
                    pr, pd = a[3] + wrap(b[3] - a[3]) / dt * (c[2] - a[2]), a[4] + (b[4] - a[4]) / dt * (c[2] - a[2])
                    if abs(wrap(c[3] - pr)) * np.cos(np.radians(c[4])) < tol and abs(c[4] - pd) < tol:
                        track.append(c)
                        break
            if len(track) >= least:
                used |= {r[0] for r in track}
                out.append(sorted(r[0] for r in track))
                break
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_tracks_equal_the_greedy_rule(spark, seed):
    rng = np.random.default_rng(seed)
    rows, n = [], itertools.count()
    for f in range(5):
        for k in range(4):
            rows.append((f, 8.0 * f, (359.99 + 0.004 * k + 0.0006 * f * (k + 1)) % 360, 5 + 0.004 * k + 0.0003 * f))
        rows += [(f, 8.0 * f, float(rng.uniform(359.98, 360.03) % 360), float(rng.uniform(4.99, 5.03))) for _ in range(4)]
    rows = [(next(n), *r) for r in rows]
    settings = discovery.Settings(max_motion_arcsec_per_min=3.0)
    got = {}
    for r in discovery.link_movers(spark.createDataFrame(rows, DET), settings).collect():
        got.setdefault(r.track, []).append(r.det_idx)
    assert sorted(map(sorted, got.values())) == brute_tracks(rows, 3.0, 2.5 * 2.5 / 3600, 3)


def test_seeds_reach_over_the_sphere(spark):
    rng = np.random.default_rng(5)
    dec, ra = np.degrees(np.arcsin(rng.uniform(-1, 1, 60))), rng.uniform(0, 360, 60)
    rows = [(i, i % 2, 20000.0 * (i % 2), float(ra[i]), float(dec[i])) for i in range(60)]  # 180 degrees take 10800 minutes
    got = {(r.a, r.b) for r in discovery.seed_pairs(spark.createDataFrame(rows, DET), 60.0).collect()}
    assert got == {(a, b) for a in range(0, 60, 2) for b in range(1, 60, 2)}


def test_rows_of_many_cells_stay_off_the_driver(spark, tmp_path):
    """Small files whose rows become many: their joins are shuffled."""
    spark.createDataFrame([(i, i % 3, 8.0 * (i % 3), 100 + 0.01 * i, 10.0) for i in range(30)], DET).write.parquet(str(tmp_path / "d"))
    dets = spark.read.parquet(str(tmp_path / "d"))
    seeds = discovery.seed_pairs(dets, 4.0)
    assert "BroadcastExchange" not in seeds._jdf.queryExecution().executedPlan().toString()
    found = discovery.predicted_matches(Workspace(spark).put(seeds, "seeds"), dets, 0.002)
    assert re.search(r"SortMergeJoin \[[^]]*frame_c#", found._jdf.queryExecution().executedPlan().toString())


def test_rank_goldens(spark):
    one = lambda **k: spark.range(1).select(discovery.composite_rank(F.lit(k["kind"]), F.lit(k["snr"]), F.lit(k["n"]), F.lit(k["rb"]), F.lit(k.get("sig")).cast("double")).alias("v")).first().v
    assert round(one(kind="single", snr=1e4, n=1, rb=0.75), 4) == 0.1318
    assert round(one(kind="single", snr=1e4, n=1, rb=0.315), 4) == 0.0913
    assert one(kind="variable", snr=1e4, n=4, rb=1.0, sig=1e3) == pytest.approx(0.55 * 1.3)


def test_real_bogus_is_strict_about_missing_shapes(spark):
    v = lambda f, e, s, n: spark.range(1).select(discovery.real_bogus(F.lit(f).cast("double"), F.lit(e).cast("double"), F.lit(s), F.lit(False), F.lit(n), F.lit(4.0), F.lit(False)).alias("v")).first().v
    assert v(2.0, 0.1, 50.0, 2) == pytest.approx(0.15) and v(4.0, 0.7, 50.0, 2) == pytest.approx(0.5)
    assert v(None, None, 50.0, 1) == pytest.approx(0.75)


def light(frame, i, ra, dec, mag, snr=100.0):
    return (frame, i, 8.0 * frame, ra, dec, snr, 4.0, 0.1, False, False, mag, mag, 0.01)


def test_discovery_names_each_kind(spark):
    rng = np.random.default_rng(9)
    rows, stars = [], [(130 + 0.01 * k, 10.0) for k in range(12)]
    for f in range(6):
        rows += [light(f, k, ra, dec, 16 + 0.002 * float(rng.normal())) for k, (ra, dec) in enumerate(stars[:-1])]
        rows.append(light(f, 11, *stars[-1], 16 + (0.4 if f % 2 else -0.4)))
        rows.append(light(f, 12, 130.5, 10.2 + f * 24 / 3600, 18.0))
        if f >= 2:
            rows.append(light(f, 13, 130.8, 10.3, 17.0))
    rows += [light(3, 20, 131.5, 11.0, 19.0), light(2, 21, 131.9, 11.0, 19.0, 4.0), (2, 22, 16.0, None, None, 50.0, 4.0, 0.1, False, False, 1.0, 1.0, 0.01)]
    ref = spark.createDataFrame([(i, ra, dec, 16.0) for i, (ra, dec) in enumerate(stars)], "ref_id long, ra double, dec double, mag double")
    src = spark.createDataFrame(rows, SRC)
    got = discovery.candidates(discovery.discover(src, ref, discovery.Settings())).collect()
    kinds = [r.kind for r in got]
    assert kinds[:3] == ["mover", "transient", "variable"] and kinds.count("known") == 11 and kinds.count("single") == 1
    assert got[0].motion_arcsec_min == pytest.approx(3.0, abs=0.01) and got[0].frames == "0,1,2,3,4,5"
    assert sorted(r.obj_id for r in got) == list(range(len(got)))
    off = discovery.discover(src, None, discovery.Settings(flag_unmatched=False, moving_object_link=False))
    assert {r.kind for r in off.collect()} == {"known"}
    assert discovery.discover(src, ref, discovery.Settings(enabled=False)).count() == 0


def test_pointings_wrap_and_fall_back(spark):
    rows = [(0, 359.99, 0.0), (1, 0.01, 0.0), (2, 90.0, 0.0), (3, None, None), (4, 90.05, 0.02)]
    got = {r.frame_index: r.field_id for r in pointings.pointing_clusters(spark.createDataFrame(rows, "frame_index long, ra double, dec double"), 15.0).collect()}
    assert got == {0: 0, 1: 0, 2: 1, 3: 0, 4: 1}

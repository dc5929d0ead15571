"""Scalar functions, spatial joins and calibration against analytic values."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from nocturne.functions import headers, photometric, sky, text
from nocturne.operators import calibration, crossmatch, motion


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("value", "is_ra", "expect"),
    [("06:45:08.9", True, 101.28708333), ("06 45 08.9", True, 101.28708333), ("101.287", True, 101.287), ("101:17:13.5", True, 101.287083333), ("-16:42:58", False, -16.71611111), ("-00:30:00", False, -0.5), ("", True, None), ("n/a", True, None), ("1:x", False, None), (None, False, None)],
)
def test_coordinates(spark, value, is_ra, expect):
    got = one(spark, sky.parse_coordinate(F.lit(value).cast("string"), is_ra))
    assert got is None if expect is None else got == pytest.approx(expect, abs=1e-7)


@pytest.mark.parametrize(("tag", "exp", "kind"), [("Bias Frame", "3", "bias"), ("object", None, "light"), ("Dome Flat", "1", "flat"), ("DARK", "1", "dark"), (None, "0", "bias"), ("", "0.0", "bias"), ("focus", "2", "unknown"), (None, None, "unknown")])
def test_frame_classes(spark, tag, exp, kind):
    assert one(spark, headers.classify_frame(F.lit(tag).cast("string"), F.lit(exp).cast("string"))) == kind


def test_header_fallbacks(spark):
    h = F.create_map(F.lit("EXPTIME"), F.lit(""), F.lit("EXPOSURE"), F.lit("30"))
    assert one(spark, headers.first_present(h, ("EXPTIME", "EXPOSURE"))) == "30"
    assert one(spark, headers.as_float(F.lit("x"), 2.0)) == 2.0
    assert one(spark, headers.truthy_or(F.lit(0.0), 1.5)) == 1.5


def test_times(spark):
    a, b = one(spark, headers.time_minutes(F.lit("60123.456"))), one(spark, headers.time_minutes(F.lit("2460123.956")))
    assert a == pytest.approx(60123.456 * 1440) and b == pytest.approx(a, abs=1e-4)
    iso = one(spark, headers.time_minutes(F.lit("2026-07-04T15:08:00.000")))
    assert iso % 1440 == pytest.approx(15 * 60 + 8)
    assert one(spark, headers.time_minutes(F.lit("not a date"))) is None and one(spark, headers.time_minutes(F.lit(""))) is None


def test_geometry(spark):
    sep = one(spark, sky.separation_arcsec(F.lit(359.9999), F.lit(0.0), F.lit(0.0001), F.lit(0.0)))
    assert sep == pytest.approx(0.72, abs=1e-9)
    assert one(spark, sky.position_angle_deg(F.lit(10.0), F.lit(0.0), F.lit(10.1), F.lit(0.0))) == pytest.approx(90)
    assert one(spark, sky.wrap_deg(F.lit(359.0) - F.lit(1.0))) == pytest.approx(-2)
    ra, dec = sky.tan_pix2sky(F.lit(10.0), F.lit(700.0), 512.5, 512.5, 359.99, 60.0, -1e-4, 0.0, 0.0, 1e-4)
    x, y = sky.tan_sky2pix(ra, dec, 512.5, 512.5, 359.99, 60.0, -1e-4, 0.0, 0.0, 1e-4)
    row = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    assert (row.x, row.y) == (pytest.approx(10, abs=1e-6), pytest.approx(700, abs=1e-6))


def table(spark, key, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"{key} long, ra double, dec double")


def test_crossmatch_contract(spark):
    a = table(spark, "l", [(10.0, 0.0), (20.0, 0.0), (30.0, 0.0), (None, 1.0), (0.00001, 89.9999)])
    b = table(spark, "r", [(None, None), (10 + 0.2 / 3600, 0.0), (200.0, 0.0), (30 - 0.1 / 3600, 0.0), (180.0, 89.9999)])
    got = {r.l: r for r in crossmatch.crossmatch(a, b, 1.0, "l", "r").collect()}
    assert (got[0].idx, got[0].matched) == (1, True) and got[0].sep_arcsec == pytest.approx(0.2, abs=1e-6)
    assert got[2].idx == 3 and got[2].matched
    assert (got[1].matched, got[3].idx, got[3].matched) == (False, -1, False)
    assert got[4].idx == 4 and got[4].sep_arcsec == pytest.approx(0.72, abs=1e-3)
    assert crossmatch.crossmatch(a, b.limit(0), 1.0, "l", "r").where("matched").count() == 0


def test_cells_find_every_pair(spark):
    rng = np.random.default_rng(0)
    pos = [(float(a), float(d)) for a, d in zip(rng.uniform(359.9, 360.1, 200) % 360, rng.uniform(-0.1, 0.1, 200), strict=True)]
    pos += [(float(a), float(d)) for a, d in zip(rng.uniform(0, 360, 200), rng.uniform(89.9, 90, 200), strict=True)]
    t = table(spark, "i", pos)
    got = {(r.a, r.b) for r in crossmatch.radius_pairs(t, 60.0, "i").collect()}
    v = np.array([[math.cos(math.radians(d)) * math.cos(math.radians(a)), math.cos(math.radians(d)) * math.sin(math.radians(a)), math.sin(math.radians(d))] for a, d in pos])
    sep = 2 * np.degrees(np.arcsin(np.linalg.norm(v[:, None] - v[None], axis=2) / 2)) * 3600
    expect = {(i, j) for i in range(400) for j in range(i + 1, 400) if sep[i, j] <= 60}
    assert got == expect


def test_isolation(spark):
    rows = [(0, "f", 10.0, 10.0, 3.0), (1, "f", 15.0, 10.0, 3.0), (2, "f", 100.0, 10.0, 3.0), (0, "g", 5.0, 5.0, None)]
    got = {(r.frame, r.id): r.isolated for r in crossmatch.isolated(spark.createDataFrame(rows, "id long, frame string, x double, y double, fwhm double")).collect()}
    assert got == {("f", 0): False, ("f", 1): False, ("f", 2): True, ("g", 0): True}


def test_zero_point_is_exact(spark):
    mags = np.linspace(12, 19, 10)
    rows = [(i, "f", 150 + i * 30 / 3600, 20.0, 50.0 * i + 10, 50.0 * i + 10, float(10 ** (-0.4 * (m - 25))), 100.0, 3.0, 0.1, False, False) for i, m in enumerate(mags)]
    rows += [(10, "f", 151.0, 20.0, 900.0, 900.0, -5.0, 100.0, 3.0, 0.1, False, False), (11, "f", 151.1, 20.0, 950.0, 950.0, 0.0, 100.0, 3.0, 0.1, False, False)]
    s = spark.createDataFrame(rows, "id long, frame string, ra double, dec double, x double, y double, flux double, snr double, fwhm double, ellipticity double, flag_edge boolean, flag_saturated boolean")
    ref = spark.createDataFrame([(i, 150 + i * 30 / 3600, 20.0, float(m)) for i, m in enumerate(mags)], "ref_id long, ra double, dec double, mag double")
    got = {r.id: r for r in calibration.calibrate(s, ref, F.lit(1.0), F.lit("B")).collect()}
    assert got[0].zeropoint == pytest.approx(25.0, abs=1e-6) and got[0].extinction == 0.25
    assert all(got[i].mag_calib == pytest.approx(mags[i], abs=1e-6) for i in range(10))
    assert got[10].mag_inst is None and got[11].mag_calib is None
    few = calibration.calibrate(s, ref.limit(3), F.lit(1.0), F.lit("B")).first()
    assert few.mag_calib is None


def test_sigma_clip_equals_a_loop(spark):
    rng = np.random.default_rng(3)
    rows = [(int(g), float(x)) for g in range(5) for x in np.concatenate([rng.normal(0, 1, 60), rng.normal(0, 20, 6)])]
    got = calibration.clipped_stats(spark.createDataFrame(rows, "g int, v double"), ["g"], "v").collect()
    for r in got:
        v = np.array([x for g, x in rows if g == r.g])
        for _ in range(5):
            v = v[np.abs(v - np.median(v)) <= 3 * v.std()]
        assert r.n_kept == len(v) and r.median == pytest.approx(np.median(v)) and r.std == pytest.approx(v.std())


def test_reduction_variance(spark):
    d, v = calibration.reduce_pixels(F.lit(100.0), F.lit(None).cast("double"), F.lit(0.05), F.lit(1.0), F.lit(60.0), F.lit(2.0), F.lit(8.0))
    row = spark.range(1).select(d.alias("d"), v.alias("v")).first()
    assert (row.d, row.v) == (pytest.approx(97.0), pytest.approx(66.0))


def test_astrometry_rolls_back(spark):
    ref = spark.createDataFrame([(i, 150 + (i % 3) * 0.01, 20 + (i // 3) * 0.01) for i in range(9)], "ref_id long, ra double, dec double")
    good = ref.select(F.lit("f").alias("frame"), F.col("ref_id").alias("id"), "ra", (F.col("dec") - 2.0 / 3600).alias("dec"))
    r = calibration.refine_astrometry(good, ref, "id", "frame").first()
    assert r.refined and r.n_matched == 9 and r.rms_arcsec < 0.3 and r.shift_dec == pytest.approx(2 / 3600)
    off = [2.0, 2.0, 2.0, -1.5, -1.5]
    bad = spark.createDataFrame([("f", i, 150 + (i % 3) * 0.01, 20 + (i // 3) * 0.01 - off[i] / 3600) for i in range(5)], "frame string, id long, ra double, dec double")
    r = calibration.refine_astrometry(bad, ref, "id", "frame").first()
    assert not r.refined and r.n_matched == 5 and r.shift_dec == 0


def test_motion_prediction(spark):
    pts = spark.createDataFrame([(0, i, 8.0 * i, 132 + 0.001 * i, 11.0) for i in range(4)], "k int, det_idx long, time_min double, ra double, dec double")
    r = motion.fit_motion(pts, "k").first()
    assert r.ra_24h == pytest.approx(132 + 0.001 * (3 + 180)) and r.fit_rms_arcsec < 0.01
    wrap = spark.createDataFrame([(0, i, 1.0 * i, (359.999 + 0.001 * i) % 360, 0.0) for i in range(4)], "k int, det_idx long, time_min double, ra double, dec double")
    assert motion.fit_motion(wrap, "k").first().speed_arcsec_min == pytest.approx(3.6)
    assert motion.fit_motion(pts.limit(1), "k").count() == 0


@pytest.mark.parametrize("name", ["ABC0001", "LONGNAME", "A"])
def test_report_lines_have_80_columns(spark, name):
    line = one(spark, motion.report_line(F.lit(name), F.lit(359.99999999), F.lit(-0.00001), F.lit(60123.999999 * 1440), F.lit(60.0), F.lit(18.25)))
    assert len(line) == 80 and line.endswith("XXX") and ":" not in line and "60" not in line[32:56].split()[1:3]
    assert one(spark, motion.report_line(F.lit(name), F.lit(1.0), F.lit(1.0), F.lit(None).cast("double"), F.lit(0.0), F.lit(1.0))) is None


def test_the_nearest_is_found_at_any_distance(spark):
    left = spark.createDataFrame([(1, 0.0, 0.0), (2, 170.0, 10.0)], "a long, ra double, dec double")
    right = spark.createDataFrame([(7, 180.0, 0.0)], "b long, ra double, dec double")
    got = {r.a: (r.idx, r.sep_arcsec, r.matched) for r in crossmatch.crossmatch(left, right, 60.0, "a", "b").collect()}
    assert got[1] == (7, pytest.approx(648000.0), False) and got[2][0] == 7


def test_stems_of_junk_reach_the_fixpoint(spark):
    words = ["s" * 30, "x" + "es" * 40, "abc" + "ing" * 25, "e" * 50, "bcd" + "ers" * 30 + "ed", "q" * 40]
    once = lambda t: u if (u := re.sub(r"^(.{3,}?)(ing|ers|ies|ed|es|er|s)$", r"\1", t)) != t else re.sub(r"^(.{4,})[ey]$", r"\1", t)
    got = {r.w: r.s for r in spark.createDataFrame([(w,) for w in words], "w string").select("w", text.stem(F.col("w")).alias("s")).collect()}
    assert got["s" * 30] == "sss"
    for w in words:
        t = w
        while once(t) != t:
            t = once(t)
        assert got[w] == t


def test_stems(spark):
    words = ["discovery", "discoveries", "discovered", "discovers", "source", "sources", "sky"]
    got = {r.w: r.s for r in spark.createDataFrame([(w,) for w in words], "w string").select("w", text.stem(F.col("w")).alias("s")).collect()}
    assert len({got[w] for w in words[:4]}) == 1 and got["source"] == got["sources"] and got["sky"] == "sky"


def test_mag_functions(spark):
    assert one(spark, photometric.instrumental_mag(F.lit(-1.0), F.lit(1.0))) is None
    assert one(spark, photometric.instrumental_mag(F.lit(100.0), F.lit(1.0))) == pytest.approx(-5.0)
    assert one(spark, photometric.lightcurve_err(F.lit(None).cast("double"), F.lit(1e6))) == pytest.approx(0.005)


@pytest.mark.parametrize("seed", range(3))
def test_nearest_at_any_distance_equals_brute_force(spark, seed):
    rng = np.random.default_rng(seed)

    def sphere(n):
        return np.degrees(np.arctan2(*rng.normal(size=(2, n)))) % 360, np.degrees(np.arcsin(rng.uniform(-1, 1, n)))

    ra, dec = sphere(300)
    if seed == 1:  # a dense patch far from most rows, and repeated positions
        ra, dec = 40 + rng.uniform(0, 0.01, 300).round(4), -30 + rng.uniform(0, 0.01, 300).round(4)
    if seed == 2:  # about the pole and RA 0
        ra, dec = rng.uniform(-1, 1, 300) % 360, np.where(rng.random(300) < 0.5, 90 - rng.uniform(0, 1e-3, 300), rng.uniform(-1, 1, 300))
    la, ld = sphere(200)
    la[:60], ld[:60] = ra[:60], dec[:60]
    left = spark.createDataFrame([(i, float(a), float(d)) for i, (a, d) in enumerate(zip(la, ld, strict=True))] + [(900, None, 1.0)], "l long, ra double, dec double")
    right = spark.createDataFrame([(i, float(a), float(d)) for i, (a, d) in enumerate(zip(ra, dec, strict=True))] + [(901, 1.0, None)], "r long, ra double, dec double")
    got = {r.l: r for r in crossmatch.crossmatch(left, right, 1.0, "l", "r").collect()}
    a1, d1, a2, d2 = (np.radians(x) for x in (la[:, None], ld[:, None], ra[None], dec[None]))
    y = np.hypot(np.cos(d2) * np.sin(a2 - a1), np.cos(d1) * np.sin(d2) - np.sin(d1) * np.cos(d2) * np.cos(a2 - a1))
    sep = np.degrees(np.arctan2(y, np.sin(d1) * np.sin(d2) + np.cos(d1) * np.cos(d2) * np.cos(a2 - a1))) * 3600
    for i in range(200):
        assert got[i].sep_arcsec == pytest.approx(sep[i].min(), rel=1e-6, abs=1e-6) and sep[i, got[i].idx] == pytest.approx(sep[i].min(), rel=1e-6, abs=1e-6)
        assert got[i].matched == (got[i].sep_arcsec <= 1.0)
        if seed == 1:
            ties = np.flatnonzero((ra == ra[got[i].idx]) & (dec == dec[got[i].idx]))
            assert got[i].idx == ties.min()
    assert got[900].idx == -1 and got[900].sep_arcsec is None and len(got) == 201


def test_flags_of_matches_hold_no_pairs(spark):
    rows = [(i, 359.9999 + 0.0001 * (i % 3), 1.0) for i in range(30)] + [(30, 50.0, 1.0), (31, None, 1.0), (0, 359.9999, 1.0)]
    t = spark.createDataFrame(rows, "i long, ra double, dec double")
    flagged = crossmatch.flag_matched(t, t.where("i between 1 and 29"), 2.5, "i")
    assert sorted((r.i, r.matched_ref) for r in flagged.collect()) == sorted((r[0], r[0] < 30) for r in rows)
    assert "LeftSemi" in flagged._jdf.queryExecution().optimizedPlan().toString()

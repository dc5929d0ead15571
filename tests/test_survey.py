"""Catalogues by sky cell: cones against brute force, and files that a cone must not open."""

from pathlib import Path

import numpy as np
import pytest

from nocturne.sources import survey

WIDTH = 15.0
SHAPE = "ra double, dec double, mag double, n int"


@pytest.fixture(scope="module")
def stars(spark, tmp_path_factory):
    rng = np.random.default_rng(4)
    ra, dec = rng.uniform(0, 360, 4000), np.degrees(np.arcsin(rng.uniform(-1, 1, 4000)))
    ra[:300], dec[:300] = rng.uniform(-3, 3, 300) % 360, rng.uniform(-3, 3, 300)
    dec[300:400] = 90 - rng.uniform(0, 3, 100)
    rows = [(float(a), float(d), 15.0 + i % 8, i) for i, (a, d) in enumerate(zip(ra, dec, strict=True))] + [(None, 1.0, 15.0, -1), (0.0, -90.0, 15.0, 9000), (359.999999, 90.0, 15.0, 9001)]
    path = str(tmp_path_factory.mktemp("survey") / "catalogue")
    df = spark.createDataFrame(rows, SHAPE)
    survey.store(df, path, WIDTH, 1)
    return rows, path, df.schema


def inside(rows, ra, dec, radius):
    out = set()
    for a, d, _, n in rows:
        if a is not None:
            x, y, da = np.radians(dec), np.radians(d), np.radians(a - ra)
            sep = np.degrees(np.arctan2(np.hypot(np.cos(y) * np.sin(da), np.cos(x) * np.sin(y) - np.sin(x) * np.cos(y) * np.cos(da)), np.sin(x) * np.sin(y) + np.cos(x) * np.cos(y) * np.cos(da)))
            if sep <= radius:
                out.add(n)
    return out


@pytest.mark.parametrize(("ra", "dec", "radius"), [(0.0, 0.0, 2.0), (359.9, 1.0, 4.0), (120.0, 89.0, 3.0), (10.0, -89.99, 5.0), (200.0, 30.0, 11.0), (77.0, 60.0, 0.5), (5.0, 80.0, 9.9), (180.0, -45.0, 100.0)])
def test_cones_equal_brute_force(spark, stars, ra, dec, radius):
    rows, path, _ = stars
    assert {r.n for r in survey.cone(spark, path, ra, dec, radius, WIDTH).collect()} == inside(rows, ra, dec, radius)


def test_other_cells_are_not_opened(spark, stars, tmp_path):
    import shutil

    rows, path, schema = stars
    spoiled = tmp_path / "c"
    shutil.copytree(path, spoiled)
    wanted = set(survey.cells_of_cone(200.0, 30.0, 3.0, WIDTH))
    kept = 0
    for f in Path(spoiled).glob("sky_cell=*/*.parquet"):
        if int(f.parent.name.removeprefix("sky_cell=")) in wanted:
            kept += 1
        else:
            f.write_bytes(b"no parquet")
            (f.parent / f".{f.name}.crc").unlink(missing_ok=True)
    assert 0 < len(wanted) < 8 and kept
    assert {r.n for r in survey.cone(spark, str(spoiled), 200.0, 30.0, 3.0, WIDTH, schema=schema).collect()} == inside(rows, 200.0, 30.0, 3.0)


def test_service(spark, stars, monkeypatch):
    from nocturne.sources import reference

    rows, path, _ = stars
    monkeypatch.setitem(reference.SERVICES, "gaia", survey.service(path, width=WIDTH))
    found = reference.reference_catalog(spark, "gaia", 0.0, 0.0, 2.0)
    assert {r.mag for r in found.collect()} <= {15.0 + i for i in range(6)} and found.count() == len([r for r in rows if r[3] in inside(rows, 0.0, 0.0, 2.0) and r[2] < 21.0])
    assert reference.reference_catalog(spark, "gaia", 200.0, 89.99999, 1e-6) is None


@pytest.mark.parametrize("width", [5.0, 7.0, 30.0])
def test_cells_of_cones_hold_their_rows(spark, width):
    """Every position within a cone lies in one of its cells, at the borders too."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(int(width))
    points = [(float(a), float(d)) for a, d in zip(rng.uniform(0, 360, 3000), np.degrees(np.arcsin(rng.uniform(-1, 1, 3000))), strict=True)] + [(0.0, 90.0), (0.0, -90.0), (360.0, 0.0), (0.0, 0.0), (45.0, 45.0)]
    cells = [r.c for r in spark.createDataFrame(points, "ra double, dec double").coalesce(1).select(survey.cell_of(F.col("ra"), F.col("dec"), width).alias("c")).collect()]
    for ra, dec, radius in ((0.0, 0.0, 6.0), (359.0, 88.0, 4.0), (45.0, 45.0, 12.0), (10.0, -90.0, 20.0), (0.0, 60.0, 31.0)):
        wanted = set(survey.cells_of_cone(ra, dec, radius, width))
        near = inside([(a, d, 0.0, i) for i, (a, d) in enumerate(points)], ra, dec, radius)
        assert near and {cells[i] for i in near} <= wanted

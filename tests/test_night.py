"""Files, images, nights, products, configuration and retrieval."""

import gzip
import json
import re
import zipfile  # noqa: F401  (kept out of Spark: uploads are plain files)
from pathlib import Path

import numpy as np
import pytest

from nocturne.images import kernels
from nocturne.operators.retrieval import PassageIndex, chunk_documents
from nocturne.plans import products
from nocturne.plans.config import NightConfig, get_instrument
from nocturne.plans.night import run_night
from nocturne.plans.products import sanitise
from nocturne.plans.synth import Sky, generate_night
from nocturne.sources import fits, knowledge
from nocturne.sources.reference import load_local_reference

from .test_tiles import compressed


def test_fits_round_trip(tmp_path, spark):
    image = np.arange(12, dtype=np.float32).reshape(3, 4)
    path = fits.write_fits(tmp_path / "b.fits", image, {"IMAGETYP": "it's a light", "EXPTIME": 1.5, "SYNTH": True, "N": 7}, ["made"])
    header, back = fits.read_fits(path.read_bytes())
    assert (back == image).all() and header["IMAGETYP"] == "it's a light" and float(header["EXPTIME"]) == 1.5 and header["SYNTH"] == "True"
    assert path.stat().st_size % 2880 == 0
    reduced = fits.write_reduced(tmp_path / "a.fits", image, image, np.zeros((3, 4), np.uint8), {"OBJECT": "x"})
    header, sci = fits.read_fits(reduced.read_bytes())
    assert (sci == image).all() and header["NOCTRED"] == "True" and header["EXTNAME"] == "SCI"
    (tmp_path / "c.FITS").write_bytes(b"nothing")
    (tmp_path / "d.txt").write_text("no frame")
    assert [Path(p).name for p in fits.list_frames(str(tmp_path))] == ["a.fits", "b.fits", "c.FITS"]
    with pytest.raises(NotADirectoryError):
        fits.list_frames(str(tmp_path / "none"))
    fits.register(spark)
    rows = {Path(r.path).name: r for r in spark.read.format("fits").option("path", str(tmp_path)).option("pixels", "false").load().collect()}
    assert rows["b.fits"].header["N"] == "7" and rows["b.fits"].px is None and rows["c.FITS"].error
    rows = {Path(r.path).name: r for r in fits.read_frames(spark, str(tmp_path)).collect()}
    assert (rows["b.fits"].ny, rows["b.fits"].nx) == (3, 4) and rows["c.FITS"].error


def test_stack_resists_a_hit():
    rng = np.random.default_rng(0)
    frames = [rng.normal(100, 2, (16, 16)).astype(np.float32) for _ in range(7)]
    frames[3][5, 5] = 50000
    assert abs(kernels.combine(frames)[5, 5] - 100) < 3
    assert (kernels.combine(frames[:1]) == frames[0]).all()


def test_reduction_figures():
    d, v = kernels.reduce_image(np.full((4, 4), 100.0), None, None, np.full((4, 4), 0.7), 60.0, 2.0, 8.0)
    assert v[0, 0] == pytest.approx((16 + 50) / 0.49) and d[0, 0] == pytest.approx(100 / 0.7, rel=1e-6)
    d, v = kernels.reduce_image(np.full((4, 4), 100.0), None, np.full((4, 4), 0.05), None, 60.0, 2.0, 8.0)
    assert (d[0, 0], v[0, 0]) == (pytest.approx(97), pytest.approx(66.0))


def test_labels_join_diagonals():
    m = np.array([[1, 0, 0, 1], [0, 1, 0, 1], [0, 0, 0, 0], [1, 1, 0, 0]], bool)
    seg = kernels.label(m)
    assert seg.max() == 3 and seg[0, 0] == seg[1, 1] and seg[0, 3] == seg[1, 3] != seg[3, 0]
    assert kernels.detect(m.astype(float), np.full(m.shape, 0.5), 3).max() == 0


def test_detection_measures_and_deblends():
    gy, gx = np.mgrid[0:80, 0:80]
    star = lambda x, y, a: a * np.exp(-((gx - x) ** 2 + (gy - y) ** 2) / (2 * 1.8**2))
    image = star(20.3, 30.6, 900) + star(50, 50, 700) + star(57, 50, 600) + np.random.default_rng(1).normal(100, 2, (80, 80))
    bkg = kernels.background(image, 40)
    assert abs(bkg["median"] - 100) < 1
    smooth = kernels.convolve(bkg["sub"], kernels.gaussian_kernel())
    seg = kernels.detect(smooth, 3 * bkg["rms"], 5)
    split = kernels.deblend(smooth, seg)
    assert split.max() == seg.max() + 1 == 3
    m = kernels.measure(bkg["sub"], smooth, np.full(image.shape, 2.0), split)
    i = int(np.argmin(np.hypot(m["x"] - 20.3, m["y"] - 30.6)))
    assert abs(m["x"][i] - 20.3) < 0.1 and abs(m["y"][i] - 30.6) < 0.1
    ap = kernels.aperture_photometry(bkg["sub"], np.full(image.shape, 2.0), m["x"], m["y"], 6.0)
    assert ap["flux_aper"][i] == pytest.approx(2 * np.pi * 1.8**2 * 900, rel=0.03)
    _, _, w = kernels.aperture_weights(10.2, 9.7, 4.0, (30, 30))
    assert w.sum() == pytest.approx(np.pi * 16, rel=0.005)


def test_cosmic_rays_go_and_stars_stay():
    gy, gx = np.mgrid[0:64, 0:64]
    image = 200 + 5000 * np.exp(-((gx - 32) ** 2 + (gy - 32) ** 2) / (2 * 1.6**2)) + np.random.default_rng(2).normal(0, 5, (64, 64))
    hit = image.copy()
    hit[10, 12] += 4000
    hit[50, 20:23] += 3000
    clean, mask = kernels.cosmic_rays(hit, 2.0, 7.0, 60000)
    assert mask[10, 12] and mask[50, 20:23].all() and not mask[30:35, 30:35].any()
    assert abs(clean[10, 12] - 200) < 50


def test_config(tmp_path, caplog):
    c = NightConfig.from_dict({"instrument": "st_1m", "discovery": {"min_snr": 7, "nope": 1}, "detect": 3, "what": 1, "instrument_overrides": {"gain": 3.0, "header": {"gain": ["MYGAIN"]}}})
    assert c.discovery.min_snr == 7 and c.detect.npixels == 5 and "nope" in caplog.text and "what" in caplog.text
    inst = c.resolve_instrument()
    assert inst.gain == 3.0 and inst.header.gain == ("MYGAIN",) and inst.header.exptime[0] == "EXPTIME" and get_instrument("st_1m").gain == 10.0
    c.to_yaml(tmp_path / "c.yaml")
    assert NightConfig.from_yaml(tmp_path / "c.yaml").discovery.min_snr == 7
    with pytest.raises(KeyError, match="dot_4kx4k"):
        get_instrument("hubble")


def test_reference_csv(tmp_path, spark):
    (tmp_path / "r.csv").write_text("RA,Dec,Extra\n10,20,x\nbad,1,y\n")
    rows = load_local_reference(spark, str(tmp_path / "r.csv")).collect()
    assert len(rows) == 1 and rows[0].mag is None
    assert load_local_reference(spark, str(tmp_path / "none.csv")) is None


def test_json_is_strict():
    assert json.loads(json.dumps(sanitise({"a": float("nan"), "b": [float("inf"), 1.0]}), allow_nan=False)) == {"a": None, "b": [None, 1.0]}


@pytest.fixture(scope="module")
def night(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("night")
    config = NightConfig(instrument="dfot_2kx2k")
    for name in ("raw", "master", "reduced", "catalogs", "reports"):
        setattr(config.paths, name, str(root / name))
    generate_night(spark, config.paths.raw, sky=Sky(nx=300, ny=300, stars=60, science=6, bias=3, dark=3, flat=3, cosmics=30))
    broken = Path(config.paths.raw) / "science_005.fits"
    header, _ = fits.read_fits(broken.read_bytes())
    fits.write_fits(broken, np.zeros((16, 16), np.float32), {k: v for k, v in header.items() if k not in ("SIMPLE", "BITPIX", "NAXIS", "NAXIS1", "NAXIS2", "CREATOR")})
    packed = Path(config.paths.raw) / "science_004.fits"
    header, image = fits.read_fits(packed.read_bytes())
    Path(f"{packed}.fz").write_bytes(compressed(image, "GZIP_2", -32, {k: v for k, v in header.items() if k not in ("SIMPLE", "BITPIX", "NAXIS", "NAXIS1", "NAXIS2")}))
    packed.unlink()
    return run_night(spark, config), config


def test_planted_sources_are_recovered(night):
    result, _ = night
    rows = result.candidates.collect()
    movers = [r for r in rows if r.kind == "mover"]
    assert 1 <= len(movers) <= 2 and any(abs(r.motion_arcsec_min - 3.0) < 1.0 for r in movers)
    assert any(r.kind == "transient" for r in rows) and 1 <= sum(r.kind == "variable" for r in rows) <= 3
    assert rows[0].kind not in ("known", "single")


def test_a_missing_folder_is_told(spark, tmp_path):
    config = NightConfig()
    for path in (tmp_path / "none", tmp_path / "file.fits"):
        config.paths.raw = str(path)
        if path.suffix:
            path.write_bytes(b"")
        with pytest.raises(NotADirectoryError):
            run_night(spark, config)


def test_compressed_frame_takes_part(night):
    result, _ = night
    qa = {r["name"]: r for r in result.qa.collect()}
    assert qa["science_004.fits.fz"]["ok"] and qa["science_004.fits.fz"]["n_sources"] > 30
    assert any("4" in r.frames.split(",") for r in result.candidates.where("kind = 'mover'").collect())


def test_frame_figures_and_fault_isolation(night):
    qa = {r["name"]: r for r in night[0].qa.collect()}
    assert not qa["science_005.fits"]["ok"] and qa["science_005.fits"]["error"]
    good = [r for r in qa.values() if r["ok"]]
    assert len(good) == 5 and np.median([r["n_sources"] for r in good]) > 30
    assert all(r["astrom_rms_arcsec"] < 1.0 and r["zp_scatter"] < 0.1 for r in good)


def test_products(night):
    result, config = night
    reports = Path(config.paths.reports)
    qa = json.loads((reports / "qa_summary.json").read_text())
    assert {"instrument", "telescope", "frames", "reference_size"} <= qa.keys() and len(qa["frames"]) == 6
    dossiers = json.loads((reports / "dossiers.json").read_text())
    mover = next(d for d in dossiers if d["kind"] == "mover")
    assert {c["status"] for c in mover["checks"][:3]} == {"unavailable"} and (reports / mover["html_name"]).exists()
    assert "Median seeing" in (reports / "run_summary.txt").read_text() and "<table>" in (reports / "report.html").read_text()
    assert list(Path(config.paths.reduced).glob("*_reduced.fits")) and (Path(config.paths.master) / "master_bias.fits").exists()
    catalogs = Path(config.paths.catalogs)
    assert (catalogs / "candidates.csv").read_text().splitlines()[0].startswith("obj_id,kind,rank_score")
    made = {p.name: len(p.read_text().splitlines()) - 1 for p in catalogs.glob("*_catalog.csv")}
    assert len(made) == 5 and made["science_000_catalog.csv"] == result.sources.where("frame = 'science_000.fits'").count()
    page = (reports / mover["html_name"]).read_text()
    assert "class='track'" in page and page.count("class='light-curve'") == 1 and ">+1h</text>" in page
    report = (reports / "report.html").read_text()
    assert 0 < report.count("class='stamp'") == report.count("data:image/png") <= 12
    other = next(d for d in dossiers if d["kind"] == "transient")
    assert "class='track'" not in (reports / other["html_name"]).read_text() and "class='light-curve'" in (reports / other["html_name"]).read_text()
    assert "COD XXX" in page and "+24h" in page and "+1h" in page and "fit rms" in page and "re-check online" in mover["verdict"]
    assert "<polyline" in (reports / "report.html").read_text()


def test_dossiers_hold_every_detection(night):
    result, config = night
    reports = Path(config.paths.reports)
    n_det = {r.obj_id: r.n_det for r in result.objects.collect()}
    dossiers = json.loads((reports / "dossiers.json").read_text())
    assert {"mover", "transient"} <= {d["kind"] for d in dossiers}
    for d in dossiers:
        page = (reports / d["html_name"]).read_text()
        lines = page.split("<pre>")[1].split("</pre>")[0].splitlines()
        assert len(lines) == n_det[d["obj_id"]] == len(set(lines)) and all(len(x) == 80 for x in lines)
        assert page.count("data:image/png") <= min(8, n_det[d["obj_id"]])
    mover = next(d for d in dossiers if d["kind"] == "mover")
    assert mover["motion"].keys() == {"speed_arcsec_min", "pa_deg", "fit_rms_arcsec", "predictions", "arc_minutes", "n_epochs"}
    assert mover["motion"]["n_epochs"] == n_det[mover["obj_id"]] and mover["motion"]["fit_rms_arcsec"] < 3.0
    assert mover["motion"]["predictions"].keys() == {"+1h", "+24h"}


def test_no_science_frames(spark, tmp_path):
    config = NightConfig()
    config.paths.raw = str(tmp_path)
    fits.write_fits(tmp_path / "b.fits", np.zeros((4, 4)), {"IMAGETYP": "bias"})
    with pytest.raises(RuntimeError, match="no science frames"):
        run_night(spark, config, write=False)


def test_knowledge_files(tmp_path, spark):
    (tmp_path / "a.md").write_bytes("﻿Hello moving objects ".encode() * 10)
    (tmp_path / "my_keys.yaml").write_text("secret: 1")
    (tmp_path / "monkey.md").write_text("a note")
    (tmp_path / "keyboard_notes.txt").write_text("another")
    (tmp_path / "b.json").write_text('{"k": [1, 2]}')
    (tmp_path / "c.csv").write_text("h\n" + "\n".join(map(str, range(500))))
    (tmp_path / "d.html").write_text("<nav>no</nav><p>yes &amp; so</p><script>x</script>")
    rows = {r.source: r.text for r in knowledge.read_files(spark, str(tmp_path)).collect()}
    assert set(rows) == {"a.md", "b.json", "c.csv", "d.html", "monkey.md", "keyboard_notes.txt"} and rows["d.html"] == "yes & so"
    assert rows["a.md"].startswith("Hello") and rows["c.csv"].splitlines()[:3] == ["CSV c.csv", "columns: h", "0"] and len(rows["c.csv"].splitlines()) == 401


@pytest.mark.parametrize("name", ["vault", "notes/.x/notes", "a [b] c"])
def test_vault_skips_dot_folders(tmp_path, spark, name):
    vault = tmp_path / ".hidden" / name
    (vault / ".git").mkdir(parents=True)
    (vault / "sub").mkdir()
    (vault / "n.md").write_text("note one")
    (vault / "sub" / "m.txt").write_text("note two")
    (vault / ".git" / "x.md").write_text("no")
    assert {r.source for r in knowledge.read_vault(spark, str(vault)).collect()} == {f"{vault.name}/n.md", f"{vault.name}/sub/m.txt"}


def test_caps_take_the_file_that_reaches_them(spark):
    files = spark.createDataFrame([(f"{i:03d}", 10) for i in range(50)], "path string, length long")
    assert knowledge.within_caps(files, 400, 95).count() == 10 and knowledge.within_caps(files, 400, 100).count() == 10 and knowledge.within_caps(files, 7, 1000).count() == 7


def test_fits_units_of_other_kinds(tmp_path, spark):
    image = np.arange(12, dtype=np.float32).reshape(3, 4)
    card = lambda *c: b"".join(f"{x:<80}".encode() for x in (*c, "END")).ljust(2880)
    table = card("XTENSION= 'BINTABLE'", "BITPIX  = 8", "NAXIS   = 2", "NAXIS1  = 16", "NAXIS2  = 10", "PCOUNT  = 0", "GCOUNT  = 1", "TFIELDS = 0") + b"\1" * 160 + b"\0" * 2720
    reduced = fits.write_reduced(tmp_path / "r.fits", image, image, np.zeros((3, 4), np.uint8), {"OBJECT": "x"}).read_bytes()
    (tmp_path / "t.fits").write_bytes(reduced[:2880] + table + reduced[2880:])
    header, back = fits.read_path(str(tmp_path / "t.fits"))
    assert (back == image).all() and header["EXTNAME"] == "SCI"
    (tmp_path / "z.fits.fz").write_bytes(reduced[:2880] + table.replace(b"TFIELDS = 0".ljust(80), b"ZIMAGE  = T".ljust(80)))
    fits.write_fits(tmp_path / "long.fits", image, {"N": 5}, [f"step {i}" for i in range(900)])
    (tmp_path / "g.fits.gz").write_bytes(gzip.compress((tmp_path / "long.fits").read_bytes()))
    fits.register(spark)
    for pixels in ("true", "false"):
        rows = {Path(r.path).name: r for r in spark.read.format("fits").option("path", str(tmp_path)).option("pixels", pixels).load().collect()}
        assert rows["long.fits"].header["N"] == rows["g.fits.gz"].header["N"] == "5" and rows["t.fits"].error is None and (rows["z.fits.fz"].error is not None) == (pixels == "true")
        assert (rows["g.fits.gz"].px is None) == (pixels == "false")


def test_url_checks():
    public, private = (lambda h: ["93.184.216.34"]), (lambda h: ["10.0.0.1"])
    assert knowledge.blocked_reason("http://a.org/x", public) is None
    assert knowledge.blocked_reason("ftp://a.org", public) and knowledge.blocked_reason("http://a.org", private) and knowledge.blocked_reason("http://", public)
    hops = {"http://a.org/": (302, {"location": "/b"}, b""), "http://a.org/b": (200, {"content-type": "text/html"}, b"<p>hi</p>")}
    assert knowledge.fetch_page("http://a.org/", hops.__getitem__, public) == "hi"
    with pytest.raises(ValueError):
        knowledge.fetch_page("http://a.org/", lambda u: (302, {"location": "/"}, b""), public)


def test_retrieval(spark):
    docs = spark.createDataFrame([("movers", "moving objects are linked across frames by their motion " * 6), ("flats", "flat fields correct the response of pixels in each filter " * 6), ("tiny", "short")], "source string, text string")
    index = PassageIndex.build(chunk_documents(docs, "source", "source"))
    hits = index.search("How do movers move?").collect()
    assert hits[0].source == "movers" and all(h.source != "tiny" for h in hits)
    assert index.answer("flat response")["passages"][0]["source"] == "flats"
    assert index.answer("zzzz qqqq")["passages"] == []
    assert index.answer("flat response", generate=lambda q, p: "told")["answer"] == "told"


def test_dossiers_with_services(night):
    result, config = night

    def fetch(service, ra, dec, epoch):
        if service == "skybot":
            return f"1 | Planted | {ra / 15:.8f} | {dec:.8f} | 18"
        raise OSError("refused")

    records = products.dossiers(result, products.member_points(result), fetch=fetch)
    mover = next(d for d in records if d["kind"] == "mover")
    assert mover["verdict"].startswith("known moving object: known object 1 Planted at 0.0 arcsec") and [c["status"] for c in mover["checks"]] == ["match", "unavailable", "no_match"]
    assert all("refused" in d["checks"][0]["detail"] for d in records if d["kind"] != "mover")


def test_figures_of_odd_points():
    point = lambda t, ra, mag, inst=18.0: {"time_min": t, "ra": ra, "dec": 1.0, "frame_index": t, "snr": 20.0, "mag_calib": mag, "mag_inst": inst}
    assert products.light_curve([point(0, 1.0, 17.0)]) == "" and products.track_figure([point(0, 1.0, 17.0)], {}) == ""
    mixed = products.light_curve([point(0, 1.0, 17.0), point(1, 1.0, None), point(2, 1.0, 17.2)])
    assert "instrumental" in mixed and mixed.count("<circle") == 3
    assert "calibrated" in products.light_curve([point(0, 1.0, 17.0), point(1, 1.0, 17.0)])
    over = products.track_figure([point(0, 359.999, 17.0), point(1, 0.001, 17.0)], {"predictions": {"+1h": {"ra": 0.003, "dec": 1.0}}})
    xs = [float(x) for x in re.findall(r"<circle cx='([0-9.]+)'", over)]
    assert 100 < xs[0] - xs[1] < 200 and "+1h" in over
    assert products.light_curve([point(None, 1.0, 17.0)] * 3) == ""

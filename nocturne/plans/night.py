"""A night end to end: frames to masters, reduced images, source tables, candidates and products.

Frames are rows. Masters are combined by row blocks of the detector in parallel; each science frame
is one task of a single Python stage (reduce, cosmic rays, background, detection, measurement), so
pixels never travel between stages. From the source tables on everything is DataFrames.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import headers, photometric, sky
from ..images import kernels
from ..operators import calibration, discovery, plate, pointings
from ..operators.components import Workspace
from ..sources import fits
from ..sources.reference import acquire_reference
from .config import Instrument, NightConfig

log = logging.getLogger("nocturne.night")

MATCH_ARCSEC = 3.0  # of the astrometric refinement

SOURCE_SCHEMA = (
    "frame string, frame_index long, id long, x double, y double, flux double, flux_err double, snr double, kron_flux double, fwhm double, ellipticity double, elongation double, peak double, area double, "
    "local_bkg double, flux_aper double, flux_aper_err double, snr_aper double, sky_adu double, bkg_rms_adu double, n_cosmic_rays long, ok boolean, error string"
)


@dataclass
class NightResult:
    """Lazy tables of a night; ``qa`` has a row a frame, failed ones included."""

    frames: DataFrame
    sources: DataFrame
    qa: DataFrame
    objects: DataFrame
    candidates: DataFrame
    reference: DataFrame | None
    instrument: Instrument


def combine_frames(frames: DataFrame, group: list[str], method: str = "mean", rows: int = 64) -> DataFrame:
    """group, y0, block: clipped combination of each group's frames by blocks of detector rows.

    ``frames`` has ny, nx and v (packed float32). A block of a group is one task: no stack of whole
    frames is ever in memory.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                image = np.frombuffer(r.v, "<f4").reshape(r.ny, r.nx)
                yield pd.DataFrame([{**{g: getattr(r, g) for g in group}, "y0": y, "nx": r.nx, "v": np.ascontiguousarray(image[y : y + rows]).tobytes()} for y in range(0, r.ny, rows)])

    fields = ", ".join(f"{g} {frames.schema[g].dataType.simpleString()}" for g in group)
    parts = frames.select(*group, "ny", "nx", "v").mapInPandas(cut, f"{fields}, y0 long, nx long, v binary")

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        nx = int(pdf["nx"].iloc[0])
        stack = [np.frombuffer(v, "<f4").reshape(-1, nx) for v in pdf["v"]]
        return pd.DataFrame([{**{g: pdf[g].iloc[0] for g in group}, "y0": int(pdf["y0"].iloc[0]), "nx": nx, "v": kernels.combine(stack, method).astype("<f4").tobytes()}])

    return parts.groupBy(*group, "y0").applyInPandas(merge, f"{fields}, y0 long, nx long, v binary")


def _assemble(blocks: DataFrame) -> dict[str, np.ndarray]:
    """Masters on the driver: one image a kind and filter, a bounded set."""
    out: dict[str, list[tuple[int, np.ndarray]]] = {}
    for r in blocks.collect():
        out.setdefault(r["kind"], []).append((r["y0"], np.frombuffer(r["v"], "<f4").reshape(-1, r["nx"])))
    return {k: np.concatenate([b for _, b in sorted(v, key=lambda p: p[0])]) for k, v in out.items()}


def _levelled(frames: DataFrame, run, held: dict) -> DataFrame:
    """kind, ny, nx, v of frames whose pixels ``run(image, row, held)`` changes; the images in ``held`` go to a machine once."""
    shared = frames.sparkSession.sparkContext.broadcast(held)

    def every(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [{"kind": r.kind, "ny": r.ny, "nx": r.nx, "v": run(np.frombuffer(r.px, "<f4").reshape(r.ny, r.nx), r, shared.value).astype("<f4").tobytes()} for r in pdf.itertuples(index=False)]
            yield pd.DataFrame(rows, columns=["kind", "ny", "nx", "v"])

    return frames.select("kind", "ny", "nx", "px", "exptime").mapInPandas(every, "kind string, ny int, nx int, v binary")


def build_masters(frames: DataFrame, out_dir: str | None = None) -> dict:
    """bias, dark_rate, flats by filter and the bad-pixel mask of readable calibration frames."""
    m: dict = {"bias": None, "dark_rate": None, "flats": {}, "bad": None}
    usable = frames.where("error is null and px is not null")
    bias = _levelled(usable.where("ftype = 'bias'").withColumn("kind", F.lit("bias")), lambda im, r, held: im, {})
    m["bias"] = _assemble(combine_frames(bias, ["kind"])).get("bias")
    darks = usable.where("ftype = 'dark'").withColumn("e", F.round("exptime", 1))
    longest = darks.agg(F.max("e").alias("e")).first()["e"]
    level = m["bias"]
    if longest is not None:
        dark = _levelled(darks.where(F.col("e") == longest).withColumn("kind", F.lit("dark")), lambda im, r, held: im, {})
        image = _assemble(combine_frames(dark, ["kind"]))["dark"].astype(np.float64)
        image = image - level if level is not None else image
        m["dark_rate"] = (image / longest if longest > 0 else image).astype(np.float32)
        m["bad"] = m["dark_rate"] > np.median(m["dark_rate"]) + 8 * m["dark_rate"].std()
    else:
        log.warning("no dark frames: dark subtraction is left out")
    rate = m["dark_rate"]

    def flatten(im: np.ndarray, r, held: dict) -> np.ndarray:
        im, level, rate = im.astype(np.float64), held["level"], held["rate"]
        im = im - level if level is not None else im
        im = im - rate * r.exptime if rate is not None else im
        mid = np.median(im)
        return im / mid if mid > 0 else im

    flats = _levelled(usable.where("ftype = 'flat'").withColumn("kind", F.col("filt")), flatten, {"level": level, "rate": rate})
    for filt, image in _assemble(combine_frames(flats, ["kind"])).items():
        norm = float(np.median(image))
        if norm <= 0:
            log.warning("the flat of filter %s has no positive level and is left out", filt)
            continue
        image = image / norm
        low = image < 0.05
        m["bad"] = low if m["bad"] is None else m["bad"] | low
        m["flats"][filt] = np.where(low, 1.0, image).astype(np.float32)
    if out_dir:
        for name, image in [("bias", m["bias"]), ("dark_rate", rate), *((f"flat_{k}", v) for k, v in m["flats"].items())]:
            if image is not None:
                fits.write_fits(Path(out_dir) / f"master_{name}.fits", image, history=[f"master {name}"])
    return m


def flat_of(masters: dict, filt: str) -> np.ndarray | None:
    flats = masters["flats"]
    if filt in flats or len(flats) != 1:
        return flats.get(filt)
    only = next(iter(flats))
    log.warning("no flat of filter %s: the only one, of %s, is used", filt, only)
    return flats[only]


def process_frame(image: np.ndarray, row, masters: dict, inst: Instrument, config: NightConfig, reduced: str | None = None) -> pd.DataFrame:
    """The source table of one frame, with its sky and cosmic-ray figures in every row."""
    gain, noise = row.gain or inst.gain, row.read_noise or inst.read_noise
    data, variance = kernels.reduce_image(image, masters["bias"], masters["dark_rate"], flat_of(masters, row.filt), row.exptime, gain, noise)
    quality = np.zeros(data.shape, np.uint8)
    c = config.cosmic_ray
    if c.enabled and c.method != "none":
        data, hits = kernels.cosmic_rays(data, gain, noise, inst.saturation, c.sigclip, c.sigfrac, c.objlim, c.niter)
        quality |= hits.astype(np.uint8)
    if masters["bad"] is not None:
        quality |= (masters["bad"] * 2).astype(np.uint8)
    if config.denoise.enabled:
        data = kernels.denoise(data, config.denoise.method, config.denoise.strength)
    d = config.detect
    bkg = kernels.background(data, config.background.box_size, config.background.estimator, d.nsigma, d.npixels, config.background.mask_sources_iters, config.background.filter_size)
    smooth = kernels.convolve(bkg["sub"], kernels.gaussian_kernel(d.kernel_fwhm))
    seg = kernels.detect(smooth, d.nsigma * bkg["rms"], d.npixels)
    if d.deblend:
        seg = kernels.deblend(smooth, seg, d.deblend_nlevels, d.deblend_contrast, d.npixels)
    error = np.sqrt(np.clip(variance, 0, None))
    t = pd.DataFrame(kernels.measure(bkg["sub"], smooth, error, seg))
    if reduced:
        fits.write_reduced(Path(reduced) / f"{Path(row.frame).stem}_reduced.fits", data, variance, quality, {"FRAME": row.frame})
    x, y = t["x"].to_numpy(), t["y"].to_numpy()
    iy, ix = np.clip(np.round(y).astype(int), 0, data.shape[0] - 1), np.clip(np.round(x).astype(int), 0, data.shape[1] - 1)
    t["local_bkg"] = bkg["level"][iy, ix] if len(t) else []
    edge = (x < 8) | (y < 8) | (x > data.shape[1] - 8) | (y > data.shape[0] - 8)
    full = t["peak"] + t["local_bkg"] >= 0.95 * (inst.saturation - 400)
    stars = t[(t["snr"] > 20) & (t["ellipticity"] < 0.3) & ~edge & ~full]
    fwhm = float(np.median(stars["fwhm"])) if len(stars) else float(np.median(t["fwhm"])) if len(t) else 3.0
    fwhm = fwhm if np.isfinite(fwhm) and fwhm > 0 else 3.0
    for k, v in kernels.aperture_photometry(bkg["sub"], error, x, y, max(3.0, d.aperture_scale * fwhm)).items():
        t[k] = v
    t["kron_flux"] = kernels.kron_flux(bkg["sub"], x, y, t["fwhm"].to_numpy(), t["flux"].to_numpy())
    return t.assign(frame=row.frame, frame_index=row.frame_index, sky_adu=bkg["median"], bkg_rms_adu=bkg["median_rms"], n_cosmic_rays=int((quality & 1).sum()), ok=True, error=None)


def extract(lights: DataFrame, masters: dict, inst: Instrument, config: NightConfig, reduced: str | None = None) -> DataFrame:
    """Sources of all frames; a frame that fails gives one row with ok false and its error."""
    shared = lights.sparkSession.sparkContext.broadcast(masters)  # a few images, whatever the night
    names = [f.split()[0] for f in SOURCE_SCHEMA.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                try:
                    if row.px is None:
                        raise ValueError("no image")
                    out = process_frame(np.frombuffer(row.px, "<f4").reshape(int(row.ny), int(row.nx)), row, shared.value, inst, config, reduced)
                    if not len(out):
                        out = pd.DataFrame([{"frame": row.frame, "frame_index": row.frame_index, "n_cosmic_rays": 0, "ok": True}])
                except Exception as e:  # noqa: BLE001  one bad frame must not end the night
                    out = pd.DataFrame([{"frame": row.frame, "frame_index": row.frame_index, "n_cosmic_rays": 0, "ok": False, "error": f"{type(e).__name__}: {e}"}])
                yield out.reindex(columns=names)

    columns = ["frame", "frame_index", "ny", "nx", "px", "gain", "read_noise", "exptime", "filt"]
    return lights.select(*columns).repartition("frame_index").mapInPandas(run, SOURCE_SCHEMA)


def timed(lights: DataFrame) -> DataFrame:
    """Adds frame_index and time_min: parsed times from the first frame, or plain order if any fails."""
    t = discovery.numbered(lights.withColumn("m", headers.time_minutes(F.col("dateobs"))), "dateobs", "frame")
    whole = F.broadcast(t.agg(F.bool_and(F.col("m").isNotNull()).alias("all"), F.min("m").alias("first")))  # one row
    keyed = t.crossJoin(whole).withColumn("time_min", F.when(F.col("all"), F.col("m") - F.col("first")).otherwise(F.col("det_idx").cast("double"))).drop("m", "all", "first", "det_idx")
    return discovery.numbered(keyed, "time_min", "frame").withColumnRenamed("det_idx", "frame_index")


def planes(lights: DataFrame, sources: DataFrame, reference: DataFrame | None, inst: Instrument, config: NightConfig, work: Workspace) -> DataFrame:
    """Each frame's tangent plane: its header's, else the one that its stars have on the reference; nulls where neither is known."""
    a = config.astrometry
    num = lambda k: F.try_element_at(F.col("header"), F.lit(k.upper())).try_cast("double")
    known = lights.select("frame_index", "naxis1", "naxis2", *[(num(t) if a.use_header_wcs else F.lit(None).cast("double")).alias(t) for t in plate.TERMS])
    lost = known.where(" or ".join(f"{t} is null" for t in plate.TERMS)).select(F.col("frame_index").alias("frame"), F.col("naxis1").alias("nx"), F.col("naxis2").alias("ny"))
    if not a.enabled or a.solver == "none" or reference is None or lost.isEmpty():
        return known.drop("naxis1", "naxis2")
    stars = sources.where("ok and id is not null").withColumnRenamed("frame", "name").withColumnRenamed("frame_index", "frame").join(lost, "frame", "left_semi")
    scale = (a.scale_low or 0.8 * inst.pixel_scale, a.scale_high or 1.2 * inst.pixel_scale)
    found = work.put(plate.solve(stars, lost, reference, scale, work, radius_arcsec=max(MATCH_ARCSEC, 2 * inst.pixel_scale)), "planes")
    for r in found.groupBy("solved").count().collect():
        (log.info if r["solved"] else log.warning)("%d frames without a usable header: %s by their stars", r["count"], "placed" if r["solved"] else "not placed")
    won = found.where("solved").select(F.col("frame").alias("frame_index"), *[F.col(t).alias(f"{t}_") for t in plate.TERMS])
    both = known.join(won, "frame_index", "left")
    return both.select("frame_index", *[F.when(F.col("crval1_").isNotNull(), F.col(f"{t}_")).otherwise(F.col(t)).alias(t) for t in plate.TERMS])


def with_positions(sources: DataFrame, lights: DataFrame, wcs: DataFrame, inst: Instrument) -> DataFrame:
    """Adds ra, dec by each frame's tangent plane (null without one), quality flags and frame columns."""
    s = sources.join(lights.select("frame_index", "time_min", "exptime", "filt", "airmass", "naxis1", "naxis2"), "frame_index").join(wcs, "frame_index")
    ra, dec = sky.tan_pix2sky(F.col("x"), F.col("y"), *[F.col(t) for t in plate.TERMS])
    flags = {"flag_edge": calibration.edge_flag(F.col("x"), F.col("y"), F.col("naxis1"), F.col("naxis2")), "flag_saturated": calibration.saturation_flag(F.col("peak"), F.col("local_bkg"), inst.saturation, 0.0)}
    return s.withColumns({"ra": ra, "dec": dec, **flags}).drop(*plate.TERMS)


def run_night(spark: SparkSession, config: NightConfig, write: bool = True) -> NightResult:
    """Reduces the raw folder of ``config`` and ranks its candidates; products are written on demand."""
    inst, work = config.resolve_instrument(), Workspace(spark)
    fits.must_be_folder(spark, config.paths.raw)
    raw = fits.read_frames(spark, config.paths.raw)
    meta = work.put(fits.frame_meta(raw, inst).withColumn("frame", F.regexp_replace("path", "^.*/", "")), "frames")
    lights = work.put(timed(meta.where("ftype = 'light'")), "lights")
    if lights.isEmpty():
        raise RuntimeError(f"no science frames in {config.paths.raw}")
    masters = build_masters(meta, config.paths.master if write else None)
    raw_sources = work.put(extract(lights, masters, inst, config, config.paths.reduced if write else None), "extracted")
    if raw_sources.where("ok").isEmpty():
        raise RuntimeError("every science frame failed")
    fields = work.put(pointings.pointing_clusters(lights.select("frame_index", *_pointing(lights)), inst.fov_arcmin), "fields")
    anchors = lights.select("frame_index", *_pointing(lights)).join(fields, "frame_index").where("ra is not null and dec is not null").groupBy("field_id").agg(F.min_by("ra", "frame_index").alias("ra"), F.min_by("dec", "frame_index").alias("dec"))
    reference = acquire_reference(spark, config, anchors, inst)
    if reference is not None:
        reference = work.put(reference, "reference")
    wcs = planes(lights, raw_sources, reference, inst, config, work)
    placed = work.put(with_positions(raw_sources.where("ok and id is not null"), lights, wcs, inst), "placed")
    astrometry = None
    if reference is not None and config.astrometry.enabled:
        astrometry = work.put(calibration.refine_astrometry(placed.where("ra is not null").select("frame_index", "id", "ra", "dec"), reference, "id", "frame_index", MATCH_ARCSEC), "astrometry")
        shift = astrometry.select("frame_index", "shift_ra", "shift_dec")
        placed = placed.join(shift, "frame_index", "left").withColumns({"ra": F.pmod(F.col("ra") + F.coalesce("shift_ra", F.lit(0.0)), F.lit(360.0)), "dec": F.col("dec") + F.coalesce("shift_dec", F.lit(0.0))}).drop("shift_ra", "shift_dec")
    measured = placed.withColumn("seg_flux", F.col("flux")).withColumn("flux", F.col("flux_aper")).withColumn("seg_snr", F.col("snr")).withColumn("snr", F.col("snr_aper"))
    calibrated = calibration.calibrate(measured, reference if config.photometry.enabled else None, F.col("exptime"), F.col("filt"), config.photometry.match_radius_arcsec, config.photometry.min_ref_stars, "id", "frame_index")
    sources = calibrated.withColumns({"flux": F.col("seg_flux"), "snr": F.col("seg_snr"), "mag_err": photometric.instrumental_mag_err(F.col("snr_aper"))}).drop("seg_flux", "seg_snr")
    sources = work.put(sources, "sources")
    qa = work.put(frame_qa(sources, raw_sources, lights, astrometry, inst), "qa")
    d = config.discovery
    settings = discovery.Settings(d.enabled, d.catalog_match_radius_arcsec, d.flag_unmatched, d.moving_object_link, d.max_motion_arcsec_per_min, d.min_tracklet_points, d.variability, d.min_snr, d.top_n)
    tagged = work.put(sources.join(fields, "frame_index"), "tagged")
    parts = {}
    for row in tagged.select("field_id").distinct().orderBy("field_id").collect():  # a row a field
        field = row["field_id"]
        try:  # stored here, so that a failure shows here
            parts[field] = work.put(discovery.discover(tagged.where(F.col("field_id") == field), reference, settings), f"objects_{field}")
        except Exception:  # noqa: BLE001  one field must not end the night
            log.exception("discovery of field %s failed", field)
    if not parts:
        raise RuntimeError("discovery failed in every field")
    objects = work.put(pointings.merge_fields(parts), "all_objects")
    result = NightResult(meta, sources, qa, objects, discovery.candidates(objects, d.top_n), reference, inst)
    if write:
        from .products import write_products

        write_products(result, config)
    return result


def _pointing(lights: DataFrame):
    h = F.col("header")
    crval = lambda k: F.try_element_at(h, F.lit(k)).try_cast("double")
    return [F.coalesce("ra", crval("CRVAL1")).alias("ra"), F.coalesce("dec", crval("CRVAL2")).alias("dec")]


def frame_qa(sources: DataFrame, extracted: DataFrame, lights: DataFrame, astrometry: DataFrame | None, inst: Instrument) -> DataFrame:
    """One row a science frame with its quality figures; failed frames keep ok false and the error."""
    per = extracted.groupBy("frame_index").agg(F.first("frame").alias("name"), F.count("id").alias("n_sources"), F.max("n_cosmic_rays").alias("n_cosmic_rays"), F.max("sky_adu").alias("sky_adu"), F.max("bkg_rms_adu").alias("bkg_rms_adu"), F.bool_and("ok").alias("ok"), F.max("error").alias("error"))
    zp = sources.groupBy("frame_index").agg(F.max("zeropoint").alias("zeropoint"), F.max("zp_scatter").alias("zp_scatter"))
    out = per.join(calibration.seeing(sources, ["frame_index"]), "frame_index", "left").join(zp, "frame_index", "left").join(calibration.limiting_mag(sources, ["frame_index"]), "frame_index", "left")
    out = out.join(lights.select("frame_index", "airmass"), "frame_index", "left")
    if astrometry is not None:
        out = out.join(astrometry.select("frame_index", F.col("rms_arcsec").alias("astrom_rms_arcsec"), F.col("n_matched").alias("n_astrom_matched")), "frame_index", "left")
    else:
        out = out.withColumns({"astrom_rms_arcsec": F.lit(None).cast("double"), "n_astrom_matched": F.lit(0).cast("long")})
    return out.withColumn("fwhm_arcsec", F.col("median_fwhm") * F.lit(inst.pixel_scale)).withColumnRenamed("median_fwhm", "fwhm_pix").orderBy("frame_index")

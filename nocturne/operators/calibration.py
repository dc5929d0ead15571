"""Robust statistics and calibration: sigma clipping, zero points, astrometric refinement, stacks.

Clipping is unrolled: a pass over survivors that removes nothing repeats itself, so a fixed number
of passes equals a loop that stops early. Each pass is a window over one partitioning of the group,
so the whole operator shuffles once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.photometric import EXTINCTION, calibrated_mag, calibrated_mag_err, extinction_prior, instrumental_mag, instrumental_mag_err
from ..functions.sky import separation_arcsec, wrap_deg
from .crossmatch import isolated, nearest_match

MAD_TO_SIGMA = 1.482602218505602

__all__ = ["EXTINCTION", "sigma_clip", "zero_point", "refine_astrometry", "combine_stack", "normalise_flats", "hot_pixels", "reduce_pixels", "limiting_mag", "flat_for"]


def sigma_clip(rows: DataFrame, keys: list[str], value: str, sigma: float = 3.0, passes: int = 5, spread: str = "std") -> DataFrame:
    """Adds kept: whether the value survives ``passes`` rounds of |x - median| <= sigma * spread.

    ``spread`` is std (population) or mad (scaled median absolute deviation). Null values are never
    kept. With zero spread only values equal to the centre stay.
    """
    own = Window.partitionBy(*keys)
    out = rows.withColumn("kept", F.col(value).isNotNull())
    for _ in range(passes):
        alive = F.when(F.col("kept"), F.col(value))
        out = out.withColumn("_c", F.median(alive).over(own))
        if spread == "mad":
            out = out.withColumn("_s", F.median(F.abs(alive - F.col("_c"))).over(own) * F.lit(MAD_TO_SIGMA))
        else:
            out = out.withColumn("_s", F.stddev_pop(alive).over(own))
        out = out.withColumn("kept", F.col("kept") & (F.abs(F.col(value) - F.col("_c")) <= F.lit(sigma) * F.col("_s"))).drop("_c", "_s")
    return out


def clipped_stats(rows: DataFrame, keys: list[str], value: str, sigma: float = 3.0, passes: int = 5) -> DataFrame:
    """keys, n (before clipping), n_kept, mean, median and std (population) of the survivors."""
    alive = F.when(F.col("kept"), F.col(value))
    return sigma_clip(rows, keys, value, sigma, passes).groupBy(*keys).agg(F.count(value).alias("n"), F.count(alive).alias("n_kept"), F.avg(alive).alias("mean"), F.median(alive).alias("median"), F.stddev_pop(alive).alias("std"))


def star_like(snr: Column, ellipticity: Column, saturated: Column, edge: Column) -> Column:
    return (snr > 20) & (ellipticity < 0.3) & ~saturated & ~edge


def seeing(sources: DataFrame, keys: list[str]) -> DataFrame:
    """keys, median_fwhm of star-like sources, else of all, else 3 pixels."""
    good = star_like(F.col("snr"), F.col("ellipticity"), F.col("flag_saturated"), F.col("flag_edge"))
    best, every = F.median(F.when(good, F.col("fwhm"))), F.median("fwhm")
    value = F.coalesce(best, every)
    return sources.groupBy(*keys).agg(F.when(value > 0, value).otherwise(3.0).alias("median_fwhm"))


def edge_flag(x: Column, y: Column, nx: Column | int, ny: Column | int, margin: int = 8) -> Column:
    nx, ny = (v if isinstance(v, Column) else F.lit(v) for v in (nx, ny))
    return (x < margin) | (y < margin) | (x > nx - margin) | (y > ny - margin)


def saturation_flag(peak: Column, local: Column, saturation: Column | float, sky: Column | float) -> Column:
    level = saturation if isinstance(saturation, Column) else F.lit(float(saturation))
    fallback = sky if isinstance(sky, Column) else F.lit(float(sky))
    return peak + F.coalesce(local, fallback) >= F.lit(0.95) * (level - F.lit(400.0))


def calibrators(sources: DataFrame, reference: DataFrame, radius_arcsec: float, key: str = "id", frame: str = "frame") -> DataFrame:
    """Matched, bright, round, unsaturated, isolated sources with both magnitudes: frame, key, diff."""
    tagged = isolated(sources, key, frame).withColumn("row_key", F.concat_ws("|", frame, key))
    match = nearest_match(tagged.select("row_key", "ra", "dec"), reference.select("ref_id", "ra", "dec"), radius_arcsec, "row_key", "ref_id")
    good = star_like(F.col("snr"), F.col("ellipticity"), F.col("flag_saturated"), F.col("flag_edge")) & F.col("isolated")
    both = tagged.where(good).join(match, "row_key").join(reference.select("ref_id", F.col("mag").alias("ref_mag")), "ref_id")
    return both.where("mag_inst is not null and ref_mag is not null").select(frame, key, (F.col("ref_mag") - F.col("mag_inst")).alias("diff"))


def zero_point(sources: DataFrame, reference: DataFrame, radius_arcsec: float = 2.0, least: int = 8, key: str = "id", frame: str = "frame") -> DataFrame:
    """frame, n_calib, zeropoint, zp_scatter: null below ``least`` calibrators (counted before clipping)."""
    stats = clipped_stats(calibrators(sources, reference, radius_arcsec, key, frame), [frame], "diff")
    enough = F.col("n") >= least
    return stats.select(frame, F.col("n").alias("n_calib"), F.when(enough, F.col("median")).alias("zeropoint"), F.when(enough, F.col("std")).alias("zp_scatter"))


def calibrate(sources: DataFrame, reference: DataFrame | None, exptime: Column, filt: Column, radius_arcsec: float = 2.0, least: int = 8, key: str = "id", frame: str = "frame") -> DataFrame:
    """Adds mag_inst, mag_inst_err, mag_calib, mag_calib_err and the recorded (never applied) extinction."""
    out = sources.withColumns({"mag_inst": instrumental_mag(F.col("flux"), exptime), "mag_inst_err": instrumental_mag_err(F.col("snr")), "extinction": extinction_prior(filt)})
    if reference is None:
        return out.withColumns({c: F.lit(None).cast("double") for c in ("zeropoint", "zp_scatter", "mag_calib", "mag_calib_err")})
    zp = zero_point(out, reference, radius_arcsec, least, key, frame)
    out = out.join(zp.select(frame, "zeropoint", "zp_scatter"), frame, "left")
    return out.withColumns({"mag_calib": calibrated_mag(F.col("mag_inst"), F.col("zeropoint")), "mag_calib_err": calibrated_mag_err(F.col("mag_inst_err"), F.col("zp_scatter"))})


def limiting_mag(sources: DataFrame, keys: list[str]) -> DataFrame:
    """Median calibrated magnitude of sources with 3 < S/N < 8, else the 95th percentile of all."""
    faint = F.median(F.when((F.col("snr") > 3) & (F.col("snr") < 8), F.col("mag_calib")))
    return sources.groupBy(*keys).agg(F.coalesce(faint, F.percentile("mag_calib", 0.95)).alias("limiting_mag"))


def refine_astrometry(catalog: DataFrame, reference: DataFrame, key: str, frame: str, radius_arcsec: float = 3.0) -> DataFrame:
    """frame, shift_ra, shift_dec, refined, n_matched, rms_arcsec: a median shift kept only if it helps.

    Fewer than four matches: unchanged. After the shift positions are matched again; it is rolled
    back unless there are as many matches and no larger scatter.
    """

    def match(cat: DataFrame, tag: str) -> DataFrame:
        cat = cat.withColumn("row_key", F.concat_ws("|", frame, key))
        hit = nearest_match(cat.select("row_key", "ra", "dec"), reference.select("ref_id", "ra", "dec"), radius_arcsec, "row_key", "ref_id")
        ref = reference.select("ref_id", F.col("ra").alias("ref_ra"), F.col("dec").alias("ref_dec"))
        both = cat.join(hit, "row_key").join(ref, "ref_id")
        return both.groupBy(frame).agg(
            F.count("*").alias(f"n{tag}"),
            F.sqrt(F.avg(F.col("sep_arcsec") * F.col("sep_arcsec"))).alias(f"rms{tag}"),
            F.median(wrap_deg(F.col("ref_ra") - F.col("ra"))).alias(f"dra{tag}"),
            F.median(F.col("ref_dec") - F.col("dec")).alias(f"ddec{tag}"),
        )

    first = match(catalog, "0")
    moved = catalog.join(first.where("n0 >= 4"), frame).withColumns({"ra": F.pmod(F.col("ra") + F.col("dra0"), F.lit(360.0)), "dec": F.col("dec") + F.col("ddec0")}).select(frame, key, "ra", "dec")
    second = match(moved, "1").select(frame, "n1", "rms1")
    both = first.join(second, frame, "left")
    keep = (F.col("n0") >= 4) & (F.col("n1") >= F.col("n0")) & (F.col("rms1") <= F.col("rms0"))
    keep = F.coalesce(keep, F.lit(False))
    return both.select(frame, F.when(keep, F.col("dra0")).otherwise(0.0).alias("shift_ra"), F.when(keep, F.col("ddec0")).otherwise(0.0).alias("shift_dec"), keep.alias("refined"), F.when(keep, F.col("n1")).otherwise(F.col("n0")).alias("n_matched"), F.when(keep, F.col("rms1")).otherwise(F.col("rms0")).alias("rms_arcsec"))


# ---- stacks of pixels ------------------------------------------------------------------------


def combine_stack(pixels: DataFrame, keys: list[str], value: str = "v", method: str = "mean", sigma: float = 3.0, passes: int = 5) -> DataFrame:
    """keys, combined, n_kept: per pixel the mean or median of values that survive MAD clipping; else the plain median."""
    alive = F.when(F.col("kept"), F.col(value))
    merged = F.avg(alive) if method == "mean" else F.median(alive)
    return sigma_clip(pixels, keys, value, sigma, passes, "mad").groupBy(*keys).agg(F.coalesce(merged, F.median(value)).alias("combined"), F.count(alive).alias("n_kept"))


def normalise_flats(flats: DataFrame, filt: str, frame: str, pixel: list[str], value: str = "v") -> DataFrame:
    """filter, pixel, flat, bad: flats at their own median, combined, at the median of all; low response is flagged.

    Frames with a median that isn't positive stay as they are; a filter whose combined median isn't
    positive gives no rows. Pixels below 0.05 are bad and count as 1.
    """
    own = flats.groupBy(filt, frame).agg(F.median(value).alias("_m"))
    level = flats.join(own, [filt, frame]).withColumn("_v", F.when(F.col("_m") > 0, F.col(value) / F.col("_m")).otherwise(F.col(value)))
    master = combine_stack(level, [filt, *pixel], "_v", "mean")
    norm = master.groupBy(filt).agg(F.median("combined").alias("_n")).where("_n > 0")
    scaled = master.join(norm, filt).withColumn("_f", F.col("combined") / F.col("_n"))
    return scaled.select(filt, *pixel, F.when(F.col("_f") < 0.05, 1.0).otherwise(F.col("_f")).alias("flat"), (F.col("_f") < 0.05).alias("bad"))


def hot_pixels(dark_rate: DataFrame, value: str = "rate", sigma: float = 8.0) -> DataFrame:
    """Adds hot: above the median by ``sigma`` population standard deviations of the frame."""
    stats = dark_rate.agg(F.median(value).alias("_m"), F.stddev_pop(value).alias("_s"))
    return dark_rate.crossJoin(F.broadcast(stats)).withColumn("hot", F.col(value) > F.col("_m") + F.lit(sigma) * F.col("_s")).drop("_m", "_s")


def reduce_pixels(raw: Column, bias: Column, dark_rate: Column, flat: Column, exptime: Column, gain: Column, read_noise: Column) -> tuple[Column, Column]:
    """(data, variance): (raw - bias - dark t) / flat and its propagated noise; absent steps are null columns."""
    dark = F.coalesce(dark_rate, F.lit(0.0))
    before = raw - F.coalesce(bias, F.lit(0.0)) - dark * exptime
    response = F.coalesce(flat, F.lit(1.0))
    noise = read_noise / gain
    variance = noise * noise + F.greatest(before, F.lit(0.0)) / gain + F.greatest(dark, F.lit(0.0)) * exptime / gain
    return before / response, variance / (response * response)


def flat_for(frames: DataFrame, flats: DataFrame) -> DataFrame:
    """Adds flat_filt: the frame's own filter if it has a flat, else the only flat there is, else null."""
    only = flats.agg(F.when(F.count_distinct("filt") == 1, F.max("filt")).alias("only_filt"))
    have = flats.select(F.col("filt").alias("have_filt")).distinct()
    joined = frames.join(F.broadcast(have), F.col("filt") == F.col("have_filt"), "left").crossJoin(F.broadcast(only))
    return joined.withColumn("flat_filt", F.coalesce("have_filt", "only_filt")).drop("have_filt", "only_filt")


def separation_column(a: str, b: str) -> Column:
    return separation_arcsec(F.col(f"{a}_ra"), F.col(f"{a}_dec"), F.col(f"{b}_ra"), F.col(f"{b}_dec"))


def brightest(sources: DataFrame, most: int, group: str = "frame_index", flux: str = "flux", key: str = "id") -> DataFrame:
    """Each frame's ``most`` sources of greatest flux with their order (from 1); equal fluxes go by key, a missing one comes last."""
    order = F.row_number().over(Window.partitionBy(group).orderBy(F.desc_nulls_last(flux), key))
    return sources.withColumn("order", order).where(F.col("order") <= most)

"""Linear motion of tracks, predictions, report lines and the pieces of a dossier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sky import wrap_deg


def unwrap_ra(points: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Adds ra_u: right ascension along the order without jumps at 0/360."""
    w = Window.partitionBy(key).orderBy(*order)
    step = F.col("ra") - F.lag("ra").over(w)
    jump = F.coalesce(wrap_deg(step) - step, F.lit(0.0))
    return points.withColumn("_jump", jump).withColumn("ra_u", F.col("ra") + F.sum("_jump").over(w)).drop("_jump")


def fit_motion(points: DataFrame, key: str) -> DataFrame:
    """key, n, speed_arcsec_min, pa_deg, fit_rms_arcsec, arc_minutes and the 1 h and 24 h predictions.

    Least-squares lines of unwrapped right ascension and declination over time. Tracks of fewer than
    two points or without a time span give no row; two points fit exactly.
    """
    u = unwrap_ra(points, key, ["time_min", "det_idx"])
    origin = u.groupBy(key).agg(F.min("time_min").alias("t0"))
    per = u.join(origin, key).withColumn("t", F.col("time_min") - F.col("t0"))
    a = per.groupBy(key).agg(
        F.count("*").alias("n"),
        F.regr_slope("ra_u", "t").alias("v_ra"),
        F.regr_intercept("ra_u", "t").alias("ra0"),
        F.regr_slope("dec", "t").alias("v_dec"),
        F.regr_intercept("dec", "t").alias("dec0"),
        F.avg("dec").alias("mean_dec"),
        F.max("t").alias("arc_minutes"),
        (F.regr_syy("ra_u", "t") - F.try_divide(F.regr_sxy("ra_u", "t") * F.regr_sxy("ra_u", "t"), F.regr_sxx("ra_u", "t"))).alias("ss_ra"),
        (F.regr_syy("dec", "t") - F.try_divide(F.regr_sxy("dec", "t") * F.regr_sxy("dec", "t"), F.regr_sxx("dec", "t"))).alias("ss_dec"),
    )
    cosd = F.cos(F.radians("mean_dec"))
    rms = F.sqrt(F.greatest((F.col("ss_ra") * cosd * cosd + F.col("ss_dec")) / F.col("n"), F.lit(0.0))) * 3600.0
    at = lambda m: F.col("arc_minutes") + F.lit(m)
    ahead = lambda m: [F.pmod(F.col("ra0") + F.col("v_ra") * at(m), F.lit(360.0)), F.col("dec0") + F.col("v_dec") * at(m)]
    (ra1, dec1), (ra24, dec24) = ahead(60.0), ahead(1440.0)
    return a.where("n >= 2 and arc_minutes > 0").select(
        key,
        "n",
        (F.hypot(F.col("v_ra") * cosd, F.col("v_dec")) * 3600.0).alias("speed_arcsec_min"),
        F.pmod(F.degrees(F.atan2(F.col("v_ra") * cosd, F.col("v_dec"))), F.lit(360.0)).alias("pa_deg"),
        F.when(F.col("n") > 2, rms).otherwise(0.0).alias("fit_rms_arcsec"),
        "arc_minutes",
        ra1.alias("ra_1h"),
        dec1.alias("dec_1h"),
        ra24.alias("ra_24h"),
        dec24.alias("dec_24h"),
    )


def middle_epoch(points: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The row at position n div 2 (from 0) of each track in the given order."""
    own = Window.partitionBy(key)
    ranked = points.withColumns({"_n": F.count("*").over(own), "_i": F.row_number().over(own.orderBy(*order))})
    return ranked.where(F.col("_i") == F.expr("_n div 2") + 1).drop("_n", "_i")


def report_line(designation: Column, ra: Column, dec: Column, mjd_minutes: Column, exptime_s: Column, mag: Column, band: str = "V", code: str = "XXX") -> Column:
    """An 80-column observation line; null without a time.

    Right ascension, declination and the day are rounded once to integer ticks and then split, so
    nothing rolls over to 60. The time is that of mid-exposure. The code closes the line.
    """
    minutes = mjd_minutes + F.when(exptime_s > 0, exptime_s / 120.0).otherwise(0.0)
    ticks = F.round(minutes / 1440.0 * 100000.0).cast("long")
    day = F.date_add(F.lit("1970-01-01").cast("date"), (F.floor(ticks / 100000) - 40587).cast("int"))
    date = F.concat(F.date_format(day, "yyyy MM dd"), F.format_string(".%05d", F.pmod(ticks, F.lit(100000))))
    r = F.pmod(F.round(F.pmod(ra, F.lit(360.0)) / 15.0 * 360000.0).cast("long"), F.lit(24 * 360000))
    d = F.round(F.abs(dec) * 36000.0).cast("long")
    whole = lambda a, b: F.floor(a / b).cast("long")
    ra_text = F.format_string("%02d %02d %02d.%02d", whole(r, 360000), whole(r, 6000) % 60, whole(r, 100) % 60, r % 100)
    dec_text = F.format_string("%s%02d %02d %02d.%d", F.when(dec < 0, "-").otherwise("+"), whole(d, 36000), whole(d, 600) % 60, whole(d, 10) % 60, d % 10)
    mag_text = F.when(mag.isNotNull(), F.format_string("%5.1f", mag)).otherwise(F.lit("     "))
    body = F.concat(F.lit("     "), F.rpad(F.substring(designation, 1, 7), 7, " "), F.lit("  C"), date, F.lit(" "), ra_text, F.lit(" "), dec_text, F.lit("         "), mag_text, F.lit(f" {band}"))
    return F.when(mjd_minutes.isNotNull(), F.concat(F.rpad(body, 77, " "), F.rpad(F.lit(code), 3, " ")))


def picks(points: DataFrame, objects: DataFrame, key: str) -> DataFrame:
    """Cutout epochs: first, middle and last by frame of a mover, else the brightest epoch."""
    own = Window.partitionBy(key)
    by_frame = F.row_number().over(own.orderBy("frame_index", "det_idx"))
    by_snr = F.row_number().over(own.orderBy(F.desc("snr"), "det_idx"))
    ranked = points.join(objects.select(key, "kind"), key).withColumns({"_n": F.count("*").over(own), "_i": by_frame, "_s": by_snr})
    mover = (F.col("_i") == 1) | (F.col("_i") == F.expr("_n div 2") + 1) | (F.col("_i") == F.col("_n"))
    return ranked.where(F.when(F.col("kind") == "mover", mover).otherwise(F.col("_s") == 1)).drop("_n", "_i", "_s")


def identity_checks(objects: DataFrame, services: DataFrame | None = None, key: str = "obj_id") -> DataFrame:
    """Adds checks, rows of service, status and detail, to each interesting object.

    ``services`` (key, services) holds what the services answered (``sources.services``). Of an object without an
    entry, as of all without a network, the two small-body services and the near-earth context, or the object
    service, are ``unavailable``, never ``no_match``. The local catalogue closes the list.
    """
    row = lambda s, st, d: F.struct(F.lit(s).alias("service"), st.alias("status"), d.alias("detail"))
    away, why = F.lit("unavailable"), F.lit("offline mode")
    mover = F.array(*[row(s, away, why) for s in ("skybot", "jpl_sbident", "neows")])
    other = F.array(row("simbad", away, why))
    offline = F.when(F.col("kind") == "mover", mover).otherwise(other)
    matched = F.coalesce(F.col("matched_reference"), F.lit(False))
    own = F.array(row("local_reference", F.when(matched, "match").otherwise("no_match"), F.when(matched, "in the reference catalogue").otherwise("not in the reference catalogue")))
    if services is None:
        return objects.withColumn("checks", F.concat(offline, own))
    return objects.join(services.select(key, "services"), key, "left").withColumn("checks", F.concat(F.coalesce("services", offline), own)).drop("services")


def verdict(kind: Column, checks: Column, speed: Column) -> tuple[Column, Column]:
    """(verdict, action) of an object from its kind and the states of its checks; the near-earth context identifies nothing."""
    telling = F.filter(checks, lambda c: ~c["service"].isin("local_reference", "neows"))
    found = F.get(F.filter(telling, lambda c: c["status"] == "match"), F.lit(0))["detail"]
    any_match = found.isNotNull()
    asked = F.exists(telling, lambda c: c["status"] == "no_match")
    told = (
        F.when((kind == "mover") & any_match, F.concat(F.lit("known moving object: "), found))
        .when((kind == "mover") & asked, F.format_string("uncatalogued moving object (%.2f arcsec/min)", speed))
        .when(kind == "mover", F.format_string("moving object, identity unchecked (%.2f arcsec/min)", speed))
        .when((kind == "transient") & any_match, F.concat(F.lit("catalogued object missing from the reference: "), found))
        .when((kind == "transient") & asked, "new stationary source")
        .when(kind == "transient", "stationary source, identity unchecked")
        .when((kind == "variable") & any_match, F.concat(F.lit("variable star: "), found))
        .when(kind == "variable", "variable star candidate")
        .otherwise("no follow-up")
    )
    action = F.when((kind == "mover") & any_match, "report astrometry").when(kind == "mover", "check services, then report as new").when((kind == "transient") & any_match, "inspect by eye").when(kind == "transient", "take another image soon").when(kind == "variable", "extend the light curve").otherwise("none")
    away = F.array_join(F.transform(F.filter(checks, lambda c: c["status"] == "unavailable"), lambda c: c["service"]), ", ")
    caveat = F.when((away != "") & kind.isin("mover", "transient"), F.concat(F.lit(" ("), away, F.lit(" could not be reached: re-check online)"))).otherwise("")
    return F.concat(told, caveat), action


def neo_counts(body: Column) -> tuple[Column, Column]:
    """(all, hazardous) near-earth objects of a feed's JSON; null where it can't be read."""
    parsed = F.from_json(body, "near_earth_objects map<string, array<struct<is_potentially_hazardous_asteroid boolean>>>")
    every = F.flatten(F.map_values(parsed["near_earth_objects"]))
    return F.when(every.isNotNull(), F.size(every)), F.when(every.isNotNull(), F.size(F.filter(every, lambda o: F.coalesce(o["is_potentially_hazardous_asteroid"], F.lit(False)))))

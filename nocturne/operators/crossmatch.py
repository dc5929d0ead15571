"""Spatial joins on the sphere through three-dimensional cells.

A position's unit vector falls in a cubic cell of twice the chord of the match radius, so that all its
partners lie in the cells that the cube of the radius about it touches, two along an axis at most: the
theta join becomes an equi-join on the cell with the exact separation as a residual, without special
cases at RA 0 or the poles. Catalyst picks a broadcast or a shuffled join by the sizes it knows;
nothing is hinted.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sky import separation_arcsec, unit_vector
from .components import Workspace


def chord(radius_arcsec: float) -> float:
    """Straight distance of points a radius apart on the unit sphere, with a margin for rounding."""
    return max(2.0 * math.sin(math.radians(min(radius_arcsec / 3600.0, 180.0)) / 2.0) * 1.000001, 1e-9)


def in_cell(df: DataFrame, ra: str, dec: str, reach: Column) -> DataFrame:
    """Adds cx, cy, cz for cells of twice ``reach`` (a chord); rows without a position are left out."""
    placed = df.where(F.col(ra).isNotNull() & F.col(dec).isNotNull())
    return placed.withColumns({n: F.floor(v / (reach * 2.0)).cast("long") for n, v in zip(("cx", "cy", "cz"), unit_vector(F.col(ra), F.col(dec)), strict=True)})


def in_cells_around(df: DataFrame, ra: str, dec: str, reach: Column) -> DataFrame:
    """One row for each cell that may hold a partner: those within ``reach`` along each axis that meet the sphere."""
    out = df.where(F.col(ra).isNotNull() & F.col(dec).isNotNull()).withColumns(dict(zip(("_x", "_y", "_z"), unit_vector(F.col(ra), F.col(dec)), strict=True)))
    size, near, far = reach * 2.0, F.lit(0.0), F.lit(0.0)
    for n in "xyz":
        touched = F.sequence(F.floor((F.col(f"_{n}") - reach) / size).cast("long"), F.floor((F.col(f"_{n}") + reach) / size).cast("long"))
        out = out.withColumn(f"c{n}", F.explode(touched))
        middle = F.abs((F.col(f"c{n}") + 0.5) * size)
        near += F.pow(F.greatest(middle - reach, F.lit(0.0)), F.lit(2.0))
        far += F.pow(middle + reach, F.lit(2.0))
    return out.where((near <= 1.000001) & (far >= 0.999999)).drop("_x", "_y", "_z")


def with_cell(df: DataFrame, ra: str, dec: str, radius_arcsec: float) -> DataFrame:
    return in_cell(df, ra, dec, F.lit(chord(radius_arcsec)))


def with_neighbour_cells(df: DataFrame, ra: str, dec: str, radius_arcsec: float) -> DataFrame:
    return in_cells_around(df, ra, dec, F.lit(chord(radius_arcsec)))


def pairs_within(left: DataFrame, right: DataFrame, radius_arcsec: float) -> DataFrame:
    """All (left, right) pairs at most ``radius_arcsec`` apart, as structs l and r with sep_arcsec.

    Both sides need ra and dec in degrees. The right side is the one repeated over cells: give the
    smaller one.
    """
    size = ["cx", "cy", "cz"]
    a = with_cell(left.select(F.struct("*").alias("l"), F.col("ra").alias("_ra"), F.col("dec").alias("_dec")), "_ra", "_dec", radius_arcsec)
    b = with_neighbour_cells(right.select(F.struct("*").alias("r"), F.col("ra").alias("ra_"), F.col("dec").alias("dec_")), "ra_", "dec_", radius_arcsec)
    met = a.join(b, size).withColumn("sep_arcsec", separation_arcsec(F.col("_ra"), F.col("_dec"), F.col("ra_"), F.col("dec_")))
    return met.where(F.col("sep_arcsec") <= radius_arcsec).select("l", "r", "sep_arcsec")


def nearest_match(left: DataFrame, right: DataFrame, radius_arcsec: float, left_id: str, right_id: str) -> DataFrame:
    """left_id, right_id, sep_arcsec: the nearest right row within the radius, ties to the smaller right id.

    Several left rows may share one right row. Left rows without a partner give no row.
    """
    pairs = pairs_within(left.select(left_id, "ra", "dec"), right.select(right_id, "ra", "dec"), radius_arcsec)
    rank = F.row_number().over(Window.partitionBy(F.col(f"l.{left_id}")).orderBy("sep_arcsec", F.col(f"r.{right_id}")))
    return pairs.withColumn("rank", rank).where("rank = 1").select(F.col(f"l.{left_id}").alias(left_id), F.col(f"r.{right_id}").alias(right_id), "sep_arcsec")


def _mindist(size: Column) -> Column:
    """Chord from the row (x, y, z) to the nearest point of the cell (cx, cy, cz)."""
    total = F.lit(0.0)
    for n in "xyz":
        lo = F.col(f"c{n}") * size - 2.0
        total += F.pow(F.greatest(lo - F.col(n), F.col(n) - (lo + size), F.lit(0.0)), F.lit(2.0))
    return F.sqrt(total)


def nearest_anywhere(left: DataFrame, right: DataFrame, left_id: str, right_id: str, finest_arcsec: float, work: Workspace) -> DataFrame:
    """left_id, right_id, sep_arcsec: the nearest right row at any distance, ties to the smaller right id.

    Right rows are counted out into cells of several sizes, each four times the next finer one, and every
    occupied cell keeps one of its rows. A left row knows from the cells that it lies in itself how far a
    neighbour is at most. From the finest size at which its own cell is occupied it goes down, size by
    size: occupied cells beyond the least distance known to any kept row are left out, so that a row
    carries the few cells that the nearest one may be in, and meets single rows at the finest size only.
    """
    finest = max(chord(finest_arcsec), 1e-6)
    top = max(1, math.ceil(math.log(4.0 / finest, 4)))
    size = lambda level: F.lit(finest) * F.pow(F.lit(4.0), level)
    unit = lambda df: df.withColumns(dict(zip("xyz", unit_vector(F.col("ra"), F.col("dec")), strict=True)))
    cells = ["cx", "cy", "cz"]
    usable = "ra is not null and dec is not null"
    placed = unit(right.select(right_id, "ra", "dec").where(usable)).withColumns({f"c{n}": F.floor((F.col(n) + 2.0) / finest).cast("long") for n in "xyz"})
    points = work.put(placed, "points")
    if points.isEmpty():
        return points.select(F.col(right_id).alias(left_id), right_id, F.lit(0.0).alias("sep_arcsec"))
    each = points.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(top))))
    up = lambda c: F.expr(f"shiftright({c}, 2 * level)")
    kept = each.select("level", *[up(c).alias(c) for c in cells], F.struct("x", "y", "z").alias("at")).groupBy("level", *cells).agg(F.min("at").alias("at"))
    kept = work.put(kept.select("level", *cells, F.col("at.x").alias("px"), F.col("at.y").alias("py"), F.col("at.z").alias("pz")), "cells")
    far = F.sqrt(sum((F.pow(F.col(n) - F.col(f"p{n}"), F.lit(2.0)) for n in "xyz"), F.lit(0.0))) * (1 + 1e-9) + 1e-12

    rows = unit(left.select(F.col(left_id).alias("row"), "ra", "dec").where(usable)).select("row", "ra", "dec", "x", "y", "z")
    own = rows.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(top)))).withColumns({f"c{n}": F.expr(f"shiftright(cast(floor(({n} + 2D) / {finest!r}) as bigint), 2 * level)") for n in "xyz"})
    starts = own.join(kept, ["level", *cells]).withColumn("far", far).groupBy("row", "ra", "dec", "x", "y", "z").agg(F.min("level").alias("level"), F.min("far").alias("u"))
    around = starts
    for n in "xyz":
        s = size(F.col("level"))
        around = around.withColumn(f"c{n}", F.explode(F.sequence(F.floor((F.col(n) + 2.0 - F.col("u")) / s).cast("long"), F.floor((F.col(n) + 2.0 + F.col("u")) / s).cast("long"))))
    starts = work.put(around.where(_mindist(size(F.col("level"))) <= F.col("u")).join(kept.select("level", *cells), ["level", *cells], "left_semi"), "starts")
    highest = starts.agg(F.max("level")).head()[0]
    highest = 0 if highest is None else highest
    open_ = starts.where(F.col("level") == highest)
    for level in range(highest, 0, -1):
        here = kept.where(F.col("level") == level).drop("level")
        met = open_.drop("level").join(here, cells).withColumn("far", far)
        bound = met.groupBy("row").agg(F.min("far").alias("u_"))
        near = met.join(bound, "row").withColumn("u", F.least("u", "u_")).where(_mindist(size(F.lit(level))) <= F.col("u")).select("row", "ra", "dec", "x", "y", "z", "u", *[F.col(c).alias(f"p_{c}") for c in cells])
        below = kept.where(F.col("level") == level - 1).select(*cells, *[F.shiftright(c, 2).alias(f"p_{c}") for c in cells])
        down = near.join(below, [f"p_{c}" for c in cells]).where(_mindist(size(F.lit(level - 1))) <= F.col("u"))
        down = down.withColumn("level", F.lit(level - 1)).select(*starts.columns)
        open_ = work.put(down.union(starts.where(F.col("level") == level - 1)), f"open_{level - 1}")
        work.drop(f"open_{level}")
    last = points.select(*cells, F.col(right_id).alias("other"), F.col("ra").alias("ra_"), F.col("dec").alias("dec_"))
    met = open_.join(last, cells).select("row", "other", separation_arcsec(F.col("ra"), F.col("dec"), F.col("ra_"), F.col("dec_")).alias("sep_arcsec"))
    best = met.groupBy("row").agg(F.min(F.struct("sep_arcsec", "other")).alias("b"))
    return best.select(F.col("row").alias(left_id), F.col("b.other").alias(right_id), F.col("b.sep_arcsec").alias("sep_arcsec"))


def crossmatch(left: DataFrame, right: DataFrame, radius_arcsec: float, left_id: str, right_id: str, work: Workspace | None = None) -> DataFrame:
    """The full contract: every left row with idx (right id or -1), sep_arcsec (null is no neighbour) and matched.

    Neighbours beyond the radius are still reported, at any distance: the rows without a partner
    search once more by cells of growing size.
    """
    work = work or Workspace(left.sparkSession)
    usable = left.select(left_id, "ra", "dec").where("ra is not null and dec is not null")
    hits = work.put(nearest_match(usable, right, radius_arcsec, left_id, right_id), "hits")
    rest = work.put(usable.join(hits.select(left_id), left_id, "left_anti"), "rest")
    found = hits.unionByName(nearest_anywhere(rest, right, left_id, right_id, radius_arcsec, work))
    out = left.select(left_id).join(found, left_id, "left")
    return out.select(left_id, F.coalesce(F.col(right_id), F.lit(-1)).alias("idx"), "sep_arcsec", F.coalesce(F.col("sep_arcsec") <= radius_arcsec, F.lit(False)).alias("matched"))


def flag_matched(detections: DataFrame, reference: DataFrame | None, radius_arcsec: float, det_id: str = "det_idx") -> DataFrame:
    """Adds matched_ref: whether a reference row lies within the radius (false without a reference)."""
    if reference is None:
        return detections.withColumn("matched_ref", F.lit(False))
    # a semi-join goes on to the next detection at its first partner; shuffled, as the size of exploded rows is guessed
    here = with_cell(detections.select(F.col(det_id).alias("id_"), F.col("ra").alias("_ra"), F.col("dec").alias("_dec")), "_ra", "_dec", radius_arcsec)
    other = with_neighbour_cells(reference.select(F.col("ra").alias("ra_"), F.col("dec").alias("dec_")), "ra_", "dec_", radius_arcsec)
    near = separation_arcsec(F.col("_ra"), F.col("_dec"), F.col("ra_"), F.col("dec_")) <= radius_arcsec
    same = [here[c] == other[c] for c in ("cx", "cy", "cz")]
    hits = here.join(other.hint("merge"), [*same, near], "left_semi").select(F.col("id_").alias(det_id)).distinct().withColumn("matched_ref", F.lit(True))
    return detections.join(hits, det_id, "left").withColumn("matched_ref", F.coalesce("matched_ref", F.lit(False)))


def radius_pairs(rows: DataFrame, radius_arcsec: float, key: str) -> DataFrame:
    """a, b, sep_arcsec of all pairs a < b of one table within the radius."""
    slim = rows.select(key, "ra", "dec")
    met = pairs_within(slim, slim, radius_arcsec).where(F.col(f"l.{key}") < F.col(f"r.{key}"))
    return met.select(F.col(f"l.{key}").alias("a"), F.col(f"r.{key}").alias("b"), "sep_arcsec")


def cone_search(rows: DataFrame, ra: float, dec: float, radius_deg: float) -> DataFrame:
    """Rows within a cone; the declination band is a plain range that reaches the scan."""
    band = F.col("dec").between(dec - radius_deg, dec + radius_deg)
    sep = separation_arcsec(F.lit(float(ra)), F.lit(float(dec)), F.col("ra"), F.col("dec"))
    return rows.where(band).withColumn("sep_arcsec", sep).where(F.col("sep_arcsec") <= radius_deg * 3600.0)


def isolated(sources: DataFrame, key: str = "id", group: str = "frame", min_fwhm: float = 3.0) -> DataFrame:
    """Adds isolated: no other source of the frame within max(10, 3 median FWHM) pixels.

    An unusable FWHM counts as 4 pixels. Frames of fewer than two sources are isolated throughout.
    The threshold differs by frame, so cells are counted in units of it.
    """
    scale = sources.groupBy(group).agg(F.median("fwhm").alias("m")).select(group, F.greatest(F.lit(10.0), F.lit(min_fwhm) * F.when(F.col("m") > 0, F.col("m")).otherwise(4.0)).alias("reach"))
    placed = sources.select(group, key, "x", "y").where("x is not null and y is not null").join(scale, group).withColumns({"gx": F.floor(F.col("x") / F.col("reach")), "gy": F.floor(F.col("y") / F.col("reach"))})
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    other = placed.withColumn("s", F.explode(steps)).select(F.col(group).alias("g_"), F.col(key).alias("k_"), F.col("x").alias("x_"), F.col("y").alias("y_"), (F.col("gx") + F.col("s.i")).alias("gx_"), (F.col("gy") + F.col("s.j")).alias("gy_"))
    near = placed.join(other, (F.col(group) == F.col("g_")) & (F.col("gx") == F.col("gx_")) & (F.col("gy") == F.col("gy_")) & (F.col(key) != F.col("k_")) & (F.hypot(F.col("x") - F.col("x_"), F.col("y") - F.col("y_")) <= F.col("reach")))
    crowded = near.select(group, key).distinct().withColumn("crowded", F.lit(True))
    return sources.join(crowded, [group, key], "left").withColumn("isolated", F.col("crowded").isNull()).drop("crowded")

"""From detections to ranked candidates: clustering, tracklets, light curves, scores, ranks.

Relational steps are DataFrame expressions. Two greedy rules whose outcome depends on the order of
detections (constrained merging and track linking) run in Python over one connected component at a
time, so their groups are bounded by the density of the sky and not by the night.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.photometric import lightcurve_err
from ..functions.sky import position_angle_deg, separation_arcsec, wrap_deg
from . import tracklets
from .components import Workspace, connected_components
from .crossmatch import chord, flag_matched, in_cell, with_cell, with_neighbour_cells


#: Base rank of each kind, its default, and the texts of notes.
RANK_BASE = {"mover": 0.85, "transient": 0.8, "variable": 0.55, "single": 0.2, "known": 0.02}
RANK_OTHER = 0.1
NOTES = {
    "unmatched": "unmatched source; novelty flagging disabled",
    "transient": "stationary source with no catalog match, %d detections",
    "single": "single unmatched detection (low confidence)",
    "orphan": "single unmatched detection",
    "instrumental": "light curve in instrumental mags (calibration unavailable)",
    "variable": "variable: rms=%.3f mag, %d/%d epochs >4 sigma, reduced chi2=%.0f, amp=%.2f mag (%s mags)",
    "mover": "moving object: %.2f arcsec/min at PA %.0f deg, %d epochs linked",
}


@dataclass(frozen=True)
class Settings:
    """Discovery settings with their defaults."""

    enabled: bool = True
    match_radius_arcsec: float = 2.5
    flag_unmatched: bool = True
    moving_object_link: bool = True
    max_motion_arcsec_per_min: float = 60.0
    min_tracklet_points: int = 3
    variability: bool = True
    min_snr: float = 5.0
    top_n: int = 50


# ---- detections ------------------------------------------------------------------------------


def significant(sources: DataFrame, min_snr: float) -> DataFrame:
    """Sources at or above the threshold, unsaturated and with a position."""
    return sources.where((F.col("snr") >= min_snr) & ~F.col("flag_saturated") & F.col("ra").isNotNull() & F.col("dec").isNotNull())


def numbered(detections: DataFrame, *order: str, work: Workspace | None = None) -> DataFrame:
    """Adds det_idx, a dense index from 0 in the given order, which must be total.

    Rows are range-partitioned by the order, sorted and stored once with their partition and their
    place in it; the offsets are counted from the same stored rows (a row a partition), so that rows
    and offsets can't come from two different partitionings.
    """
    work = work or Workspace(detections.sparkSession)
    ranged = detections.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
    stored = work.put(ranged.withColumn("_at", F.monotonically_increasing_id()), f"numbered_{uuid.uuid4().hex[:8]}")
    part, place = F.shiftrightunsigned("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))  # the layout of that id
    counts = stored.groupBy(part.alias("_part")).agg(F.count("*").alias("n"))
    before = counts.select("_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("_before"))
    return stored.withColumn("_part", part).join(F.broadcast(before), "_part").withColumn("det_idx", F.col("_before") + place).drop("_part", "_at", "_before")


def as_detections(sources: DataFrame, reference: DataFrame | None, settings: Settings, order: tuple[str, ...] = ("frame_index", "id"), work: Workspace | None = None) -> DataFrame:
    """Significant sources with det_idx in catalogue order and matched_ref."""
    kept = significant(sources, settings.min_snr).withColumn("key_", F.struct(*order))
    return numbered(flag_matched(kept, reference, settings.match_radius_arcsec, "key_").drop("key_"), *order, work=work)


# ---- constrained clusters --------------------------------------------------------------------


PAIRS_A_GROUP = 20_000  # pairs of a component that one Python group takes
ROUNDS = 6  # of locally least pairs before the components are looked at again
FINISH = 200_000  # edges whose components one task may end
PAIRS_A_ROW = 1  # pairs a detection, about, that the first band of radii may have
PAIRS_AT_ONCE = 200_000  # pairs, about, that it may have in any case
BANDS = 16  # radii at most, each half the one before


def merge_nearest_first(frames: dict[int, set[int]], links: list[tuple[float, int, int, int, int]]) -> dict[int, int]:
    """Cluster of each start cluster: links (sep, a, b, x, y) between clusters x and y in order, never two detections of one frame together."""
    parent, epochs = {n: n for n in frames}, {n: set(f) for n, f in frames.items()}

    def root(n: int) -> int:
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for _, _, _, x, y in sorted(links):
        x, y = root(x), root(y)
        if x != y and epochs[x].isdisjoint(epochs[y]):
            lo, hi = min(x, y), max(x, y)
            parent[hi] = lo
            epochs[lo] |= epochs.pop(hi)
    return {n: root(n) for n in frames}


def _merged_in_groups(links: DataFrame, clusters: DataFrame, labels: DataFrame) -> DataFrame:
    """cluster, final of the clusters that links join, a Python group for each component (root of labels)."""
    none = lambda *names: [F.lit(None).cast("double" if n == "sep" else "long").alias(n) for n in names]
    held = labels.join(clusters, F.col("node") == F.col("cluster")).select("root", F.col("cluster").alias("x"), "frames", *none("y", "a", "b", "sep"))
    pairs = links.join(labels, F.col("x") == F.col("node")).select("root", "x", F.lit(None).cast("array<long>").alias("frames"), "y", "a", "b", "sep")

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        is_pair = group["y"].notna()
        own, pairs = group[~is_pair], group[is_pair]
        found = merge_nearest_first({int(x): {int(f) for f in fs} for x, fs in zip(own["x"], own["frames"], strict=True)}, [(s, int(a), int(b), int(x), int(y)) for s, a, b, x, y in zip(pairs["sep"], pairs["a"], pairs["b"], pairs["x"], pairs["y"], strict=True)])
        return pd.DataFrame({"cluster": list(found), "final": list(found.values())})

    return held.unionByName(pairs).groupBy("root").applyInPandas(solve, "cluster long, final long")


def _least_pairs(links: DataFrame, clusters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(links that may still merge, hi and lo of those that are the least of both their clusters).

    Such a link comes before every other one that touches its clusters, so nothing that the greedy
    order does earlier can change them: merging all of them at once gives what the order gives. A
    link whose clusters share a frame never merges later either.
    """
    of = lambda c: clusters.select(F.col("cluster").alias(c), F.col("frames").alias(f"f{c}"))
    live = links.where("x <> y").join(of("x"), "x").join(of("y"), "y").where(~F.arrays_overlap("fx", "fy")).select("a", "b", "sep", "x", "y")
    key = F.struct("sep", "a", "b")
    least = live.select(F.col("x").alias("c"), key.alias("k")).union(live.select("y", key)).groupBy("c").agg(F.min("k").alias("k"))
    first = lambda c: live.select("a", "b", "sep", "x", "y", key.alias("k")).join(least.select(F.col("c").alias(c), "k"), [c, "k"])
    picked = first("x").select("a", "b", "x", "y").join(first("y").select("a", "b"), ["a", "b"])
    return live, picked.select(F.greatest("x", "y").alias("hi"), F.least("x", "y").alias("lo"))


def _bands(detections: DataFrame, radius_arcsec: float) -> list[float]:
    """Rising radii up to the whole one, each twice the one before.

    The first is the largest with few pairs of detections of two frames, or about one a detection, or not many more
    than the least radius has, as where frames repeat their positions. Pairs are estimated from counts in cells.
    """
    radii = [radius_arcsec / 2.0**k for k in range(BANDS)]
    levels = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(chord(r)).alias("reach")) for k, r in enumerate(radii)])
    each = detections.select("frame_index", "ra", "dec", F.explode(levels).alias("g")).select("frame_index", "ra", "dec", "g.k", "g.reach")
    counts = in_cell(each, "ra", "dec", F.col("reach")).groupBy("k", "cx", "cy", "cz", "frame_index").agg(F.count("*").cast("double").alias("n"))
    cells = counts.groupBy("k", "cx", "cy", "cz").agg(F.sum("n").alias("n"), ((F.pow(F.sum("n"), F.lit(2.0)) - F.sum(F.col("n") * F.col("n"))) / 2.0).alias("pairs"))
    rows = cells.groupBy("k").agg(F.sum("n").alias("n"), F.sum("pairs").alias("pairs")).orderBy("k").collect()  # a row a radius
    few = [r["k"] for r in rows if r["pairs"] <= max(PAIRS_AT_ONCE, PAIRS_A_ROW * r["n"], 2 * rows[-1]["pairs"])]
    return radii[(few or [0])[0] :: -1]


def _links(members: DataFrame, above: float, radius_arcsec: float) -> DataFrame:
    """a, b, sep, x, y: the first pair, of those above one radius and within another, of clusters x and y that share no frame.

    Later pairs of the same two clusters change nothing: the first merges them, or they share a frame by then.
    Sets of frames meet before detections do, a row for each set in a cell, so that the detections of a cell whose
    clusters all share frames are not paired.
    """
    cells = ["cx", "cy", "cz"]
    side = lambda d, c: members.select(F.col("det_idx").alias(d), F.col("cluster").alias(c), F.col("frames").alias(f"f{c}"), F.col("ra").alias(f"ra_{c}"), F.col("dec").alias(f"dec_{c}"))
    left = with_cell(side("a", "x"), "ra_x", "dec_x", radius_arcsec)
    right = with_neighbour_cells(side("b", "y"), "ra_y", "dec_y", radius_arcsec)
    free = left.select(*cells, "fx").distinct().hint("merge").join(right.select(*cells, "fy").distinct(), cells).where(~F.arrays_overlap("fx", "fy"))
    # shuffled, as in seed_pairs
    met = left.hint("merge").join(free, [*cells, "fx"]).hint("merge").join(right, [*cells, "fy"]).where("a < b")
    met = met.withColumn("sep", separation_arcsec(F.col("ra_x"), F.col("dec_x"), F.col("ra_y"), F.col("dec_y"))).where((F.col("sep") > above) & (F.col("sep") <= radius_arcsec))
    first = met.groupBy(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).agg(F.min(F.struct("sep", "a", "b")).alias("k"))
    return first.select("k.a", "k.b", "k.sep", "x", "y")


def _merged(links: DataFrame, clusters: DataFrame, pairs_a_group: int, work: Workspace, tag: str) -> list[DataFrame]:
    """Tables of cluster, final, to be applied one after the other: what all links together merge."""
    moved, step = [], 0  # node, final: what each look or round has merged
    while True:
        labels = connected_components(links.select(F.col("x").alias("u"), F.col("y").alias("v")), work, f"cc_{tag}_{step}", finish=FINISH)
        rooted = links.join(labels, F.col("x") == F.col("node")).select("root")
        crowded = work.put(rooted.groupBy("root").agg(F.count("*").alias("n")).where(F.col("n") > pairs_a_group).select("root"), f"crowded_{tag}_{step}")
        some = not crowded.isEmpty()
        small = labels.join(crowded, "root", "left_anti") if some else labels
        solved = _merged_in_groups(links.join(small.select("node"), F.col("x") == F.col("node"), "left_semi") if some else links, clusters, small)
        moved.append(work.put(solved.where("cluster <> final"), f"solved_{tag}_{step}"))
        if not some:
            return moved
        links = links.join(labels.join(crowded, "root", "left_semi"), F.col("x") == F.col("node"), "left_semi")
        for k in range(ROUNDS):
            live, picked = _least_pairs(links, clusters)
            live, picked = work.put(live, f"live_{tag}_{step}_{k}"), work.put(picked, f"picked_{tag}_{step}_{k}")
            if picked.isEmpty():
                links = live
                break
            to = lambda c, picked=picked: picked.select(F.col("hi").alias(c), F.col("lo").alias(f"{c}_"))
            links = work.put(live.join(to("x"), "x", "left").join(to("y"), "y", "left").select("a", "b", "sep", F.coalesce("x_", "x").alias("x"), F.coalesce("y_", "y").alias("y")), f"links_{tag}_{step}_{k}")
            both = clusters.join(to("cluster"), "cluster", "left").groupBy(F.coalesce("cluster_", "cluster").alias("cluster"))
            clusters = work.put(both.agg(F.flatten(F.collect_list("frames")).alias("frames")), f"clusters_{tag}_{step}_{k}")
            moved.append(picked.select(F.col("hi").alias("cluster"), F.col("lo").alias("final")))
        links = work.put(_least_pairs(links, clusters)[0], f"links_{tag}_{step}")
        step += 1


def constrained_clusters(detections: DataFrame, radius_arcsec: float, pairs_a_group: int = PAIRS_A_GROUP, work: Workspace | None = None) -> DataFrame:
    """det_idx, cluster (the least det_idx of it): pairs merge nearest first, never two detections of one frame.

    Nearer pairs come first, so a crowded field is taken in bands of rising radius: a band pairs only detections
    whose clusters, as the bands before have left them, share no frame. All pairs within the radius, a number that
    grows with the square of the density, never stand side by side. In a band, components of at most
    ``pairs_a_group`` links are merged in a Python group each. Larger ones go through rounds that merge all
    locally least pairs at once, until what can still merge has fallen into small components.
    """
    work = work or Workspace(detections.sparkSession)
    placed = work.put(detections.select("det_idx", F.col("frame_index").cast("long").alias("frame_index"), "ra", "dec", F.col("det_idx").alias("cluster")), "placed")
    members, above = placed.withColumn("frames", F.array("frame_index")), -1.0
    for k, radius in enumerate(_bands(placed, radius_arcsec)):
        if k:
            frames = work.put(placed.groupBy("cluster").agg(F.array_sort(F.collect_set("frame_index")).alias("frames")), f"frames_{k}")
            members = placed.join(frames, "cluster")
        links = work.put(_links(members, above, radius), f"edges_{k}")
        above = radius
        if links.isEmpty():
            continue
        for to in _merged(links, members.select("cluster", "frames").distinct(), pairs_a_group, work, str(k)):
            placed = placed.join(to, "cluster", "left").withColumn("cluster", F.coalesce("final", "cluster")).drop("final")
        placed = work.put(placed, f"placed_{k}")
    return placed.select("det_idx", "cluster")


# ---- tracklets -------------------------------------------------------------------------------


def _gap_levels(orphans: DataFrame) -> list[float]:
    """The powers of two u for which frames lie d apart with u / 2 < d <= u."""
    times = np.sort([r["t"] for r in orphans.select(F.col("time_min").alias("t")).where("t is not null").distinct().collect()])  # a number a frame
    if len(times) < 2:
        return []
    level = lambda d: math.frexp(d)[1] - (math.frexp(d)[0] == 0.5)  # noqa: E731  a power of two is a level of its own
    every = [2.0**k for k in range(level(float(np.diff(times).min())), level(float(times[-1] - times[0])) + 1)]
    apart = lambda d: np.searchsorted(times, times + d * (1 + 1e-12), "right")
    return [u for u in every if (np.searchsorted(times, times + u / 2.0 * (1 - 1e-12), "right") < apart(u)).any()]


def seed_pairs(orphans: DataFrame, max_speed: float, work: Workspace | None = None) -> DataFrame:
    """a, b and the velocity of every pair of a later frame with 0 < speed <= max_speed.

    Only detections are shuffled, to the tiles of ``tracklets``; pairs are made there and go on as they come.
    """
    return tracklets.seeds(orphans, max_speed, _gap_levels(orphans), work or Workspace(orphans.sparkSession))


def first_matches(orphans: DataFrame, max_speed: float, tol_deg: float, work: Workspace | None = None) -> DataFrame:
    """``predicted_matches`` of all seeds; neither seeds nor predictions are stored or shuffled."""
    return tracklets.first_matches(orphans, max_speed, tol_deg, _gap_levels(orphans), work or Workspace(orphans.sparkSession))


def tracklet_points(orphans: DataFrame, max_speed: float, tol_deg: float, work: Workspace | None = None) -> DataFrame:
    """a, b, points: seeds with a match in some other frame, counted with a and b, where they are made."""
    return tracklets.points(orphans, max_speed, tol_deg, _gap_levels(orphans), work or Workspace(orphans.sparkSession))


def predicted_matches(seeds: DataFrame, orphans: DataFrame, tol_deg: float, work: Workspace | None = None) -> DataFrame:
    """a, b, frame_c, c: for each seed and other frame the first detection inside the predicted box.

    Frames are taken in blocks of time, about the root of their number. A seed is followed through a block
    only if some detection of it lies as near to the position predicted for its middle as a match could;
    a few seeds so fast that the cells of this look are too small for them are followed in any case.
    ``seeds`` are read twice: give a stored table.
    """
    work = work or Workspace(orphans.sparkSession)
    start = orphans.select(F.col("det_idx").alias("a"), F.col("time_min").alias("t0"), F.col("ra").alias("ra0"), F.col("dec").alias("dec0"))
    other = orphans.select(F.col("det_idx").alias("c"), F.col("frame_index").alias("frame_c"), F.col("time_min").alias("tc"), F.col("ra").alias("rac"), F.col("dec").alias("decc"))
    times = orphans.select(F.col("frame_index").alias("frame_c"), F.col("time_min").alias("tf")).where("time_min is not null").distinct()
    first, last, n = times.agg(F.min("tf"), F.max("tf"), F.count("*")).head()
    length = (last - first) / math.sqrt(n) if n > 1 and last > first else 1.0
    block = lambda t: F.floor((F.col(t) - F.lit(first or 0.0)) / length)
    times = times.withColumn("block", block("tf"))
    off = F.hypot("v_ra", "v_dec") * (length / 2.0) + 1.5 * tol_deg  # degrees that a match may lie away from the middle's position
    typical = seeds.agg(F.percentile_approx(off, 0.9)).head()[0] or 1.0
    reach = min(typical * 1.01, 180.0) * 3600.0
    occupied = with_neighbour_cells(other.withColumn("block", block("tc")), "rac", "decc", reach).select("block", "cx", "cy", "cz").distinct()
    occupied = work.put(occupied, f"occupied_{uuid.uuid4().hex[:8]}").withColumn("hit", F.lit(True))  # stored: its size is known then
    middle = times.select("block", (F.lit(first or 0.0) + (F.col("block") + 0.5) * length).alias("tm")).distinct()
    through = seeds.join(start.hint("merge"), "a").crossJoin(F.broadcast(middle))  # a row a block
    through = through.withColumns({"off": off, "m_ra": F.col("ra0") + F.col("v_ra") * (F.col("tm") - F.col("t0")), "m_dec": F.col("dec0") + F.col("v_dec") * (F.col("tm") - F.col("t0"))})
    looked = with_cell(through, "m_ra", "m_dec", reach).join(occupied, ["block", "cx", "cy", "cz"], "left")
    followed = looked.where(F.col("hit") | (F.col("off") * 3600.0 > reach)).select(*through.columns)
    ahead = followed.join(F.broadcast(times), "block").where((F.col("frame_c") != F.col("frame_a")) & (F.col("frame_c") != F.col("frame_b")))
    dt = F.col("tf") - F.col("t0")
    placed = ahead.withColumns({"p_ra": F.col("ra0") + F.col("v_ra") * dt, "p_dec": F.col("dec0") + F.col("v_dec") * dt})
    # a box of half side tol lies within tol * sqrt(2); detections are fewer than predictions and take the 27 cells
    reach = tol_deg * 3600.0 * 1.5
    cells = ["frame_c", "cx", "cy", "cz"]
    near = with_cell(placed, "p_ra", "p_dec", reach).join(with_neighbour_cells(other, "rac", "decc", reach).hint("merge"), cells).where(F.col("tc") == F.col("tf"))
    inside = (F.abs(wrap_deg(F.col("rac") - F.col("p_ra"))) * F.cos(F.radians("decc")) < tol_deg) & (F.abs(F.col("decc") - F.col("p_dec")) < tol_deg)
    return near.where(inside).groupBy("a", "b", "frame_c").agg(F.min("c").alias("c"))


def link_movers(orphans: DataFrame, settings: Settings, work: Workspace | None = None) -> DataFrame:
    """track (its seed's order), pos, det_idx. Components of what seeds and their boxes hold are resolved apart.

    Neither seeds nor matches are stored: a tile gives edges no more than its detections, and a component makes its
    seeds again while it is resolved, those of detections that are still free.
    """
    tol, speed, least = settings.match_radius_arcsec * 2.5 / 3600.0, settings.max_motion_arcsec_per_min, settings.min_tracklet_points
    work = work or Workspace(orphans.sparkSession)
    edges = work.put(tracklets.links(orphans, speed, tol, least, _gap_levels(orphans), work), "links")
    labels = connected_components(edges, work, "linked", finish=FINISH)
    spot = [F.col(c).cast("double").alias(c) for c in ("time_min", "ra", "dec")]
    members = orphans.join(labels, F.col("det_idx") == F.col("node")).select("root", F.col("det_idx").cast("long").alias("det_idx"), F.col("frame_index").cast("long").alias("frame_index"), *spot)

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        tracks = tracklets.greedy_tracks(*[group[c].to_numpy() for c in tracklets.SPOT], speed, tol, least)
        rows = [(min(t), k, d) for t in tracks for k, d in enumerate(t)]
        return pd.DataFrame(rows, columns=["track", "pos", "det_idx"]).astype("int64")

    return members.groupBy("root").applyInPandas(solve, "track long, pos long, det_idx long")


# ---- light curves and variability ------------------------------------------------------------


def selected_epochs(points: DataFrame, key: str) -> DataFrame:
    """key, mag, err, system, n_det: calibrated magnitudes where an object has three, else instrumental ones."""
    own = Window.partitionBy(key)
    n_calib = F.count("mag_calib").over(own)
    system = F.when(n_calib >= 3, "calibrated").otherwise("instrumental")
    mag = F.when(n_calib >= 3, F.col("mag_calib")).otherwise(F.col("mag_inst"))
    out = points.select(key, mag.alias("mag"), lightcurve_err(F.col("mag_err"), F.col("snr")).alias("err"), system.alias("system"), F.count("*").over(own).alias("n_det"))
    return out.where("mag is not null")


def lightcurve_stats(epochs: DataFrame, key: str) -> DataFrame:
    """key, n, var_chi2, amplitude, mean_mag, mag_rms; statistics are null below three epochs.

    The weighted chi-square is taken about each object's weighted mean, in two passes over one
    partitioning.
    """
    w = F.lit(1.0) / (F.col("err") * F.col("err"))
    mean = F.sum(F.col("mag") * w).over(Window.partitionBy(key)) / F.sum(w).over(Window.partitionBy(key))
    per = epochs.withColumn("wmean", mean)
    n = F.count("*")
    few = lambda c: F.when(n >= 3, c)
    return per.groupBy(key).agg(
        n.alias("n"),
        F.first("system").alias("system"),
        few(F.try_divide(F.sum(F.pow((F.col("mag") - F.col("wmean")) / F.col("err"), F.lit(2.0))), (n - 1).cast("double"))).alias("var_chi2"),
        few(F.max("mag") - F.min("mag")).alias("amplitude"),
        few(F.avg("mag")).alias("mean_mag"),
        few(F.stddev_samp("mag")).alias("mag_rms"),
    )


def noise_floor(stats: DataFrame, *ensemble: Column) -> DataFrame:
    """sys_floor, the median scatter of the ensemble held between 0.005 and 0.03: one row, or one for each of several ensembles."""
    return stats.groupBy(*ensemble).agg(F.least(F.greatest(F.median("mag_rms"), F.lit(0.005)), F.lit(0.03)).alias("sys_floor"))


def ensemble_variability(epochs: DataFrame, stats: DataFrame, key: str, ensemble: Column | None = None) -> DataFrame:
    """Deviation statistics and the decision of each candidate object (three detections and finite scatter).

    ``ensemble``, an expression of the key, names the group of objects whose scatter an object is held
    against; by default that is all of them.
    """
    dets = epochs.groupBy(key).agg(F.first("n_det").alias("n_det"))
    cands = stats.join(dets, key).where("n_det >= 3 and mean_mag is not null and mag_rms is not null")
    med = epochs.groupBy(key).agg(F.median("mag").alias("med"))
    dev = F.abs(F.col("mag") - F.col("med")) / F.sqrt(F.col("err") * F.col("err") + F.col("sys_floor") * F.col("sys_floor"))
    held = epochs.drop("n_det").join(med, key)
    if ensemble is None:
        held = held.crossJoin(F.broadcast(noise_floor(cands)))
    else:
        held = held.withColumn("ensemble_", ensemble).join(noise_floor(cands, ensemble.alias("ensemble_")), "ensemble_")
    per = held.withColumn("dev", dev).groupBy(key).agg(F.sum(F.when(F.col("dev") > 4.0, 1).otherwise(0)).cast("long").alias("n_sig"), F.avg(F.col("dev") * F.col("dev")).alias("red_chi2"), F.first("sys_floor").alias("sys_floor"))
    decided = (F.col("n_sig") >= F.greatest(F.lit(2), F.expr("n_det div 2"))) & (F.col("red_chi2") > 10.0) & (F.col("amplitude") > 0.1) & (F.col("mag_rms") > F.lit(2.5) * F.col("sys_floor"))
    return cands.join(per, key).withColumn("significance", F.sqrt(F.greatest("red_chi2", F.lit(0.0)))).withColumn("is_variable", decided)


# ---- scores and ranks ------------------------------------------------------------------------


def strict(agg: Column, column: str) -> Column:
    """An aggregate that is null as soon as one value is (a NaN would spoil it in the same way)."""
    return F.when(F.count("*") == F.count(column), agg)


def circular_median_ra(first_ra: Column, ra: Column) -> Column:
    """Median right ascension about the first one, safe across 0/360."""
    return F.pmod(first_ra + F.median(wrap_deg(ra - first_ra)), F.lit(360.0))


def real_bogus(fwhm: Column, ellipticity: Column, snr: Column, edge: Column, n: Column, median_fwhm: Column, is_mover: Column) -> Column:
    ratio = F.try_divide(fwhm, F.nullif(median_fwhm, F.lit(0.0)))
    sharp = F.when(ratio < 0.55, 0.15).when(ratio < 0.75, 0.6).otherwise(1.0)
    long_ = F.when((ellipticity > 0.6) & ~is_mover, 0.5).otherwise(1.0)
    faint, at_edge = F.when(snr < 5, 0.5).otherwise(1.0), F.when(edge, 0.7).otherwise(1.0)
    score = sharp * long_ * faint * at_edge * F.least(F.lit(1.0), F.lit(0.5) + F.lit(0.25) * n)
    return F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0))


def composite_rank(kind: Column, mean_snr: Column, n_det: Column, rb: Column, significance: Column) -> Column:
    base = F.coalesce(*[F.when(kind == k, F.lit(v)) for k, v in RANK_BASE.items()], F.lit(RANK_OTHER))
    score = base * (F.lit(0.4) + F.lit(0.3) * (F.lit(1.0) - F.exp(-mean_snr / 20.0)) + F.lit(0.3) * F.least(F.lit(1.0), n_det / 4.0)) * (F.lit(0.4) + F.lit(0.6) * rb)
    boosted = F.when((kind == "variable") & significance.isNotNull(), score * F.least(F.lit(1.3), F.lit(1.0) + significance / 30.0)).otherwise(score)
    return F.least(F.greatest(boosted, F.lit(0.0)), F.lit(1.0))


def discover(sources: DataFrame, reference: DataFrame | None, settings: Settings, frame_fwhm: DataFrame | None = None) -> DataFrame:
    """Objects of a sequence of source tables, ranked: obj_id, kind, rank_score, members and their evidence.

    ``sources`` needs frame_index, id, time_min, ra, dec, snr, fwhm, ellipticity, flag_edge,
    flag_saturated, mag_inst, mag_calib and mag_err; ``frame_fwhm`` (median_fwhm per frame)
    defaults to the medians of the sources. An empty frame is returned when discovery is off.
    """
    if not settings.enabled:
        sources = sources.limit(0)
    work = Workspace(sources.sparkSession)
    dets = as_detections(sources, reference, settings, work=work)
    per_frame = frame_fwhm if frame_fwhm is not None else sources.groupBy("frame_index").agg(F.median("fwhm").alias("median_fwhm"))
    typical = F.broadcast(per_frame.agg(F.median("median_fwhm").alias("typical_fwhm")))
    dets = dets.join(constrained_clusters(dets, settings.match_radius_arcsec, work=work), "det_idx").crossJoin(typical)
    size = Window.partitionBy("cluster")
    dets = work.put(dets.withColumn("orphan", (F.count("*").over(size) == 1) & ~F.col("matched_ref") & F.lit(settings.moving_object_link)), "clustered")
    fixed = work.put(_scored(dets.where("not orphan"), "cluster", False), "fixed")
    kind = F.when(F.col("matched_reference"), "known").when(F.lit(not settings.flag_unmatched), "known").when(F.col("n_det") >= 2, "transient").otherwise("single")
    note = F.when(F.col("matched_reference"), F.lit("")).when(F.lit(not settings.flag_unmatched), NOTES["unmatched"]).when(F.col("n_det") >= 2, F.format_string(NOTES["transient"], F.col("n_det"))).otherwise(NOTES["single"])
    fixed = fixed.withColumns({"kind": kind, "notes": note, "class": F.lit(0), "speed": F.lit(None).cast("double"), "pa": F.lit(None).cast("double")})
    known = dets.where("not orphan").join(fixed.where("matched_reference").select("cluster"), "cluster", "left_semi")
    epochs = work.put(selected_epochs(known, "cluster"), "epochs")
    stats = work.put(lightcurve_stats(epochs, "cluster"), "stats")
    judged = ensemble_variability(epochs, stats, "cluster").select("cluster", "red_chi2", "significance", "is_variable", "n_sig")
    if not settings.variability:
        judged = judged.limit(0)
    fixed = fixed.join(stats.drop("n"), "cluster", "left").join(judged, "cluster", "left")
    text = F.format_string(NOTES["variable"], "mag_rms", "n_sig", "n_det", "red_chi2", "amplitude", "system")
    dim = (F.col("system") == "instrumental") & F.col("mean_mag").isNotNull()
    fixed = fixed.withColumns(
        {
            "kind": F.when(F.coalesce("is_variable", F.lit(False)), "variable").otherwise(F.col("kind")),
            "notes": F.when(F.coalesce("is_variable", F.lit(False)), text).when(dim, NOTES["instrumental"]).otherwise(F.col("notes")),
            "var_chi2": F.coalesce("red_chi2", "var_chi2"),
        }
    )
    parts = [fixed]
    if settings.moving_object_link:
        orphans = dets.where("orphan")
        tracks = work.put(link_movers(orphans, settings, work), "tracks")
        linked = orphans.join(tracks, "det_idx")
        ends = linked.groupBy("track").agg(*[f(c, "pos").alias(f"{n}_{c}") for n, f in (("a", F.min_by), ("z", F.max_by)) for c in ("ra", "dec", "time_min")])
        movers = _scored(linked, "track", True).join(ends, "track")
        sep = separation_arcsec(F.col("a_ra"), F.col("a_dec"), F.col("z_ra"), F.col("z_dec"))
        movers = movers.withColumns({"speed": F.try_divide(sep, F.col("z_time_min") - F.col("a_time_min")), "pa": position_angle_deg(F.col("a_ra"), F.col("a_dec"), F.col("z_ra"), F.col("z_dec"))})
        movers = movers.withColumns({"kind": F.lit("mover"), "class": F.lit(1), "notes": F.format_string(NOTES["mover"], "speed", "pa", "n_det")})
        left = _scored(orphans.join(tracks, "det_idx", "left_anti").withColumn("lone", F.col("det_idx")), "lone", False)
        lone = F.when(F.lit(settings.flag_unmatched), "single").otherwise("known")
        left = left.withColumns({"kind": lone, "class": F.lit(2), "notes": F.when(F.lit(settings.flag_unmatched), NOTES["orphan"]).otherwise(NOTES["unmatched"])})
        parts += [movers.drop(*[c for c in movers.columns if c[:2] in ("a_", "z_")]).withColumnRenamed("track", "cluster"), left.withColumnRenamed("lone", "cluster")]
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p, allowMissingColumns=True)
    rank = composite_rank(F.col("kind"), F.col("mean_snr"), F.col("n_det"), F.col("rb_score"), F.when(F.col("kind") == "variable", F.col("significance")))
    ordered = numbered(work.put(merged.withColumn("rank_score", rank), "objects"), "class", "first_det").withColumnRenamed("det_idx", "obj_id")
    work.clear()  # the numbered objects are stored
    return ordered.drop("class", "is_variable", "red_chi2", "n_sig")


def _scored(members: DataFrame, key: str, mover: bool) -> DataFrame:
    """key, position, counts, mean S/N, real/bogus score, frames and members of detections grouped by ``key``."""
    first = members.groupBy(key).agg(F.min_by("ra", "det_idx").alias("ra0"))
    grouped = members.join(first, key).groupBy(key, "ra0").agg(
        F.median(wrap_deg(F.col("ra") - F.col("ra0"))).alias("dra"),
        F.median("dec").alias("dec"),
        F.count("*").alias("n_det"),
        strict(F.avg("snr"), "snr").alias("mean_snr"),
        strict(F.median("fwhm"), "fwhm").alias("fwhm"),
        strict(F.median("ellipticity"), "ellipticity").alias("ellipticity"),
        F.bool_or(F.coalesce("flag_edge", F.lit(False))).alias("edge"),
        F.bool_or("matched_ref").alias("matched_reference"),
        F.min("det_idx").alias("first_det"),
        F.first("typical_fwhm").alias("typical_fwhm"),
        F.array_join(F.transform(F.array_sort(F.collect_set("frame_index")), lambda x: x.cast("string")), ",").alias("frames"),
        F.array_sort(F.collect_list(F.struct("frame_index", "id", "det_idx"))).alias("members"),
    )
    rb = real_bogus(F.col("fwhm"), F.col("ellipticity"), F.col("mean_snr"), F.col("edge"), F.col("n_det"), F.col("typical_fwhm"), F.lit(mover))
    return grouped.withColumns({"ra": F.pmod(F.col("ra0") + F.col("dra"), F.lit(360.0)), "rb_score": rb}).drop("ra0", "dra", "fwhm", "ellipticity", "edge", "typical_fwhm")


def candidates(objects: DataFrame, top_n: int | None = None) -> DataFrame:
    """The ranked, rounded candidate table; ties by obj_id."""
    table = objects.select(
        "obj_id",
        "kind",
        F.round("rank_score", 4).alias("rank_score"),
        F.round("ra", 6).alias("ra"),
        F.round("dec", 6).alias("dec"),
        "n_det",
        "frames",
        F.round("mean_snr", 1).alias("mean_snr"),
        F.round("rb_score", 3).alias("rb_score"),
        F.when(F.col("kind") == "mover", F.round("speed", 3)).alias("motion_arcsec_min"),
        F.when(F.col("kind") == "mover", F.round("pa", 1)).alias("motion_pa_deg"),
        F.round("var_chi2", 2).alias("var_chi2"),
        F.round("amplitude", 3).alias("var_amp_mag"),
        "notes",
        F.col("rank_score").alias("_rank"),
    ).orderBy(F.desc("_rank"), "obj_id")
    return (table.limit(top_n) if top_n else table).drop("_rank")

"""Seeds of moving objects and what they meet in other frames, a small piece of one frame at a time.

Detections of a frame are cut into tiles of the sphere. A tile gets the detections of other frames that lie
as near as something moving with the greatest speed could be at their time, so that every seed that begins in
the tile, and every detection that the seed predicts, is there. Only detections are shuffled: seeds and
matches, whose number grows with the square of the density, come into being in the tasks, some at a time.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sky import unit_vector
from .components import Workspace
from .crossmatch import chord

TURN = 1024.0  # keys of neighbouring strips lie further apart than right ascensions
AT_ONCE = 1 << 20  # pairs that a task holds
EDGE = 32  # edge of a tile, in reaches of the shortest gap
TILE = ["frame_index", "time_min", "tx", "ty", "tz"]
SPOT = ["det_idx", "frame_index", "time_min", "ra", "dec"]


def wrap(d: np.ndarray) -> np.ndarray:
    turned = d + 180.0
    return turned - 360.0 * np.floor(turned / 360.0) - 180.0


def separation(d_ra: np.ndarray, s1: np.ndarray, c1: np.ndarray, s2: np.ndarray, c2: np.ndarray) -> np.ndarray:
    """Arcseconds, as ``functions.sky.separation_arcsec``, from sines and cosines of the declinations."""
    da = np.radians(d_ra)
    ca = np.cos(da)
    return np.degrees(np.arctan2(np.hypot(c2 * np.sin(da), c1 * s2 - s1 * c2 * ca), s1 * s2 + c1 * c2 * ca)) * 3600.0


class Strips:
    """Positions in strips of declination, sorted by right ascension within each; windows of them are found by halving."""

    def __init__(self, ra: np.ndarray, dec: np.ndarray, height: float):
        self.height = min(max(height, 1e-6), 180.0)
        self.about = float(ra[0])
        strip = np.floor((dec + 90.0) / self.height)
        self.strips = np.unique(strip)
        key = np.searchsorted(self.strips, strip) * TURN + wrap(ra - self.about)
        self.order = np.argsort(key, kind="stable")
        self.key = key[self.order]
        self.slack = 1e-7 + 4.0 * float(np.spacing(len(self.strips) * TURN))
        edges = [np.cos(np.radians(np.clip((self.strips + k) * self.height - 90.0, -90.0, 90.0))) for k in (0, 1)]
        self.cos = np.maximum(np.minimum(*edges), 0.0)  # the least of a strip

    def windows(self, ra: np.ndarray, dec: np.ndarray, half: float, wide: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[np.ndarray, ...]]:
        """Rows of the asked positions with runs of ``order``, strips and middles of the keys: all spots within ``half`` in declination and ``wide`` (of rows and least cosines) in right ascension, and some more."""
        rel = wrap(ra - self.about)
        low, high = (np.floor((dec + 90.0 + s * (half + 1e-9)) / self.height) for s in (-1, 1))
        for k in range(int((high - low).max()) + 1 if len(ra) else 0):
            at = np.minimum(np.searchsorted(self.strips, low + k), len(self.strips) - 1)
            rows = np.flatnonzero((self.strips[at] == low + k) & (low + k <= high))
            if not len(rows):
                continue
            at, p = at[rows], rel[rows]
            w = np.minimum(wide(rows, self.cos[at]) * (1 + 1e-9) + self.slack, 180.0)
            for turn, there in ((0.0, None), (360.0, (p - w < -180.0) & (w < 180.0)), (-360.0, (p + w >= 180.0) & (w < 180.0))):
                if there is None:
                    r, a, q, v = rows, at, p, w
                elif there.any():
                    r, a, q, v = rows[there], at[there], p[there] + turn, w[there]
                else:
                    continue
                whole = v >= 180.0
                begin = np.searchsorted(self.key, a * TURN + np.where(whole, -181.0, q - v), "left")
                end = np.searchsorted(self.key, a * TURN + np.where(whole, 181.0, q + v), "right")
                some = np.flatnonzero(end > begin)
                if len(some):
                    yield r[some], begin[some], end[some], a[some], a[some] * TURN + q[some]

    def ranges(self, tol: float, dec: np.ndarray, cos: np.ndarray, numbers: np.ndarray) -> None:
        """Prepares ``sure``: what holds for all spots of a strip, and the least number of every 1, 2, 4, ... in a row."""
        d, c = dec[self.order], cos[self.order]
        first = np.searchsorted(self.key, np.arange(len(self.strips)) * TURN - TURN / 2.0)
        self.low, self.high = np.maximum.reduceat(d, first) - tol + 1e-9, np.minimum.reduceat(d, first) + tol - 1e-9
        self.inner = tol / np.maximum(np.maximum.reduceat(c, first), 1e-300) * (1 - 1e-9) - self.slack
        table = [numbers[self.order]]
        while (step := 1 << (len(table) - 1)) * 2 <= len(d):
            last = table[-1]
            table.append(np.concatenate([np.minimum(last[:-step], last[step:]), last[len(last) - step :]]))
        self.table = np.stack(table)

    def sure(self, dec: np.ndarray, begin: np.ndarray, end: np.ndarray, strip: np.ndarray, middle: np.ndarray) -> np.ndarray:
        """Runs all of whose spots lie in the box about a position, told by its strip and by the first and last of them."""
        w = self.inner[strip]
        return (dec > self.low[strip]) & (dec < self.high[strip]) & (self.key[begin] >= middle - w) & (self.key[end - 1] <= middle + w)

    def least(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        k = np.frexp(end - begin)[1] - 1
        return np.minimum(self.table[k, begin], self.table[k, end - (1 << k)])


def parts(rows: np.ndarray, begin: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs written out, about ``AT_ONCE`` places at a time: rows, how many places each has, where they start, the places."""
    n = end - begin
    upto = np.cumsum(n)
    i = 0
    while i < len(rows):
        j = max(int(np.searchsorted(upto, (upto[i - 1] if i else 0) + AT_ONCE, "right")), i + 1)
        m = n[i:j]
        starts = np.cumsum(m) - m
        yield rows[i:j], m, starts, np.repeat(begin[i:j] - starts, m) + np.arange(int(m.sum()))
        i = j


def near_pairs(here: dict[str, np.ndarray], there: dict[str, np.ndarray], dt: float, max_speed: float, held: dict | None = None, key: object = None) -> Iterator[tuple[np.ndarray, ...]]:
    """Rows of both sides with speed and differences of ra and dec, where 0 < speed <= max_speed; strips of ``there`` are kept in ``held`` under ``key``."""
    a_ra, a_dec, a_sin, a_cos = (here[c] for c in ("ra", "dec", "sin", "cos"))
    b_ra, b_dec, b_sin, b_cos = (there[c] for c in ("ra", "dec", "sin", "cos"))
    half = min(max_speed * dt / 3600.0, 180.0) * (1 + 1e-9) + 1e-9
    sine = math.sin(math.radians(half) / 2.0)
    held = {} if held is None else held
    if key not in held:
        held[key] = Strips(b_ra, b_dec, 2.0 * half)
    spots = held[key]

    def wide(rows: np.ndarray, cos: np.ndarray) -> np.ndarray:
        across = np.sqrt(np.maximum(a_cos[rows], 0.0) * cos)
        return np.where(across > sine, np.degrees(2.0 * np.arcsin(sine / np.maximum(across, sine))), 180.0)

    for q, begin, end, _, _ in spots.windows(a_ra, a_dec, half, wide):
        for r, m, _, places in parts(q, begin, end):
            a, b = np.repeat(r, m), spots.order[places]
            near = np.flatnonzero(np.abs(b_dec[b] - a_dec[a]) <= half)
            a, b = a[near], b[near]
            d_ra, d_dec = b_ra[b] - a_ra[a], b_dec[b] - a_dec[a]
            speed = separation(d_ra, a_sin[a], a_cos[a], b_sin[b], b_cos[b]) / dt
            ok = np.flatnonzero((speed > 0) & (speed <= max_speed))
            if len(ok):
                yield a[ok], b[ok], speed[ok], d_ra[ok], d_dec[ok]


class Piece:
    """The detections of a tile and those around it; ``groups`` are their frames: number, time and rows of the others."""

    def __init__(self, rows: dict[str, np.ndarray], tol_deg: float):
        own, other = rows["own"], ~rows["own"]
        self.own = {c: rows[c][own] for c in ("det_idx", "ra", "dec")}
        self.frame, self.time = int(rows["frame_index"][own][0]), float(rows["time_min"][own][0])
        order = np.lexsort((rows["det_idx"][other], rows["time_min"][other], rows["frame_index"][other]))
        self.other = {c: rows[c][other][order] for c in SPOT}
        for spots in (self.own, self.other):
            spots["sin"], spots["cos"] = np.sin(np.radians(spots["dec"])), np.cos(np.radians(spots["dec"]))
        frame, time = self.other["frame_index"], self.other["time_min"]
        cuts = np.flatnonzero((np.diff(frame) != 0) | (np.diff(time) != 0)) + 1
        ends = [0, *cuts.tolist(), len(frame)] if len(frame) else [0]
        self.groups = [(int(frame[i]), float(time[i]), i, j) for i, j in zip(ends[:-1], ends[1:], strict=True)]
        self.tol = tol_deg
        self.strips: dict[int, Strips] = {}

    def seeds(self, max_speed: float) -> Iterator[tuple[np.ndarray, ...]]:
        """Rows of a and b with speed, v_ra and v_dec: partners of later frames with 0 < speed <= max_speed."""
        for frame, time, i, j in self.groups:
            dt = time - self.time
            if frame <= self.frame or dt <= 0:
                continue
            there = {c: self.other[c][i:j] for c in ("ra", "dec", "sin", "cos")}
            for a, b, speed, d_ra, d_dec in near_pairs(self.own, there, dt, max_speed):
                yield a, b + i, speed, wrap(d_ra) / dt, d_dec / dt

    def chunks(self, max_speed: float) -> Iterator[tuple[np.ndarray, ...]]:
        """The seeds of all frames, about ``AT_ONCE`` together."""
        held, n = [], 0
        for s in self.seeds(max_speed):
            held.append(s)
            n += len(s[0])
            if n >= AT_ONCE:
                yield tuple(np.concatenate(c) for c in zip(*held, strict=True))
                held, n = [], 0
        if held:
            yield tuple(np.concatenate(c) for c in zip(*held, strict=True))

    def boxes(self, g: int, rows: np.ndarray, a: np.ndarray, v_ra: np.ndarray, v_dec: np.ndarray, at_once: bool = False, runs_only: bool = False) -> Iterator[tuple[np.ndarray, ...]]:
        """Of group ``g``: rows of seeds, starts of their runs, rows of the others, whether each lies in the predicted box.

        Where a whole run is known to lie in the box, ``at_once`` gives rows of seeds and the least det_idx instead,
        ``runs_only`` rows of seeds and the run in the order of the group's strips.
        """
        _, time, i, j = self.groups[g]
        ra, dec, cos = (self.other[c][i:j] for c in ("ra", "dec", "cos"))
        if g not in self.strips:
            self.strips[g] = Strips(ra, dec, 2.0 * self.tol)
            self.strips[g].ranges(self.tol, dec, cos, self.other["det_idx"][i:j])
        spots = self.strips[g]
        dt = time - self.time
        p_ra = self.own["ra"][a[rows]] + v_ra[rows] * dt
        p_dec = self.own["dec"][a[rows]] + v_dec[rows] * dt
        wide = lambda _, least: np.where(least * 180.0 > self.tol, self.tol / np.maximum(least, self.tol / 180.0), 180.0)
        for q, begin, end, strip, middle in spots.windows(p_ra, p_dec, self.tol, wide):
            if at_once or runs_only:
                sure = spots.sure(p_dec[q], begin, end, strip, middle)
                yield (rows[q[sure]], spots.least(begin[sure], end[sure])) if at_once else (rows[q[sure]], begin[sure], end[sure])
                q, begin, end = q[~sure], begin[~sure], end[~sure]
            for r, m, starts, places in parts(q, begin, end):
                c = spots.order[places]
                each = np.repeat(r, m)
                inside = (np.abs(wrap(ra[c] - p_ra[each])) * cos[c] < self.tol) & (np.abs(dec[c] - p_dec[each]) < self.tol)
                yield rows[r], starts, c + i, inside

    def matches(self, seeds: tuple[np.ndarray, ...]) -> Iterator[tuple[int, np.ndarray]]:
        """Each other frame with the least det_idx in the box of every seed, -1 where there is none."""
        a, b, _, v_ra, v_dec = seeds
        frame_b, none = self.other["frame_index"][b], np.iinfo(np.int64).max
        at = 0
        while at < len(self.groups):
            frame = self.groups[at][0]
            first = np.full(len(a), none)
            rows = None
            while at < len(self.groups) and self.groups[at][0] == frame:
                if frame != self.frame:
                    rows = np.flatnonzero(frame_b != frame) if rows is None else rows
                    for r, *found in self.boxes(at, rows, a, v_ra, v_dec, at_once=True):
                        if len(found) > 1:
                            starts, c, inside = found
                            found = [np.minimum.reduceat(np.where(inside, self.other["det_idx"][c], none), starts)]
                        first[r] = np.minimum(first[r], found[0])
                at += 1
            yield frame, np.where(first == none, -1, first)


def _piece(batches: list[pa.RecordBatch], tol_deg: float) -> Piece:
    table = pa.Table.from_batches(batches)
    return Piece({c: table.column(c).to_numpy() for c in [*SPOT, "own"]}, tol_deg)


def _batches(columns: dict[str, np.ndarray], most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    n = len(next(iter(columns.values())))
    for i in range(0, n, most):
        yield pa.RecordBatch.from_pydict({k: v[i : i + most] for k, v in columns.items()})


def _bucket(time: Column, u: Column) -> Column:
    return F.when(u == 0, time).otherwise(F.floor(time / (u / 2.0)).cast("double"))


def pieces(orphans: DataFrame, max_speed: float, tol_deg: float, levels: list[float], work: Workspace, later: bool = False) -> DataFrame:
    """Rows of tiles (``TILE`` as t_..) with their own detections and those of other frames that their seeds may meet.

    ``levels`` are the powers of two that time gaps fall under; ``later`` leaves out what lies before a tile, for
    seeds alone. A prediction is linear in right ascension, so a tile near a pole reaches further than the speed:
    the greatest velocity in right ascension follows from the declinations that a seed may touch.
    """
    shortest = min(levels, default=1.0)
    edge = min(EDGE * chord(max_speed * shortest + 2 * 3600.0 * tol_deg), 1.0)
    spots = orphans.select(F.col("det_idx").cast("long").alias("det_idx"), F.col("frame_index").cast("long").alias("frame_index"), *[F.col(c).cast("double").alias(c) for c in ("time_min", "ra", "dec")]).where(" and ".join(f"{c} is not null" for c in SPOT))
    cells = {t: F.floor(v / edge).cast("long") for t, v in zip(("tx", "ty", "tz"), unit_vector(F.col("ra"), F.col("dec")), strict=True)}
    placed = work.put(spots.withColumns(cells), "placed")
    round_ = edge * math.sqrt(3.0) / 2.0  # from the middle of a cell to its corner
    tiles = placed.groupBy(*TILE).agg(F.max(F.abs("dec")).alias("far"), F.min(F.abs("dec")).alias("near"))

    moved = lambda u: min(max_speed * u / 3600.0, 180.0)  # noqa: E731  degrees
    cos = lambda d: F.cos(F.radians(F.least(F.greatest(d, F.lit(0.0)), F.lit(90.0))))
    rates = []
    for u in levels:
        across = F.sqrt(cos(F.col("far")) * cos(F.col("far") + moved(u)))
        sine = math.sin(math.radians(moved(u)) / 2.0)
        rates.append(F.when(across > sine, F.degrees(2.0 * F.asin(F.lit(sine) / across)) / u).otherwise(360.0 / u))
    rate = F.greatest(*rates, F.lit(0.0), F.lit(0.0))

    def reach(u: float) -> Column:
        turned = F.sin(F.radians(F.least(F.col("rate") * u, F.lit(180.0))) / 2.0)
        square = math.sin(math.radians(moved(u)) / 2.0) ** 2 + (F.lit(0.0) if later else cos(F.col("near")) * cos(F.col("near") - moved(u)) * turned * turned)
        angle = F.least(2.0 * F.asin(F.sqrt(F.least(square, F.lit(1.0)))) + math.radians(2.0 * tol_deg), F.lit(math.pi))
        return 2.0 * F.sin(angle / 2.0) * 1.000001 + 1e-9

    gaps = [*levels] if later and levels else [0.0, *levels]
    tiles = work.put(tiles.withColumn("rate", rate).select(*TILE, *[reach(u).alias(f"reach{k}") for k, u in enumerate(gaps)]), "tiles")
    most = tiles.agg(*[F.max(f"reach{k}").alias(f"reach{k}") for k in range(len(gaps))]).head()
    size = [2.0 * ((most[k] or 0.0) + 2.0 * round_) for k in range(len(gaps))]
    each = F.explode(F.array(*[F.struct(F.lit(u).alias("u"), F.lit(size[k]).alias("size"), F.col(f"reach{k}").alias("reach")) for k, u in enumerate(gaps)]))
    side = tiles.withColumn("g", each).select(*TILE, "g.u", "g.size", "g.reach").withColumns({c: (F.col(f"t{c}") + 0.5) * edge for c in "xyz"})
    bucket = _bucket(F.col("time_min"), F.col("u"))
    shifts = F.when(F.col("u") == 0, F.array(bucket)).otherwise(F.array(*[bucket + k for k in ((1, 2) if later else (-2, -1, 1, 2))]))
    here = side.withColumn("tb", F.explode(shifts))
    span = F.col("reach") + 2.0 * round_
    for c in "xyz":
        here = here.withColumn(f"c{c}", F.explode(F.sequence(F.floor((F.col(c) - span) / F.col("size")).cast("long"), F.floor((F.col(c) + span) / F.col("size")).cast("long"))))
    met = ["u", "tb", "cx", "cy", "cz"]
    here = here.select(*met, *[F.col(t).alias(f"t_{t}") for t in TILE], "reach", *[F.col(c).alias(f"t_{c}") for c in "xyz"])
    there = side.withColumn("tb", bucket).withColumns({f"c{c}": F.floor(F.col(c) / F.col("size")).cast("long") for c in "xyz"}).select(*met, *TILE, *"xyz")
    apart = F.sqrt(sum((F.pow(F.col(f"t_{c}") - F.col(c), F.lit(2.0)) for c in "xyz"), F.lit(0.0)))
    dt = F.abs(F.col("time_min") - F.col("t_time_min"))
    fits = (F.col("frame_index") > F.col("t_frame_index") if later else F.col("frame_index") != F.col("t_frame_index")) & ((F.col("u") == 0) | ((dt > F.col("u") / 2.0) & (dt <= F.col("u"))))
    # shuffled: sizes of exploded rows are guessed from the rows before, and such a guess would send them through the driver
    pairs = here.hint("merge").join(there, met).where(fits & (apart <= F.col("reach") + 2.0 * round_)).select(*[f"t_{t}" for t in TILE], "reach", *[f"t_{c}" for c in "xyz"], *TILE)
    pairs = work.put(pairs, "tile_pairs")
    at = dict(zip("xyz", unit_vector(F.col("ra"), F.col("dec")), strict=True))
    off = F.sqrt(sum((F.pow(F.col(f"t_{c}") - at[c], F.lit(2.0)) for c in "xyz"), F.lit(0.0)))
    others = placed.join(pairs.hint("merge"), TILE).where(off <= F.col("reach") + round_).select(*[f"t_{t}" for t in TILE], *SPOT, F.lit(False).alias("own"))
    own = placed.select(*[F.col(t).alias(f"t_{t}") for t in TILE], *SPOT, F.lit(True).alias("own"))
    return own.union(others)


def in_pieces(rows: DataFrame, tol_deg: float, run: Callable[[Piece], Iterator[dict[str, np.ndarray]]], schema: str) -> DataFrame:
    """What ``run`` makes of each tile. Many partitions: work grows with the square of a tile's rows, which sizes do not show."""
    keys = [f"t_{t}" for t in TILE]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = _piece(list(batches), tol_deg)
        for columns in run(piece):
            yield from _batches(columns)

    n = 16 * rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(n, *keys).groupBy(*keys).applyInArrow(solve, schema)


def seeds(orphans: DataFrame, max_speed: float, levels: list[float], work: Workspace) -> DataFrame:
    """a, b, frame_a, frame_b and the velocity of every pair of a later frame with 0 < speed <= max_speed."""

    def run(piece: Piece) -> Iterator[dict[str, np.ndarray]]:
        for a, b, speed, v_ra, v_dec in piece.seeds(max_speed):
            yield {"a": piece.own["det_idx"][a], "b": piece.other["det_idx"][b], "frame_a": np.full(len(a), piece.frame), "frame_b": piece.other["frame_index"][b], "speed": speed, "v_ra": v_ra, "v_dec": v_dec}

    return in_pieces(pieces(orphans, max_speed, 0.0, levels, work, later=True), 0.0, run, "a long, b long, frame_a long, frame_b long, speed double, v_ra double, v_dec double")


def first_matches(orphans: DataFrame, max_speed: float, tol_deg: float, levels: list[float], work: Workspace) -> DataFrame:
    """a, b, frame_c, c: for each seed and other frame the first detection inside the predicted box."""

    def run(piece: Piece) -> Iterator[dict[str, np.ndarray]]:
        for s in piece.chunks(max_speed):
            a, b = piece.own["det_idx"][s[0]], piece.other["det_idx"][s[1]]
            for frame, first in piece.matches(s):
                hit = np.flatnonzero(first >= 0)
                if len(hit):
                    yield {"a": a[hit], "b": b[hit], "frame_c": np.full(len(hit), frame), "c": first[hit]}

    return in_pieces(pieces(orphans, max_speed, tol_deg, levels, work), tol_deg, run, "a long, b long, frame_c long, c long")


def points(orphans: DataFrame, max_speed: float, tol_deg: float, levels: list[float], work: Workspace) -> DataFrame:
    """a, b, points: seeds with a match in some other frame, and in how many frames they are then."""

    def run(piece: Piece) -> Iterator[dict[str, np.ndarray]]:
        for s in piece.chunks(max_speed):
            n = np.full(len(s[0]), 2)
            for _, first in piece.matches(s):
                n += first >= 0
            hit = np.flatnonzero(n > 2)
            yield {"a": piece.own["det_idx"][s[0][hit]], "b": piece.other["det_idx"][s[1][hit]], "points": n[hit]}

    return in_pieces(pieces(orphans, max_speed, tol_deg, levels, work), tol_deg, run, "a long, b long, points long")


def _joined(labels: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Labels, each that of its component's least node, after edges u, v."""
    while True:
        a, b = labels[u], labels[v]
        apart = np.flatnonzero(a != b)
        if not len(apart):
            return labels
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while (labels[labels] != labels).any():
            labels = labels[labels]


def _linked(piece: Piece, max_speed: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and roots, other than themselves, of what seeds with enough matches link: a, b and all that lies in their boxes."""
    n = len(piece.own["det_idx"])
    labels = np.arange(n + len(piece.other["det_idx"]))
    for s in piece.chunks(max_speed):
        a, b, _, v_ra, v_dec = s
        frame_b, viable = piece.other["frame_index"][b], np.full(len(a), least <= 2)
        for g, (frame, _, i, j) in enumerate(piece.groups):
            if frame == piece.frame:
                continue
            spots, runs = None, np.zeros(j - i + 1, np.int64)  # runs that begin less those that end at a place
            for r, *found in piece.boxes(g, np.flatnonzero(frame_b != frame), a, v_ra, v_dec, runs_only=True):
                spots = piece.strips[g]
                if len(found) == 2:
                    begin, end = found
                    np.add.at(runs, begin, 1)
                    np.add.at(runs, end - 1, -1)
                    hit, c = r, spots.order[begin] + i
                else:
                    starts, c, inside = found
                    hit = np.repeat(r, np.diff(np.append(starts, len(c))))[inside]
                    c = c[inside]
                viable[hit] = True
                labels = _joined(labels, a[hit], n + c)
            if spots is not None:
                at = np.flatnonzero(np.cumsum(runs)[:-1] > 0)
                labels = _joined(labels, n + i + spots.order[at], n + i + spots.order[np.minimum(at + 1, j - i - 1)])
        labels = _joined(labels, a[viable], n + b[viable])
    node = np.flatnonzero(labels != np.arange(len(labels)))
    return node, labels[node]


def links(orphans: DataFrame, max_speed: float, tol_deg: float, least: int, levels: list[float], work: Workspace) -> DataFrame:
    """u, v: edges that join detections of one track or of tracks that compete for one, no more than a tile has detections."""

    def run(piece: Piece) -> Iterator[dict[str, np.ndarray]]:
        ids = np.concatenate([piece.own["det_idx"], piece.other["det_idx"]])
        node, root = _linked(piece, max_speed, least)
        if len(node):
            yield {"u": ids[node], "v": ids[root]}

    return in_pieces(pieces(orphans, max_speed, tol_deg, levels, work), tol_deg, run, "u long, v long")


class Boxes:
    """Detections of a frame and time by small strips, for one position after the other."""

    def __init__(self, rows: np.ndarray, ra: np.ndarray, dec: np.ndarray, cos: np.ndarray, tol_deg: float):
        self.tol, self.height = tol_deg, max(2.0 * tol_deg, 1e-9)
        self.strips: dict[int, tuple[list[float], list[int], float]] = {}
        turned = ra[rows] - 360.0 * np.floor(ra[rows] / 360.0)
        strip = np.floor(dec[rows] / self.height).astype(np.int64)
        order = np.lexsort((turned, strip))
        cuts = np.flatnonzero(np.diff(strip[order])) + 1
        for part in np.split(order, cuts) if len(order) else []:
            least = float(cos[rows[part]].min())
            wide = tol_deg / least + 1e-9 if least * 180.0 > tol_deg else 360.0
            self.strips[int(strip[part[0]])] = (turned[part].tolist(), rows[part].tolist(), wide)

    def free(self, p_ra: float, p_dec: float, ra: list[float], dec: list[float], cos: list[float], used: bytearray, best: int) -> int:
        """The least row below ``best`` that lies in the box and is not used, else ``best``."""
        tol = self.tol
        for strip in range(math.floor((p_dec - tol) / self.height - 1e-9), math.floor((p_dec + tol) / self.height + 1e-9) + 1):
            if strip not in self.strips:
                continue
            at, rows, wide = self.strips[strip]
            q = p_ra - 360.0 * math.floor(p_ra / 360.0)
            if wide >= 180.0:
                there = rows
            else:
                there = rows[bisect_left(at, q - wide) : bisect_right(at, q + wide)]
                if q - wide < 0.0:
                    there = there + rows[bisect_left(at, q - wide + 360.0) :]
                elif q + wide >= 360.0:
                    there = there + rows[: bisect_right(at, q + wide - 360.0)]
            for r in there:
                if r < best and not used[r] and abs(dec[r] - p_dec) < tol:
                    turned = ra[r] - p_ra + 180.0
                    if abs(turned - 360.0 * math.floor(turned / 360.0) - 180.0) * cos[r] < tol:
                        best = r
        return best


def greedy_tracks(ids: np.ndarray, frame: np.ndarray, time: np.ndarray, ra: np.ndarray, dec: np.ndarray, max_speed: float, tol_deg: float, least: int) -> list[list[int]]:
    """Tracks of one component: its seeds in order of (frame, det_idx) pairs, other frames give their first free match, members are used once.

    Seeds are made for some detections at a time, and only of those that are still free then.
    """
    order = np.lexsort((ids, frame))
    order = order[np.append(True, np.diff(ids[order]) != 0)] if len(order) else order
    ids, frame, time, ra, dec = (x[order] for x in (ids, frame, time, ra, dec))
    sin, cos = np.sin(np.radians(dec)), np.cos(np.radians(dec))
    groups: list[tuple[int, float, np.ndarray, Boxes]] = []
    by = np.lexsort((np.arange(len(ids)), time, frame))
    cuts = np.flatnonzero((np.diff(frame[by]) != 0) | (np.diff(time[by]) != 0)) + 1
    for rows in np.split(by, cuts):
        groups.append((int(frame[rows[0]]), float(time[rows[0]]), rows, Boxes(rows, ra, dec, cos, tol_deg)))
    rows_of = [(f, [(t, box) for g, t, _, box in groups if g == f]) for f in dict.fromkeys(g[0] for g in groups)]
    used, none = bytearray(len(ids)), len(ids)
    view = np.frombuffer(used, np.uint8)
    l_ra, l_dec, l_cos, l_time, l_frame = (x.tolist() for x in (ra, dec, cos, time, frame))
    out: list[list[int]] = []

    def seeds(some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found_a, found_b = [some[:0]], [some[:0]]
        for t in np.unique(time[some]):
            a = some[time[some] == t]
            spots = {"det_idx": a, "ra": ra[a], "dec": dec[a], "sin": sin[a], "cos": cos[a]}
            for g, (f, t_b, rows, _) in enumerate(groups):
                if f <= frame[a[0]] or t_b <= t:
                    continue
                for p, q in pairs_of(spots, rows, g, t_b - t):
                    found_a.append(a[p])
                    found_b.append(rows[q])
        return np.concatenate(found_a), np.concatenate(found_b)

    held: dict[tuple[int, float], Strips] = {}

    def pairs_of(spots: dict[str, np.ndarray], rows: np.ndarray, g: int, dt: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        there = {"ra": ra[rows], "dec": dec[rows], "sin": sin[rows], "cos": cos[rows]}
        for p, q, *_ in near_pairs(spots, there, dt, max_speed, held, (g, dt)):
            yield p, q

    i, some_at_once = 0, 16
    while i < none:
        j = min(i + some_at_once, int(np.searchsorted(frame, frame[i], "right")))
        a, b = seeds(i + np.flatnonzero(view[i:j] == 0))
        some_at_once = int(min(max(some_at_once * (AT_ONCE / 4) / max(len(a), 1), 1), 4096, 8 * some_at_once))
        free = view[b] == 0
        a, b = a[free], b[free]
        sort = np.lexsort((b, a))
        a, b = a[sort], b[sort]
        for part_a, part_b in zip(a[starts_of(a)].tolist() if len(a) else [], np.split(b, starts_of(a)[1:]) if len(a) else [], strict=True):
            if used[part_a]:
                continue
            r0, d0, t0, f0 = l_ra[part_a], l_dec[part_a], l_time[part_a], l_frame[part_a]
            for k in part_b.tolist():
                if used[k]:
                    continue
                dt = l_time[k] - t0
                turned = l_ra[k] - r0 + 180.0
                v_ra, v_dec = (turned - 360.0 * math.floor(turned / 360.0) - 180.0) / dt, (l_dec[k] - d0) / dt
                track = [part_a, k]
                for f, boxes in rows_of:
                    if f == f0 or f == l_frame[k]:
                        continue
                    best = none
                    for t, box in boxes:
                        best = box.free(r0 + v_ra * (t - t0), d0 + v_dec * (t - t0), l_ra, l_dec, l_cos, used, best)
                    if best < none:
                        track.append(best)
                if len(track) >= least:
                    track.sort(key=l_frame.__getitem__)
                    for m in track:
                        used[m] = 1
                    out.append([int(ids[m]) for m in track])
                    break
        held = {k: v for k, v in held.items() if j < none and frame[j] == frame[i]}
        i = j
    return out


def starts_of(sorted_: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, np.diff(sorted_) != 0))

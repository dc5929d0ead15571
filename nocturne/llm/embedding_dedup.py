"""Embedding near-duplicates: iterative quantisation, multi-index Hamming tables, exact reranking.

1. Identical vectors are folded into one with its copies (a grouped minimum and count).
2. Rotations of the centred vectors are learned by iterative quantisation on a bounded sample (the
   rows of least hash); signs of the rotated components are 64-bit codes of every vector. The width
   of the tables' keys, the number of rotations and the Hamming radius are the cheapest for the number
   of rows (keys grow with its logarithm) whose recall, measured on the sample, reaches TARGET. Where
   none does (vectors with a strong common direction, a loose group of most rows), steps 3 and 4 are
   left out and all pairs of blocks of vectors are compared.
3. Vectors sorted by code are gathered into balls: members within the pivot's half angle are linked
   with each other by the triangle inequality, so a dense group needs no pairs of its own.
4. Multi-index tables: a code falls into substrings; two-sided probing of one bit each way meets all
   codes whose substring differs in two bits at most. Met balls whose codes lie within the Hamming
   radius are candidates, kept once per pair of balls. Keys that many codes share are dealt over
   several tasks.
5. Candidate balls are opened and compared with their original vectors in doubles. Links are counted
   per vector; balls with a link are joined, and connected components follow.

Every row is indexed; no bucket is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, components

SAMPLE, ROUNDS, BITS = 8192, 40, 64
WIDTHS, ROTATIONS, RADII = (16, 18, 20, 21, 24, 26, 28, 32), (1, 2, 3, 4, 5, 6, 8, 10, 12, 16), (18, 24)
MEETING = 0.05  # cost of two codes that meet, in units of a key that is sent
HOT = 4096  # codes of a key that one task compares with others
TARGET, LEAST = 0.99, 50  # recall asked for; links of the sample from which their own recall counts
BLOCK, SLICE = 4096, 512  # vectors of a block where all pairs are compared; rows compared at once
BALL = 256  # members of a ball at most; further ones open another ball


def fit_rotation(x: np.ndarray, bits: int = BITS, rounds: int = ROUNDS, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection): principal directions times the learned rotation; wide codes add random directions."""
    random = np.random.default_rng(seed)
    dim = x.shape[1]
    mean = x.mean(0)
    _, _, axes = np.linalg.svd(x - mean, full_matrices=False)
    axes = axes[:bits].T
    rotation = np.linalg.qr(random.normal(size=(axes.shape[1], axes.shape[1])))[0]
    v = (x - mean) @ axes
    for _ in range(rounds):
        signs = np.sign(v @ rotation)
        u, _, wt = np.linalg.svd(signs.T @ v)
        rotation = (u @ wt).T
    projection = axes @ rotation
    if projection.shape[1] < bits:
        projection = np.concatenate([projection, random.normal(size=(dim, bits - projection.shape[1]))], 1)
    return mean, projection


def unit_vectors(rows: DataFrame) -> DataFrame:
    """vec_id, dim and packed unit vector in doubles of usable rows."""
    usable = "vec_id is not null and embedding is not null and size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(embedding, x -> x <> 0)"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            out, at = [], 0
            for n in lengths:
                v = flat[at : at + n]
                v = v / np.abs(v).max()
                out.append((v / np.linalg.norm(v)).tobytes())
                at += n
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int32()), pa.array(out, pa.binary())], ["vec_id", "dim", "unit"])

    return rows.where(usable).select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(run, "vec_id long, dim int, unit binary")


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


WEIGHT = (1 << np.arange(BITS, dtype=np.uint64))[::-1]


def _code(x: np.ndarray, fit: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    mean, projection = fit
    return (((x - mean) @ projection > 0) * WEIGHT).sum(1, dtype=np.uint64)


def _kinds_of_pairs(x: np.ndarray, cosine: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs to measure recall on: planted at the threshold, in any direction and towards other vectors, and the sample's own links that no ball holds."""
    random = np.random.default_rng(7)
    angle = np.arccos(np.clip(cosine, -1.0, 1.0))
    kinds = []
    for u in (random.normal(size=x.shape), x[random.permutation(len(x))] - x):
        u = u - (u * x).sum(1, keepdims=True) * x
        size = np.linalg.norm(u, axis=1)
        on = size > 1e-9
        if on.any():
            kinds.append((x[on], np.cos(angle) * x[on] + np.sin(angle) * u[on] / size[on, None]))
    left, right = [], []
    for lo in range(0, len(x), 1024):
        g = x[lo : lo + 1024] @ x.T
        i, j = np.nonzero((g >= cosine) & (g < np.cos(angle / 2)))
        keep = i + lo < j
        left.append(i[keep][:8192] + lo)
        right.append(j[keep][:8192])
    i, j = np.concatenate(left), np.concatenate(right)
    return [*kinds, (x[i], x[j])] if len(i) >= LEAST else kinds


def options(n: int) -> list[tuple[float, int, int, int]]:
    """(cost, key width, rotations, radius) for n vectors, cheapest first: keys sent and pairs that meet by chance."""
    out = []
    for width in WIDTHS:
        near = (1 + width + width * (width - 1) / 2) / 2.0**width  # of random keys, those within two bits
        for count in ROTATIONS:
            for radius in RADII:
                out.append((count * (BITS // width) * (width + 1 + MEETING * n * near) * (1.0 + 0.1 * (radius > RADII[0])), width, count, radius))
    return sorted(out)


def choose(x: np.ndarray, cosine: float, n: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], int, int]:
    """(rotations, key width, radius), the cheapest of the options that reaches TARGET for each kind of pairs; no rotations if none does."""
    kinds = _kinds_of_pairs(x, cosine)
    fits: list[tuple[np.ndarray, np.ndarray]] = []
    apart: list[list[np.ndarray]] = [[] for _ in kinds]  # the bits that differ, by rotation
    hit: dict[tuple[int, int, int, int], np.ndarray] = {}  # by kind, rotation, width and radius

    def found(kind: int, rotation: int, width: int, radius: int) -> np.ndarray:
        if (key := (kind, rotation, width, radius)) not in hit:
            d = apart[kind][rotation]
            parts = [np.bitwise_count((d >> np.uint64(t * width)) & np.uint64((1 << width) - 1)) for t in range(BITS // width)]
            hit[key] = (np.bitwise_count(d) <= radius) & (np.min(parts, 0) <= 2)
        return hit[key]

    for _, width, count, radius in options(n):
        while len(fits) < count:
            fits.append(fit_rotation(x, seed=5 + len(fits)))
            for seen, (a, b) in zip(apart, kinds, strict=True):
                seen.append(_code(a, fits[-1]) ^ _code(b, fits[-1]))
        if all(np.any([found(k, r, width, radius) for r in range(count)], 0).mean() >= TARGET for k in range(len(kinds))):
            return fits[:count], width, radius
    return [], 0, 0


def _codes(distinct: DataFrame, fits: list[tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(2))
                codes = np.stack([_code(x, fit) for fit in fits], 1).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(fits), pa.int32()), pa.array(codes.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], ["rep", "copies", "unit", "codes"])

    return distinct.select("rep", "copies", "unit").mapInArrow(run, "rep long, copies long, unit binary, codes array<long>")


def _balls(coded: DataFrame, cosine: float) -> DataFrame:
    """ball (its least rep), rep, copies, unit, codes: pivot groups among neighbours in code order."""
    half = np.cos(np.arccos(min(1.0, cosine)) / 2) + 1e-9 if cosine > -1 else 2.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for lo in range(0, big.num_rows, 2048):
                batch = big.slice(lo, 2048)
                reps, v = batch.column(0).to_numpy(), _matrix(batch.column(2))
                ball = np.full(len(reps), -1, np.int64)
                for i in range(len(reps)):
                    if ball[i] < 0:
                        free = i + np.flatnonzero(ball[i : i + 512] < 0)
                        inside = free[v[free] @ v[i] >= half][: BALL - 1]
                        inside = inside if i in inside[:1] else np.concatenate([[i], inside[inside != i]])
                        ball[inside] = reps[inside].min()
                yield pa.RecordBatch.from_arrays([pa.array(ball), *batch.columns], ["ball", "rep", "copies", "unit", "codes"])

    first = F.col("codes")[0]
    return coded.repartitionByRange(first, "rep").sortWithinPartitions(first, "rep").mapInArrow(run, "ball long, rep long, copies long, unit binary, codes array<long>")


def _candidates(balls: DataFrame, width: int, radius: int) -> DataFrame:
    """Pairs (p, q), p < q, of balls with codes that meet in a table and lie within the Hamming radius."""
    tables = BITS // width
    probes = F.explode(F.array(*[F.lit(p).cast("long") for p in (0, *(1 << b for b in range(width)))]))
    part = F.expr(f"shiftrightunsigned(code, t * {width}) & {(1 << width) - 1}L")
    codes = balls.select("ball", F.posexplode("codes").alias("c", "code")).distinct().withColumn("t", F.explode(F.array(*map(F.lit, range(tables)))))
    codes = codes.select(((F.col("c") * tables + F.col("t")).cast("long") * (1 << width) + part).alias("key"), "ball", "code")  # the table and the substring
    probed = lambda df, *more: df.withColumn("probe", probes).select(F.col("key").bitwiseXOR(F.col("probe")).alias("key"), *more)
    a = b = probed(codes, "ball", "code")
    hot = codes.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > HOT)
    salt = F.lit(True)
    if not hot.isEmpty():  # at most one key in HOT codes; its neighbours are as full
        shares = probed(hot, F.ceil(F.col("n") / HOT).alias("m")).groupBy("key").agg(F.max("m").alias("m"))
        dealt = probed(codes, "ball", "code").join(shares, "key", "left").withColumn("m", F.coalesce("m", F.lit(1)).cast("int"))
        a = dealt.withColumn("salt", F.pmod(F.xxhash64("ball"), F.col("m")).cast("int"))
        b = dealt.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
        salt = F.col("a.salt") == F.col("b.salt")
    met = a.alias("a").join(b.alias("b"), (F.col("a.key") == F.col("b.key")) & salt & (F.col("a.ball") < F.col("b.ball")) & (F.bit_count(F.col("a.code").bitwiseXOR(F.col("b.code"))) <= radius))
    return met.select(F.col("a.ball").alias("p"), F.col("b.ball").alias("q")).distinct()


def _least_reached(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """The least of each of n nodes' connected component under the edges (u, v)."""
    label = np.arange(n)
    while True:
        low, after = np.minimum(label[u], label[v]), label.copy()
        for at in (u, v, label[u], label[v]):
            np.minimum.at(after, at, low)
        after = after[after]
        if (after == label).all():
            return label
        label = after


def _compare_all(distinct: DataFrame, cosine: float, n: int) -> DataFrame:
    """The links of ``_open`` from all pairs of vectors: kind 0 counts, kind 1 edges that span each block pair's links."""
    blocks = -(-n // BLOCK)
    own = distinct.select("rep", "copies", "unit", F.pmod(F.xxhash64("rep"), F.lit(blocks)).cast("int").alias("block"))
    dealt = own.withColumn("with", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select("rep", "copies", "unit", "block", F.least("block", "with").alias("p"), F.greatest("block", "with").alias("q"))

    def run(group: pa.Table) -> pa.Table:
        reps, copies, block = (group[c].to_numpy() for c in ("rep", "copies", "block"))
        x = _matrix(group["unit"])
        p, q = group["p"][0].as_py(), group["q"][0].as_py()
        left, right = np.flatnonzero(block == p), np.flatnonzero(block == q)
        found, edges = np.zeros(len(reps), np.int64), np.zeros((2, 0), np.int64)
        y = x[right]
        for lo in range(0, len(left), SLICE):
            at = left[lo : lo + SLICE]
            on = x[at] @ y.T >= cosine
            if p == q:
                on[np.arange(len(at)), lo + np.arange(len(at))] = False
            found[at] += on @ copies[right]
            if p != q:
                found[right] += on.T @ copies[at]
            i, j = np.nonzero(on)
            if len(i):
                u, v = np.concatenate([edges[0], at[i]]), np.concatenate([edges[1], right[j]])
                ends = np.unique(np.concatenate([u, v]))
                edges = np.stack([ends, _least_reached(u, v, len(reps))[ends]])
        some = np.flatnonzero(found)
        kind = np.repeat([0, 1], [len(some), edges.shape[1]])
        return pa.table({"kind": kind, "id": np.concatenate([reps[some], reps[edges[0]]]), "other": np.concatenate([found[some], reps[edges[1]]])})

    return dealt.groupBy("p", "q").applyInArrow(run, "kind long, id long, other long")


def _open(pairs: DataFrame, balls: DataFrame, cosine: float) -> DataFrame:
    """kind 0: (id=rep, other=links to vectors of the other ball); kind 1: linked balls (id=p, other=q)."""
    packed = balls.groupBy("ball").agg(F.array_sort(F.collect_list(F.struct("rep", "copies", "unit"))).alias("m"))  # BALL members at most
    packed = packed.select("ball", F.col("m.rep").alias("reps"), F.col("m.copies").alias("copies"), F.col("m.unit").alias("units"))
    side = lambda n: packed.select(*[F.col(c).alias(f"{n}_{c}") for c in packed.columns])
    both = pairs.join(side("p"), F.col("p") == F.col("p_ball")).join(side("q"), F.col("q") == F.col("q_ball"))

    def members(batch: pa.RecordBatch, side: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Vectors, representatives and copies of one side's balls, and where each ball begins."""
        reps, copies, units = (batch.column(f"{side}_{c}") for c in ("reps", "copies", "units"))
        return _matrix(units.flatten()), reps.flatten().to_numpy(), copies.flatten().to_numpy(), np.concatenate([[0], np.cumsum(units.value_lengths().to_numpy())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for lo in range(0, big.num_rows, 1024):
                batch = big.slice(lo, 1024)
                p, q = batch.column("p").to_numpy(), batch.column("q").to_numpy()
                (x, xr, xc, xs), (y, yr, yc, ys) = members(batch, "p"), members(batch, "q")
                single = (np.diff(xs) == 1) & (np.diff(ys) == 1)
                i, j = xs[:-1][single], ys[:-1][single]
                on = (x[i] * y[j]).sum(1) >= cosine
                i, j = i[on], j[on]
                kind = [np.repeat([1, 0, 0], len(i))]
                one, other = [np.concatenate([p[single][on], xr[i], yr[j]])], [np.concatenate([q[single][on], yc[j], xc[i]])]
                for k in np.flatnonzero(~single):
                    u, v = slice(xs[k], xs[k + 1]), slice(ys[k], ys[k + 1])
                    on = x[u] @ y[v].T >= cosine
                    if on.any():
                        n, m = on @ yc[v], on.T @ xc[u]
                        kind.append(np.repeat([1, 0], [1, (n > 0).sum() + (m > 0).sum()]))
                        one.append(np.concatenate([p[k : k + 1], xr[u][n > 0], yr[v][m > 0]]))
                        other.append(np.concatenate([q[k : k + 1], n[n > 0], m[m > 0]]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(z), pa.int64()) for z in (kind, one, other)], ["kind", "id", "other"])

    return both.select("p", "q", *[f"{s}_{c}" for s in "pq" for c in ("reps", "copies", "units")]).mapInArrow(run, "kind long, id long, other long")


def near_duplicates(rows: DataFrame, scratch: Scratch, cosine: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row of ``rows`` (vec_id, embedding).

    Null, empty, zero and non-finite vectors link with nothing; nor do vectors of different lengths or
    without an id (their component_id is null, and they are kept). One round of jobs runs per length.
    Copies of a vector are linked with one another. Rows that repeat a vec_id count each; they are
    told apart only by their vectors. An empty table gives no rows; more columns are ignored.
    """
    units = scratch.put(unit_vectors(rows), "units")
    key = lambda: ("dim", F.xxhash64("unit").alias("h"), F.sha2("unit", 256).alias("s"))
    keyed = units.select("vec_id", "unit", *key())
    distinct = scratch.put(keyed.groupBy("dim", "h", "s").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("unit").alias("unit")), "distinct")
    links, edges = [], []
    dims = {r["dim"]: r["count"] for r in distinct.groupBy("dim").count().orderBy("dim").collect()}  # a row a vector length
    for dim, n in dims.items():
        alike = distinct.where(F.col("dim") == dim)
        fits, width, radius = choose(_matrix(alike.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("unit").toArrow()["unit"]), cosine, n)
        if fits:
            balls = scratch.put(_balls(_codes(alike, fits), cosine), f"balls_{dim}")
            pairs = scratch.put(_candidates(balls, width, radius), f"pairs_{dim}")
            opened = scratch.put(_open(pairs, balls, cosine), f"opened_{dim}")
        else:
            balls = alike.select(F.col("rep").alias("ball"), "rep", "copies", "unit")
            opened = scratch.put(_compare_all(alike, cosine, n), f"opened_{dim}")
        inner = balls.groupBy("ball").agg(F.sum("copies").alias("all"))
        links += [opened.where("kind = 0").select(F.col("id").alias("rep"), F.col("other").alias("n")), balls.join(inner, "ball").select("rep", (F.col("all") - 1).alias("n"))]
        edges += [opened.where("kind = 1").select(F.col("id").alias("u"), F.col("other").alias("v")), balls.select(F.col("rep").alias("u"), F.col("ball").alias("v"))]
    if not dims:
        return rows.select(F.col("vec_id").cast("long"), F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"), F.lit(True).alias("kept"))
    merged_links, merged_edges = links[0], edges[0]
    for x, y in zip(links[1:], edges[1:], strict=True):
        merged_links, merged_edges = merged_links.union(x), merged_edges.union(y)
    roots = scratch.put(components(merged_edges, scratch, "roots"), "roots")
    totals = scratch.put(merged_links.groupBy("rep").agg(F.sum("n").alias("n_links")), "totals")
    scratch.drop(*(f"{t}_{dim}" for t in ("balls", "pairs", "opened") for dim in dims))
    known = distinct.join(totals, "rep", "left").join(roots, F.col("rep") == F.col("node"), "left").select("dim", "h", "s", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "rep").alias("component_id"))
    salted = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(15))))  # a vector copied millions of times is joined in 16 parts
    found = keyed.select("vec_id", "dim", "h", "s", F.pmod(F.xxhash64("vec_id"), F.lit(16)).cast("int").alias("salt")).join(salted, ["dim", "h", "s", "salt"]).select("vec_id", "n_links", "component_id")
    unusable = "vec_id is null or embedding is null or size(embedding) = 0 or exists(embedding, x -> x is null or isnan(x) or abs(x) = double('Infinity')) or forall(embedding, x -> x = 0)"
    rest = rows.where(f"coalesce({unusable}, true)").select(F.col("vec_id").cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"))
    return found.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

"""Exact top-k inner products by Fagin's threshold algorithm.

Queries and candidates are dealt into blocks by hash and every block pair meets once (a stated query
set against all rows); blocks grow with the tables up to the bounds below, so that a row is sent to
few of them. In a pair, each dimension's candidates are sorted once. A query walks all lists from the
end that its sign favours, scores each newly seen row by random access, and stops when the threshold,
the score that the lists' current entries could give together, is below its kth score. Equal scores
go to the smaller id, so the walk goes on while the threshold equals the kth.

The first candidate block goes first: its kth score of a query is a floor for all other blocks, whose
walks may stop as soon as the threshold falls below it. The k rows of each block are merged by rank.

Scores are exact integers. Components so large that a double could not hold every sum are multiplied
as Python integers, and ranks follow an order-preserving key of the exact score, which no width of
the ``score`` column limits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch

SCALE = 1024
QUERY_BLOCK, CANDIDATE_BLOCK = (1024, 32768), (4096, 32768)  # rows of a block: in small tables, and at most
SPREAD = 16  # blocks a side before they grow
LONG = 2**63 - 1
USABLE = "vec_id is not null and embedding is not null and size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"


def packed_vectors(rows: DataFrame) -> DataFrame:
    """id, dim, packed doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            at = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            packed = pa.array([flat[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), lists.value_lengths().cast(pa.int32()), packed], ["id", "dim", "packed"])

    return rows.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>")).mapInArrow(run, "id long, dim int, packed binary")


def exact_integers(x: np.ndarray) -> list[int]:
    """floor(1024 x) of each double, also where 1024 x is beyond the doubles."""
    return [math.floor(v * SCALE) if abs(v) < 1e300 else int(v) * SCALE for v in x.tolist()]


def sort_key(score: int) -> bytes:
    """Bytes whose unsigned order is that of the integers."""
    size = (abs(score).bit_length() + 7) // 8
    body = size.to_bytes(4, "big") + abs(score).to_bytes(size, "big")
    return b"\x01" + body if score >= 0 else b"\x00" + bytes(255 - b for b in body)


def threshold_search(order: np.ndarray, rows: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int, floor: float = -np.inf) -> tuple[list[int], list[int], int]:
    """(ids, scores, depth reached) of one query; ``order[d]`` lists rows by ascending value of dimension d.

    Rows below ``floor`` may be left out.
    """
    n, dims = len(ids), np.flatnonzero(query)
    walk = np.where((query[dims] > 0)[:, None], order[dims][:, ::-1], order[dims])
    seen = np.zeros(n, bool)
    top_s, top_i = np.zeros(0), np.zeros(0, np.int64)
    depth, step = 0, 16
    while depth < n and len(dims):
        to = min(n, depth + step)
        part = walk[:, depth:to].ravel()
        fresh = np.zeros(n, bool)
        fresh[part] = True
        fresh &= ~seen
        seen |= fresh
        new = np.flatnonzero(fresh)
        new = new[ids[new] != own]
        top_s, top_i = _best(np.concatenate([top_s, rows[new] @ query]), np.concatenate([top_i, ids[new]]), k)
        depth, step = to, step * 2
        bound = float(query[dims] @ rows[walk[:, depth - 1], dims])
        if bound < floor or (len(top_s) == k and bound < top_s[-1]):
            break
    if not len(dims):  # every score is 0
        new = np.flatnonzero(ids != own)
        top_s, top_i = _best(np.zeros(len(new)), ids[new], k)
    return top_i.tolist(), [int(s) for s in top_s], depth


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(scores) > 4 * k:  # only rows that reach the kth score, ties included
        on = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        scores, ids = scores[on], ids[on]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def _meet(k: int):
    """Of a query block (with floors) and a candidate block: query_id, vec_id, score and its key."""

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if asked.num_rows and held.num_rows:
            with np.errstate(over="ignore"):  # beyond the doubles: infinite, and so among the large ones
                view = lambda t: (t["id"].to_numpy(), x := np.frombuffer(b"".join(t["packed"].to_pylist())).reshape(t.num_rows, -1), np.floor(x * SCALE))
                (qi, q_raw, q), (ci, c_raw, c) = view(asked), view(held)
            limit = math.isqrt(2**53 // c.shape[1])  # products of smaller components sum up exactly in doubles
            small = np.abs(c).max(1) <= limit
            rows, ids = c[small], ci[small]
            order = np.argsort(rows.T, axis=1, kind="stable").astype(np.int32)
            large = [(int(i), exact_integers(x)) for i, x in zip(ci[~small], c_raw[~small], strict=True)]
            every = None
            for i, x, raw, floor in zip(qi.tolist(), q, q_raw, asked["floor"].to_pylist(), strict=True):
                if np.abs(x).max() <= limit:
                    got = list(zip(*threshold_search(order, rows, ids, x, i, k, -np.inf if floor is None else float(floor))[:2], strict=True))
                    others = large
                else:
                    every = every or [(int(j), exact_integers(y)) for j, y in zip(ci, c_raw, strict=True)]
                    got, others = [], every
                if others:
                    mine = exact_integers(raw)
                    got += [(j, sum(a * b for a, b in zip(mine, y, strict=True))) for j, y in others if j != i]
                    got = sorted(got, key=lambda r: (-r[1], r[0]))[:k]
                out.extend((i, j, s) for j, s in got)
        scores = [max(-LONG - 1, min(LONG, s)) for _, _, s in out]
        return pa.table({"query_id": pa.array([r[0] for r in out], pa.int64()), "vec_id": pa.array([r[1] for r in out], pa.int64()), "score": pa.array(scores, pa.int64()), "key": pa.array([sort_key(r[2]) for r in out], pa.binary())})

    return run


def _blocks(n: int, sizes: tuple[int, int]) -> int:
    return max(1, min(-(-n // sizes[0]), max(SPREAD, -(-n // sizes[1]))))


def exact_top_k(rows: DataFrame, queries: DataFrame, scratch: Scratch, k: int = 10, query_block: tuple[int, int] = QUERY_BLOCK, candidate_block: tuple[int, int] = CANDIDATE_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score of each query row's k best rows other than itself.

    Vectors that are null, empty, non-finite or without an id take no part; vectors of another length
    than the query's are not compared with it. Repeated rows of one id count once for each row (a
    repeated query row asks once, other query rows of one id share its ranks). A query without any candidate gives no row. Every finite vector
    has exact scores and ranks; a score beyond the long range is shown as its nearest end.
    """
    rows, queries = rows.where(USABLE), queries.where(USABLE)
    stored, asked = packed_vectors(rows), packed_vectors(queries).dropDuplicates(["id", "packed"])
    qb, cb = _blocks(queries.count(), query_block), _blocks(rows.count(), candidate_block)
    block = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    placed = asked.select("dim", block(qb).alias("qb"), "id", "packed")
    held = stored.select("dim", F.explode(F.sequence(F.lit(0), F.lit(qb - 1))).alias("qb"), block(cb).alias("cb"), "id", "packed")
    shape = "query_id long, vec_id long, score long, key binary"
    keys = ("dim", "qb", "cb")

    def met(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_meet(k), shape)

    first = placed.withColumns({"cb": F.lit(0), "floor": F.lit(None).cast("long")})
    found = met(first, held.where("cb = 0"))
    if cb > 1:
        found = scratch.put(found, "first_block")
        floors = found.groupBy("query_id").agg(F.when((F.count("*") >= k) & (F.min("score") > -LONG - 1), F.min("score")).alias("floor"))  # a score clamped from above is still a floor
        later = placed.join(floors, F.col("id") == F.col("query_id"), "left").withColumn("cb", F.explode(F.sequence(F.lit(1), F.lit(cb - 1)))).select(*keys, "id", "packed", "floor")
        found = found.union(met(later, held.where("cb > 0")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("key"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

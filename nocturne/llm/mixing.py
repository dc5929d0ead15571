"""Mixing sources to target weights: exact block quotas dealt by a multivariate-hypergeometric tree.

1. A permutation hash of id, text and source puts each document of a source into one of its blocks
   (bounded in number over all sources). Sizes are summed per source and per block, with partial sums
   before the shuffle.
2. A source's target is met by whole passes over its blocks and one partial pass in permuted order.
   The pass goes on to the first document that no longer fits, found by block, by sub-block and then
   among the documents of one sub-block; it continues behind it with the documents that still fit, and so
   on until next to nothing is left or the source ends. Rows that repeat one document share a place:
   where the pass ends among them, as many are taken as fit. At last the document whose size
   comes nearest to what is left is added, if that leaves less.
3. The drawn (block, pass) units of all sources are split among output shards: a tree over shard
   ranges draws each left half's share of every source from the multivariate hypergeometric
   distribution, with a seed per node. Leaves hold exact unit quotas; each source's permuted units
   are dealt to the shards in those numbers, so that shards are disjoint.
4. Inside a shard, documents are shuffled by a hash.

Everything is a function of (doc_id, text, source, seed): reruns agree. The driver holds a few rows a
source and at most MAX_BLOCKS block sums, whatever the documents; their number of sources has no cap.
Documents meet a broadcast of those rows, or beyond BROADCAST_SOURCES sources a salted join.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.discovery import numbered
from .shared import Scratch

MAX_BLOCKS = 32768  # over all sources, and one more for each source
SUB_BLOCKS = 1024
BROADCAST_SOURCES = 100_000  # sources whose few rows each are broadcast; more are joined by salted keys
MAX_SHARDS = MAX_BLOCKS // 8  # unless the caller asks for more: a shard should hold several units
SALTS = 16
EVERY = 1 << 62  # more words than any document has
RULES = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("lo", "hi", "most")]))
NEAR = 0.005  # the share of a target below which the pass needn't go on
PLACES = 1 << 37  # values of the permutation hash; times MAX_BLOCKS they are exact in doubles
WEIGHTS, SHARE, CEILING = (3.0, 1.0, 2.0), 1.5, 2.0
WORD = "[^\\x20\\x09-\\x0D]+"


def size_of(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, ceiling: float = CEILING) -> list[float]:
    """Words to take from each source: by weight, none above ``ceiling`` times its size.

    The excess of a stopped source is shared again by weight among the others until none is above.
    """
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    out, open_, left = [0.0] * len(sizes), list(range(len(sizes))), share * sum(sizes)
    while open_:
        total = sum(w[i] for i in open_)
        full = [i for i in open_ if left * w[i] / total > ceiling * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * w[i] / total
            break
        for i in full:
            out[i] = ceiling * sizes[i]
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return out


def deal(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """The shard of each unit, units in order of their source: each source's quota, and nearly equal totals a shard."""
    found: list[tuple[int, np.ndarray, np.ndarray]] = []

    def split(lo: int, hi: int, of: np.ndarray, left: np.ndarray) -> None:
        of, left = of[left > 0], left[left > 0]  # the tree holds no more than the units there are
        if not len(of):
            return
        if hi - lo == 1:
            found.append((lo, of, left))
            return
        mid, total = (lo + hi) // 2, int(left.sum())
        random = np.random.Generator(np.random.PCG64([seed, lo, hi]))
        first = random.multivariate_hypergeometric(left, total * (mid - lo) // (hi - lo), method="marginals")
        split(lo, mid, of, first)
        split(mid, hi, of, left - first)

    split(0, shards, np.arange(len(quotas)), quotas.astype(np.int64))
    if not found:
        return np.zeros(0, np.int64)
    shard = np.concatenate([np.full(len(of), s) for s, of, _ in found])
    source, n = np.concatenate([of for _, of, _ in found]), np.concatenate([c for _, _, c in found])
    order = np.lexsort((shard, source))
    return np.repeat(shard[order], n[order])


def _taken() -> Column:
    """Whether a document lies in its source's partial pass, by the rules (lo, hi, most words); places with numbered rows aside."""
    return F.exists("m_rules", lambda r: (F.col("place_") > r["lo"]) & (F.col("place_") <= r["hi"]) & (F.col("size") <= r["most"]))


def _drawn(rules: list[tuple[int, int, int]], places: list[int], blocks: int) -> list[int]:
    """Blocks of the partial pass: those that its rules reach over and those of the given places."""
    at = lambda x: min(int(np.floor(x * blocks / PLACES)), blocks - 1)
    return sorted({b for lo, hi, _ in rules if hi > lo for b in range(at(lo + 1), at(hi) + 1)} | {at(p) for p in places})


@dataclass
class Mix:
    """``rows``: doc (a struct of the document's own columns), size, source_size, target, copies and shards (one per copy)."""

    rows: DataFrame
    shards: int

    def drawn(self) -> DataFrame:
        """doc, copy, shard and place (the order inside the shard): one row per drawn copy."""
        copies = self.rows.select("doc", F.posexplode("shards").alias("copy", "shard"))
        return copies.withColumn("place", F.xxhash64("doc.doc_id", "copy", F.lit("place")))


def mix(docs: DataFrame, scratch: Scratch, shards: int | None = None, seed: int = 17, shard_words: int = 1 << 24) -> Mix:
    """Draws ``docs`` (doc_id, text, source, others) to the target weights.

    A null text has size 0; a document of size 0 is taken as often as its block is, and counts
    nothing. A null source is a source of its own, last in order. Rows that repeat an id are rows of
    their own: those with different texts or sources have different places, and of those with one text any number
    may be taken, the first by all their columns, so that targets are met however often a row repeats. An empty table gives no rows.
    All columns of docs stay in ``doc`` under their own names. No row has more than two copies.
    """
    spark = docs.sparkSession
    place = F.pmod(F.xxhash64("doc_id", F.xxhash64("text"), F.xxhash64("source"), F.lit(seed)), F.lit(PLACES))  # uniform
    sized = scratch.put(docs.select("source", size_of(F.col("text")).alias("size"), place.alias("place")), "sized")
    listed = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).orderBy(F.col("source").asc_nulls_last()).collect()  # a row a source
    sizes = [int(r["size"]) for r in listed]
    wanted, total = targets(sizes), max(1, sum(sizes))
    blocks = [max(1, min(int(r["n"]), round(MAX_BLOCKS * s / total))) for r, s in zip(listed, sizes, strict=True)]
    at = {r["source"]: i for i, r in enumerate(listed)}

    def a_row_each(rows: list[tuple], **fields: T.DataType) -> DataFrame:
        """A table with k_source first; ``rows`` gives the index of the source there."""
        schema = T.StructType([T.StructField("k_source", docs.schema["source"].dataType), *(T.StructField(n, t) for n, t in fields.items())])
        return spark.createDataFrame([(listed[r[0]]["source"], *r[1:]) for r in rows], schema)

    def meet(rows: DataFrame, source: str, few: DataFrame, *more: Column) -> DataFrame:
        """Joins ``few`` rows a source to many; of ``more`` conditions all must hold."""
        on = F.col(source).eqNullSafe(F.col("k_source"))
        for c in more:
            on &= c
        if len(listed) <= BROADCAST_SOURCES:
            return rows.join(F.broadcast(few), on).drop("k_source")
        salted = few.withColumn("k_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        return rows.withColumn("salt_", F.pmod(F.xxhash64("place"), F.lit(SALTS)).cast("int")).join(salted, on & (F.col("salt_") == F.col("k_salt"))).drop("k_source", "k_salt", "salt_")

    long, double = T.LongType(), T.DoubleType()
    known = a_row_each([(i, b) for i, b in enumerate(blocks)], m_blocks=long)
    block = F.floor(F.col("place") * F.col("m_blocks") / F.lit(PLACES))
    sub = F.floor((F.col("place") * F.col("m_blocks") / F.lit(PLACES) - block) * SUB_BLOCKS)
    placed = meet(sized, "source", known).select("source", "place", "size", block.alias("block"), sub.alias("sub"))

    def _first_over(open_: dict[int, tuple[int, int]], rest: list[float]) -> dict[int, tuple[int, int | None, int, int]]:
        """Of each open source: words before the first place that doesn't fit any more, that place (null: all fit), words of a row and rows there."""
        few = a_row_each([(i, lo, most) for i, (lo, most) in open_.items()], o_lo=long, o_most=long)
        eligible = meet(placed, "source", few, F.col("place") > F.col("o_lo"), F.col("size") <= F.col("o_most"))
        by_block: dict[int, list[tuple[int, int]]] = {i: [] for i in open_}
        for r in eligible.groupBy("source", "block").agg(F.sum("size").alias("size")).collect():  # at most MAX_BLOCKS and a row a source
            by_block[at[r["source"]]].append((r["block"], r["size"]))
        out, found = {i: (sum(s for _, s in by), None, 0, 0) for i, by in by_block.items()}, []
        for i, by in by_block.items():
            held = 0
            for b, s in sorted(by):
                if held + s > rest[i]:
                    found.append((i, b, rest[i] - held))
                    out[i] = (held, None, 0, 0)
                    break
                held += s
        for key in ("sub", "place"):
            if not found:
                return out
            if key == "sub":
                cut = a_row_each(found, e_block=long, e_rest=double)
                inside = meet(eligible, "source", cut, F.col("block") == F.col("e_block"))
            else:
                cut = a_row_each(found, e_block=long, e_sub=long, e_rest=double)
                inside = meet(eligible, "source", cut, F.col("block") == F.col("e_block"), F.col("sub") == F.col("e_sub"))
            sums = inside.groupBy("source", key, "e_rest").agg(F.sum("size").alias("size"), F.max("size").alias("most"), F.count("*").alias("n"))
            upto = F.sum("size").over(Window.partitionBy("source").orderBy(key))  # SUB_BLOCKS rows a source, then the places of one sub-block
            first = sums.withColumn("upto", upto).where(F.col("upto") > F.col("e_rest")).groupBy("source").agg(F.min(F.struct(key, "upto", "size", "most", "n")).alias("x"))
            blocks_of, found = {f[0]: f for f in found}, []
            for r in first.collect():  # a row a source
                i, x = at[r["source"]], r["x"]
                before = x["upto"] - x["size"]
                held = out[i][0] + before
                out[i] = (held, None, 0, 0)
                if key == "sub":
                    found.append((i, blocks_of[i][1], x["sub"], blocks_of[i][2] - before))
                else:
                    out[i] = (held, x["place"], x["most"], x["n"])
        return out

    passes = [int(t // s) if s else 1 for s, t in zip(sizes, wanted, strict=True)]
    rest = [float(t - p * s) for s, t, p in zip(sizes, wanted, passes, strict=True)]
    rules: list[list[tuple[int, int, int]]] = [[] for _ in listed]
    among: list[dict[int, int]] = [{} for _ in listed]  # rows taken of a place
    partial = [i for i, s in enumerate(sizes) if s and passes[i] < CEILING]
    open_ = {i: (-1, EVERY) for i in partial}  # where the pass goes on, and the most words that a document may have
    while open_:
        over = _first_over(open_, rest)
        after = {}
        for i, (lo, most) in open_.items():
            held, stop, one, n = over[i]
            rest[i] -= held
            rules[i].append((lo, PLACES if stop is None else stop - 1, most))
            if stop is None:
                continue
            if n > 1 and (take := int(rest[i] // one)):
                among[i][stop] = take
                rest[i] -= take * one
            if rest[i] > max(NEAR * wanted[i], 1):
                after[i] = (stop, int(rest[i]))
        open_ = after
    few = a_row_each([(i, rest[i], [*rules[i]], among[i]) for i in partial if rest[i] > 0], gap=double, m_rules=RULES, m_among=T.MapType(long, long))
    left = meet(placed.withColumn("place_", F.col("place")), "source", few).where((F.col("size") > 0) & (F.col("size") < 2 * F.col("gap")))
    left = left.where(F.coalesce(F.element_at("m_among", F.col("place_")), F.when(_taken(), EVERY).otherwise(0)) < EVERY)
    left = left.groupBy("source", "place_", "gap", F.coalesce(F.element_at("m_among", F.col("place_")), F.lit(0)).alias("took")).agg(F.max("size").alias("size"), F.count("*").alias("n")).where("took < n")
    nearest = left.groupBy("source").agg(F.min(F.struct(F.abs(F.col("gap") - F.col("size")), "place_")).alias("x"))
    for r in nearest.collect():  # a row a source
        own = among[at[r["source"]]]
        own[r["x"]["place_"]] = own.get(r["x"]["place_"], 0) + 1

    # units: (source, block, pass); the partial pass has the blocks that it draws from
    units = [(i, b, p) for i in range(len(listed)) for p in range(passes[i] + 1) for b in (range(blocks[i]) if p < passes[i] else _drawn(rules[i], list(among[i]), blocks[i]))]
    shards = shards or max(1, min(-(-round(SHARE * total) // shard_words), MAX_SHARDS))
    quotas = np.bincount([u[0] for u in units], minlength=len(listed)) if units else np.zeros(len(listed), np.int64)
    dealt = deal(quotas, shards, seed)
    home: dict[tuple[int, int], list[int]] = {}
    start = 0
    for i, q in enumerate(quotas.tolist()):
        order = np.random.Generator(np.random.PCG64([seed, i])).permutation(q)
        for u, shard in zip(order.tolist(), dealt[start : start + q].tolist(), strict=True):
            _, b, p = units[start + u]
            home.setdefault((i, b), [0] * 3)[p] = shard + 1
        start += q
    table = [(i, b, sizes[i], wanted[i], passes[i], rules[i], among[i], [x - 1 for x in home.get((i, b), [0] * 3)]) for i in range(len(listed)) for b in range(blocks[i])]
    plan = a_row_each(table, m_block=long, source_size=long, target=double, m_passes=long, m_rules=RULES, m_among=T.MapType(long, long), m_home=T.ArrayType(long))

    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col("source").alias("source_"), size_of(F.col("text")).alias("size"), place.alias("place"))
    rows = meet(rows, "source_", known)
    rows = rows.withColumns({"b_": block, "place_": F.col("place")})
    rows = meet(rows, "source_", plan, F.col("b_") == F.col("m_block"))
    if any(among):  # the rows of each such place are numbered, and the first ones taken
        shared = F.map_contains_key("m_among", F.col("place_"))
        few = a_row_each([(i, p, n) for i, own in enumerate(among) for p, n in own.items()], a_place=long, a_take=long)
        every = numbered(rows.where(shared).withColumns({"place": F.col("place_"), "like": F.xxhash64(F.to_json("doc"))}), "source_", "place", "like", work=scratch)
        first = every.groupBy(F.col("source_").alias("f_source"), F.col("place").alias("f_place")).agg(F.min("det_idx").alias("first"))  # a row for each row of few
        every = meet(every, "source_", few, F.col("place") == F.col("a_place")).join(first, F.col("source_").eqNullSafe(F.col("f_source")) & (F.col("place") == F.col("f_place")))
        taken = every.withColumn("more", F.col("det_idx") - F.col("first") < F.col("a_take"))
        rows = rows.where(~shared).withColumn("more", _taken()).select(*(keep := ["doc", "size", "source_size", "target", "m_passes", "m_home", "more"])).union(taken.select(*keep))
    else:
        rows = rows.withColumn("more", _taken())
    rows = rows.withColumn("copies", (F.col("m_passes") + F.col("more").cast("int")).cast("int"))
    scratch.drop("sized")
    return Mix(rows.select("doc", "size", "source_size", "target", "copies", F.slice("m_home", 1, F.col("copies")).alias("shards")), shards)

"""Exact n-gram Jaccard join on a token-group matrix.

Documents are sets of hashed k-word shingles. Documents of equal sets form a class with one
representative. Tokens have one global order: those whose sketch bucket is crowded come last, then
by hash; two sets of Jaccard t or more share a token among their first n - ceil(t n) + 1 ones (the
signature).

Groups. Similar documents are partitioned into groups: a document is compared with a few leaders
(per signature token the documents of least hash under several permutations); those linked by whole
sets form components, and a document without a link joins the group of the leader with which it
shares most tokens. The token-group matrix holds each group's union of signature tokens with its
least and largest set size.

Bound and open. A document's tokens are joined with the matrix of the groups it isn't in. The number
of shared signature tokens bounds the overlap with any member from above; groups that may still
hold a partner are opened: their members' whole sets, in blocks, meet the document's set. Of two
groups the smaller asks; an unlinked document asks its own group too. A block returns a spanning
forest of the components that its links join, not the links. No link between different texts is
lost, while pairs inside a group are never formed.

Hashes have 64 bits (sets are told apart by 128); equal hashes are taken as equal shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch, components, make_room
from .textbytes import mix, shingle_sets, slices

SKETCH_BITS = (16, 26)  # least and most; the bitmap of crowded buckets has at most 8 MB
SKETCHED = 0.4  # share of the hash range that is counted: signatures hardly reach beyond
LEADERS = 4  # candidates for leaders by token; of all that a document meets it asks ASKED
ASKED = 2
BLOCK = 256  # members or askers that meet at once
BLOOM_BITS = 23


def ceil_share(n, percent: int):
    """ceil(percent n / 100) in integers, for numbers and arrays."""
    return -(-percent * n // 100)


def signature_size(n: int, percent: int) -> int:
    return n - ceil_share(n, percent) + 1


def size_bits(docs: DataFrame) -> int:
    """About the logarithm of an eighth of the tokens, by the size of the files that docs reads."""
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return (size // 120).bit_length()


def crowded(docs: DataFrame, k: int) -> tuple[int, bytes]:
    """(bits, bitmap over 2^bits token buckets): set where a bucket counts over twice the mean plus 12.

    Only an order hint: a bucket's state never changes a result. Counts cover all documents. Tasks
    send sorted 16-bit offsets by chunk of the buckets; a chunk's counts are added up in a stream.
    """
    bits = min(max(size_bits(docs), SKETCH_BITS[0]), SKETCH_BITS[1])
    limit = np.uint64(int(SKETCHED * 2**64))

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        buckets = np.sort(np.concatenate([np.zeros(0, np.uint64), *held]) >> np.uint64(64 - bits))
        chunks, starts = np.unique(buckets >> np.uint64(16), return_index=True)
        low = (buckets & np.uint64(0xFFFF)).astype(np.uint16)
        return pa.RecordBatch.from_arrays([pa.array(chunks.astype(np.int32)), pa.array([x.tobytes() for x in np.split(low, starts[1:])] if len(chunks) else [], pa.binary())], ["chunk", "offsets"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        held, n = [], 0
        for batch in batches:
            text = batch.column(0)
            for lo, hi in slices(text):
                for s in shingle_sets(text.slice(lo, hi - lo), k):
                    held.append(s[: np.searchsorted(s, limit)].copy())  # a view would keep the whole set
                    n += len(held[-1])
                if n > 4_000_000:
                    yield flush(held)
                    held, n = [], 0
        yield flush(held)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part = np.bincount(np.frombuffer(raw.as_py(), np.uint16), minlength=65536)
                total[c] = total[c] + part if c in total else part
        mean = [float(v.sum()) for v in total.values()]
        full = [np.packbits(v > 2 * m / 65536 + 12).tobytes() for v, m in zip(total.values(), mean, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(full, pa.binary())], ["chunk", "full"])

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = docs.select("text").mapInArrow(count, "chunk int, offsets binary").repartition(parts, "chunk").mapInArrow(add, "chunk int, full binary")
    bitmap = bytearray(1 << (bits - 3))
    for r in found.toLocalIterator():  # 2^bits bits in all, whatever the corpus
        bitmap[r["chunk"] * 8192 : (r["chunk"] + 1) * 8192] = r["full"]
    return bits, bytes(bitmap)


def profiles(docs: DataFrame, k: int, percent: int, bits: int, bitmap: bytes) -> DataFrame:
    """doc_id, n, d1, d2 (set digest) and signature of each row.

    Signature tokens are cut to 16 bits more than the corpus has tokens by its size: rare collisions
    only add candidates, and posting lists are a third smaller.
    """
    cut = np.uint64(max(1, 64 - (size_bits(docs) + 19)))
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        late = np.unpackbits(np.frombuffer(shared.value, np.uint8)).view(bool)
        for batch in batches:
            text = batch.column(1)
            for lo, hi in slices(text):
                n, d1, d2, sig = [], [], [], []
                for s in shingle_sets(text.slice(lo, hi - lo), k):
                    n.append(len(s))
                    d1.append(int(s.sum(dtype=np.uint64).astype(np.int64)))
                    d2.append(int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)))
                    take = signature_size(len(s), percent) if len(s) else 0
                    slow = late[(s >> np.uint64(64 - bits)).astype(np.int64)]
                    first = s[~slow][:take]
                    sig.append((np.concatenate([first, s[slow][: take - len(first)]]) >> cut).view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(sig, pa.list_(pa.int64()))], ["doc_id", "n", "d1", "d2", "sig"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, d1 long, d2 long, sig array<long>")


def wanted_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """doc, tokens (packed sorted hashes) of at least the documents in ``wanted`` (doc).

    A bitmap of fixed size over the wanted ids spares the others the work; the few that get through
    by chance are dropped by the join that follows.
    """
    bits = 1 << BLOOM_BITS
    spot = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    words = wanted.select(spot(F.col("doc")).alias("b")).groupBy(F.floor(F.col("b") / 64).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 64 as int))")).alias("bits"))
    bitmap = np.zeros(bits // 64, np.int64)
    for r in words.toLocalIterator():  # bits / 64 rows at most
        bitmap[r["w"]] = r["bits"]
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = batch.column(2).to_numpy()
            on = pa.array(((shared.value[b >> 6] >> (b & 63)) & 1).astype(bool))
            ids, text = batch.column(0).filter(on), batch.column(1).filter(on)
            for lo, hi in slices(text):
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array([s.tobytes() for s in shingle_sets(text.slice(lo, hi - lo), k)], pa.binary())], ["doc", "tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null").withColumn("b", spot(F.col("doc_id"))).mapInArrow(run, "doc long, tokens binary")


def spanning(pairs: Iterator[tuple[int, int, int, int]]) -> Iterator[tuple[int, int]]:
    """Of links (doc, its component, partner, its component) those that join components not yet joined here."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = parent[x]
        return x

    for u, cu, v, cv in pairs:
        a, b = root(cu), root(cv)
        if a != b:
            parent[max(a, b)] = min(a, b)
            yield u, v


def verified(asks: DataFrame, members: DataFrame, docs: DataFrame, k: int, percent: int, scratch: Scratch, name: str) -> DataFrame:
    """Opens groups: links (u, v) that join the components of asking documents and of partners.

    ``asks`` has (doc, comp, grp), ``members`` (grp, doc, comp). Members and askers of a group meet in
    blocks of BLOCK by BLOCK, so that neither a large group nor one that many ask fills a task. Each
    document's set is made once, meets its routes by id and goes to its blocks.
    """
    sized = lambda df, n: df.groupBy("grp").agg(F.ceil(F.count("*") / BLOCK).alias(n))
    spread = lambda n, seed: F.pmod(F.xxhash64("doc", F.lit(seed)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), (F.col(n) - 1).cast("int")))
    counts = sized(asks, "nq").join(sized(members, "nm"), "grp")
    left = asks.join(counts, "grp").withColumn("qb", spread("nq", 1)).withColumn("mb", every("nm")).withColumn("asks", F.lit(True))
    right = members.join(counts, "grp").withColumn("mb", spread("nm", 2)).withColumn("qb", every("nq")).withColumn("asks", F.lit(False))
    columns = ["doc", "comp", "grp", "qb", "mb", "asks"]
    routes = scratch.put(left.select(*columns).union(right.select(*columns)), f"routes_{name}")
    routed = wanted_sets(docs, routes.select("doc"), k).join(routes, "doc")

    def links(asked: pa.Table, held: pa.Table) -> Iterator[tuple[int, int, int, int]]:
        ids, comps = held["doc"].to_numpy(), held["comp"].to_numpy()
        rows = [np.frombuffer(x, np.uint64) for x in held["tokens"].to_pylist()]
        n = np.array([len(r) for r in rows])
        tokens, owner = np.concatenate(rows), np.repeat(np.arange(len(rows)), n)
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        for doc, comp, raw in zip(asked["doc"].to_pylist(), asked["comp"].to_pylist(), asked["tokens"].to_pylist(), strict=True):
            mine = np.frombuffer(raw, np.uint64)
            lo, hi = np.searchsorted(tokens, mine, "left"), np.searchsorted(tokens, mine, "right")
            spans = hi - lo
            at = np.repeat(lo - np.concatenate([[0], np.cumsum(spans)[:-1]]), spans) + np.arange(spans.sum())
            common = np.bincount(owner[at], minlength=len(rows))
            for i in np.flatnonzero((100 * common >= percent * (n + len(mine) - common)) & (ids != doc)):
                yield doc, comp, int(ids[i]), int(comps[i])

    def meet(block: pa.Table) -> pa.Table:
        on = block["asks"].combine_chunks()
        asked, held = block.filter(on), block.filter(pc.invert(on))
        found = list(spanning(links(asked, held))) if asked.num_rows and held.num_rows else []
        return pa.table({"u": pa.array([u for u, _ in found], pa.int64()), "v": pa.array([v for _, v in found], pa.int64())})

    links_ = scratch.put(routed.groupBy("grp", "qb", "mb").applyInArrow(meet, "u long, v long"), f"links_{name}")
    scratch.drop(f"routes_{name}")
    return links_


def _need(n: Column, m: Column, percent: int) -> Column:
    """Shared signature tokens that sets of n and m tokens have at least if they are partners."""
    common = F.ceil(F.lit(percent) * (n + m) / F.lit(100 + percent))
    beyond = F.ceil(F.lit(percent) * F.greatest(n, m) / F.lit(100)) - 1
    return F.greatest(F.lit(1), common - beyond - 1)


def similar_groups(docs: DataFrame, scratch: Scratch, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id of each row of docs (doc_id, text).

    Words are runs of bytes other than 20 and 09-0D, A-Z lower-cased; whole texts. Null, empty and
    blank texts have an empty set and link with nothing; a text of fewer than k words is one shingle.
    Rows that repeat a doc_id are distinct rows of one document: they share a component when their
    sets do. A null doc_id is its own component. More columns of docs are ignored.
    """
    rows = scratch.put(profiles(docs, k, percent, *crowded(docs, k)), "profiles")
    classes = rows.where("n > 0 and doc_id is not null").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    classes = scratch.put(classes, "classes")
    reps = rows.join(classes.select("n", "d1", "d2", F.col("rep").alias("doc_id")), ["n", "d1", "d2", "doc_id"], "left_semi")
    # one exchange by token serves the count, the filter and the leaders of shared tokens
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = reps.select(F.col("doc_id").alias("doc"), "n", F.explode("sig").alias("token")).repartition(parts, "token")
    shared = every.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    several = every.join(shared, "token")
    lead = [F.min_by(F.struct("doc", "n"), F.xxhash64("doc", F.lit(i))).alias(f"l{i}") for i in range(LEADERS)]
    posted = scratch.put(several.join(several.groupBy("token").agg(*lead), "token"), "posted")
    rows = scratch.put(rows.drop("sig"), "slim")
    scratch.drop("profiles")

    leaders = posted.select("doc", "n", "df", F.explode(F.array_distinct(F.array(*[f"l{i}" for i in range(LEADERS)]))).alias("l"))
    one_way = (F.col("doc") > F.col("l.doc")) | ((F.col("doc") < F.col("l.doc")) & (F.col("df") > 2))  # of two documents one asks
    pairs = leaders.where(one_way).groupBy("doc", "n", F.col("l.doc").alias("grp"), F.col("l.n").alias("m")).agg(F.count("*").alias("c"))
    fits = (F.col("c") >= _need(F.col("n"), F.col("m"), percent)) & (100 * F.least("n", "m") >= percent * F.greatest("n", "m"))
    best = F.row_number().over(Window.partitionBy("doc").orderBy(F.desc("c"), "grp"))  # the most promising leaders; the matrix finds what they miss
    asks = pairs.where(fits).withColumn("best", best).where(F.col("best") <= ASKED).select("doc", F.col("doc").alias("comp"), "grp", "c")
    asks = scratch.put(asks, "asks_0")
    own = asks.select("grp").distinct().select("grp", F.col("grp").alias("doc"), F.col("grp").alias("comp"))
    links = verified(asks.drop("c"), own, docs, k, percent, scratch, "0")
    linked = scratch.put(components(links, scratch, "groups"), "linked")
    nearest = asks.groupBy("doc").agg(F.max_by("grp", F.struct("c", -F.col("grp"))).alias("leader"))
    of_leader = linked.select(F.col("node").alias("leader"), F.col("root").alias("leader_root"))
    nearest = nearest.join(of_leader, "leader", "left").select("doc", F.coalesce("leader_root", "leader").alias("near"))

    # the matrix: union of signature tokens, with set sizes, of each group
    placed = posted.select("doc", "n").distinct().join(linked.select(F.col("node").alias("doc"), "root"), "doc", "left").join(nearest, "doc", "left")
    placed = placed.select("doc", F.coalesce("root", "doc").alias("comp"), F.coalesce("root", "near", "doc").alias("grp"), (F.col("root").isNull() & F.col("near").isNotNull()).alias("loose"))
    weight = placed.groupBy("grp").agg(F.count("*").alias("size"))
    placed = scratch.put(placed.join(weight, "grp"), "placed")
    in_group = scratch.put(posted.select("doc", "n", "token").join(placed, "doc"), "in_group")
    matrix = in_group.groupBy("token", "grp", "size").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.max("loose").alias("open"))
    several = matrix.groupBy("token").agg(F.count("*").alias("g"), F.max("open").alias("open")).where("g > 1 or open").select("token")
    matrix = scratch.put(matrix.drop("open").join(several, "token"), "matrix")
    asked = in_group.select("token", "doc", "comp", "n", "loose", F.col("grp").alias("own"), F.col("size").alias("own_size")).join(several, "token", "left_semi")
    smaller = (F.col("own") != F.col("grp")) & ((F.col("own_size") < F.col("size")) | ((F.col("own_size") == F.col("size")) & (F.col("own") > F.col("grp"))))
    met = asked.join(matrix, "token").where(smaller | (F.col("loose") & (F.col("own") == F.col("grp")))).groupBy("doc", "comp", "n", "grp").agg(F.count("*").alias("c"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    low = F.greatest(F.col("lo"), F.ceil(F.lit(percent) * F.col("n") / 100))
    high = F.least(F.col("hi"), F.floor(F.lit(100) * F.col("n") / percent))
    bound = F.least(_need(F.col("n"), low, percent), _need(F.col("n"), high, percent))
    asks = scratch.put(met.where((low <= high) & (F.col("c") >= bound)).select("doc", "comp", "grp"), "asks_1")
    opened = scratch.put(placed.select("grp", "doc", "comp").join(asks.select("grp").distinct(), "grp", "left_semi"), "opened")
    more = verified(asks, opened, docs, k, percent, scratch, "1")
    scratch.drop("posted", "placed", "in_group", "matrix", "asks_0", "asks_1", "opened")

    roots = scratch.put(components(links.union(more), scratch, "roots"), "final")
    several = classes.join(roots, F.col("rep") == F.col("node"), "left").where("copies > 1 or root is not null").select("n", "d1", "d2", F.coalesce("root", "rep").alias("root"))
    salted = several.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(15))))  # a class of millions is joined in 16 parts
    slim = rows.select("doc_id", "n", "d1", "d2", F.when(F.col("doc_id").isNotNull(), F.pmod(F.xxhash64("doc_id"), F.lit(16))).cast("int").alias("salt"))
    return slim.join(salted, ["n", "d1", "d2", "salt"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "doc_id").alias("component_id"))

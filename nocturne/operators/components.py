"""Intermediate tables in the shared folder, and connected components by forests and star contraction."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; on a local master that sets none (tests), a folder of the warehouse.

    A cluster has to name one: a folder of one machine would be empty for the others.
    """
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder
    if not (spark.sparkContext.master + "[").startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
    return f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"


class Workspace:
    """Parquet tables in the shared folder that cut lineage; they survive the loss of executors.

    ``put`` writes a table and returns it re-read; ``drop`` deletes tables that nothing will read
    again, ``clear`` all of them. Tables that a returned lazy frame still reads must not be dropped:
    who gets such a frame from a function calls ``clear`` on the workspace it gave once the rows are
    stored elsewhere.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/nocturne-{uuid.uuid4().hex}"

    def put(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """Stores ``df``, with a folder for each value of column ``by``, and reads it again."""
        path = f"{self.root}/{name}"
        writer = df.repartition(by).write.partitionBy(by) if by else df.write
        writer.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            self._delete(f"{self.root}/{name}")

    def clear(self) -> None:
        self._delete(self.root)

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def spread(rows: DataFrame, key: str, small: int = 1 << 30) -> DataFrame:
    """Deals out rows of a small table, whose file may be one block, over all cores; a large one has blocks enough."""
    if int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) > small:
        return rows
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism, key)


FOREST = 1_000_000  # nodes of a forest in memory; further edges of a partition begin another one


def _forests(edges: DataFrame) -> DataFrame:
    """Edges (node, least) of each partition's own components: fewer edges, the same components overall."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict = {}

        def root(x):
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = parent[up]
                x = parent[x]
            return x

        def found(schema: pa.Schema) -> pa.RecordBatch:
            rows = [(n, r) for n in list(parent) if (r := root(n)) != n]
            parent.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], schema.field(i).type) for i in (0, 1)], ["u", "v"])

        schema = None
        for batch in batches:
            schema = batch.schema
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = root(u), root(v)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            if len(parent) > FOREST:
                yield found(schema)
        if parent:
            yield found(schema)

    return edges.mapInArrow(run, edges.schema)


def connected_components(edges: DataFrame, work: Workspace | None = None, name: str = "cc", native: bool = False, finish: int = 0) -> DataFrame:
    """node, root (the least node reachable) of undirected edges (u, v) of one integer or string type.

    Every partition first joins what its own edges join (left out if ``native``, which keeps to
    DataFrame functions); then large-star and small-star contraction alternate until only stars about
    their least node are left. Each round is a grouped minimum (combined before the shuffle, so a hub
    with millions of neighbours costs one row per task) and a join on the node; rounds grow with the
    logarithm of the graph, however long its paths. Self-loops and repeated edges are ignored; an edge
    with a null end is dropped. An empty input gives no rows. The last round's table stays in
    ``work``, as the result reads it. As soon as no more than ``finish`` edges are left, a number
    whose forest fits a task, one task ends the work.
    """
    work = work or Workspace(edges.sparkSession)

    def star(e: DataFrame, larger_only: bool) -> DataFrame:
        both = e if larger_only else e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        moved = both.join(least, "u")
        if larger_only:  # u > v: v and u itself go to the least neighbour
            out = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        else:  # larger neighbours go to the least one
            out = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def done(e: DataFrame) -> bool:
        """Whether every node has one edge to a least node, which has none itself."""
        ends = e.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("v", F.lit(0), F.lit(1)))
        return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)").isEmpty()

    now = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now, i = work.put(now.distinct() if native else _forests(now).distinct(), f"{name}_0"), 0
    while True:
        if few := finish and now.count() <= min(finish, FOREST // 2):
            now = work.put(_forests(now.coalesce(1)), f"{name}_{i + 1}")
            work.drop(f"{name}_{i}")
        if few or done(now):
            break
        i += 1
        now = work.put(star(star(now, False), True), f"{name}_{i}")
        work.drop(f"{name}_{i - 1}")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

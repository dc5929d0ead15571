"""A night as a stream: windowed quality figures, sessions and incremental ingestion.

Queries run with ``availableNow`` over a folder of files and write tables in the shared folder. Oracle-checked ones use
complete mode, which keeps sessions that are still open behind the last watermark; production jobs should
use append mode, which drops the state of windows behind the watermark.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.components import shared_folder


def exactly(path: str) -> str:
    """A pattern that ``path`` alone matches: file streams take a folder as it is, but a single file only by a pattern."""
    path = re.sub(r"([\[\]{}*?\\])", r"\\\1", path.rstrip("/"))
    return f"{path[:-1]}[{path[-1]}]"


def events_stream(spark: SparkSession, path: str, watermark: str = "1 hour") -> DataFrame:
    """Events as they arrive, late rows dropped beyond the watermark in append mode."""
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).parquet(exactly(path))
    return stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)


def run_available(spark: SparkSession, df: DataFrame, mode: str = "complete") -> DataFrame:
    """Runs a streaming query over what there is into a table of the shared folder and reads it.

    In complete mode each batch replaces the table, in append mode it adds its own rows as a partition of its
    number, which a batch that is taken again replaces.
    """
    folder = f"{shared_folder(spark)}/night_{uuid.uuid4().hex}"
    spark.createDataFrame([], df.schema).write.parquet(f"{folder}/rows")  # stands if no batch comes

    def put(batch: DataFrame, number: int) -> None:
        if mode == "complete":
            batch.write.mode("overwrite").parquet(f"{folder}/rows")
        else:
            batch.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{folder}/rows")

    q = df.writeStream.foreachBatch(put).outputMode(mode).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/rows")


def windowed_qa(spark: SparkSession, path: str) -> DataFrame:
    """Daily tumbling windows per event type: count, total and top value."""
    agg = events_stream(spark, path).groupBy(F.window("ts", "1 day"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"), F.max("value").alias("top"))
    return run_available(spark, agg).select(F.col("window.start").cast("timestamp_ntz").alias("day"), "event_type", "n", F.round("total", 4).alias("total"), F.round("top", 6).alias("top"))


def sessions(spark: SparkSession, path: str, gap: str = "30 minutes") -> DataFrame:
    """Activity sessions per user: start, count and total."""
    agg = events_stream(spark, path).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return run_available(spark, agg).select("user_id", F.col("session_window.start").cast("timestamp_ntz").alias("started"), "n", F.round("total", 4).alias("total"))


def ingest_catalogues(spark: SparkSession, folder: str, target: str, checkpoint: str, schema: str):
    """Appends new per-frame catalogues to the night's table, each file once."""
    stream = spark.readStream.schema(schema).parquet(folder)
    return stream.writeStream.format("parquet").outputMode("append").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

"""Keeps the text index of the observing notes up to date, taking only files that are new.

    python -m jobs.note_index --documents notes/ --out index/ --checkpoint index_state/ --config jobs/note_index.json

A file stream lists the folder of notes and hands over what its checkpoint has not seen, some files a
batch. Each batch becomes a segment of the passage index (``nocturne.operators.retrieval``): passages,
vectors, postings and terms, partitioned by segment. A batch that was cut off is taken again under its number
and replaces its own segment only; with nothing new the job ends without writing. The index answers
questions at once: ``PassageIndex(spark, out, key_type).search("...")``.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nocturne.operators.retrieval import PassageIndex, chunk_documents
from nocturne.streaming.night_stream import exactly

from .common import command_line

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Settings:
    """``key``, ``source`` and ``text`` name columns of the documents; ``words`` and ``overlap`` cut passages."""

    key: str = "doc_id"
    source: str = "source"
    text: str = "text"
    words: int = 220
    overlap: int = 40
    files_per_batch: int = 1000


def run(spark: SparkSession, documents: str, out: str, checkpoint: str, settings: Settings = Settings()) -> dict[str, int]:
    """Indexes the new files of ``documents`` (Parquet, a file or a folder); gives batches, documents read and passages written.

    Rows without text give no passage. A document that comes again in another file is indexed again, beside the
    older one.
    """
    schema = spark.read.parquet(documents).select(settings.key, settings.source, settings.text).schema
    index = PassageIndex(spark, out, schema[settings.key].dataType.simpleString())
    index.create()

    def take(batch: DataFrame, number: int) -> None:
        index.add(chunk_documents(batch, settings.key, settings.source, settings.text, settings.words, settings.overlap), number)
        log.info("wrote segment %d of %s", number, out)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", settings.files_per_batch).parquet(exactly(documents))
    query = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    progress = [p for p in query.recentProgress if p["numInputRows"]]
    batches = sorted({p["batchId"] for p in progress})
    told = {"batches": len(batches), "documents": 0, "passages": index.table("passages").where(F.col("segment").isin(batches)).count()}
    for p in progress:  # a row a batch
        told["documents"] += p["numInputRows"]
        log.info("batch %d: read %d rows", p["batchId"], p["numInputRows"])
    log.info("read %d new documents of %s, wrote %d passages in %d segments", told["documents"], documents, told["passages"], told["batches"])
    return told


def output(spark: SparkSession, out: str, key_type: str) -> DataFrame:
    """key, pos, source, term, c and df over all segments: the terms of each passage, with what belongs to them.

    Passages meet their sources before their terms are written out, so that terms are not shuffled for it.
    """
    index = PassageIndex(spark, out, key_type)
    frequency = index.table("terms").groupBy("term").agg(F.sum("df").alias("df"))
    passages = index.table("passages").select("segment", "key", "pos", "source")
    counts = index.table("vectors").join(passages, ["segment", "key", "pos"])
    flat = counts.select("key", "pos", "source", F.explode("counts").alias("x")).select("key", "pos", "source", "x.term", "x.c")
    return index.looked_up(flat, frequency).select("key", "pos", "source", "term", "c", "df")


if __name__ == "__main__":
    paths = {"documents": "Parquet file or folder of notes", "out": "folder of the index", "checkpoint": "folder of the stream's checkpoint"}
    command_line("note_index", paths, run, Settings)

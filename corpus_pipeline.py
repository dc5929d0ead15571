"""A corpus pipeline of five operators: language, near duplicates, personal data, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nocturne.llm import jaccard_join, linear_models, mixing, pieces, pii
from nocturne.llm.queries import tokenizer_file
from nocturne.llm.shared import Scratch


_scratches: list[Scratch] = []  # of stages whose results nobody has stored yet


def _scratch(spark: SparkSession) -> Scratch:
    _scratches.append(Scratch(spark))
    return _scratches[-1]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language can be told; those without a letter (or text) go.

    ``lang`` becomes the predicted language. The model learns from the stage's own labelled rows.
    """
    found = linear_models.predict_language(docs.withColumn("text_", F.col("text")), docs.select("doc_id", "lang"), keep=("doc_id", "text_", "source", "n_chars"))
    kept = found.where("lang_pred <> 'und'")
    return kept.select("doc_id", F.col("text_").alias("text"), F.col("lang_pred").alias("lang"), "source", "n_chars")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of least id of each group of Jaccard 0.8 on five-word shingles."""
    scratch = _scratch(spark)
    groups = jaccard_join.similar_groups(docs, scratch, k=5, percent=80)
    lost = groups.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(lost, "doc_id", "left_anti").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces each span of personal data by its kind in brackets; n_chars follows the text."""
    found = pii.find(docs, keep=("doc_id", "lang", "source", "n_chars"), redacted=True)
    return found.select("doc_id", F.col("redacted").alias("text"), "lang", "source", F.coalesce(F.length("redacted"), F.lit(0)).cast("long").alias("n_chars"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per drawn copy, dealt to shards and shuffled inside each by a hash."""
    mix = mixing.mix(docs, _scratch(spark))
    drawn = mix.drawn()
    if mix.shards > 1:
        drawn = drawn.repartition("shard", F.pmod("place", F.lit(16)))
    return drawn.sortWithinPartitions("shard", "place").select("doc.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of each row, with source and lang; see op1."""
    return pieces.encode_documents(docs, tokenizer_file(), keep=("doc_id", "lang", "source"))


STAGES = [
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("PII", personal_data),
    ("mixing sources to target weights", mixed),
    ("SentencePiece encoding and decoding", tokens),
]

#: Stages learn models and walk trees, which SQL can't express; tests use brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again, and what its stage stored goes."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = scratch.put(stage(spark, docs, sf_dir), f"stage_{i}")
        while _scratches:
            _scratches.pop().clear()
        if i:
            scratch.drop(f"stage_{i - 1}")
    return docs

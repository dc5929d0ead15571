"""The thin queries op1 to op12, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, embedding_dedup, html_main, jaccard_join, linear_models, mixing, oracle, pieces, pii, topk, url_filter, warc
from .shared import Scratch, table

RULES = [
    url_filter.Rule.parse("block", "com/en/"),
    url_filter.Rule.parse("allow", "example.com/en/7"),
    url_filter.Rule.parse("block", "net/de/"),
    url_filter.Rule.parse("block", "example.net/de/8"),
    url_filter.Rule.parse("block", "org/es/"),
]


def tokenizer_file(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_sentencepiece(spark: SparkSession, sf_dir: str, model_file: str | None = None) -> DataFrame:
    return pieces.encode_documents(table(spark, sf_dir, "documents"), model_file or tokenizer_file())


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES, Scratch(spark))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = linear_models.fold_of(F.col("doc_id"), 3) == 1
    scored = linear_models.score_quality(docs, table(spark, sf_dir, "labels").where(~out))
    return scored.select("doc_id", (linear_models.fold_of(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), Scratch(spark), 0.9)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs, Scratch(spark)).rows.select("doc.doc_id", "size", "source_size", "target", (F.col("size") * F.size("shards")).alias("taken"), "doc.source", "shards")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_groups(table(spark, sf_dir, "documents"), Scratch(spark), k=4, percent=85)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(table(spark, sf_dir, "pages"), Scratch(spark))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = linear_models.fold_of(F.col("doc_id"), 4) == 2
    found = linear_models.predict_language(docs, docs.where(~out))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return topk.exact_top_k(rows, rows.where("vec_id % 100 = 0"), Scratch(spark))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"), Scratch(spark))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"), Scratch(spark)).drop("computed")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_sentencepiece, op2_url_filter, op3_quality, op4_embedding_dedup, op5_mixing, op6_jaccard_join, op7_html_extraction, op8_language_id, op9_pii, op10_exact_topk, op11_warc, op12_centroids)
}

ORACLE_SQL: dict[str, str] = {
    "op2_url_filter": oracle.url_filter_sql(RULES),
    "op4_embedding_dedup": oracle.VECTORS_SQL,
    "op6_jaccard_join": oracle.groups_sql(4, 85),
    "op10_exact_topk": oracle.TOP_K_SQL,
    "op11_warc": oracle.WARC_SQL,
    "op12_centroids": oracle.centroids_sql(40, 5),
}

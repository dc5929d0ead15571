"""Queries over documents, conversations and pages: passages, weights, retrieval, small text functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import retrieval
from ..operators.components import spread
from ..sources.knowledge import html_to_text
from .registry import query
from .views import load

QUESTION = "with the tion and thing of under the licence version"
STOPS = ", ".join(f"'{w}'" for w in text.STOP_WORDS)
SPACES = r"[\s\x1c-\x1f\x85]+"
CHUNKS_SQL = rf"""SELECT doc_id AS key, source, CAST((i - 1) // 180 AS INTEGER) AS pos, array_to_string(words[i:i + 219], ' ') AS passage FROM (
 SELECT doc_id, source, list_filter(regexp_split_to_array(text, '[\s\x0b\x1c-\x1f\x85]+'), lambda w: w <> '') AS words FROM documents WHERE text IS NOT NULL), unnest(range(1, len(words) + 1, 180)) AS t(i)
 WHERE length(array_to_string(words[i:i + 219], ' ')) > 80"""
TOKENS_SQL = f"SELECT key, pos, unnest(list_filter(regexp_extract_all(lower(passage), '[a-z0-9][a-z0-9_.\\-]{{1,}}'), lambda t: t NOT IN ({STOPS}))) AS token FROM ch"
STEM_ONCE = "CASE WHEN regexp_replace(t, '^(.{3,}?)(ing|ers|ies|ed|es|er|s)$', '\\1') <> t THEN regexp_replace(t, '^(.{3,}?)(ing|ers|ies|ed|es|er|s)$', '\\1') ELSE regexp_replace(t, '^(.{4,})[ey]$', '\\1') END"
STEMS_SQL = f"""st(token, t, n) AS (SELECT DISTINCT token, token, 0 FROM tk UNION ALL SELECT token, {STEM_ONCE}, n + 1 FROM st WHERE {STEM_ONCE} <> t), sm AS (SELECT token, arg_max(t, n) AS term FROM st GROUP BY 1)"""
COUNTS_SQL = f"ch AS ({CHUNKS_SQL}), tk AS ({TOKENS_SQL}), {STEMS_SQL}, ct AS (SELECT key, pos, term, count(*) AS c FROM tk JOIN sm USING (token) GROUP BY 1, 2, 3)"
WEIGHTS_SQL = f"{COUNTS_SQL}, nn AS (SELECT count(*) AS n FROM ch), idf AS (SELECT term, count(*) AS df, ln((1 + max(n)) / (1 + count(*))::DOUBLE) + 1 AS idf FROM ct, nn GROUP BY 1), x AS (SELECT key, pos, term, (1 + ln(c)) * idf AS x FROM ct JOIN idf USING (term)), w AS (SELECT key, pos, term, x / sqrt(sum(x * x) OVER (PARTITION BY key, pos)) AS w FROM x)"
QTOKENS = f"SELECT unnest(list_filter(regexp_extract_all('{QUESTION}', '[a-z0-9][a-z0-9_.\\-]{{1,}}'), lambda t: t NOT IN ({STOPS}))) AS token"
SEARCH_SQL = f"""{WEIGHTS_SQL}, qt AS ({QTOKENS}), qs(token, t, n) AS (SELECT DISTINCT token, token, 0 FROM qt UNION ALL SELECT token, {STEM_ONCE}, n + 1 FROM qs WHERE {STEM_ONCE} <> t),
 qm AS (SELECT arg_max(t, n) AS term, token FROM qs GROUP BY token), qc AS (SELECT term, count(*) * max(idf) AS x FROM qt JOIN qm USING (token) JOIN idf USING (term) GROUP BY 1), qv AS (SELECT term, x / sqrt(sum(x * x) OVER ()) AS q FROM qc),
 hits AS (SELECT key, pos, sum(w * q) AS score FROM w JOIN qv USING (term) GROUP BY 1, 2 ORDER BY round(sum(w * q), 9) DESC, key, pos LIMIT 6)"""


def chunks_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.chunk_documents(spread(load(spark, sf_dir, "documents").select("doc_id", "source", "text"), "doc_id"), "doc_id", "source")


@query(f"WITH ch AS ({CHUNKS_SQL}) SELECT key, pos, source, length(passage) AS n_chars, md5(passage) AS digest FROM ch")
def chunk_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks_of(spark, sf_dir).select("key", "pos", "source", F.length("passage").cast("long").alias("n_chars"), F.md5(F.col("passage").cast("binary")).alias("digest"))


@query(f"WITH RECURSIVE {COUNTS_SQL} SELECT key, pos, count(*) AS terms, sum(c)::BIGINT AS tokens FROM ct GROUP BY 1, 2")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.term_counts(chunks_of(spark, sf_dir)).groupBy("key", "pos").agg(F.count("*").alias("terms"), F.sum("c").alias("tokens"))


@query(f"WITH RECURSIVE ch AS ({CHUNKS_SQL}), tk AS ({TOKENS_SQL}), {STEMS_SQL} SELECT token, term FROM sm")
def stem_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = chunks_of(spark, sf_dir).select(F.explode(text.tokens(F.col("passage"))).alias("token")).distinct()
    return words.select("token", text.stem(F.col("token")).alias("term"))


@query(f"WITH RECURSIVE {COUNTS_SQL} SELECT term, count(*) AS df FROM ct GROUP BY 1")
def doc_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.document_frequency(retrieval.term_counts(chunks_of(spark, sf_dir)))


@query(f"WITH RECURSIVE {WEIGHTS_SQL} SELECT key, pos, count(*) AS terms, round(max(w), 6) AS top, round(sum(w), 5) AS total FROM w GROUP BY 1, 2")
def tfidf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.PassageIndex.build(chunks_of(spark, sf_dir), asked=False).weights().groupBy("key", "pos").agg(F.count("*").alias("terms"), F.round(F.max("w"), 6).alias("top"), F.round(F.sum("w"), 5).alias("total"))


@query(f"WITH RECURSIVE {SEARCH_SQL} SELECT key, pos, round(score, 6) AS score FROM hits WHERE score > 0.03")
def search_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.PassageIndex.build(chunks_of(spark, sf_dir)).search(QUESTION, 6).select("key", "pos", F.round("score", 6).alias("score"))


@query(f"WITH RECURSIVE {SEARCH_SQL} SELECT ch.source, substr(passage, 1, 900) AS text, round(score, 3) AS score FROM hits JOIN ch USING (key, pos) WHERE score > 0.03")
def answer_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = retrieval.PassageIndex.build(chunks_of(spark, sf_dir)).search(QUESTION, 6)
    return found.select("source", F.substring("passage", 1, 900).alias("text"), F.round("score", 3).alias("score"))


@query("SELECT count(DISTINCT source) AS sources, count(*) AS docs FROM documents")
def source_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").agg(F.count_distinct("source").alias("sources"), F.count("*").alias("docs"))


@query("SELECT conv_id, turn, replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;') AS escaped FROM conversations")
def html_escape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "conversations").select("conv_id", "turn", text.html_escape(F.col("text")).alias("escaped"))


@query(r"SELECT page_id, CASE WHEN n = '' THEN 'upload' ELSE n END AS name FROM (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(url, '^.*/', ''), '[^A-Za-z0-9._-]+', '_', 'g'), '^[.]+', '') AS n FROM pages)")
def safe_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "pages").select("page_id", text.safe_name(F.col("url")).alias("name"))


@query("SELECT event_id, CASE event_id % 4 WHEN 3 THEN event_type || ' 2026-01-02' ELSE event_type || ' ' || props END AS message FROM events")
def log_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log lines of three forms, and lines without a prefix, which stay as they are."""
    e, k = load(spark, sf_dir, "events"), F.col("event_id") % 4
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS")
    level = F.element_at(F.array(*map(F.lit, ("INFO", "WARNING", "ERROR"))), (F.col("event_id") % 3 + 1).cast("int"))
    message = F.concat("event_type", F.lit(" "), "props")
    line = F.when(k == 0, F.concat(stamp, F.lit(" "), level, F.lit(" engine.run: "), message)).when(k == 1, F.concat(stamp, F.lit(" ["), level, F.lit("] engine.run: "), message)).when(k == 2, F.concat(F.replace(stamp, F.lit(" "), F.lit("T")), F.lit("  "), level, F.lit("  engine: "), message)).otherwise(F.concat("event_type", F.lit(" 2026-01-02")))
    return e.select("event_id", text.log_message(line).alias("message"))


@query()
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_to_text(load(spark, sf_dir, "pages"), "page_id", "html")


@query("SELECT count(*) AS files, coalesce(sum(n_chars), 0)::BIGINT AS chars FROM (SELECT n_chars, row_number() OVER (ORDER BY source, doc_id) AS k, sum(n_chars) OVER (ORDER BY source, doc_id) AS total FROM documents) WHERE k <= 400 AND total - n_chars < 8000000")
def kb_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.knowledge import within_caps

    d = load(spark, sf_dir, "documents").select(F.concat_ws("/", "source", F.lpad(F.col("doc_id").cast("string"), 12, "0")).alias("path"), F.col("n_chars").alias("length"), "source", "doc_id")
    kept = within_caps(d, 400, 8_000_000, order=("source", "doc_id"))
    return kept.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("chars"))
